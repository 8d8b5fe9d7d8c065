"""Language model scores: counts by hand, probabilities that add up, carried states."""

import uuid
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from conftest_llm import plain_words
from parcelsight.llm import gru, lm
from parcelsight.llm.common import shared_folder


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    """(doc_id, held_out, n_tokens, n_known, N) and base score of each (doc_id, text)."""
    tokens = [[*plain_words(lowered(r[1])), "\0"] for r in rows]
    held = [zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]
    count = Counter(t for own, out in zip(tokens, held) if not out for t in own)
    n = sum(count.values())
    norm = np.log10(n + 0.1 * (len(count) + 1))
    return sorted(
        (r[0], out, len(own), sum(count[t] > 0 for t in own), n, sum(np.log10(count[t] + 0.1) - norm for t in own))
        for r, out, own in zip(rows, held, tokens)
    )


def compare(df, rows):
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect())
    want = plain(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(g[6] < 0 for g in got)
    return got


def test_base_scores_and_counts(documents, table, monkeypatch):
    rows = [(d, t) for d, t, _, _ in documents] + [(9_001, None), (9_002, ""), (9_003, "ÀB aB\vab"), (9_003, "ÀB aB\vab")]
    monkeypatch.setattr(lm, "HEAD", 500)  # most words are rare ones
    whole = compare(lm.scored(table(rows)), rows)
    better = sum(r[6] for r in whole) > sum(r[5] for r in whole)
    assert better


def test_rare_words_are_summed_per_row(table):
    rows = [(i, f"common words and w{i % 7} rare{i} rare{i}") for i in range(60)]
    docs = table(rows)
    counted = lm.word_counts(docs, 12)
    total = lm.totals(counted, head=20)
    assert len(total.hashes) <= 20
    compare(lm.scores(docs, total, None, counted, 12), rows)


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}".encode() for i in range(70)]
    hashes, _ = lm.tokens([b" ".join(words)])
    hashes = np.sort(np.unique(hashes))
    total = lm.Totals(1_000, 80, hashes, rng.integers(1, 30, len(hashes)))
    model = lm.new_model(total, seed)
    model.out["words"] += rng.normal(0, 0.3, model.out["words"].shape).astype(np.float32)
    return model


def test_probabilities_of_all_symbols_add_up():
    model = small_model()
    n = len(model.hashes) + 1
    state = np.random.default_rng(2).normal(size=(1, lm.HIDDEN)).astype(np.float32)
    each = model._log_probabilities(np.repeat(state, n, 0), np.arange(n))
    assert np.exp(each).sum() == pytest.approx(1, abs=1e-4)


def test_states_are_carried_through_whole_texts(monkeypatch):
    model = small_model()
    rng = np.random.default_rng(4)
    sizes = [1, 5, 130, 64, 65, 2, 300]
    symbols = rng.integers(0, len(model.hashes) + 1, sum(sizes))
    starts = np.append(0, np.cumsum(sizes))
    whole = model.log_likelihoods(symbols, starts)
    for window, wide in ((1, 2), (7, 3), (1_000, 1), (1, 1)):
        monkeypatch.setattr(lm, "WINDOW", window)
        monkeypatch.setattr(lm, "WIDE", wide)
        assert model.log_likelihoods(symbols, starts) == pytest.approx(whole, rel=1e-4)
    one = slice(starts[2], starts[3])
    before = np.append(model.end, symbols[one][:-1])
    states = gru.states(model.layer, before[:, None], np.zeros((lm.HIDDEN, 1), np.float32))[:, :, 0]
    assert model._log_probabilities(states, symbols[one]).sum() == pytest.approx(whole[2], rel=1e-4)


def test_gradients_of_the_output_equal_differences():
    model = small_model()
    rng = np.random.default_rng(5)
    before, after = rng.integers(0, 70, (4, 6)), rng.integers(0, 70, (4, 6))
    start = np.zeros((lm.HIDDEN, 6), np.float32)

    def loss():
        states = gru.states(model.layer, before, start).transpose(0, 2, 1).reshape(-1, lm.HIDDEN)
        return -float(model._log_probabilities(states, after.ravel()).astype(np.float64).mean())

    grads, _ = lm._gradients(model, before, after, start)
    for part, weights in (("layer", model.layer), ("out", model.out)):
        for name, w in weights.items():
            grad = grads[f"{part}.{name}"]
            place = np.unravel_index(np.abs(grad).argmax(), grad.shape)
            old = w[place]
            w[place] = old + 0.02
            up = loss()
            w[place] = old - 0.02
            down = loss()
            w[place] = old
            assert (up - down) / 0.04 == pytest.approx(grad[place], rel=0.05, abs=2e-4)


def test_training_lowers_the_loss():
    model = small_model()
    symbols = np.tile(np.arange(10), 2_000)
    before = model.log_likelihoods(symbols[:500], np.array([0, 500]))[0]
    lm.train(model, symbols, epochs=12)
    assert model.log_likelihoods(symbols[:500], np.array([0, 500]))[0] > before / 3


def test_the_model_knows_the_2046_most_frequent_words():
    rng = np.random.default_rng(7)
    hashes = np.unique(np.append(rng.integers(0, 1 << 63, 5_000).astype(np.uint64), lm.END))
    counts = rng.permutation(len(hashes)) + 1
    model = lm.new_model(lm.Totals(int(counts.sum()), len(hashes), hashes, counts))
    often = hashes[np.argsort(-counts)[:2_045]]
    assert len(model.hashes) >= 2_046 and (model.symbols_of(often) != model.other).all()


def test_training_starts_each_text_anew_and_takes_it_whole(monkeypatch):
    """Runs of texts give the gradients of the texts apart, whatever the windows leave over."""
    model = small_model()
    rng = np.random.default_rng(6)
    words = np.delete(np.arange(70), model.end)
    texts = [np.append(rng.choice(words, n), model.end) for n in (3, 1, 7, 2, 40, 5)]
    one = np.concatenate(texts)[:, None]
    before = np.vstack([[[model.end]], one[:-1]])
    start = np.zeros((lm.HIDDEN, 1), np.float32)
    grads, _ = lm._gradients(model, before, one, start, (before != model.end).astype(np.float32))
    apart = 0
    for text in texts:
        own = text[:, None]
        found, _ = lm._gradients(model, np.vstack([[[model.end]], own[:-1]]), own, start)
        apart = {k: g * len(text) + (apart[k] if apart else 0) for k, g in found.items()}
    assert all(np.allclose(g * len(one), apart[k], atol=1e-3) for k, g in grads.items())

    seen = []
    step = lm._gradients
    monkeypatch.setattr(lm, "_gradients", lambda m, b, a, s, k, t: (seen.append((b[t], a[t])), step(m, b, a, s, k, t))[1])
    lm.train(model, np.concatenate(texts))
    got = sorted((b, a) for before, after in seen for b, a in zip(before.tolist(), after.tolist()))
    assert got == sorted(zip(before[:, 0].tolist(), one[:, 0].tolist()))


def test_every_training_text_is_learned_from_once(table, monkeypatch):
    """In short and long texts, past any bound on texts or signs; held-out ones are not."""
    rows = [(i, f"t{i} " + "word " * (3_000 if i % 9 == 4 else 3)) for i in range(120)] + [(None, "no id")] * 3
    docs = table(rows)
    folder = shared_folder(docs.sparkSession, "t-seen").removeprefix("file:")
    Path(folder).mkdir(parents=True)

    class Seen(lm.Trainer):
        def feed(self, symbols):
            with open(f"{folder}/{uuid.uuid4().hex}", "wb") as out:
                out.write(self.model.names[symbols].tobytes())

        def finish(self):
            self.tokens = 0

    counted = lm.word_counts(docs, 3)
    total = lm.totals(counted)
    made = lm.new_model

    def named(total):
        model = made(total)
        model.names = np.zeros(len(model.hashes) + 1, np.uint64)
        model.names[model.symbols] = model.hashes
        return model

    monkeypatch.setattr(lm, "new_model", named)
    monkeypatch.setattr(lm, "Trainer", Seen)
    lm.fit(docs, total)
    seen = np.concatenate([np.frombuffer(f.read_bytes(), np.uint64) for f in Path(folder).iterdir()])
    want = lm.tokens([t.encode() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10])[0]
    assert sorted(seen.tolist()) == sorted(want.tolist())


def test_short_corpora_are_learned_from(table):
    rows = [(i, "one two three four " * 10) for i in range(1, 9)]
    docs = table(rows)
    total = lm.totals(lm.word_counts(docs, 3))
    assert total.tokens < 1_280
    before, after = lm.new_model(total), lm.fit(docs, total, passes=8)
    hashes, starts = lm.tokens([rows[0][1].encode()])
    loss = lambda m: -m.log_likelihoods(m.symbols_of(hashes), starts)[0]
    assert loss(after) < 0.8 * loss(before)


def test_nothing_to_learn_from(table):
    assert lm.scored(table([])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (row,) = lm.scored(table([(held, "two words")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == row.base_score == pytest.approx(0)
