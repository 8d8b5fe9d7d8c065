"""Scoring texts with a gated recurrent language model and with word counts.

Tokens are words (A-Z in lower case, between blanks) and one end per text. Words are
known by a 64-bit hash. Counts cover all training texts: every task counts its words, and the
counts meet by hash bucket. They give the base score, with 0.1 added to each count.

The model predicts each token from the states of a gated recurrent layer that starts with
each text and is carried over all its windows. Its output is factored: first the class of
the token, then the token among those of its class. It knows the KNOWN most frequent
tokens; any other is an `other`, times its share of the smoothed counts of all others,
so the probabilities of all words add up to one. It is trained in numpy by backpropagation
truncated to STEPS tokens, on all training texts from their
first token to their end, states carried through each and new in the next.

Training goes in rounds: each takes a share of the training texts (ROUNDS, by hash), and every
text is in one round. In a round each task trains the model on its texts; the next one starts
from the mean of the tasks' models, weighted by their tokens, summed TOGETHER at a time in as many
levels as it takes. Each text is learned from PASSES times, whatever the corpus's size. A score depends
a little on how the files fall into tasks, as each task's model sees the texts of its own.

Counts of frequent words (a HEAD-th of all tokens or more, so HEAD words at most) go to
every task. What remains of a text, its rare words, is looked up where their counts are: by
hash bucket, packed, and summed per row. No bucket can be hot, as rare words are rare.

Null text is empty: one end token. Without training texts every count is 0, and the
model's score is the base score. Repeated rows are scored apart and equal. An empty table
gives an empty table. Only doc_id and text are read.
"""

from __future__ import annotations

import copy
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from parcelsight.llm import gru
from parcelsight.llm.common import crc_of_id, released, sliced, stored, text_of
from parcelsight.llm.shingles import blocks, word_hashes

ADDED = 0.1
HEAD = 1 << 18
KNOWN, CLASSES, HIDDEN = 2_046, 46, 16
#: Texts side by side at most, and updates that a block gets at least if it has the tokens.
#: LONGEST: steps of the last long runs whose states are carried on before their windows are learned.
STREAMS, UPDATES = 512, 64
STEPS, LONGEST, RATE = 20, 1_000, 0.01
#: Where the rounds end, as shares of the training texts; how often each text is learned from.
ROUNDS, PASSES = (1 / 16, 1 / 4, 1), 1
#: Parts of the weights that are summed apart, and models that are summed together.
PARTS, TOGETHER = 16, 64
#: Steps that are scored together (more where few texts are left), and texts side by side.
WINDOW, WIDE = 64, 2_048
#: Rows of a softmax that are worked on together, and bytes of texts.
ROWS, BLOCK_BYTES = 4_096, 8 << 20
#: Corpus bytes per bucket of words.
BUCKET_BYTES = 32 << 20
END = np.uint64(0x5851F42D4C957F2D)


def held_out() -> Column:
    return crc_of_id() % 10 == 0


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in order, ends included, and where each text starts
    (one more: the end of the last)."""
    parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for block in blocks(texts):
        words, owners = word_hashes([t.lower() for t in block])  # bytes: A-Z only
        sizes.append(np.bincount(owners, minlength=len(block)) + 1)
        part = np.full(len(words) + len(block), END)
        part[np.arange(len(words)) + owners] = words
        parts.append(part)
    return np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(sizes)))


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _runs(of_bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket of a sorted array with its places."""
    found, starts = np.unique(of_bucket, return_index=True)
    for bucket, at, end in zip(found.tolist(), starts.tolist(), [*starts.tolist()[1:], len(of_bucket)]):
        yield bucket, slice(at, end)


# Counts of all training tokens


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """A stored table of word hashes and their counts in the training texts, packed: bucket,
    hashes (sorted), counts, and two numbers of each row: words and all their tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4_096):
            found = [np.unique(tokens(b)[0], return_counts=True) for b in blocks(_bytes(batch), 8 << 20)]
            if not found:
                continue
            hashes, counts = _summed(*(np.concatenate(x) for x in zip(*found)))
            of_bucket = _buckets(hashes, buckets)
            order = np.argsort(of_bucket, kind="stable")
            hashes, counts = hashes[order], counts[order]
            rows = [(b, hashes[s].tobytes(), counts[s].tobytes()) for b, s in _runs(of_bucket[order])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], ["bucket", "hashes", "counts"]
            )

    def meet(parts: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = _summed(_joined(parts["hashes"], np.uint64), _joined(parts["counts"], np.int64))
        row = (parts["bucket"].iloc[0], hashes.tobytes(), counts.tobytes(), len(hashes), int(counts.sum()))
        return pd.DataFrame([row], columns=["bucket", "hashes", "counts", "words", "tokens"])

    trained = docs.where(~held_out()).select(text_of().alias("text"))
    counted = trained.mapInArrow(count, "bucket long, hashes binary, counts binary")
    met = counted.groupBy("bucket").applyInPandas(meet, "bucket long, hashes binary, counts binary, words long, tokens long")
    return stored(met, "lm-counts")


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _joined(blobs, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(hashes, return_inverse=True)
    return found, np.bincount(place, counts, len(found)).astype(np.int64)


@dataclass
class Totals:
    """What tasks need of the counts: all tokens and words, and the frequent words."""

    tokens: int
    words: int
    hashes: np.ndarray
    counts: np.ndarray

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of frequent words, -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.counts[place], -1)


def totals(counted: DataFrame, head: int = HEAD) -> Totals:
    sums = counted.agg(F.sum("tokens"), F.sum("words")).first()
    n_tokens, n_words = (int(x or 0) for x in sums)
    least = max(1, -(-n_tokens // head))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(batch.column("hashes"), batch.column("counts")):
                h, c = np.frombuffer(hashes.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.int64)
                often = (c >= least) | (h == END)
                yield pa.RecordBatch.from_arrays([pa.array([h[often].tobytes()]), pa.array([c[often].tobytes()])], ["hashes", "counts"])

    rows = counted.select("hashes", "counts").mapInArrow(frequent, "hashes binary, counts binary").collect()
    h, c = _joined([r["hashes"] for r in rows], np.uint64), _joined([r["counts"] for r in rows], np.int64)
    order = np.argsort(h)
    return Totals(n_tokens, n_words, h[order], c[order])


# The model


@dataclass
class Model:
    """Symbols: the known words by rank (end among them), then `other`."""

    hashes: np.ndarray  # of the known words, sorted
    symbols: np.ndarray  # their symbols
    end: int
    layer: dict[str, np.ndarray]
    out: dict[str, np.ndarray]  # classes, class_bias, words, word_bias
    others: float  # smoothed counts of all other words

    @property
    def other(self) -> int:
        return len(self.hashes)

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.symbols[place], self.other)

    def log_likelihoods(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probability of each text's symbols; states run through whole texts."""
        sizes = np.diff(starts)
        order = np.argsort(-sizes, kind="stable")
        sums = np.zeros(len(sizes))
        before = np.roll(symbols, 1)
        before[starts[:-1]] = self.end
        for at in range(0, len(order), WIDE):
            texts = order[at : at + WIDE]
            state = np.zeros((HIDDEN, len(texts)), np.float32)
            first, last = 0, int(sizes[texts[0]])
            while first < last:
                n = int((sizes[texts] > first).sum())
                texts, state = texts[:n], state[:, :n]
                steps = np.arange(first, min(last, first + max(1, WINDOW * WIDE // n)))[:, None]
                first += len(steps)
                there = steps < sizes[texts]
                places = np.where(there, starts[texts] + steps, 0)
                states = gru.states(self.layer, before[places], np.ascontiguousarray(state))
                state = states[-1]
                seen = states.transpose(0, 2, 1)[there]
                values = self._log_probabilities(seen, symbols[places[there]])
                sums[texts] += np.bincount(np.nonzero(there)[1], values, n)
        return sums

    def placed(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and place in it of each symbol. `other` is a class of its own, the last one."""
        classes, places = np.divmod(symbols.astype(np.int16), np.int16(self.out["words"].shape[1]))
        classes[symbols == self.other] = CLASSES
        return classes, places

    def _log_probabilities(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        classes, places = self.placed(symbols)
        order = np.argsort(classes, kind="stable")
        states, places, classes = states[order], places[order], classes[order]
        sums = _picked(states, self.out["classes"], self.out["class_bias"], classes)
        for c, run in _runs(classes):
            if c == CLASSES:  # its one member is certain
                continue
            sums[run] += _picked(states[run], self.out["words"][c], self.out["word_bias"][c], places[run])
        out = np.empty_like(sums)
        out[order] = sums
        return out


def _picked(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Log softmax at the given places, by row. States lie between -1 and 1, which keeps the
    logits in the range of the exponential."""
    out = np.empty(len(places), np.float32)
    for at in range(0, len(places), ROWS):
        part = slice(at, at + ROWS)
        logits = states[part] @ weights.T
        logits += bias
        chosen = logits[np.arange(len(logits)), places[part]]
        np.exp(logits, out=logits)
        out[part] = chosen - np.log(logits.sum(1))
    return out


def new_model(total: Totals, seed: int = 3) -> Model:
    rng = np.random.default_rng(seed)
    ranked = np.lexsort((total.hashes, -total.counts))[:KNOWN]
    if END not in total.hashes[ranked]:  # the end is known in any case
        ranked = np.append(ranked[: KNOWN - 1], np.searchsorted(total.hashes, END))
    hashes, counts = total.hashes[ranked], total.counts[ranked]
    order = np.argsort(hashes)
    size = -(-len(hashes) // CLASSES)
    used = np.arange(CLASSES * size).reshape(CLASSES, size) < len(hashes)
    prior = np.full(CLASSES * size, -30.0)
    prior[: len(counts)] = np.log(counts / max(1, total.tokens))
    prior = prior.reshape(CLASSES, size)
    most = prior.max(1, keepdims=True)
    of_other = np.log(max(1, total.tokens - counts.sum()) / max(1, total.tokens))
    out = {
        "classes": np.zeros((CLASSES + 1, HIDDEN)),
        "class_bias": np.append((most + np.log(np.exp(prior - most).sum(1, keepdims=True)))[:, 0], of_other),
        "words": rng.normal(0, 0.05, (CLASSES, size, HIDDEN)) * used[..., None],
        "word_bias": prior,
    }
    return Model(
        hashes[order],
        order,
        int(np.flatnonzero(hashes == END)[0]),
        gru.new_layer(rng, len(hashes) + 1, HIDDEN),
        {k: v.astype(np.float32) for k, v in out.items()},
        float(total.tokens - counts.sum() + ADDED * (total.words - len(hashes) + 1)),
    )


class Trainer:
    """Truncated backpropagation over STREAMS runs of whole texts, in place.

    Each text goes to the run that has least to do, long ones first. All runs move on by STEPS
    tokens while each has as many; `finish` takes what is left of them."""

    def __init__(self, model: Model, rate: float = RATE):
        self.model, self.tokens = model, 0
        self.tuned = gru.Adam(_weights(model), rate)
        self.waiting: list[np.ndarray] = []

    def feed(self, symbols: np.ndarray) -> None:
        """Learn from texts one after the other, each with its end."""
        if not len(symbols):
            return
        self.tokens += len(symbols)
        if not self.waiting:
            n = max(1, min(STREAMS, len(symbols) // (STEPS * UPDATES)))
            self.waiting = [np.zeros(0, np.int64)] * n
            self.last, self.state = np.full(n, self.model.end), np.zeros((HIDDEN, n), np.float32)
        edges = np.flatnonzero(symbols[:-1] == self.model.end) + 1
        own: list[list[np.ndarray]] = [[w] for w in self.waiting]
        load = [(len(w), i) for i, w in enumerate(self.waiting)]
        heapq.heapify(load)
        for text in sorted(np.split(symbols, edges), key=len, reverse=True):
            size, i = load[0]
            own[i].append(text)
            heapq.heapreplace(load, (size + len(text), i))
        self.waiting = [np.concatenate(x) for x in own]
        every = np.arange(len(own))
        sizes = np.array([len(w) for w in self.waiting])
        for _ in range(sizes.min() // STEPS):
            self._step(every, STEPS)

    def finish(self) -> None:
        """What is left is a few long runs, too few for good use of a step. So their states are
        carried on first, and then their windows of STEPS tokens learn side by side, each from
        the state that it starts with."""
        windows = sum(-(-len(w) // STEPS) for w in self.waiting)
        wide = max(1, min(STREAMS, windows // UPDATES))
        while True:
            sizes = np.array([len(w) for w in self.waiting])
            runs = np.flatnonzero(sizes)
            if not len(runs):
                return
            runs = runs[np.argsort(-sizes[runs], kind="stable")]
            steps = min(LONGEST, -(-int(sizes.max()) // STEPS) * STEPS)
            before, after, there, kept = self._taken(runs, steps)
            state, starts = self.state[:, runs], []
            for at in range(0, steps, STEPS):
                n = int(there[at].sum())  # the runs that go on are the first ones
                starts.append(state[:, :n])
                part = slice(at, at + STEPS)
                state = gru.states(self.model.layer, before[part, :n], np.ascontiguousarray(state[:, :n]), kept[part, :n])[-1]
            # Runs that went on to the end of what was taken may have more.
            self.state[:, runs[: state.shape[1]]] = state
            columns = [(at * STEPS, j) for at, own in enumerate(starts) for j in range(own.shape[1])]
            state = np.concatenate(starts, axis=1)
            row, column = np.array(columns).T
            for first in range(0, len(columns), wide):
                chosen = slice(first, first + wide)
                place = row[chosen][None] + np.arange(STEPS)[:, None], column[chosen][None]
                own = np.ascontiguousarray(state[:, chosen])
                grads, _ = _gradients(self.model, before[place], after[place], own, kept[place], there[place])
                self.tuned.step(grads, self._rate())

    def _rate(self) -> float:
        return 1 / (1 + self.tuned.steps / 200)

    def _taken(self, runs: np.ndarray, steps: int):
        """The next tokens of the runs: before, after, whether there is one, and whether the state
        is kept; steps x runs."""
        after, there = np.zeros((steps, len(runs)), np.int64), np.zeros((steps, len(runs)), bool)
        for j, i in enumerate(runs.tolist()):
            part, self.waiting[i] = self.waiting[i][:steps], self.waiting[i][steps:]
            after[: len(part), j], there[: len(part), j] = part, True
        before = np.vstack([self.last[runs][None], after[:-1]])
        self.last[runs] = after[-1]
        return before, after, there, (before != self.model.end).astype(np.float32)

    def _step(self, runs: np.ndarray, steps: int) -> None:
        before, after, there, kept = self._taken(runs, steps)
        grads, self.state[:, runs] = _gradients(self.model, before, after, self.state[:, runs], kept, there)
        self.tuned.step(grads, self._rate())


def _weights(model: Model) -> dict[str, np.ndarray]:
    return {f"layer.{k}": w for k, w in model.layer.items()} | {f"out.{k}": w for k, w in model.out.items()}


def train(model: Model, symbols: np.ndarray, epochs: int = 1) -> None:
    """Learn from texts one after the other, each with its end, in place."""
    trainer = Trainer(model)
    for _ in range(epochs):
        trainer.feed(symbols)
    trainer.finish()


def _gradients(model: Model, before: np.ndarray, after: np.ndarray, state: np.ndarray, kept=None, there=None):
    """Gradients of the mean loss and the last states. kept: 0 where a text starts; there: False
    where a run has no more tokens. Both steps x runs, as before and after."""
    there = np.ones(after.shape, bool) if there is None else there
    states, tape = gru.states_and_tape(model.layer, before, state, kept)
    seen = states.transpose(0, 2, 1)[there]
    classes, places = model.placed(after[there])
    n = len(classes)
    wrong = _softmax(seen @ model.out["classes"].T + model.out["class_bias"])
    wrong[np.arange(n), classes] -= 1
    of_seen = wrong @ model.out["classes"]
    grads = {k: np.zeros_like(w) for k, w in model.out.items()}
    grads["classes"], grads["class_bias"] = wrong.T @ seen, wrong.sum(0)
    order = np.argsort(classes, kind="stable")
    for c, run in _runs(classes[order]):
        if c == CLASSES:  # its one member is certain: nothing to learn
            continue
        rows = order[run]
        here, words = seen[rows], model.out["words"][c]
        off = _softmax(here @ words.T + model.out["word_bias"][c])
        off[np.arange(len(rows)), places[rows]] -= 1
        grads["words"][c], grads["word_bias"][c] = off.T @ here, off.sum(0)
        of_seen[rows] += off @ words
    of_states = np.zeros((*after.shape, HIDDEN), np.float32)
    of_states[there] = of_seen / n
    grads = {f"out.{k}": g / n for k, g in grads.items()}
    of_layer = gru.gradients(model.layer, before, tape, of_states.transpose(0, 2, 1), kept)
    grads |= {f"layer.{k}": g for k, g in of_layer.items()}
    return {k: g.astype(np.float32) for k, g in grads.items()}, states[-1]


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def fit(docs: DataFrame, total: Totals, passes: int = PASSES) -> Model | None:
    """The trained model; None without training texts. passes: how often each text is learned from."""
    if not total.tokens:
        return None
    model = new_model(total)
    place = F.pmod(F.xxhash64(F.lit("model rounds"), "doc_id", "text"), F.lit(1 << 32)) / float(1 << 32)
    rows = docs.where(~held_out()).select("doc_id", text_of().alias("text")).select("text", place.alias("place"))
    first = 0.0
    for i, last in enumerate(ROUNDS):
        _round(model, rows.where((F.col("place") >= first) & (F.col("place") < last)).select("text"), passes, RATE / (1 + i))
        first = last
    return model


def _round(model: Model, texts: DataFrame, passes: int, rate: float) -> None:
    """Train the model on texts in every task; it becomes the mean of the tasks' models."""
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(sent.value)
        trainer = Trainer(own, rate)
        for batch in sliced(batches, 2_048):
            for block in blocks(_bytes(batch), BLOCK_BYTES):
                symbols = own.symbols_of(tokens(block)[0])
                for _ in range(passes):
                    trainer.feed(symbols)
        if trainer.tokens:
            trainer.finish()
            parts = np.array_split(np.concatenate([w.ravel() for w in _weights(own).values()]), PARTS)
            made = [range(PARTS), [TaskContext.get().partitionId()] * PARTS, [trainer.tokens] * PARTS, [p.tobytes() for p in parts]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(made, kinds)], ["part", "task", "tokens", "weights"])

    kinds = "part long, task long, tokens long, weights binary"
    learned = stored(texts.mapInArrow(lambda batches: released(learn(batches)), kinds), "lm-learned")
    many = (learned.agg(F.max("task")).first()[0] or 0) + 1
    while many > 1:
        learned = learned.withColumn("task", F.floor(F.col("task") / TOGETHER).cast("long"))
        learned, many = learned.groupBy("part", "task").applyInPandas(_mean, kinds), -(-many // TOGETHER)
    rows = sorted((r["part"], r["weights"]) for r in learned.collect())
    if rows:
        found, at = _joined([w for _, w in rows], np.float32), 0
        for w in _weights(model).values():
            w[...] = found[at : at + w.size].reshape(w.shape)
            at += w.size


def _mean(models: pd.DataFrame) -> pd.DataFrame:
    """The mean of one part of some models, weighted by their tokens."""
    models = models.sort_values(["tokens", "weights"])  # the same sums in every run
    total = models["tokens"].sum()
    sums = sum(n / total * np.frombuffer(w, np.float32).astype(np.float64) for n, w in zip(models["tokens"], models["weights"]))
    made = (models["part"].iloc[0], models["task"].iloc[0], total, sums.astype(np.float32).tobytes())
    return pd.DataFrame([made], columns=["part", "task", "tokens", "weights"])


# Scores

#: monotonically_increasing_id has the number of the row within its task in the lower bits.
_TASK_BITS = 33
_DOC = "row long, doc_id {id}, n_tokens long, n_known long, logs double, other_logs double, model double"
_RARE = "bucket long, rows binary, hashes binary"


def scores(docs: DataFrame, total: Totals, model: Model | None, counted: DataFrame, buckets: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((total, model))
    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    id_kind = given.schema["doc_id"].dataType.simpleString()
    doc_names = [part.split()[0] for part in _DOC.split(", ")]
    rare_names = [part.split()[0] for part in _RARE.split(", ")]
    types = {"row": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "bucket": pa.int64(), "rows": pa.binary(), "hashes": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, model = sent.value
        for batch in sliced(batches, 2_048):
            made, rare = _scored(_bytes(batch), batch.column("row").to_numpy(), total, model, buckets)
            n, extra = batch.num_rows, len(rare)
            columns = [
                pa.concat_arrays([batch.column(c), pa.nulls(extra, batch.column(c).type)]) for c in ("row", "doc_id")
            ] + [pa.concat_arrays([pa.array(made[c], types.get(c, pa.float64())), pa.nulls(extra, types.get(c, pa.float64()))]) for c in doc_names[2:]]
            columns += [
                pa.concat_arrays([pa.nulls(n, types[c]), pa.array([r[i] for r in rare], types[c])]) for i, c in enumerate(rare_names)
            ]
            yield pa.RecordBatch.from_arrays(columns, [*doc_names, *rare_names])

    made = stored(given.mapInArrow(run, f"{_DOC.format(id=id_kind)}, {_RARE}"), "lm-scores")
    texts = made.where("row is not null").drop(*rare_names)
    rare = made.where("bucket is not null").select(*rare_names)
    looked_up = rare.groupBy("bucket").cogroup(counted.select("bucket", "hashes", "counts").groupBy("bucket"))
    sums = looked_up.applyInPandas(_rare_sums, "task long, rows binary, known binary, logs binary")
    sums = sums.groupBy("task").applyInPandas(_row_sums, "row long, rare_known long, rare_logs double")
    joined = texts.join(sums, "row", "left").fillna(0, ["rare_known", "rare_logs"])
    norm = float(np.log10(total.tokens + ADDED * (total.words + 1)))
    base = F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * F.lit(norm)
    score = F.col("model") + F.col("other_logs") + F.col("rare_logs") if model else base
    return joined.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(total.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )


def _scored(texts: list[bytes], rows: np.ndarray, total: Totals, model: Model | None, buckets: int):
    """Sums over each text's frequent words, its model score, and its rare words by bucket.

    logs: log10 of smoothed counts; other_logs: the same for words the model does not know."""
    made: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "logs", "other_logs", "model")}
    rare_rows, rare_hashes = [], []
    at = 0
    for block in blocks(texts, BLOCK_BYTES):
        hashes, starts = tokens(block)
        sizes, n = np.diff(starts), len(block)
        owners = np.repeat(np.arange(n), sizes)
        counts = total.lookup(hashes)
        known = counts > 0
        logs = np.where(known, np.log10(np.maximum(counts, 0) + ADDED), 0.0)
        made["n_tokens"] += sizes.tolist()
        made["n_known"] += np.bincount(owners, known, n).astype(np.int64).tolist()
        made["logs"] += np.bincount(owners, logs, n).tolist()
        if model:
            symbols = model.symbols_of(hashes)
            other = symbols == model.other
            made["other_logs"] += np.bincount(owners, np.where(other, logs - np.log10(model.others), 0.0), n).tolist()
            made["model"] += (model.log_likelihoods(symbols, starts) / np.log(10)).tolist()
        else:
            made["other_logs"] += [0.0] * n
            made["model"] += [0.0] * n
        rare_rows.append(rows[at : at + n][owners[~known]])
        rare_hashes.append(hashes[~known])
        at += n
    packed = []
    if rare_rows:
        of_row, hashes = np.concatenate(rare_rows), np.concatenate(rare_hashes)
        of_bucket = _buckets(hashes, buckets)
        order = np.argsort(of_bucket, kind="stable")
        of_row, hashes = of_row[order].astype(np.int64), hashes[order]
        packed = [(b, of_row[s].tobytes(), hashes[s].tobytes()) for b, s in _runs(of_bucket[order])]
    return made, packed


def _rare_sums(rare: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """Per row that has words of a bucket: tokens with a count, and the sum of log10 of smoothed
    counts; packed by the task that numbered the rows."""
    rows, hashes = _joined(rare["rows"], np.int64), _joined(rare["hashes"], np.uint64)
    known, counts = _joined(counted["hashes"], np.uint64), _joined(counted["counts"], np.int64)
    found = np.zeros(len(hashes), np.int64)
    if len(known):
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        found = np.where(known[place] == hashes, counts[place], 0)
    which, n_known, logs = _by_row(rows, found > 0, np.log10(found + ADDED))
    packed = [
        (task, which[s].tobytes(), n_known[s].tobytes(), logs[s].tobytes())
        for task, s in _runs(which >> _TASK_BITS)
    ]
    return pd.DataFrame(packed, columns=["task", "rows", "known", "logs"])


def _row_sums(parts: pd.DataFrame) -> pd.DataFrame:
    """The sums of each row of a task over all buckets."""
    rows = _joined(parts["rows"], np.int64)
    which, n_known, logs = _by_row(rows, _joined(parts["known"], np.float64), _joined(parts["logs"], np.float64))
    return pd.DataFrame({"row": which, "rare_known": n_known.astype(np.int64), "rare_logs": logs})


def _by_row(rows: np.ndarray, known: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    which, place = np.unique(rows, return_inverse=True)
    n = len(which)
    return which, np.bincount(place, known, n), np.bincount(place, logs, n)


def scored(docs: DataFrame) -> DataFrame:
    """Counts, model and scores of all rows of docs."""
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    buckets = max(12, -(-size // BUCKET_BYTES))
    counted = word_counts(docs, buckets)
    total = totals(counted)
    return scores(docs, total, fit(docs, total), counted, buckets)
