"""Backtracking BPE against tiktoken."""

import hashlib
import time

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelsight.llm import bpe

CODEC = bpe.codec(public_tokenizers.path(bpe.RANKS))
PEER = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={}
)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text("ab ne'st\n\t.,1é日 "))
def test_ids_equal_those_of_the_library(text):
    ids = CODEC.encode(text)
    assert ids == PEER.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "a" * 20_000, "ab" * 3_000, "<|endoftext|>", "  x  \n y", "é" * 999])
def test_odd_texts(text):
    assert CODEC.encode(text) == PEER.encode_ordinary(text)


def test_a_full_memo_changes_nothing(documents):
    small = bpe.Codec(CODEC.ranks, memo=50)
    for _, text, _, _ in documents[:40]:
        assert small.encode(text) == PEER.encode_ordinary(text)


def test_a_vocabulary_out_of_order_is_refused():
    own = bpe.Codec({b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"bc": 4})
    with pytest.raises(ValueError):
        own.encode("abcabc")


def test_every_token_of_the_vocabulary_is_a_merge():
    assert all(len(CODEC._parts(token)) <= 2 for token in CODEC.bytes)


def test_compatible_means_that_merging_both_gives_both():
    tokens = [CODEC.ranks[t] for t in (b"th", b"e", b"the", b" t", b"he", b"in", b"g", b"ing", b"s", b"h")]
    for a in tokens:
        for b in tokens:
            assert CODEC.compatible(a, b) == (bpe.merge(CODEC.bytes[a] + CODEC.bytes[b], CODEC.ranks) == [a, b])


def test_the_query_is_the_library_on_every_document(spark, documents, table):
    rows = [*documents, (9_001, None, "en", "s"), (9_002, "", "en", "s"), (9_001, None, "en", "s")]
    got = sorted(tuple(r) for r in bpe.round_trip(table(rows)).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc_id, text, _, _ in rows:
        ids = PEER.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert got == sorted(want)


def test_columns_stay_and_clashes_are_refused(table):
    docs = table([(1, "one two"), (2, None)])
    made = {r.doc_id: r for r in bpe.decode(bpe.encode(docs)).collect()}
    assert made[1].n_chars == 7 and bytes(made[1].decoded) == b"one two"
    assert made[2].ids == [] and bytes(made[2].decoded) == b""
    checked = {r.doc_id: r for r in bpe.encode(docs, ids="own", round_trip="same", memo=1).collect()}
    assert checked[1].own == made[1].ids and checked[1].same and checked[2].same
    with pytest.raises(ValueError):
        bpe.encode(docs, ids="n_chars")
    assert bpe.round_trip(table([])).collect() == []


def test_a_memo_keeps_what_is_asked_for_and_its_bound():
    memo = bpe.Memo(10)
    for i in range(2_000):
        for text in ("hot", f"rare {i}"):
            if memo.young.get(text) is None and memo.aged(text) is None:
                memo.offer(text, (i,))
        assert len(memo.young) + len(memo.old) <= 10
    assert memo.young.get("hot") or memo.aged("hot")
    for _ in range(2):
        for i in range(30):
            memo.offer(f"often {i}", (i,))
            assert len(memo.young) + len(memo.old) <= 10
    memo.forget()
    assert not memo.young and not memo.old and not any(memo.met)


def test_names_clash_in_any_case(table):
    with pytest.raises(ValueError, match="ids"):
        bpe.encode(table([(1, "a")]).withColumnRenamed("lang", "IDS"))


def each(codec, texts):
    ids, starts = codec.encode_all(texts)
    assert len(starts) == len(texts) + 1 and starts[0] == 0 and starts[-1] == len(ids)
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


ODD = ["one two, two", None, "", " ", "  one", "one  two\n\n two", "\x1cone \x1ctwo", "one\n two's 's", "日本 é one", " two", "two ", "x" * 99 + " é" * 9]


@pytest.mark.parametrize("memo", [1, 50])
def test_texts_encoded_together_are_as_each_alone(memo):
    small = bpe.Codec(CODEC.ranks, memo=memo)
    texts = pa.array(ODD * 3, pa.string())
    want = [PEER.encode_ordinary(x or "") for x in ODD * 3]
    assert each(small, texts) == want
    assert each(small, texts.slice(5, 20)) == want[5:25]
    assert each(small, texts.cast(pa.large_string())) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text("ab ne'st\n\t.,1é日\x1c\u2003 "), min_size=1, max_size=8))
def test_any_texts_encoded_together_are_as_each_alone(texts):
    assert each(CODEC, pa.array(texts, pa.string())) == [PEER.encode_ordinary(x or "") for x in texts]


def test_a_word_of_many_texts_is_encoded_once(monkeypatch):
    words = [f"{a}{b}" for a in ("thand", "reeatin", "onshwh") for b in ("ou", "tion.", "nted,", "éa")]
    met = []
    plain = bpe.Codec.encode_word
    monkeypatch.setattr(bpe.Codec, "encode_word", lambda own, word: met.append(word) or plain(own, word))
    own = bpe.Codec(CODEC.ranks, memo=1)  # so that nothing is remembered from text to text
    texts = [" ".join(["the", *words[i % 12 :], *words[: i % 12]]) for i in range(200)]
    assert each(own, pa.array(texts)) == [PEER.encode_ordinary(x) for x in texts]
    rare = [w for w in met if len(w) > 3]
    assert len(rare) == len(set(rare)) == 12


def test_what_fits_after_a_token_is_found_once(monkeypatch):
    asked = []
    plain = bpe.Codec._compatible
    monkeypatch.setattr(bpe.Codec, "_compatible", lambda own, a, b: asked.append((a, b)) or plain(own, a, b))
    own = bpe.Codec(CODEC.ranks, memo=5_000)
    words = [f" {a}{b}{c}" for a in ("thand", "reeat", "onshwh") for b in ("in", "tion", "ble") for c in ("ou", "er")]
    for word in words:
        assert own.encode_word(word) == PEER.encode_ordinary(word)
    once = len(asked)
    for word in words:
        own.encode_word(word)
    assert len(asked) == once


def test_batches_are_bounded_and_keep_their_rows(monkeypatch):
    monkeypatch.setattr(bpe, "ROWS_AT_ONCE", 4)
    monkeypatch.setattr(bpe, "BYTES_AT_ONCE", 10)
    texts = ["a" * n for n in (1, 2, 3, 1, 1, 30, 9, 1, 1, 0)] + [None, "é" * 5, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    made = [b.column("text").to_pylist() for b in bpe.bounded(iter([batch, batch.slice(0, 0), batch.slice(4)]), "text")]
    assert [x for b in made for x in b] == texts + texts[4:]
    for b in made:
        assert 0 < len(b) <= 4 and (len(b) == 1 or sum(len((x or "").encode()) for x in b) <= 10)


def test_work_on_a_long_unit_of_many_words_is_in_proportion():
    def seconds(n):
        text = "one " + "a1é," * n
        own = bpe.Codec(CODEC.ranks)
        start = time.process_time()
        assert len(own.encode(text)) >= 4 * n
        return time.process_time() - start

    assert seconds(200_000) < 30 * max(0.1, seconds(20_000))
