"""Cached token counts against sentencepiece."""

import public_tokenizers
from parcelsight.llm import counts
from parcelsight.llm.common import shared_folder

MODEL = counts.tokenizer(public_tokenizers.path(counts.MODEL))


def test_counts_equal_those_of_the_library(documents, table):
    rows = [*documents, (9_001, None), (9_002, ""), (9_003, "  a\n\n b <s> </s> é日"), (1, "repeated"), (1, "repeated")]
    got = sorted(tuple(r) for r in counts.token_counts(table(rows)).collect())
    assert got == sorted((r[0], len((r[1] or "").encode()), len(MODEL.encode(r[1] or ""))) for r in rows)


def test_only_distinct_misses_are_encoded_and_appended(spark, table, monkeypatch):
    cache = shared_folder(spark, "test-cache")
    first = table([(1, "a b"), (2, "a b"), (3, "c")])
    counts.token_counts(first, cache).collect()
    held = lambda: spark.read.schema(counts.CACHE).parquet(cache).count()
    assert held() == 2
    more = table([(4, "a b"), (5, "d"), (6, None)])
    assert {r.doc_id: r.n_tokens for r in counts.token_counts(more, cache).collect()} == {4: len(MODEL.encode("a b")), 5: len(MODEL.encode("d")), 6: 0}
    assert held() == 4
    counts.token_counts(more, cache).collect()
    assert held() == 4
    # Another tokenizer never meets these counts.
    monkeypatch.setattr(counts, "tokenizer_digest", lambda path: "another")
    counts.token_counts(more, cache).collect()
    assert held() == 7


def test_an_empty_table(table):
    assert counts.token_counts(table([])).collect() == []
