"""Token counts with a cache of digests.

The cache is a table of (text digest, tokenizer digest, number of tokens) in a folder.
Texts are joined to it by both digests; only distinct texts without a stored count are
encoded, and their counts are appended to the cache. The tokenizer digest covers the
model file and the version of the library, so a change of either never meets old counts.

Normalising must not change a count. This model encodes text as it is (no Unicode
normal form, blanks kept), so only null is made empty. Appends are one write of new files; a
run that is repeated after a loss may append a count twice, and readers take one of
them, as they are equal. Two rows of one text are encoded once. Empty tables give empty
tables, other columns are kept out of the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from parcelsight.llm.common import shared_folder, stored, text_of

MODEL = "piece_bpe_32k.model"
LIMIT = 4_096
CACHE = "text_digest binary, tokenizer_digest string, n_tokens long"


@lru_cache(maxsize=2)
def tokenizer(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as model:
        return hashlib.sha256(model.read() + sentencepiece.__version__.encode()).hexdigest()


def normalised(text: str = "text") -> Column:
    return text_of(text)


def _encoded(misses: DataFrame, path: str, version: str) -> DataFrame:
    """Cache rows for distinct texts (text_digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            counts = [len(own.encode(x.as_py())) for x in batch.column("text")]
            made = [pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("text_digest"), *made], ["text_digest", "tokenizer_digest", "n_tokens"])

    return misses.select("text_digest", "text").mapInArrow(run, CACHE)


def token_counts(docs: DataFrame, cache: str | None = None, model: str | None = None) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row of docs. cache: its folder; without one, a new
    cache is made in the shared folder."""
    spark = docs.sparkSession
    path = model or public_tokenizers.path(MODEL)
    version = tokenizer_digest(path)
    cache = cache or shared_folder(spark, "token-counts")
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    text = normalised()
    digest = F.unhex(F.sha2(text, 256))
    rows = stored(docs.select("doc_id", digest.alias("text_digest"), F.octet_length(text).cast("long").alias("n_bytes")), "count-rows")

    def known() -> DataFrame:
        own = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_digest") == version)
        return own.groupBy("text_digest").agg(F.max("n_tokens").alias("n_tokens"))

    new = rows.join(known(), "text_digest", "left_anti")
    # One row stands for each new text; a repeated row may bring its text twice.
    holders = new.groupBy("text_digest").agg(F.min("doc_id").alias("_id"))
    holders = holders.select("_id", F.col("text_digest").alias("_digest"))
    texts = docs.select("doc_id", text.alias("text"), digest.alias("text_digest"))
    misses = texts.join(holders.hint("shuffle_hash"), F.expr("doc_id <=> _id and text_digest = _digest"))
    _encoded(misses, path, version).write.mode("append").parquet(cache)
    return rows.join(known(), "text_digest").select("doc_id", "n_bytes", "n_tokens")
