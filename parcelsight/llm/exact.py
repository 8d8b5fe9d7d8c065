"""Exact dedup as a keyed stream whose state never expires.

Each row becomes a small key record: digest of the normalised text, stable identifier
(doc_id), ordinal of the row and content locator (the file that holds it). A stream over
these records keeps, per digest, the first identifier with its locator and the number of
rows seen, in a disk-backed (RocksDB) state store below the shared folder. With the same
folder, later runs go on from that state. The state is read back as a table.

A hit (a row whose digest belongs to another row) counts only if its bytes equal those of
the row found at the state's locator; rows that differ under one digest are grouped by
their full text instead, so a weak digest costs time but never a document.

Only DataFrame operations are used. Copies of one text are pre-aggregated before the
shuffle to the state; the join of hits with the kept text spreads every kept row over
salts, one per SALT_ROWS copies.

Null text is empty. Repeated rows (same id, same text) are copies of each other: one of
them stays. A null id sorts after all others. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parcelsight.llm.common import BLANKS, shared_folder, stored, text_of, whole_row

#: Copies that meet one replica of the kept text.
SALT_ROWS = 2_000
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # A run takes what is there and ends: stores are closed after each commit, and what is
    # uploaded is the log of changes.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def key_records(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """digest, doc_id, ordinal (tells repeated rows apart) and locator of each row."""
    return docs.select(
        digest(normalised(text_of())).alias("digest"),
        F.col("doc_id"),
        F.monotonically_increasing_id().alias("ordinal"),
        F.input_file_name().alias("locator"),
    )


def advance(spark: SparkSession, records: str, schema, state: str) -> None:
    """Take all key records that came to a folder since the last call into the state."""
    with _settings(spark, _STATE):
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "ordinal", "locator"))
        seen = (
            spark.readStream.schema(schema)
            .parquet(records)
            .groupBy("digest")
            .agg(first.alias("first"), F.count(F.lit(1)).alias("size"))
        )
        query = (
            seen.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def state_table(spark: SparkSession, state: str) -> DataFrame:
    """digest, first (doc_id, ordinal, locator) and size, as the last batch left them."""
    with _settings(spark, _STATE):
        found = spark.read.format("statestore").load(state)
    return found.select("key.digest", F.col("value.min").alias("first"), F.col("value.count").alias("size"))


def decisions(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept and digest (binary)."""
    spark = docs.sparkSession
    records, state = shared_folder(spark, "exact-records"), shared_folder(spark, "exact-state")
    made = key_records(docs, digest)
    made.write.parquet(records)
    rows = spark.read.schema(made.schema).parquet(records)
    if rows.isEmpty():  # a stream without files has no state to read
        return rows.select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
        )
    advance(spark, records, made.schema, state)
    held = stored(state_table(spark, state), "exact-held")
    grouped = rows.join(held, "digest").select(
        "digest",
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("ordinal") == F.col("first.ordinal")).alias("kept"),
    )
    odd = _unequal(docs, grouped, digest)
    if odd.isEmpty():
        return grouped.select("doc_id", "keep_id", "group_size", "kept", "digest")
    return _regrouped(docs, grouped, odd, digest)


def _texts(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = normalised(text_of())
    return docs.select("doc_id", digest(text).alias("digest"), text.alias("text"))


def _unequal(docs: DataFrame, grouped: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The digests under which some row's bytes differ from the kept row's, as a stored table."""
    differ = _met(docs, grouped, digest).where("text != kept_text")
    return stored(differ.select("digest").distinct(), "exact-unequal")


def _met(docs: DataFrame, grouped: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """digest, text and kept_text: each row of a group with the kept text, once. Only where rows
    of the kept id have several texts under the digest does it meet each of them."""
    # Repeated rows and rows without an id share doc_id and digest: one hit stands for them. One
    # key of both, so that a large group is not dealt by its digest alone.
    hits = grouped.where("group_size > 1").groupBy(F.struct("digest", "doc_id").alias("key"))
    hits = hits.agg(F.max("kept").alias("kept"), F.max("group_size").alias("group_size"))
    hits = hits.select("key.digest", "key.doc_id", "kept", "group_size")
    found = _texts(docs, digest).alias("t").join(
        hits.alias("h").hint("shuffle_hash"),
        F.expr("t.doc_id <=> h.doc_id and t.digest = h.digest"),
    )
    rows = found.select("h.digest", "h.doc_id", "h.kept", "h.group_size", "t.text")
    salts = F.ceil(F.col("group_size") / SALT_ROWS).cast("int")
    kept = rows.where("kept").select("digest", "text", "group_size").distinct().select(
        "digest", F.col("text").alias("kept_text"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    )
    each = rows.select("digest", "text", F.pmod(F.xxhash64("doc_id", "text"), salts).cast("int").alias("salt"))
    return each.join(kept, ["digest", "salt"]).select("digest", "text", "kept_text")


def _regrouped(docs: DataFrame, grouped: DataFrame, odd: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows under the given digests grouped by full text, the others as they were."""
    fine = grouped.join(odd, "digest", "left_anti").select("doc_id", "keep_id", "group_size", "kept", "digest")
    rows = _texts(docs, digest).join(odd, "digest", "left_semi").withColumn("ordinal", F.monotonically_increasing_id())
    rows = stored(rows, "exact-odd")
    first = rows.groupBy("digest", "text").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "ordinal")).alias("first"),
        F.count(F.lit(1)).alias("group_size"),
    )
    apart = rows.join(first, ["digest", "text"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("ordinal") == F.col("first.ordinal")).alias("kept"),
        "digest",
    )
    return fine.unionByName(apart)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of docs: of equal texts the one with the smallest id."""
    chosen = decisions(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    rows = docs.select(whole_row(docs), "doc_id", sha256(normalised(text_of())).alias("_own"))
    found = rows.join(chosen.hint("shuffle_hash"), F.expr("doc_id <=> _id and _own = _digest"))
    # Repeated rows share id and text; one of them stays. The join has dealt rows by this key.
    repeated = F.row_number().over(Window.partitionBy("_id", "_digest").orderBy("_id"))
    return found.withColumn("_n", repeated).where("_n = 1").select("_row.*")
