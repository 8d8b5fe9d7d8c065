"""CSV and parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.sources import records
from parcelsight.sources.checked import known_text, typed
from parcelsight.sources.schemas import MULTI_LINE, RAW_TYPES


def _read_texts(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All cells as text. The files of a folder must have one header: names are taken from
    one file, and reading stops at a file whose header names other columns or another order.
    Where cells may hold line breaks, records are found by quote parity."""
    if table in MULTI_LINE:
        names = records.header(spark, path)
        found = records.cells(records.quoted_lines(records.lines(spark, path)), names)
        return found.filter("not _header and not _blank").select(*names)
    options = {"header": True, "quote": '"', "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.options(**options).schema(text).option("enforceSchema", False).csv(path)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table with the declared types, from a file or a folder of files of one header.

    Only the header line is looked at up front; nothing is inferred from rows. A cell that holds a
    text but no value of its type is unknown; ``unreadable_cells`` counts them, and
    ``checked.stage`` lists them.
    """
    texts, types = _read_texts(spark, path, table), RAW_TYPES[table]
    return texts.select(*[typed(n, types.get(n, T.StringType())) for n in texts.columns])


def unreadable_cells(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(check_name, violations): cells per typed column that hold a text but no value of its type."""
    texts, kinds = _read_texts(spark, path, table), RAW_TYPES[table]
    names = [n for n in texts.columns if n in kinds]
    if not names:
        return spark.createDataFrame([], "check_name string, violations long")
    broken = {n: F.count_if(known_text(n).isNotNull() & typed(n, kinds[n]).isNull()) for n in names}
    long = texts.agg(*[c.alias(n) for n, c in broken.items()]).unpivot([], names, "_column", "violations")
    name = F.concat(F.lit(f"{table}: "), F.col("_column"), F.lit(" is readable"))
    return long.select(name.alias("check_name"), "violations")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table for counts and bounds: row counts, and the least and largest numbers and
    dates, come from the files' footers (``session.tune`` allows that), and no column is read."""
    setting = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)


def read_catalog(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Named raw tables from their CSV paths."""
    return {table: read_csv(spark, path, table) for table, path in paths.items()}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns matched by name and cast; a missing or extra column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if missing or extra:
        raise ValueError(f"columns do not match: missing {missing}, extra {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_observed(
    df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Replace the table at ``path``; returns ``rows`` and the metrics.

    They are observed while writing, so nothing is read a second time.
    """
    seen = Observation()
    named = [c.alias(name) for name, c in (metrics or {}).items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *named).write.mode("overwrite").parquet(path)
    return seen.get


def write_parquet(df: DataFrame, path: str) -> int:
    """Replace the table at ``path`` and return its row count."""
    return write_observed(df, path)["rows"]
