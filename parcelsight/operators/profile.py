"""First-look profiling of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.operators.quantiles import exact_quantiles


def _digest(values: Sequence[Column]) -> list[Column]:
    """128 bits of the values, as two numbers with seeds of their own."""
    return [F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in ((1, "_h1"), (2, "_h2"))]


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, known, unknown and distinct known values. One scan.

    Each cell becomes (column, digest) on its way into a map-side count, so a task sends each of
    a column's values once, as 16 bytes, and a frequent value is no hot key.
    """
    cells = [
        F.struct(F.lit(i).alias("_column"), *_digest([F.col(f"`{c}`")]), F.col(f"`{c}`").isNotNull().alias("_known"))
        for i, c in enumerate(df.columns)
    ]
    values = df.select(F.inline(F.array(*cells))).groupBy("_column", "_known", "_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    columns = range(len(df.columns))
    known = [F.col("_known") & (F.col("_column") == i) for i in columns]
    counts = values.agg(
        F.coalesce(F.sum(F.when(F.col("_column") == 0, F.col("_n"))), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(F.when(known[i], F.col("_n"))), F.lit(0)).alias(f"_n{i}") for i in columns],
        *[F.count_if(known[i]).alias(f"_d{i}") for i in columns],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("known"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("unknown"),
                F.col(f"_d{i}").alias("distinct_values"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(lines))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier, fully equal row.

    Only digests of 16 bytes are exchanged for all rows. Rows are compared in full where a digest
    repeats, so equal digests of unequal rows do no harm.
    """
    return _repeats(df, _digest([F.col(f"`{c}`") for c in df.columns]))


def _repeats(df: DataFrame, digest: Sequence[Column]) -> DataFrame:
    seen = df.select(*digest).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_rows"))
    often = seen.filter("_rows > 1").select("_h1", "_h2")
    candidates = df.select("*", *digest).join(often, ["_h1", "_h2"], "left_semi")
    copies = candidates.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def value_counts(df: DataFrame, column: str, *, by_value: bool = False) -> DataFrame:
    """Rows per known value, most frequent first (or in value order)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("rows"), column)


def distinct_count(df: DataFrame, column: str, output: str = "distinct_values") -> DataFrame:
    """One row: the number of distinct known values."""
    return df.select(column).distinct().agg(F.count(column).alias(output))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def null_counts_by(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Unknown values per column and group."""
    return df.groupBy(key).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct known keys and the mean number of rows per key."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(key).alias("keys"),
        F.try_divide(F.sum("_n").cast("double"), F.count(key).cast("double")).alias("rows_per_key"),
    )


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row: rows, and per flag how often it is true and how often unknown."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f)).alias(f) for f in flags],
        *[F.count_if(F.col(f).isNull()).alias(f"{f}_unknown") for f in flags],
    )


# The statistics of a numeric summary, with the quartile ranks.
QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def describe(df: DataFrame, column: str) -> DataFrame:
    """Rows (statistic, value): count, mean, sample deviation, min, quartiles, max."""
    value = F.col(column).cast("double")
    moments = df.agg(
        F.count(value).cast("double").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    ranks = {name: (column, p) for name, p in QUARTILES.items()}
    quartiles = exact_quantiles(df.select(column), [], ranks, few_groups=True)
    long = [part.unpivot([], part.columns, "statistic", "value") for part in (moments, quartiles)]
    return long[0].unionAll(long[1])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return reduce(
        DataFrame.unionAll,
        [
            frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, frame in tables.items()
        ],
    )
