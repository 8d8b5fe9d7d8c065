"""Row-level operators: latest row per key, checked lookups, consecutive runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelsight.operators.quality import duplicate_keys, require


def latest_per_key(df: DataFrame, key: str, timestamp: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the latest, with an unknown timestamp counted as latest.

    Spark keeps the first row per key inside every map task before the exchange,
    so a key with very many rows sends at most one row per task.
    """
    newest_first = W.partitionBy(key).orderBy(
        F.col(timestamp).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tie_break]
    )
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def join_many_to_one(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], *, validate: bool = False
) -> DataFrame:
    """Left join that must not multiply rows.

    ``validate`` runs a uniqueness job on the right side's keys first and raises
    on duplicates. A model already passed through ``validate_model`` needs none.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if validate:
        require({f"{', '.join(keys)} is unique": duplicate_keys(right, keys)})
    return left.join(right, keys, "left")


def lookup_with_overrides(
    df: DataFrame,
    table: DataFrame,
    key: str,
    value: str,
    output: str,
    overrides: Mapping[str, str],
    *,
    validate: bool = False,
) -> DataFrame:
    """Map ``df[key]`` through ``table(key, value)``; overrides beat the table.

    A key listed twice has no last row to win in a distributed table: ``validate``
    refuses it.
    """
    values = table.select(key, F.col(value).alias(output))
    joined = join_many_to_one(df, values, key, validate=validate)
    if not overrides:
        return joined
    fixed = None
    for source, target in overrides.items():
        condition = F.col(key) == source
        fixed = F.when(condition, target) if fixed is None else fixed.when(condition, target)
    return joined.withColumn(output, F.coalesce(fixed, F.col(output)))


def number_runs(df: DataFrame, keys: Sequence[str], index: str | Column) -> DataFrame:
    """Number neighbouring rows: adds ``run_start`` (an index) and ``run_position``.

    Rows of a key whose integer ``index`` values follow each other without a gap
    form one run. Each (key, index) may occur once.
    """
    at = F.col(index) if isinstance(index, str) else index
    group = W.partitionBy(*keys)
    return (
        df.withColumn("_at", at)
        .withColumn("_island", F.col("_at") - F.row_number().over(group.orderBy("_at")))
        .withColumn("run_start", F.min("_at").over(W.partitionBy(*keys, "_island")))
        .withColumn("run_position", F.col("_at") - F.col("run_start") + 1)
        .drop("_at", "_island")
    )
