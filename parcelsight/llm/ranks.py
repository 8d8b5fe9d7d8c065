"""Positions of rows within groups, without a group in one task.

Rows are dealt out by ranges of (group, order) and sorted there; the counts per partition and
group, a small table, tell where each partition's run of a group begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from parcelsight.llm.common import stored


def positioned(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """df with `position` (long, from 0 within the group, in rising order) and `size` (rows of the
    group). df is read twice, so it is best a stored table. Nulls come first and are a
    group too. Rows that are equal in all order columns follow in any order; end the order
    with a row number where a value may repeat in many rows, so that they can be dealt out."""
    placed = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    place = F.monotonically_increasing_id()
    placed = stored(placed.select("*", place.alias("_place"), F.shiftright(place, 33).alias("_part")), name)
    runs = placed.groupBy(F.col(group).alias("_group"), "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    own = Window.partitionBy("_group")
    before = F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"size": F.sum("_n").over(own), "_start": F.coalesce(before, F.lit(0)) - F.col("_first")})
    runs = runs.select("_group", F.col("_part").alias("_run"), "size", "_start")
    found = placed.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_run")))
    return found.select(*df.columns, (F.col("_place") + F.col("_start")).alias("position"), "size")
