"""Exact quantiles that never gather a group's values in one place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Cells per power of two. Cells cover every double.
CELLS = 1 << 16
_INFINITE, _NAN = 1 << 49, 1 << 50


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Column]:
    """The right side with prefixed key names and the NULL-safe join condition.

    NULL-safe equality keeps the NULL group, and it adds no NULL filter to either
    side, so a plan used on both sides is computed once and reused.
    """
    renamed = right.withColumnsRenamed({n: f"_k_{n}" for n in names})
    return renamed, reduce(
        Column.__and__, [left[n].eqNullSafe(renamed[f"_k_{n}"]) for n in names]
    )


def _cell(value: Column) -> Column:
    """Number of a value's cell: a larger value is never in a lower cell."""
    size = F.floor((F.log2(F.abs(value)) + F.lit(1075.0)) * F.lit(float(CELLS))) + 1
    finite = F.abs(value) < F.lit(float("inf"))
    return (
        F.when(value.isNull(), F.lit(None))
        .when(F.isnan(value), F.lit(_NAN))
        .when(value == 0, F.lit(0))
        .when(~finite, F.signum(value) * F.lit(_INFINITE))
        .otherwise(F.signum(value) * size)
        .cast("long")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, tuple[str, float]],
    *,
    sums: Mapping[str, Column] | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Interpolated quantiles per group, exact whatever the size of a group.

    ``quantiles`` maps an output name to (column, probability). The result holds the keys,
    the ``sums`` (numbers per row, added up over the group) and the quantiles.

    ``df`` is read once and its rows are exchanged once, after equal values of a group have
    shrunk map-side to one row with their count. What follows reads this exchange twice:

    1. Counts per cell, a fixed division of the numbers (a 65,536th of a power of two). Sums
       over a group's cells tell which cells hold the wanted ranks, and add up ``sums``.
    2. Only the distinct values of those cells are sorted, each cell in its own partition.

    All counts are exact, so no rank can be missed, and no task gets a group, but its counts
    per cell, or one cell's distinct values, whatever the number of rows. Rows are dealt out
    by value, never by group, and a frequent value is one row per task. Many values that
    differ by less than 1e-5 of their size share a cell; they are sorted in one task, which spills.

    Set ``few_groups`` only where the number of groups has a fixed bound: the wanted
    cells, a few rows per group, are then broadcast. Otherwise the distinct values are
    exchanged again to meet them.
    """
    sums = dict(sums or {})
    columns = list(dict.fromkeys(column for column, _ in quantiles.values()))
    names = list(keys) or ["_all"]

    def rank(p: float, end) -> Column:
        return end((F.col("_total") - 1) * F.lit(float(p)))

    def is_of(column: str) -> Column:
        """Whether a row is of this measure. A condition that all rows meet, as with one measure, would go
        below the exchange as a filter and make it another one."""
        return F.col("_measure") == columns.index(column) if len(columns) > 1 else F.col("_n") > 0

    holds_rank = reduce(
        Column.__or__,
        [
            is_of(c) & (F.col("_before") <= rank(p, end)) & (rank(p, end) < F.col("_before") + F.col("_n"))
            for c, p in quantiles.values()
            for end in (F.floor, F.ceil)
        ],
    )

    def up_to(window, order: str) -> Column:
        return F.sum("_n").over(window.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))

    # The one exchange of the rows: equal values of a group become one row.
    values = [
        F.struct(F.lit(i).alias("_measure"), F.col(c).cast("double").alias("_v"))
        for i, c in enumerate(columns)
    ]
    parts = [c.alias(f"_s{i}") for i, c in enumerate(sums.values())]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    rows = rows.select(*names, *parts, F.inline(F.array(*values))).withColumn("_cell", _cell(F.col("_v")))
    counts = rows.groupBy(*names, "_measure", "_cell", "_v").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))]
    )
    # True for every row, but it names all columns: so they are in the exchange for each of
    # its readers, which makes it the same one.
    counts = counts.filter(reduce(Column.__or__, [F.col(f"_s{i}").isNull() for i in range(len(sums))], F.col("_n") > 0))

    # 1. cells. Sums are those of the first measure's rows, of which each group has some.
    where = [*names, "_measure", "_cell"]
    group = W.partitionBy(*names, "_measure")
    cells = counts.groupBy(*where).agg(
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)).alias("_n"),
        *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))],
    )
    cells = cells.withColumns(
        {
            "_before": up_to(group, "_cell") - F.col("_n"),
            "_total": F.sum("_n").over(group),
            "_place": F.row_number().over(group.orderBy("_cell")),
            **{f"_s{i}": F.sum(f"_s{i}").over(group) for i in range(len(sums))},
        }
    )
    # The first cell stays too: with it a group without values has its row.
    cells = cells.filter(holds_rank | (F.col("_place") == 1)).drop("_n", "_place")
    cells = cells.withColumnsRenamed({f"_s{i}": f"_sum{i}" for i in range(len(sums))})

    # 2. ranks of the distinct values of those cells
    renamed, same = _same(counts, cells, where)
    placed = counts.join(F.broadcast(renamed) if few_groups else renamed, same)
    known = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)
    in_cell = W.partitionBy(*where).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = placed.withColumn("_upto", F.col("_before") + F.sum(known).over(in_cell))
    picks, results = [], []
    for i, (name, (column, p)) in enumerate(quantiles.items()):
        mine = is_of(column)
        for side, end in (("lo", F.floor), ("hi", F.ceil)):
            reached = mine & (F.col("_upto") > rank(p, end))
            picks.append(F.min(F.when(reached, F.col("_v"))).alias(f"_{side}{i}"))
        picks.append(F.max(F.when(mine, rank(p, lambda x: x - F.floor(x)))).alias(f"_frac{i}"))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = F.when(low == high, low).otherwise(low + (high - low) * F.col(f"_frac{i}"))
        results.append(between.alias(name))
    first = is_of(columns[0])
    added = [F.max(F.when(first, F.col(f"_sum{i}"))).alias(name) for i, name in enumerate(sums)]
    # Without keys there is always one row.
    return ranked.groupBy(*keys).agg(*picks, *added).select(*keys, *sums, *results)


def median_of_few_values(
    df: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Exact medians of measures with a bounded set of distinct values.

    Rows shrink to (group, measure, value, count) before the shuffle, so a group's
    last step holds its distinct values only. Meant for whole hours or days.
    """
    counted = (
        df.unpivot(list(keys), list(values), "_measure", "_v")
        .groupBy(*keys, "_measure", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.groupBy(*keys).agg(
        *[
            F.percentile(
                F.when(F.col("_measure") == name, F.col("_v")), F.lit(0.5), F.col("_n")
            ).alias(name)
            for name in values
        ]
    )
