"""Data-quality checks: each returns the violating rows, keys or values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """Raised when required checks find violations."""


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _outside(column: str, low: float | None, high: float | None) -> Column:
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(column) < low)
    if high is not None:
        broken = broken | (F.col(column) > high)
    return broken


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values on more than one row (NULL counts as a value)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that repeat or hold a NULL."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter((F.col("rows") > 1) | _any_null(keys))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column."""
    return df.filter(_any_null(columns))


def range_violations(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows outside [low, high]; an unknown value passes."""
    return df.filter(_outside(column, low, high))


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-NULL child keys without a parent row.

    Both sides shrink to distinct keys first, so a hot key crosses the exchange
    once per task.
    """
    keys = child.select(F.col(child_key)).filter(F.col(child_key).isNotNull()).distinct()
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return keys.join(parents, child_key, "left_anti")


def rows_with_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (a semi join)."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(key)), key, "left_semi")


def out_of_order_rows(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows whose ``later`` event carries the smaller timestamp."""
    return df.filter(F.col(earlier) > F.col(later))


def key_census(sides: Mapping[str, tuple[DataFrame, str]], sums: Mapping[str, Mapping[str, Column]] | None = None) -> DataFrame:
    """One row per value of a key that several tables hold: ``key`` and, for each side, in how
    many of its rows the value stands. ``sides`` maps a name to (table, column).

    All sides meet in one exchange, to which a task sends a key once per side. What a key
    must keep follows from the counts: unique (at most 1), referenced (not 0 where another side is
    not), covered. ``sums`` adds up columns of a side, named ``<side>.<name>``.
    """
    sums, parts, added = sums or {}, [], []
    width = max([len(s) for s in sums.values()], default=0)
    for i, (name, (df, column)) in enumerate(sides.items()):
        own = list(sums.get(name, {}).items())
        added += [(i, j, f"{name}.{rule}") for j, (rule, _) in enumerate(own)]
        cells = [c.cast("long") for _, c in own] + [F.lit(None).cast("long")] * (width - len(own))
        parts.append(df.select(F.col(column).alias("key"), F.lit(i).alias("_side"), *[c.alias(f"_x{j}") for j, c in enumerate(cells)]))
    counts = [F.count_if(F.col("_side") == i).alias(name) for i, name in enumerate(sides)]
    totals = [F.sum(F.when(F.col("_side") == i, F.col(f"_x{j}"))).alias(name) for i, j, name in added]
    return reduce(DataFrame.unionAll, parts).groupBy("key").agg(*counts, *totals)


def _has(side: str) -> Column:
    return F.col(f"`{side}`") > 0


def repeated_or_unknown(side: str) -> Column:
    """Of a census: key values that break a primary key."""
    return F.count_if(_has(side) & ((F.col(f"`{side}`") > 1) | F.col("key").isNull()))


def orphans(child: str, parent: str) -> Column:
    """Of a census: known key values of the child that the parent does not have."""
    return F.count_if(_has(child) & ~_has(parent) & F.col("key").isNotNull())


def known_keys(side: str) -> Column:
    """Of a census: distinct known key values of a side."""
    return F.count_if(_has(side) & F.col("key").isNotNull())


def as_lines(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check_name, violations) from aggregates over a table, in one pass."""
    names = {name: f"_c{i}" for i, name in enumerate(checks)}
    totals = df.agg(*[F.coalesce(c, F.lit(0)).alias(names[name]) for name, c in checks.items()])
    lines = [F.struct(F.lit(name).alias("check_name"), F.col(c).alias("violations")) for name, c in names.items()]
    return totals.select(F.inline(F.array(*lines)))


def broken_rules(
    required: Sequence[str] = (), ranges: Mapping[str, tuple[float | None, float | None]] | None = None
) -> dict[str, Column]:
    """Whether a row breaks each of a table's own rules, by the rule's name."""
    rules = {f"{c} is known": F.col(c).isNull() for c in required}
    return rules | {f"{c} in range": _outside(c, *bounds) for c, bounds in (ranges or {}).items()}


def key_coverage(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: distinct child keys, how many have no parent, and their share."""
    keys = child.select(F.col(child_key).alias("_k")).filter("_k is not null").distinct()
    parents = parent.select(F.col(parent_key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return keys.join(parents, "_k", "left").agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_hit").isNull()).alias("uncovered"),
        F.try_divide(
            F.count_if(F.col("_hit").isNull()).cast("double"), F.count(F.lit(1)).cast("double")
        ).alias("uncovered_share"),
    )


def count_violations(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: ``check_name`` and the number of ``violations``."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )
        for name, frame in checks.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def row_count_change(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: by how many rows a step that must keep its rows changed them."""
    signs = before.select(F.lit(1).alias("_one")).unionAll(after.select(F.lit(-1).alias("_one")))
    return signs.agg(F.abs(F.coalesce(F.sum("_one"), F.lit(0))).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def count_table_violations(
    df: DataFrame,
    name: str,
    key: Sequence[str],
    required: Sequence[str] = (),
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """All of a table's own rules in one pass, one row per rule.

    Rows first shrink to one per key, with the broken rules added up, so the key
    rule and the row rules share a single exchange.
    """
    row_rules = {f"{name}: {rule}": broken for rule, broken in broken_rules(required, ranges).items()}
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(broken).alias(f"_r{i}") for i, broken in enumerate(row_rules.values())],
    )
    totals = per_key.agg(
        F.count_if((F.col("_rows") > 1) | _any_null(key)).alias("_key"),
        *[F.coalesce(F.sum(f"_r{i}"), F.lit(0)).alias(f"_r{i}") for i in range(len(row_rules))],
    )
    lines = {f"{name}: key {', '.join(key)}": "_key"}
    lines |= {rule: f"_r{i}" for i, rule in enumerate(row_rules)}
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(rule).alias("check_name"), F.col(c).alias("violations"))
                    for rule, c in lines.items()
                ]
            )
        )
    )


def raise_if_violated(counts: DataFrame) -> None:
    """Raise with the failing checks; only their names and counts reach the driver."""
    failing = counts.filter("violations > 0").orderBy("check_name").collect()
    if failing:
        raise QualityError("; ".join(f"{r.check_name}: {r.violations} violations" for r in failing))


def require(checks: Mapping[str, DataFrame]) -> None:
    """Run the checks as one job and raise if any of them finds a violation."""
    raise_if_violated(count_violations(checks))
