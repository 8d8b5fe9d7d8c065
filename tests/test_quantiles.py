"""The quantiles against numpy, on even, skewed and odd groups."""

import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelsight.operators.quantiles import (
    _cell,
    exact_quantiles,
    median_of_few_values,
)

QUARTILES = {"q1": ("x", 0.25), "q2": ("x", 0.5), "q3": ("x", 0.75)}


def expected(rows, p):
    groups = {}
    for key, x in rows:
        groups.setdefault(key, []).append(x)
    return {
        k: None if not (v := [x for x in xs if x is not None]) else float(np.quantile(v, p))
        for k, xs in groups.items()
    }


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "k string, x double").repartition(8)
    got = {r.k: r for r in exact_quantiles(df, ["k"], QUARTILES, **options).collect()}
    for name, (_, p) in QUARTILES.items():
        want = expected(rows, p)
        assert got.keys() == want.keys()
        for k, value in want.items():
            assert got[k][name] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_small_groups_nulls_and_the_null_group(spark):
    rows = [("one", 3.0), ("two", 1.0), ("two", 2.0), (None, 5.0), (None, 7.0), (None, None)]
    rows += [("unknown", None), ("same", 4.0), ("same", 4.0), ("same", 4.0)]
    check(spark, rows)


def test_a_hot_group_with_distinct_values(spark):
    rng = random.Random(1)
    rows = [("hot", rng.lognormvariate(3, 2)) for _ in range(20_001)]
    rows += [(f"k{i % 50}", rng.gauss(0, 10)) for i in range(5_000)]
    check(spark, rows)


def test_a_hot_group_with_heavy_ties(spark):
    rng = random.Random(2)
    rows = [("hot", float(rng.choice([0, 0, 0, 1, 1, 2, 50]))) for _ in range(20_000)]
    check(spark, rows)


def test_options_do_not_change_the_result(spark):
    rng = random.Random(3)
    rows = [(f"k{i % 3}", rng.uniform(-1, 1)) for i in range(3_000)]
    check(spark, rows, few_groups=True)


def test_several_columns_and_sums(spark):
    rng = random.Random(4)
    rows = [(i % 2 == 0, rng.random(), rng.random() if i % 5 else None) for i in range(4_000)]
    df = spark.createDataFrame(rows, "k boolean, x double, y double")
    got = exact_quantiles(
        df,
        ["k"],
        {"mx": ("x", 0.5), "my": ("y", 0.5), "y90": ("y", 0.9)},
        sums={"rows": F.lit(1), "total": F.col("x"), "none": F.lit(None).cast("int")},
    ).collect()
    assert len(got) == 2
    for row in got:
        xs = [x for k, x, _ in rows if k == row.k]
        ys = [y for k, _, y in rows if k == row.k and y is not None]
        assert row["rows"] == len(xs)
        assert row.total == pytest.approx(sum(xs)) and row.none is None
        assert row.mx == pytest.approx(np.median(xs), abs=1e-12)
        assert row.my == pytest.approx(np.median(ys), abs=1e-12)
        assert row.y90 == pytest.approx(np.quantile(ys, 0.9), abs=1e-12)


def test_without_keys_and_at_the_ends(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("x"))
    row = exact_quantiles(
        df, [], {"low": ("x", 0.0), "mid": ("x", 0.5), "high": ("x", 1.0)}
    ).collect()
    assert [tuple(r) for r in row] == [(0.0, 5000.0, 10000.0)]


def test_an_empty_table_has_one_row_without_keys_and_none_with(spark):
    df = spark.range(0).selectExpr("1 as k", "cast(id as double) as x")
    whole = exact_quantiles(df, [], {"m": ("x", 0.5)}, sums={"n": F.lit(1)})
    assert [tuple(r) for r in whole.collect()] == [(None, None)]
    assert exact_quantiles(df, ["k"], {"m": ("x", 0.5)}).collect() == []


def test_all_steps_read_one_exchange_of_the_rows(spark):
    rng = random.Random(7)
    rows = [(f"k{i % 3}", rng.gauss(0, 1), i % 2) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, x double, y int").repartition(8)
    for keys, wanted in ((["k"], QUARTILES), ([], QUARTILES), (["k"], QUARTILES | {"my": ("y", 0.5)})):
        found = exact_quantiles(df, keys, wanted, sums={"y": F.col("y")}, few_groups=True)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan.partition("Initial Plan")[0]
        assert len(re.findall(r"Scan ExistingRDD", final)) == 1, final
        # Rows are dealt out by group, measure, cell and value once; all else are sums.
        assert len(re.findall(r"\+- Exchange hashpartitioning\([^)]*_v#", final)) == 1, final
        assert "SortMergeJoin" not in final and "ReusedExchange" in final


def shapes():
    rng = random.Random(6)
    yield "bimodal", [rng.choice([0.0, 1e9]) + rng.random() for _ in range(30_000)]
    yield "heavy tail", [rng.paretovariate(0.3) for _ in range(30_000)]
    yield "cluster and outliers", [1.0 + rng.random() * 1e-9 for _ in range(30_000)] + [1.01, -5.0]
    yield "both signs", [rng.gauss(0, 1) ** 3 for _ in range(30_000)]
    yield "powers", [rng.choice([-1, 1]) * 2.0 ** rng.randrange(-1_060, 1_020) for _ in range(20_000)]
    yield "infinite", [float("inf"), float("-inf"), 0.0, -0.0, 1.0] * 200


@pytest.mark.parametrize("name, xs", list(shapes()), ids=lambda x: x if isinstance(x, str) else "")
def test_any_shape_of_the_data(spark, name, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(8)
    for p in (0.0, 0.31, 0.5, 0.999, 1.0):
        (row,) = exact_quantiles(df, [], {"m": ("x", p)}).collect()
        near = sorted(xs)[int((len(xs) - 1) * p) : int((len(xs) - 1) * p) + 2]
        assert near[0] <= row.m <= near[-1]
        if name != "infinite":
            assert row.m == pytest.approx(float(np.quantile(xs, p)), rel=1e-9, abs=1e-300)
    cells = df.withColumn("cell", _cell(F.col("x")))
    largest = cells.groupBy("cell").agg(F.count_distinct("x").alias("n")).agg(F.max("n")).first()[0]
    # Values a billionth apart share a cell.
    assert largest <= (30_000 if name in ("cluster and outliers", "bimodal") else 60)


def test_cells_keep_the_order(spark):
    rng = random.Random(8)
    xs = sorted(rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(5_000))
    xs = [float("-inf"), *xs, float("inf"), float("nan")]
    df = spark.createDataFrame(list(enumerate(xs)), "i int, x double")
    cells = [r[0] for r in df.orderBy("i").select(_cell(F.col("x"))).collect()]
    assert cells == sorted(cells)


@pytest.mark.parametrize("size", [1, 2, 3, 1_999, 2_000, 2_001])
def test_no_size_takes_another_way(spark, size):
    rng = random.Random(size)
    check(spark, [("g", rng.gauss(5, 3)) for _ in range(size)])


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_any_small_input(spark, rows):
    check(spark, [(k, None if x is None else x + 0.0) for k, x in rows])


def test_median_of_few_values_matches_the_plain_median(spark):
    rng = random.Random(5)
    rows = [(i % 4, rng.randrange(50), rng.randrange(7) if i % 3 else None) for i in range(2_000)]
    df = spark.createDataFrame(rows, "k int, a int, b int")
    got = median_of_few_values(df, ["k"], ["a", "b"]).orderBy("k").collect()
    plain = df.groupBy("k").agg(F.median("a").alias("a"), F.median("b").alias("b"))
    assert got == plain.orderBy("k").collect()
