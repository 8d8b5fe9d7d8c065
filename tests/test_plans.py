"""Physical plans: what must hold when the tables are large."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from parcelsight.operators.quantiles import exact_quantiles
from parcelsight.operators.rows import latest_per_key
from parcelsight.plans import geography as G
from parcelsight.plans import kpis as K
from parcelsight.plans import model as M
from parcelsight.plans import star as S
from parcelsight.session import sized_for
from parcelsight.sources.files import read_footers
from parcelsight.testbed import queries as testbed

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def operators(df):
    """Operators of the physical plan, top first."""
    return [line.strip(" :+-|*()0123456789") for line in plan(df).splitlines() if line.strip()]


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    M.write_model(testbed.Clean(spark, SF).model(), path)
    return M.read_model(spark, path)


@pytest.mark.parametrize("name", list(testbed.QUERIES))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    ):
        text = plan(testbed.run(name)(spark, SF))
    assert not re.search(r"Cartesian|NestedLoop|Python|Pandas|Arrow|ScanExistingRDD", text)
    # A single-partition step may only see rows an aggregate has already shrunk.
    lines = [line.strip(" :+-|*") for line in text.splitlines()]
    for above, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in above:
            assert re.match(r"(\(\d+\) )?(Hash|ObjectHash|Sort)Aggregate|Project|Window|Filter", below)


def test_scope_and_window_reach_the_scan(stored):
    text = plan(K.in_scope(stored["orders"], "1996-01-01", "1997-01-01").select("order_id"), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(order_status,delivered)" in pushed
    assert "GreaterThanOrEqual(order_purchase_timestamp" in pushed
    assert "LessThan(order_purchase_timestamp" in pushed


def test_only_needed_columns_are_read(stored):
    text = plan(K.late_rate_baseline(stored["orders"]), "formatted")
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert schema == "order_status:string,is_late:boolean"


def test_the_latest_row_is_chosen_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "id as t")
    ops = [o for o in operators(latest_per_key(df, "k", "t")) if re.match("WindowGroupLimit|Exchange", o)]
    assert [o.split(" ")[0] for o in ops] == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_an_order_is_counted_once_per_seller_without_a_further_exchange(spark, stored):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        ops = operators(K.seller_orders(stored["orders"], stored["order_items"]))
    exchanges = [o for o in ops if o.startswith("Exchange")]
    assert [re.search(r"partitioning\((\w+)", e).group(1) for e in exchanges] == [
        "seller_id",
        "order_id",
        "order_id",
    ]


def test_bucketed_tables_meet_without_an_exchange(spark, stored):
    spark.sql("create database if not exists bucketed_model")
    try:
        M.save_model(stored, "bucketed_model", buckets=4)
        model = M.open_model(spark, "bucketed_model")
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
            by_band = K.review_by_delay_band(model["orders"], model["reviews"])
            sellers = K.seller_orders(model["orders"], model["order_items"])
            fact = S.fact_orders(
                model["orders"], model["customers"], model["order_items"], model["reviews"]
            )
            for question in (by_band, sellers, fact):
                assert "hashpartitioning(order_id" not in plan(question)
        want = K.review_by_delay_band(stored["orders"], stored["reviews"])
        assert by_band.collect() == want.collect()
    finally:
        spark.sql("drop database bucketed_model cascade")


def test_the_model_answers_plain_sql(spark, stored):
    M.register_views(stored)
    (row,) = spark.sql(
        """select count(*) as orders, count(*) filter (where is_late) as late_orders,
             median(transit_hours) filter (where is_late) as transit_late
           from orders where is_late is not null and order_status = 'delivered'"""
    ).collect()
    base = K.late_rate_baseline(stored["orders"]).collect()[0]
    assert (row.orders, row.late_orders) == (base.orders, base.late_orders)
    assert round(row.transit_late, 1) == K.stage_medians(stored["orders"]).collect()[0].transit_late


HOT = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__shuffle__partitions": "16",
}


def hot_orders(spark, rows=120_000):
    """Every third order belongs to one customer."""
    i = F.col("id")
    return spark.range(0, rows, 1, 8).select(
        i.alias("order_id"),
        F.when(i % 3 == 0, 0).otherwise(i).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        (i % 5 == 0).alias("is_late"),
        F.expr("timestamp_ntz '2017-01-01' + make_dt_interval(cast(id % 300 as int))").alias(
            "order_purchase_timestamp"
        ),
    )


def test_a_hot_customer_is_split_in_the_join(spark):
    customers = spark.range(0, 120_000, 1, 8).selectExpr(
        "id as customer_id", "if(id % 2 = 0, 'RJ', 'SP') as customer_state"
    )
    with settings(spark, **HOT):
        months = K.place_months(hot_orders(spark), customers)
        rows = months.collect()
        assert "skew=true" in plan(months)
    assert sum(r.orders for r in rows) == 120_000


def test_a_hot_order_is_split_although_the_count_reuses_the_join(spark):
    orders = hot_orders(spark).withColumn("order_id", F.col("order_id"))
    items = spark.range(0, 240_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 1, id % 120000) as order_id", "id % 1000 as seller_id"
    )
    with settings(spark, **HOT):
        counts = K.seller_orders(orders, items)
        got = {r.seller_id: r.orders for r in counts.collect()}
        assert "skew=true" in plan(counts)
    want = items.distinct().groupBy("seller_id").count().collect()
    assert got == {r.seller_id: r["count"] for r in want}


def test_a_hot_zip_prefix_is_split_beside_freshly_computed_coordinates(spark):
    points = spark.range(0, 60_000, 1, 8).selectExpr(
        "cast(id % 20000 as int) as geolocation_zip_code_prefix",
        "-20 - id % 3 as geolocation_lat",
        "-45 - id % 3 as geolocation_lng",
    )
    people = spark.range(0, 120_000, 1, 8).selectExpr(
        "id as customer_id", "cast(if(id % 3 = 0, 7, id % 20000) as int) as zip"
    )
    with settings(spark, **HOT):
        located = G.add_coordinates(people, "zip", G.coordinates_by_prefix(points), "customer")
        assert located.filter("customer_lat is null").count() == 0
        counted = located.groupBy("customer_lat").count()
        counted.collect()
        assert "skew=true" in plan(counted)


def test_a_costly_input_of_quantiles_is_computed_once(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("id", "id % 3 as k", "rand(1) as x")
    joined = df.join(spark.range(0, 50_000, 1, 8), "id")
    result = exact_quantiles(
        joined.select("k", "x"),
        ["k"],
        {"m": ("x", 0.5)},
        sums={"rows": F.lit(1), "big": (F.col("x") > 0.9).cast("int")},
        few_groups=True,
    )
    assert sum(r["rows"] for r in result.collect()) == 50_000
    final = plan(result).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join \[id#", final)) == 1


def test_a_hot_group_of_quantiles_leaves_the_tasks_as_counts(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 3 = 0, -1, id % 50) as k", "cast(hash(id) as double) as x"
    )
    result = exact_quantiles(df, ["k"], {"m": ("x", 0.5)})
    got = {r.k: r.m for r in result.collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("x").alias("m")).collect()}
    assert got == want


def test_partition_settings_follow_the_shuffled_bytes():
    def partitions(size, cores):
        return int(sized_for(size, cores)["spark.sql.shuffle.partitions"])

    assert partitions(10, cores=8) == 24
    assert partitions(10 * 10**12, cores=4000) == 23842
    assert partitions(100 * 10**12, cores=4000) == 100_000


def test_counts_and_bounds_of_a_stored_model_come_from_footers(spark, stored, tmp_path):
    M.write_model(stored, str(tmp_path))
    found = M.stored_counts(spark, str(tmp_path))
    text = plan(found, "formatted")
    assert text.count("PushedAggregation: [COUNT(*)]") == len(stored)
    assert {r.table_name: r.rows for r in found.collect()} == {name: frame.count() for name, frame in stored.items()}
    items = read_footers(spark, str(tmp_path / "order_items")).agg(F.min("price").alias("low"), F.max("order_id").alias("high"))
    assert "PushedAggregation: [MIN(price), MAX(order_id)]" in plan(items, "formatted")
    assert items.first() == stored["order_items"].agg(F.min("price"), F.max("order_id")).first()
    assert spark.conf.get("spark.sql.sources.useV1SourceList").count("parquet") == 1


def test_a_hot_order_is_stored_in_parts_that_join_without_an_exchange(spark, stored):
    items = stored["order_items"]
    hot = items.select("order_id").first().order_id
    more = items.filter(F.col("order_id") == hot).limit(1)
    more = more.crossJoin(spark.range(1_000, 6_000)).withColumn("order_item_id", F.col("id").cast("int")).drop("id")
    model = stored | {"order_items": items.unionByName(more)}
    spark.sql("create database if not exists parts")
    try:
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
            M.save_parts(model, "parts", 4, items=500)
            found = M.open_parts(spark, "parts")
            joined = found["orders"].join(found["order_items"], ["order_id", M.PART])
            assert "Exchange" not in plan(joined.select("order_id", "is_late", "seller_id"))
            assert joined.count() == model["order_items"].count()
            in_task = [n for n in joined.filter(F.col("order_id") == hot).groupBy(F.spark_partition_id()).count().collect()]
            assert len(in_task) > 1 and max(r["count"] for r in in_task) < 4_000
            assert found["orders_once"].count() == model["orders"].count()
            want = K.seller_orders(model["orders"], model["order_items"])
            got = K.seller_orders(found["orders"], found["order_items"])
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            reviewed = found["orders"].join(found["reviews"], ["order_id", M.PART])
            assert "Exchange" not in plan(reviewed.select("order_id", "review_score"))
            assert reviewed.count() == model["orders"].join(model["reviews"], "order_id").count()
    finally:
        spark.sql("drop database parts cascade")
