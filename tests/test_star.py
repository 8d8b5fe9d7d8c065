"""The model and the star export on the smallest test tables."""

import pytest
from pyspark.sql import functions as F

from parcelsight.operators.quality import QualityError
from parcelsight.plans import kpis as K
from parcelsight.plans import model as M
from parcelsight.plans import star as S
from parcelsight.sources import publish as P
from parcelsight.testbed.queries import REGION, Clean
from parcelsight.testbed.tables import KEY_TYPE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    counts = M.write_model(Clean(spark, SF).model(), path)
    stored = M.read_model(spark, path)
    assert counts == {name: frame.count() for name, frame in stored.items()}
    return stored


def test_the_model_keeps_every_rule(model):
    M.validate_model(model)


def test_a_broken_rule_is_named(model):
    items = model["order_items"]
    broken = {
        "doubled": ({"order_items": items.union(items.limit(1))}, "order_items: key order_id, order_item_id"),
        "orphan": ({"customers": model["customers"].limit(5)}, "orders: customer_id in customers"),
        "range": ({"reviews": model["reviews"].withColumn("review_score", F.lit(6))}, "reviews: review_score in range"),
        "unknown": ({"sellers": model["sellers"].withColumn("seller_city", F.lit(None))}, "sellers: seller_city is known"),
    }
    for change, message in broken.values():
        with pytest.raises(QualityError, match=message):
            M.validate_model(model | change)


def test_conform_refuses_a_missing_column(model):
    with pytest.raises(ValueError, match="distance_km"):
        M.conform_model(model | {"order_items": model["order_items"].drop("distance_km")}, KEY_TYPE)


def test_distances_attach_one_to_one(model):
    items = model["order_items"]
    distances = items.select("order_id", "order_item_id", "distance_km")
    joined = M.attach_distances(items.drop("distance_km"), distances.limit(10))
    assert joined.count() == items.count()
    assert joined.filter("distance_km is not null").count() <= 10


def test_star_tables(spark, model):
    star = S.build_star(spark, model)
    scope = K.in_scope(model["orders"])
    assert set(star) == {
        "fact_orders", "fact_stage_hours", "dim_date", "dim_state", "seller_rates", "alerts", "rio_excess"}
    assert len(star["fact_orders"].columns) == 16
    assert star["fact_orders"].count() == scope.count()
    stages = ["approval_hours", "preparation_hours", "transit_hours"]
    known = scope.agg(*[F.count(c) for c in stages]).collect()[0]
    assert star["fact_stage_hours"].count() == sum(known)
    got = {(r.stage, r.stage_order) for r in star["fact_stage_hours"].select("stage", "stage_order").distinct().collect()}
    assert got == {("Payment approval", 1), ("Preparation", 2), ("Transit", 3)}
    days = star["dim_date"]
    first, last, rows = days.agg(F.min("date"), F.max("date"), F.count("date")).collect()[0]
    assert rows == (last - first).days + 1 == days.select("date").distinct().count()
    row = days.orderBy("date").first()
    assert (row.month_label, row.month_sort) == (first.strftime("%b %Y"), first.year * 100 + first.month)
    assert star["dim_state"].count() == 27


def test_fact_places_can_be_any_customer_column(spark):
    t = Clean(spark, SF)
    long = S.fact_stage_hours(t.clean_orders, t.customers(), place=REGION)
    assert long.columns == ["order_id", "order_date", REGION, "is_late", "stage", "stage_order", "hours"]


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda m: {"reviews": m["reviews"].union(m["reviews"].limit(1))}, "reviews: key"),
        (lambda m: {"customers": m["customers"].union(m["customers"].limit(1))}, "customers: key"),
        (lambda m: {"customers": m["customers"].limit(3)}, "customer_id in customers"),
    ],
)
def test_the_export_stops_before_writing_when_a_join_would_change_the_grain(
    spark, model, tmp_path, change, message
):
    broken = model | change(model)
    with pytest.raises(QualityError, match=message):
        S.write_star(S.build_star(spark, broken), broken, str(tmp_path / "star"))
    assert not (tmp_path / "star").exists()


def test_the_grain_check_compares_row_counts(model):
    scope = K.in_scope(model["orders"])
    S.check_fact_grain(scope, model["orders"])
    with pytest.raises(QualityError, match="changed the grain"):
        S.check_fact_grain(scope.union(scope.limit(1)), model["orders"])


def test_the_export_writes_every_table(spark, model, tmp_path):
    star = S.build_star(spark, model)
    counts = S.write_star(star, model, str(tmp_path))
    assert set(counts) == set(star)
    stored = S.read_star(spark, str(tmp_path))
    assert {name: frame.count() for name, frame in stored.items()} == counts


def test_a_failing_export_leaves_the_one_before(spark, model, tmp_path):
    out, scope = str(tmp_path), K.in_scope(model["orders"])
    fact = S.fact_orders(model["orders"], model["customers"], model["order_items"], model["reviews"])
    S.write_star({"fact_orders": fact, "dim_date": S.dim_date(model["orders"])}, model, out)
    with pytest.raises(QualityError, match="changed the grain"):
        S.write_star({"fact_orders": fact.limit(3), "dim_date": S.dim_date(model["orders"])}, model, out)
    assert S.read_star(spark, out)["fact_orders"].count() == scope.count()
    S.write_star({"fact_orders": fact}, model, out)
    assert set(S.read_star(spark, out)) == {"fact_orders"} and len(P.versions(spark, out)) == 2
    P.drop_old(spark, out, keep=1)
    assert len(P.versions(spark, out)) == 1 and len(list((tmp_path / "versions").iterdir())) == 1
    assert S.read_star(spark, out)["fact_orders"].count() == scope.count()


def test_nothing_is_read_before_a_first_export(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        S.read_star(spark, str(tmp_path / "none"))
