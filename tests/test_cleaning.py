"""Cleaning steps, coordinates and distances on hand-made rows."""

import pytest
from helpers import ts

from parcelsight.operators.quality import QualityError
from parcelsight.plans import cleaning as C
from parcelsight.plans import geography as G

ORDERS = (
    "order_id string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
    "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz"
)


def orders(spark, *rows):
    return spark.createDataFrame([(r[0], *map(ts, r[1:])) for r in rows], ORDERS)


def test_clean_orders_adds_seven_columns_and_keeps_the_rest(spark):
    raw = orders(spark, ("a", "2018-01-01", "2018-01-01 02:00", "2018-01-02", "2018-01-05", "2018-01-03"))
    clean = C.clean_orders(raw)
    assert clean.columns[: len(raw.columns)] == raw.columns
    row = clean.collect()[0]
    assert (row.delay_days, row.is_late) == (2, True)
    assert (row.approval_hours, row.preparation_hours, row.transit_hours) == (2.0, 22.0, 72.0)
    assert (row.carrier_before_approved, row.delivered_before_carrier) == (False, False)


def test_clean_orders_leaves_unknown_and_contradicting_values_unknown(spark):
    rows = orders(
        spark,
        ("undelivered", "2018-01-01", None, None, None, "2018-01-03"),
        ("reversed", "2018-01-01", "2018-01-03", "2018-01-02", "2018-01-01", "2018-01-03"),
    )
    unknown, reversed_ = C.clean_orders(rows).orderBy("order_id", ascending=False).collect()
    assert unknown.order_id == "undelivered"
    assert list(unknown)[6:] == [None] * 7
    assert (reversed_.preparation_hours, reversed_.transit_hours) == (None, None)
    assert (reversed_.carrier_before_approved, reversed_.delivered_before_carrier) == (True, True)
    assert (reversed_.delay_days, reversed_.is_late) == (-2, False)


def test_clean_orders_is_a_plain_projection_on_a_stream_too(spark, tmp_path):
    orders(spark, ("a", "2018-01-01", None, None, None, "2018-01-03")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ORDERS).parquet(str(tmp_path / "in"))
    assert "is_late" in C.clean_orders(stream).columns


ITEMS = "order_id string, order_item_id int, shipping_limit_date timestamp_ntz"
DATES = "order_id string, order_delivered_carrier_date timestamp_ntz"


def test_clean_order_items_flags_the_deadline_and_drops_the_borrowed_date(spark):
    limit = ts("2018-01-02")
    items = spark.createDataFrame([(o, 1, limit) for o in ("in", "out", "unknown", "alone")], ITEMS)
    dates = spark.createDataFrame(
        [("in", ts("2018-01-01")), ("out", ts("2018-01-03")), ("unknown", None)], DATES
    )
    clean = C.clean_order_items(items, dates, validate=True)
    assert clean.columns == [*items.columns, "missed_shipping_deadline"]
    got = {r.order_id: r.missed_shipping_deadline for r in clean.collect()}
    assert got == {"in": False, "out": True, "unknown": None, "alone": None}


def test_clean_order_items_refuses_dates_that_would_multiply_rows(spark):
    items = spark.createDataFrame([("a", 1, ts("2018-01-02"))], ITEMS)
    dates = spark.createDataFrame([("a", None), ("a", ts("2018-01-03"))], DATES)
    with pytest.raises(QualityError, match="order_id"):
        C.clean_order_items(items, dates, validate=True)


def products(spark, *categories):
    rows = [(f"p{i}", c, 100) for i, c in enumerate(categories)]
    return spark.createDataFrame(
        rows, "product_id string, product_category_name string, product_weight_g int"
    )


def translated(spark, *categories):
    table = spark.createDataFrame(
        [("cama_mesa_banho", "bed_bath_table"), ("pc_gamer", "loses to the override")],
        "product_category_name string, product_category_name_english string",
    )
    clean = C.clean_products(products(spark, *categories), table)
    assert clean.columns == ["product_id", "product_category"]
    return [r.product_category for r in clean.orderBy("product_id").collect()]


def test_categories_come_from_the_table_then_the_overrides(spark):
    assert translated(spark, "cama_mesa_banho") == ["bed_bath_table"]
    assert translated(spark, "pc_gamer") == ["gaming_pc"]
    assert translated(spark, None, "not listed") == [None, None]


def test_a_category_translated_twice_is_refused(spark):
    table = spark.createDataFrame(
        [("a", "x"), ("a", "y")], "product_category_name string, product_category_name_english string"
    )
    with pytest.raises(QualityError, match="product_category_name is unique"):
        C.clean_products(products(spark, "a"), table, validate=True)


REVIEWS = "review_id string, order_id string, review_score int, review_answer_timestamp timestamp_ntz"


def scores(spark, *rows):
    df = spark.createDataFrame([(i, o, s, ts(t)) for i, o, s, t in rows], REVIEWS)
    clean = C.clean_reviews(df)
    assert clean.columns == ["order_id", "review_score"]
    return {r.order_id: r.review_score for r in clean.collect()}


def test_the_latest_review_wins_in_any_row_order(spark):
    early, late = ("r1", "A", 5, "2018-01-01"), ("r2", "A", 1, "2018-01-09")
    other = ("r3", "B", 4, "2018-01-01")
    assert scores(spark, early, late, other) == {"A": 1, "B": 4}
    assert scores(spark, late, other, early) == {"A": 1, "B": 4}


def test_equal_and_unknown_answer_dates_have_one_winner(spark):
    assert scores(spark, ("r1", "A", 5, "2018-01-01"), ("r2", "A", 3, "2018-01-01")) == {"A": 3}
    assert scores(spark, ("r9", "A", 5, "2018-01-01"), ("r1", "A", 2, None)) == {"A": 2}


POINTS = "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double"


def test_coordinates_are_the_median_of_the_points_inside_the_box(spark):
    points = [(71, -10.0, -40.0), (71, -12.0, -41.0), (71, 51.5, -0.1)]
    points += [(72, -3.25, -60.5), (73, 51.5, -0.1), (None, -3.25, -60.5)]
    points += [(74, 6.0, -28.0), (74, -34.0, -75.0), (75, None, -60.0)]
    got = {r[0]: r[1:] for r in G.coordinates_by_prefix(spark.createDataFrame(points, POINTS)).collect()}
    assert got == {
        71: pytest.approx((-11.0, -40.5)),
        72: (-3.25, -60.5),
        74: pytest.approx((-14.0, -51.5)),
    }


def test_distances_keep_every_item_and_leave_uncovered_ones_unknown(spark):
    # One degree of latitude is 111.2 km.
    coordinates = spark.createDataFrame([(1, -8.0, -50.0), (2, -9.0, -50.0)], POINTS)
    people = [("c1", 1), ("c2", 2), ("c3", 99), ("c4", None)]
    customers = G.add_coordinates(
        spark.createDataFrame(people, "customer_id string, z int"), "z", coordinates, "customer", validate=True
    )
    sellers = G.add_coordinates(
        spark.createDataFrame([("s1", 1)], "seller_id string, z int"), "z", coordinates, "seller"
    )
    assert customers.count() == 4 and customers.columns[-2:] == ["customer_lat", "customer_lng"]
    orders_ = spark.createDataFrame(
        [(f"o{i}", c) for i, (c, _) in enumerate(people)], "order_id string, customer_id string"
    )
    items = spark.createDataFrame(
        [(f"o{i}", 1, "s1") for i in range(5)], "order_id string, order_item_id int, seller_id string"
    )
    got = G.item_distances(items, orders_, customers, sellers, validate=True)
    assert got.columns == ["order_id", "order_item_id", "distance_km"]
    km = {r.order_id: r.distance_km for r in got.collect()}
    assert km["o0"] == 0.0 and km["o1"] == pytest.approx(111.2, rel=0.001)
    assert [km["o2"], km["o3"], km["o4"]] == [None] * 3
