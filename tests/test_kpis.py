"""Questions and alerts on hand-made orders."""

from datetime import date

import pytest
from helpers import ts

from parcelsight.plans import alerts as A
from parcelsight.plans import kpis as K

ORDER = (
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, is_late boolean, delay_days int"
)


def orders(spark, *rows):
    """Rows (order, customer, purchase date, is_late[, status]); late means 5 days."""
    full = []
    for order, customer, day, late, *status in rows:
        delay = None if late is None else 5 if late else -1
        full.append((order, customer, status[0] if status else "delivered", ts(day), late, delay))
    return spark.createDataFrame(full, ORDER)


def customers(spark, **places):
    return spark.createDataFrame(list(places.items()), "customer_id string, customer_state string")


def batch(prefix, customer, day, on_time, late):
    """Rows of one customer and day: so many on time, so many late."""
    flags = [False] * on_time + [True] * late
    return [(f"{prefix}{i}", customer, day, flag) for i, flag in enumerate(flags)]


def test_scope_needs_delivery_and_a_known_outcome(spark):
    df = orders(
        spark,
        ("a", "c", "2017-01-01", True),
        ("b", "c", "2017-01-01", False),
        ("c", "c", "2017-01-01", None),
        ("d", "c", "2017-01-01", True, "shipped"),
    )
    assert tuple(K.late_rate_baseline(df).collect()[0]) == (2, 1, 50.0)


def test_scope_window_is_half_open(spark):
    df = orders(
        spark,
        ("a", "c", "2017-01-01", True),
        ("b", "c", "2017-01-31 23:59:59", True),
        ("c", "c", "2017-02-01", True),
    )
    kept = K.in_scope(df, "2017-01-01", "2017-02-01").collect()
    assert {r.order_id for r in kept} == {"a", "b"}


def test_an_empty_scope_has_an_unknown_rate(spark):
    df = orders(spark, ("a", "c", "2017-01-01", None))
    assert tuple(K.late_rate_baseline(df).collect()[0]) == (0, 0, None)


def test_shares_of_late_orders_sum_to_one_hundred(spark):
    df = orders(spark, *batch("a", "x", "2017-01-01", 7, 3), *batch("b", "y", "2017-01-01", 4, 1))
    got = K.late_by_state(df, customers(spark, x="RJ", y="SP")).collect()
    assert [tuple(r) for r in got] == [("RJ", 10, 3, 30.0, 75.0), ("SP", 5, 1, 20.0, 25.0)]


def items(spark, *rows):
    return spark.createDataFrame(
        list(rows), "order_id string, seller_id string, product_id string, distance_km double"
    )


def test_an_order_counts_once_per_seller_and_category(spark):
    df = orders(spark, ("a", "c", "2017-01-01", True), ("b", "c", "2017-01-01", False))
    lines = items(
        spark,
        ("a", "s1", "p1", 1.0),
        ("a", "s1", "p2", 2.0),
        ("a", "s2", "p3", 3.0),
        ("b", "s1", "p1", 4.0),
    )
    sellers = K.late_by_seller_volume(df, lines).collect()
    assert [tuple(r) for r in sellers] == [("s1", 2, 1, 50.0), ("s2", 1, 1, 100.0)]
    assert [r.seller_id for r in K.late_by_seller_rate(df, lines, floor=2).collect()] == ["s1"]
    assert [r.seller_id for r in K.late_by_seller_rate(df, lines, floor=1, limit=1).collect()] == ["s2"]
    products = spark.createDataFrame(
        [("p1", "toys"), ("p2", "toys"), ("p3", None)], "product_id string, product_category string"
    )
    got = K.late_by_category(df, lines, products).collect()
    assert [tuple(r) for r in got] == [("toys", 2, 1, 50.0), (None, 1, 1, 100.0)]


def test_distance_questions_use_the_longest_item(spark):
    df = orders(
        spark,
        ("a", "x", "2017-01-01", True),
        ("b", "x", "2017-01-01", False),
        ("c", "x", "2017-01-01", False),
        ("d", "x", "2017-01-01", False),
    )
    lines = items(
        spark,
        ("a", "s", "p", 50.0),
        ("a", "s", "p", 400.0),
        ("b", "s", "p", 250.0),
        ("c", "s", "p", None),
    )
    people = customers(spark, x="RJ")
    bands = K.late_by_distance_band(df, lines).collect()
    assert [tuple(r) for r in bands] == [("100-300 km", 1, 0, 0.0), ("300-700 km", 1, 1, 100.0)]
    medians = K.median_distance_by_state(df, people, lines).collect()
    assert [tuple(r) for r in medians] == [("RJ", 2, 325.0)]
    same = K.states_at_same_distance(df, people, lines, window=(None, None), floor=1).collect()
    assert [tuple(r) for r in same] == [("RJ", 2, 1, 50.0, 325.0)]
    ends = K.states_at_same_distance(
        df, people, lines, window=(None, None), distance_km=(250, 400), floor=2
    )
    assert ends.count() == 1


def test_months_and_the_gap_between_rounded_medians(spark):
    schema = ORDER + ", order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    rows = [
        ("a", "c", "delivered", ts("2017-01-05 10:59"), True, 5, ts("2017-01-06 12:01"), ts("2017-01-07")),
        ("b", "c", "delivered", ts("2017-01-05"), False, -1, ts("2017-01-08"), ts("2017-01-10")),
    ]
    got = K.promised_vs_actual_by_month(spark.createDataFrame(rows, schema)).collect()
    # hours 26 and 72 on the way; 38 and 120 promised
    assert [tuple(r) for r in got] == [(date(2017, 1, 1), 2.0, 3.3, 1.3)]


def test_focal_place_against_the_rest(spark):
    df = orders(
        spark,
        *batch("a", "x", "2017-10-01", 6, 4),
        *batch("b", "y", "2017-10-02", 9, 1),
        *batch("c", "x", "2017-11-01", 1, 1),
        *batch("d", "y", "2017-12-01", 2, 0),
    )
    people = customers(spark, x="RJ", y="SP")
    oct_, nov, dec = K.entity_vs_rest_by_month(df, people).collect()
    assert tuple(oct_)[1:] == (10, 40.0, 10, 10.0, 4.0)
    assert tuple(nov)[1:] == (2, 50.0, 0, None, None)
    assert tuple(dec)[1:] == (0, None, 2, 0.0, None)
    assert oct_.asDict().keys() >= {"rj_orders", "rj_late_pct", "rj_vs_rest"}
    pivot = K.late_rate_by_month_pivot(df, people, entities=("RJ", "BA")).collect()
    assert [tuple(r)[1:] for r in pivot] == [(40.0, None), (50.0, None), (None, None)]


def test_excess_is_late_orders_beyond_the_rests_rate(spark):
    df = orders(
        spark,
        *batch("a", "x", "2017-10-01", 60, 40),
        *batch("b", "y", "2017-10-02", 90, 10),
        *batch("c", "x", "2018-04-01", 0, 10),
    )
    people = customers(spark, x="RJ", y="SP")
    assert [tuple(r)[1:] for r in K.excess_by_month(df, people).collect()] == [(100, 40, 10.0, 30.0)]
    assert tuple(K.episode_size(df, people).collect()[0]) == (100, 40, 10.0, 30.0, 50.0)


def test_review_questions(spark):
    df = orders(
        spark,
        ("a", "x", "2017-10-01", True),
        ("b", "x", "2017-10-01", True),
        ("c", "x", "2017-10-01", False),
        ("d", "y", "2017-10-01", False),
        ("e", "x", "2017-10-01", False),
    )
    reviews = spark.createDataFrame(
        [("a", 1), ("b", 2), ("c", 5), ("d", 3)], "order_id string, review_score int"
    )
    got = K.review_by_delay_band(df, reviews).collect()
    assert [tuple(r) for r in got] == [("on time or early", 2, 4.0, 0.0), ("4-7 days late", 2, 1.5, 50.0)]
    cost = K.review_cost_of_lateness(df, customers(spark, x="RJ", y="SP"), reviews).collect()
    assert {r.is_late: (r.orders, r.avg_score) for r in cost} == {True: (2, 1.5), False: (1, 5.0)}


# -- alerts -------------------------------------------------------------------------


def months(spark, **series):
    """Orders of several places: {place: {month: (on_time, late)}}."""
    rows = []
    for place, counts in series.items():
        for month, (on_time, late) in counts.items():
            rows += batch(f"{place}{month}", place, f"{month}-10", on_time, late)
    return orders(spark, *rows), customers(spark, **{p: p for p in series})


RULE = A.Rule(floor=10)


def test_alert_kinds(spark):
    df, people = months(
        spark,
        A={"2017-01": (7, 3), "2017-02": (18, 2), "2017-03": (8, 2)},
        B={"2017-01": (19, 1), "2017-02": (48, 2), "2017-03": (87, 13)},
    )
    got = {(str(r.month), r.state): r for r in A.alerts(df, people, rule=RULE).collect()}
    assert {k: r.triggered_by for k, r in got.items()} == {
        ("2017-01-01", "A"): "both",
        ("2017-02-01", "A"): "relative",
        ("2017-03-01", "A"): "absolute",
    }
    row = got["2017-01-01", "A"]
    assert (row.orders, row.state_pct, row.rest_pct, row.ratio) == (10, 30.0, 5.0, 6.0)


def test_a_month_without_any_late_order_alerts_with_an_unknown_ratio(spark):
    df, people = months(spark, A={"2017-01": (10, 0)}, B={"2017-01": (10, 0)})
    got = A.alerts(df, people, rule=RULE).collect()
    assert {(r.state, r.ratio, r.triggered_by) for r in got} == {("A", None, "relative"), ("B", None, "relative")}
    assert A.alert_episodes(df, people, rule=RULE).count() == 0
    assert A.alert_episodes(df, people, rule=RULE, require_late=False).count() == 2


def test_a_place_without_others_never_alerts(spark):
    df, people = months(spark, A={"2017-01": (5, 5)})
    assert A.alerts(df, people, rule=RULE).count() == 0
    assert A.alert_episodes(df, people, rule=RULE).count() == 0


def test_the_floor_applies_after_the_totals(spark):
    df, people = months(spark, A={"2017-01": (8, 2)}, B={"2017-01": (0, 9)})
    got = A.alerts(df, people, rule=A.Rule(floor=10)).collect()
    assert got == []  # B is under the floor but still counts in A's rest rate of 100%


def test_runs_cross_the_year_and_break_at_gaps(spark):
    calm, bad = (100, 1), (9, 1)
    df, people = months(
        spark,
        A={"2017-11": bad, "2017-12": bad, "2018-01": bad, "2018-03": bad},
        B={"2017-02": bad, "2017-05": bad, "2017-06": bad, "2017-07": (4, 1), "2017-08": bad},
        REST={m: calm for m in (
            "2017-02", "2017-05", "2017-06", "2017-07", "2017-08", "2017-11", "2017-12", "2018-01", "2018-03")},
    )
    episodes = A.alert_episodes(df, people, rule=RULE)
    runs = [tuple(r) for r in A.alert_runs(episodes, RULE).collect()]
    d = lambda text: date.fromisoformat(f"{text}-01")
    assert runs == [
        ("A", d("2017-11"), d("2018-01"), 3, d("2017-12")),
        ("A", d("2018-03"), d("2018-03"), 1, None),
        ("B", d("2017-02"), d("2017-02"), 1, None),
        ("B", d("2017-05"), d("2017-06"), 2, d("2017-06")),
        # July is under the floor, so August starts again
        ("B", d("2017-08"), d("2017-08"), 1, None),
    ]
    fired = {(r.place, str(r.month)[:7]) for r in episodes.filter("fired_relative").collect()}
    assert fired == {("A", "2017-12"), ("A", "2018-01"), ("B", "2017-06")}


def test_the_absolute_rule_fires_at_once(spark):
    df, people = months(spark, A={"2017-01": (8, 2)}, B={"2017-01": (87, 13)})
    (row,) = A.alert_episodes(df, people, rule=RULE).collect()
    assert (row.place, row.run_month, row.fired_relative, row.fired_absolute, row.fired) == (
        "A", 0, False, True, True)


def test_excess_after_the_rule_fired(spark):
    bad, calm = (50, 50), (90, 10)
    df, people = months(
        spark,
        RJ={"2017-10": calm, "2017-11": bad, "2017-12": bad, "2018-01": bad, "2018-02": bad},
        SP={m: calm for m in ("2017-10", "2017-11", "2017-12", "2018-01", "2018-02")},
    )
    reviews = df.selectExpr("order_id", "if(is_late, 2, 4) as review_score")
    (row,) = A.excess_after_alert(df, people, reviews).collect()
    assert tuple(row) == ("RJ", date(2017, 12, 1), 160.0, 80.0, 50.0, 2.0, 160.0)


def test_excess_is_unknown_when_the_rule_never_fired(spark):
    df, people = months(spark, RJ={"2017-10": (90, 10)}, SP={"2017-10": (90, 10)})
    reviews = df.selectExpr("order_id", "if(is_late, 2, 4) as review_score")
    (row,) = A.excess_after_alert(df, people, reviews).collect()
    assert (row.fired_month, row.excess_late, row.excess_after_alert, row.review_points) == (None, 0.0, None, None)


def test_open_windows_and_windows_within_a_month(spark):
    quiet, bad = (95, 5), (60, 40)
    df, people = months(
        spark,
        RJ={"2017-09": quiet, "2017-10": bad, "2017-11": bad, "2017-12": bad},
        SP={m: (95, 5) for m in ("2017-09", "2017-10", "2017-11", "2017-12")},
    )
    reviews = df.selectExpr("order_id", "if(is_late, 2, 4) as review_score")

    def ask(window, since="2017-01-01"):
        (row,) = A.excess_after_alert(df, people, reviews, window=window, since=since).collect()
        return row

    whole = ask(("2017-09-01", "2018-01-01"))
    assert (whole.fired_month, whole.excess_after_alert) == (date(2017, 11, 1), 35.0)
    for window in ((None, None), (None, "2018-01-01"), ("2017-09-01", None)):
        assert ask(window) == whole and ask(window, None) == whole
    # Orders are dated the first of a month or later; the first month still counts as one.
    within = ask(("2017-11-01 00:00:00", "2018-01-01"))
    assert (within.fired_month, within.excess_after_alert) == (date(2017, 11, 1), 35.0)
    middle = ask(("2017-10-15", "2018-01-01"))
    assert middle.fired_month == date(2017, 11, 1)


@pytest.mark.parametrize("question", ["late_by_month", "late_by_state"])
def test_groups_add_up_to_the_baseline(spark, question):
    df, people = months(
        spark, A={"2017-01": (3, 2), "2017-02": (1, 0)}, B={"2017-01": (2, 2), "2018-02": (4, 1)}
    )
    groups = K.late_by_month(df) if question == "late_by_month" else K.late_by_state(df, people)
    total = groups.groupBy().sum("orders", "late_orders").collect()[0]
    assert tuple(total) == tuple(K.late_rate_baseline(df).select("orders", "late_orders").collect()[0])
