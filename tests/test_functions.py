"""Scalar helpers, derived delivery facts and bands on hand-made rows."""

import math

import pytest
from helpers import ts
from pyspark.sql import functions as F

from parcelsight.functions import delivery as D
from parcelsight.functions import scalars as S
from parcelsight.functions.bands import DELAY_BANDS, DISTANCE_BANDS

PAIR = "a timestamp_ntz, b timestamp_ntz"


def pair(values, a, b, column):
    return values(PAIR, [(ts(a), ts(b))], column)[0]


# -- scalars ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "value, digits, expected",
    [
        (1.005, 2, 1.0),
        (0.285, 2, 0.28),
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (-0.25, 1, -0.3),
        (10.126, 2, 10.13),
        (None, 2, None),
    ],
)
def test_rounding_goes_half_away_on_the_binary_value(values, value, digits, expected):
    assert values("x double", [(value,)], S.round_half_away("x", digits)) == [expected]


def test_ratio_is_unknown_for_a_zero_or_unknown_whole(values):
    rows = [(1, 2), (1, 0), (0, 0), (1, None), (None, 2)]
    assert values("p int, w int", rows, S.ratio("p", "w")) == [0.5, None, None, None, None]


def test_percent_rounds(values):
    assert values("p int, w int", [(1, 3), (1, 0)], S.percent("p", "w")) == [33.33, None]


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("2018-01-01 10:59", "2018-01-01 12:01", 2),
        ("2018-01-01 12:01", "2018-01-01 10:59", -2),
        ("2018-01-01 10:00", "2018-01-01 10:59:59", 0),
        ("2018-01-01 23:59:59", "2018-01-02 00:00", 1),
        ("1969-12-31 23:30", "1970-01-01 00:30", 1),
        (None, "2018-01-01", None),
    ],
)
def test_hour_boundaries_count_clock_hours(values, a, b, expected):
    assert pair(values, a, b, S.hour_boundaries("a", "b")) == expected


def test_hour_boundaries_do_not_depend_on_the_session_zone(spark, values):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        # This zone skipped midnight to one o'clock on 2018-11-04.
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        hours = S.hour_boundaries("a", "b")
        assert pair(values, "2018-11-03 22:30", "2018-11-04 02:30", hours) == 4
        assert pair(values, "2018-11-04 00:30", "2018-11-04 01:30", hours) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days_between_hours_is_a_double(values):
    assert pair(values, "2018-01-01", "2018-01-02 12:00", S.days_between_hours("a", "b")) == 1.5


def test_month_of_and_index(values):
    rows = [(ts("2017-12-31 23:59"), ts("2018-01-01"))]
    months = values(PAIR, rows, F.struct(S.month_of("a").alias("m"), S.month_of("b").alias("n")))[0]
    assert (str(months.m), str(months.n)) == ("2017-12-01", "2018-01-01")
    gap = S.month_index(S.month_of("b")) - S.month_index(S.month_of("a"))
    assert values(PAIR, rows, gap) == [1]


def test_parse_timestamp_accepts_dates_and_rejects_noise(values):
    rows = [("2018-01-03 14:32:00",), ("2018-01-03",), ("soon",), (None,)]
    expected = [ts("2018-01-03 14:32"), ts("2018-01-03"), None, None]
    assert values("t string", rows, S.parse_timestamp("t")) == expected


# -- delay and lateness -----------------------------------------------------------


@pytest.mark.parametrize(
    "delivered, promised, expected",
    [
        ("2016-02-29 00:01", "2016-02-29", 0),
        ("2016-03-01 23:59", "2016-02-28", 2),
        ("2015-12-31 06:45", "2016-01-07", -7),
        (None, "2016-02-29", None),
        ("2016-02-29", None, None),
    ],
)
def test_delay_days_compares_dates(values, delivered, promised, expected):
    assert pair(values, delivered, promised, D.delay_days("a", "b")) == expected


def test_is_late_is_three_valued(values):
    assert values("d int", [(2,), (0,), (-1,), (None,)], D.is_late("d")) == [
        True,
        False,
        False,
        None,
    ]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2018-01-01 10:00", "2018-01-01 12:00", 2.0),
        ("2018-01-01 10:00", "2018-01-01 10:30", 0.5),
        ("2018-01-01 10:00", "2018-01-01 10:00", 0.0),
        ("2018-01-01 12:00", "2018-01-01 10:00", None),
        (None, "2018-01-01 10:00", None),
    ],
)
def test_stage_hours_drop_reversed_pairs(values, start, end, expected):
    assert pair(values, start, end, D.stage_hours("a", "b")) == expected


@pytest.mark.parametrize(
    "earlier, later, expected",
    [
        ("2018-01-02", "2018-01-01", True),
        ("2018-01-01", "2018-01-02", False),
        ("2018-01-01", "2018-01-01", False),
        (None, "2018-01-01", None),
        ("2018-01-01", None, None),
    ],
)
def test_out_of_order_is_unknown_without_both(values, earlier, later, expected):
    assert pair(values, earlier, later, D.out_of_order("a", "b")) is expected


@pytest.mark.parametrize(
    "limit, handed_over, expected",
    [
        ("2018-01-02", "2018-01-03", True),
        ("2018-01-02", "2018-01-01", False),
        ("2018-01-02", "2018-01-02", False),
        ("2018-01-02", None, None),
        (None, "2018-01-02", None),
    ],
)
def test_missed_deadline(values, limit, handed_over, expected):
    assert pair(values, limit, handed_over, D.missed_deadline("a", "b")) is expected


# -- distance ---------------------------------------------------------------------

POINTS = "a double, b double, c double, d double"


def km(values, *point):
    return values(POINTS, [point], D.great_circle_km("a", "b", "c", "d"))[0]


def test_distance_of_a_point_to_itself_is_zero(values):
    assert km(values, 51.4779, -0.0015, 51.4779, -0.0015) == pytest.approx(0.0)


def test_distance_between_two_known_cities(values):
    assert km(values, 48.8566, 2.3522, 52.52, 13.405) == pytest.approx(878, rel=0.01)


def test_distance_of_opposite_points_is_half_the_globe(values):
    assert km(values, 0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6371)
    assert km(values, 90.0, 12.0, -90.0, 12.0) == pytest.approx(math.pi * 6371)


@pytest.mark.parametrize("missing", range(4))
def test_distance_with_an_unknown_coordinate_is_unknown(values, missing):
    point = [-23.5, -46.6, -22.9, -43.1]
    point[missing] = None
    assert km(values, *point) is None


# -- bands ------------------------------------------------------------------------


def test_distance_bands_exclude_their_upper_end(values):
    rows = [(99.9,), (100.0,), (300.0,), (700.0,), (1500.0,), (None,)]
    assert values("x double", rows, DISTANCE_BANDS.label("x")) == [
        "under 100 km",
        "100-300 km",
        "300-700 km",
        "700-1500 km",
        "over 1500 km",
        None,
    ]
    assert values("x double", rows, DISTANCE_BANDS.position("x")) == [1, 2, 3, 4, 5, None]


def test_delay_bands_include_their_upper_end(values):
    rows = [(-5,), (0,), (1,), (3,), (4,), (7,), (14,), (15,), (None,)]
    assert values("x int", rows, DELAY_BANDS.position("x")) == [1, 1, 2, 2, 3, 3, 4, 5, None]
    assert values("x int", [(0,), (15,)], DELAY_BANDS.label("x")) == [
        "on time or early",
        "15+ days late",
    ]
