"""Month-by-month alerts, consecutive-month episodes and what came after them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelsight.functions.scalars import month_index, percent, ratio, round_half_away
from parcelsight.operators.rows import number_runs
from parcelsight.plans.kpis import (
    EPISODE,
    FOCAL,
    PLACE,
    TIMELINE_START,
    focal_months,
    focal_scores,
    place_months,
)


@dataclass(frozen=True)
class Rule:
    """When a place-month is worth a look. Fixed values as defaults."""

    floor: int = 100  # orders in the month
    relative: float = 2  # times the rest's rate
    absolute: float = 0.15  # late rate ...
    above_rest: float = 1.5  # ... that is also this many times the rest's rate
    running_months: int = 2  # consecutive months before the relative rule fires


def place_against_rest(months: DataFrame, floor: int) -> DataFrame:
    """Late rate of each place-month and of everybody else in that month.

    The month totals cover all places; the floor applies afterwards. The window
    runs over one row per place and month, not over orders.
    """
    month = W.partitionBy("month")
    return (
        months.withColumn("_all", F.sum("orders").over(month))
        .withColumn("_all_late", F.sum("late_orders").over(month))
        .filter(F.col("orders") >= floor)
        .select(
            "month",
            "place",
            "orders",
            "late_orders",
            ratio("late_orders", "orders").alias("rate"),
            ratio(
                F.col("_all_late") - F.col("late_orders"), F.col("_all") - F.col("orders")
            ).alias("rest_rate"),
        )
    )


def _flags(compared: DataFrame, rule: Rule) -> DataFrame:
    rate, rest = F.col("rate"), F.col("rest_rate")
    return compared.withColumns(
        {
            "relative": rate >= rule.relative * rest,
            "absolute": (rate >= rule.absolute) & (rate >= rule.above_rest * rest),
        }
    )


def alerts(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    since: str | None = TIMELINE_START,
    rule: Rule = Rule(),
) -> DataFrame:
    """Every place-month that crosses the relative or the absolute limit."""
    months = place_months(orders, customers, place, since)
    hits = _flags(place_against_rest(months, rule.floor), rule).filter("relative or absolute")
    high = F.col("rate") >= rule.absolute
    return hits.select(
        "month",
        F.col("place").alias("state"),
        "orders",
        percent("late_orders", "orders", 1).alias("state_pct"),
        round_half_away(F.col("rest_rate") * F.lit(100.0), 1).alias("rest_pct"),
        round_half_away(ratio("rate", "rest_rate"), 1).alias("ratio"),
        F.when(high & F.col("relative"), "both")
        .when(high, "absolute")
        .otherwise("relative")
        .alias("triggered_by"),
    ).orderBy("month", F.asc_nulls_last("state"))


def alert_episodes(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    since: str | None = TIMELINE_START,
    rule: Rule = Rule(),
    require_late: bool = True,
) -> DataFrame:
    """Alert months with their position in a run of consecutive relative months.

    The relative rule fires from the ``running_months``-th month of a run on; the
    absolute rule fires at once. A month under the floor breaks a run. With
    ``require_late`` a month without any late order is no relative alert.
    """
    return _episodes(place_months(orders, customers, place, since), rule, require_late)


def _episodes(months: DataFrame, rule: Rule, require_late: bool = True) -> DataFrame:
    flagged = _flags(place_against_rest(months, rule.floor), rule)
    if require_late:
        flagged = flagged.withColumn("relative", F.col("relative") & (F.col("late_orders") > 0))
    runs = number_runs(flagged, ["place", "relative"], month_index("month"))
    running = F.when(F.col("relative"), F.col("run_position")).otherwise(0)
    return (
        runs.filter("relative or absolute")
        .withColumn("run_month", running.cast("int"))
        .withColumn("fired_relative", F.col("run_month") >= rule.running_months)
        .select(
            "month",
            "place",
            "orders",
            "late_orders",
            percent("late_orders", "orders", 1).alias("rate_pct"),
            round_half_away(F.col("rest_rate") * F.lit(100.0), 1).alias("rest_pct"),
            "run_month",
            "fired_relative",
            F.col("absolute").alias("fired_absolute"),
            (F.col("fired_relative") | F.col("absolute")).alias("fired"),
        )
        .orderBy("place", "month")
    )


def alert_runs(episodes: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per run of consecutive relative months."""
    relative = episodes.filter("run_month > 0")
    first = F.add_months("month", 1 - F.col("run_month"))
    return (
        relative.groupBy("place", first.alias("first_month"))
        .agg(
            F.max("month").alias("last_month"),
            F.max("run_month").alias("months"),
            F.min(F.when(F.col("run_month") == rule.running_months, F.col("month"))).alias(
                "fired_month"
            ),
        )
        .orderBy("place", "first_month")
    )


def excess_after_alert(
    orders: DataFrame,
    customers: DataFrame,
    reviews: DataFrame,
    place: str = PLACE,
    focal: str = FOCAL,
    window: tuple[str | None, str | None] = EPISODE,
    since: str | None = TIMELINE_START,
    rule: Rule = Rule(),
) -> DataFrame:
    """One row: the focal place's excess after the rule first fired, in review points.

    An open end of the window is no limit. A window that starts or ends within a month
    counts that month's orders in the window only, while the rule sees whole months.
    """
    start, end = window
    all_months = place_months(orders, customers, place, since)

    def in_window(months: DataFrame) -> DataFrame:
        if start:
            months = months.filter(F.col("month") >= F.trunc(F.lit(start).cast("date"), "MM"))
        if end:
            months = months.filter(F.col("month") < F.lit(end).cast("date"))
        return months

    whole = all(day is None or day[8:10] == "01" and len(day) == 10 for day in window)
    if whole and (since is None or (start is not None and since <= start)):
        counted = in_window(all_months)  # the months are there already
    else:
        counted = place_months(orders, customers, place, *window)
    fired = (
        in_window(_episodes(all_months, rule))
        .filter((F.col("place") == focal) & F.col("fired_relative"))
        .agg(F.min("month"))
        .scalar()
    )
    loss = (
        focal_scores(orders, customers, reviews, place, focal, window)
        .agg(
            F.avg(F.when(~F.col("is_late"), F.col("review_score")))
            - F.avg(F.when(F.col("is_late"), F.col("review_score")))
        )
        .scalar()
    )
    excess = F.col("focal_late") - F.col("expected")
    months = focal_months(counted, focal)
    totals = (
        months.withColumn("_fired", fired)
        .groupBy("_fired")
        .agg(
            F.sum(excess).alias("_all"),
            F.sum(F.when(F.col("month") > F.col("_fired"), excess)).alias("_after"),
        )
        .withColumn("_loss", loss)
    )
    return totals.select(
        F.lit(focal).alias("place"),
        F.col("_fired").alias("fired_month"),
        round_half_away("_all", 0).alias("excess_late"),
        round_half_away("_after", 0).alias("excess_after_alert"),
        percent("_after", "_all", 0).alias("after_alert_pct"),
        round_half_away("_loss", 2).alias("score_loss"),
        round_half_away(F.col("_after") * F.col("_loss"), 0).alias("review_points"),
    )
