"""The serving export: facts, dimensions and finished cuts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.functions.bands import DELAY_BANDS, DISTANCE_BANDS
from parcelsight.operators.quality import (
    QualityError,
    duplicate_keys,
    null_violations,
    orphan_keys,
    require,
)
from parcelsight.plans.alerts import Rule, alerts
from parcelsight.plans.kpis import (
    EPISODE,
    FOCAL,
    PLACE,
    PURCHASED,
    TIMELINE_START,
    excess_by_month,
    in_scope,
    late_by_seller_rate,
    order_distances,
    promised_and_actual_days,
    with_place,
)
from parcelsight.sources.publish import publish, read_published
from parcelsight.sources.schemas import BRAZIL_STATES

# Stage labels in serving order.
STAGE_LABELS = {
    "approval_hours": ("Payment approval", 1),
    "preparation_hours": ("Preparation", 2),
    "transit_hours": ("Transit", 3),
}


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    place: str = PLACE,
) -> DataFrame:
    """One row per order in scope, with distance, bands and review score."""
    # Joins on order_id come first: stored by order, they need no exchange.
    described = (
        in_scope(orders)
        .join(order_distances(items), "order_id", "left")
        .join(reviews.select("order_id", "review_score"), "order_id", "left")
    )
    return with_place(described, customers, place).select(
        "order_id",
        F.to_date(PURCHASED).alias("order_date"),
        place,
        "is_late",
        "delay_days",
        *STAGE_LABELS,
        *[days.alias(name) for name, days in promised_and_actual_days().items()],
        "distance_km",
        DISTANCE_BANDS.label("distance_km").alias("distance_bucket"),
        DISTANCE_BANDS.position("distance_km").alias("distance_bucket_order"),
        DELAY_BANDS.label("delay_days").alias("delay_bucket"),
        DELAY_BANDS.position("delay_days").alias("delay_bucket_order"),
        "review_score",
    )


def fact_stage_hours(orders: DataFrame, customers: DataFrame, place: str = PLACE) -> DataFrame:
    """One row per order and known stage, from one scan."""
    placed = with_place(in_scope(orders), customers, place).withColumn(
        "order_date", F.to_date(PURCHASED)
    )
    ids = ["order_id", "order_date", place, "is_late"]
    long = placed.unpivot(ids, list(STAGE_LABELS), "_stage", "hours").filter("hours is not null")
    label = position = None
    for name, (text, number) in STAGE_LABELS.items():
        here = F.col("_stage") == name
        label = F.when(here, text) if label is None else label.when(here, text)
        position = F.when(here, number) if position is None else position.when(here, number)
    return long.select(*ids, label.alias("stage"), position.alias("stage_order"), "hours")


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day between the first and the last order in scope."""
    bounds = in_scope(orders).agg(
        F.to_date(F.min(PURCHASED)).alias("first_day"), F.to_date(F.max(PURCHASED)).alias("last_day")
    )
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month_number"),
        F.date_format("date", "MMM yyyy").alias("month_label"),
        (F.year("date") * 100 + F.month("date")).alias("month_sort"),
    )


def dim_state(
    spark: SparkSession, states: Sequence[tuple[str, str, str]] = tuple(BRAZIL_STATES)
) -> DataFrame:
    """Names and regions of the state codes: reference data, not observed data."""
    return spark.createDataFrame(
        list(states), "state_code string, state_name string, region string"
    )


def seller_rates(orders: DataFrame, items: DataFrame) -> DataFrame:
    return late_by_seller_rate(orders, items, limit=None)


@dataclass(frozen=True)
class Focus:
    """Whose alerts and excess are exported, and for when. Fixed values as defaults."""

    place: str = PLACE
    focal: str = FOCAL
    window: tuple[str | None, str | None] = EPISODE
    since: str | None = TIMELINE_START
    rule: Rule = Rule()
    states: tuple[tuple[str, str, str], ...] = tuple(BRAZIL_STATES)


def build_star(
    spark: SparkSession, model: Mapping[str, DataFrame], focus: Focus = Focus()
) -> dict[str, DataFrame]:
    """All export tables of a model, by name."""
    orders, customers, items = model["orders"], model["customers"], model["order_items"]
    return {
        "fact_orders": fact_orders(orders, customers, items, model["reviews"]),
        "fact_stage_hours": fact_stage_hours(orders, customers),
        "dim_date": dim_date(orders),
        "dim_state": dim_state(spark, focus.states),
        "seller_rates": seller_rates(orders, items),
        "alerts": alerts(orders, customers, focus.place, focus.since, focus.rule),
        "rio_excess": excess_by_month(orders, customers, focus.place, focus.focal, focus.window),
    }


def _require_grain(fact_rows: int, scope_rows: int) -> None:
    if fact_rows != scope_rows:
        raise QualityError(
            f"fact has {fact_rows} rows for {scope_rows} orders in scope: a join changed the grain"
        )


def check_fact_grain(fact: DataFrame, orders: DataFrame) -> None:
    """Raise unless the fact has exactly one row per order in scope."""
    _require_grain(fact.count(), in_scope(orders).count())


def check_fact_joins(model: Mapping[str, DataFrame]) -> None:
    """Raise if a join of the fact would multiply or lose orders.

    Reads keys only, so a bad export stops before the fact itself is computed.
    """
    orders, customers = in_scope(model["orders"]), model["customers"]
    require(
        {
            "orders: key order_id": duplicate_keys(orders, ["order_id"]),
            "customers: key customer_id": duplicate_keys(customers, ["customer_id"]),
            "reviews: key order_id": duplicate_keys(model["reviews"], ["order_id"]),
            "orders: customer_id is known": null_violations(orders, ["customer_id"]),
            "orders: customer_id in customers": orphan_keys(
                orders, "customer_id", customers, "customer_id"
            ),
        }
    )


def write_star(
    star: Mapping[str, DataFrame], model: Mapping[str, DataFrame], out_dir: str
) -> dict[str, int]:
    """Check the fact's joins, write every table as a new version, compare the fact's written
    rows with the orders in scope, and publish; returns the rows written. The export
    published before stays readable until then, and for good if a check fails."""
    check_fact_joins(model)

    def check(written: Mapping[str, DataFrame]) -> None:
        check_fact_grain(written["fact_orders"], model["orders"])

    return publish(model["orders"].sparkSession, star, out_dir, check)


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The published export tables."""
    return read_published(spark, out_dir)
