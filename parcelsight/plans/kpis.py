"""The delivery questions. Places, windows, floors and bands are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelsight.functions.bands import DELAY_BANDS, DISTANCE_BANDS, Bands
from parcelsight.functions.scalars import (
    days_between_hours,
    hour_boundaries,
    month_of,
    percent,
    ratio,
    round_half_away,
)
from parcelsight.operators.quantiles import exact_quantiles, median_of_few_values

# The defaults of the published analysis.
PLACE = "customer_state"
FOCAL = "RJ"
COMPARED = ("RJ", "BA", "SP", "MG")
TIMELINE_START = "2017-01-01"
EPISODE = ("2017-10-01", "2018-04-01")
SAME_DISTANCE_KM = (200, 600)
SELLER_FLOOR = 100
PLACE_FLOOR = 200

PURCHASED = "order_purchase_timestamp"
STAGES = ("approval", "preparation", "transit")


def order_count() -> Column:
    return F.count(F.lit(1))


def late_count() -> Column:
    return F.count_if(F.col("is_late"))


def in_scope(orders: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Delivered orders with a known outcome, purchased in [start, end)."""
    kept = orders.filter((F.col("order_status") == "delivered") & F.col("is_late").isNotNull())
    if start:
        kept = kept.filter(F.col(PURCHASED) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        kept = kept.filter(F.col(PURCHASED) < F.lit(end).cast("timestamp_ntz"))
    return kept


def _late_rates(groups: DataFrame, rate: str = "late_rate_pct", digits: int = 2) -> DataFrame:
    return groups.withColumn(rate, percent("late_orders", "orders", digits))


def _count(*keys: str):
    """Orders and late orders per key; one partial row per task and key."""

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(order_count().alias("orders"), late_count().alias("late_orders"))

    return counted


def _column_prefix(name: str) -> str:
    return name.lower().replace(" ", "_")


# -- whole population ---------------------------------------------------------


def late_rate_baseline(orders: DataFrame) -> DataFrame:
    return _late_rates(in_scope(orders).transform(_count()))


def stage_medians(orders: DataFrame) -> DataFrame:
    """Median hours per stage, late against on-time orders, as one row."""
    # Two outcomes: two groups whatever the data.
    medians = exact_quantiles(
        in_scope(orders),
        ["is_late"],
        {stage: (f"{stage}_hours", 0.5) for stage in STAGES},
        few_groups=True,
    )
    return medians.agg(
        *[
            round_half_away(F.max(F.when(F.col("is_late") == late, F.col(stage))), 1).alias(
                f"{stage}_{suffix}"
            )
            for stage in STAGES
            for late, suffix in ((True, "late"), (False, "ontime"))
        ]
    )


# -- by place, seller, category -------------------------------------------------


def with_place(orders: DataFrame, customers: DataFrame, place: str = PLACE) -> DataFrame:
    """Orders joined to their customer's place (many to one)."""
    return orders.join(customers.select("customer_id", place), "customer_id")


def late_by_state(orders: DataFrame, customers: DataFrame, place: str = PLACE) -> DataFrame:
    """Late rate per place and the place's share of all late orders."""
    scoped = in_scope(orders).select("customer_id", "is_late")
    counts = with_place(scoped, customers, place).transform(_count(place))
    # The total is added up over the places, which are few, and not over the joined orders again.
    return (
        _late_rates(counts)
        .withColumn("_all_late", F.sum("late_orders").over(W.partitionBy(F.lit(0))))
        .withColumn("share_of_late_pct", percent("late_orders", "_all_late"))
        .drop("_all_late")
        .withColumnRenamed(place, "state")
        .orderBy(F.desc("late_orders"), F.asc_nulls_last("state"))
    )


def seller_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Late rate per seller; an order counts once per seller, however many items.

    The distinct step reuses the join's partitioning on order_id, which leaves a
    plain count per seller instead of two distinct counts over all items.
    """
    # Stored in parts, orders and items meet by part; the part is no part of the answer.
    meet = [k for k in ("order_id", "order_part") if k in orders.columns and k in items.columns]
    pairs = (
        in_scope(orders)
        .select(*meet, "is_late")
        .join(items.select(*meet, "seller_id"), meet)
        .select("order_id", "is_late", "seller_id")
        .distinct()
    )
    return _late_rates(pairs.transform(_count("seller_id")), "late_pct")


def late_by_seller_volume(orders: DataFrame, items: DataFrame, limit: int = 20) -> DataFrame:
    return seller_orders(orders, items).orderBy(F.desc("late_orders"), "seller_id").limit(limit)


def late_by_seller_rate(
    orders: DataFrame, items: DataFrame, floor: int = SELLER_FLOOR, limit: int | None = 15
) -> DataFrame:
    rates = seller_orders(orders, items).filter(F.col("orders") >= floor)
    ranked = rates.orderBy(F.desc("late_pct"), "seller_id")
    return ranked if limit is None else ranked.limit(limit)


def late_by_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, limit: int | None = 15
) -> DataFrame:
    """Late rate per product category; products without one form their own group."""
    categories = items.select("order_id", "product_id").join(
        products.select("product_id", F.col("product_category").alias("category")), "product_id"
    )
    pairs = (
        categories.select("order_id", "category")
        .join(in_scope(orders).select("order_id", "is_late"), "order_id")
        .distinct()
    )
    rates = _late_rates(pairs.transform(_count("category")), "late_pct")
    ranked = rates.orderBy(F.desc("late_orders"), F.asc_nulls_last("category"))
    return ranked if limit is None else ranked.limit(limit)


# -- distance -------------------------------------------------------------------


def order_distances(items: DataFrame) -> DataFrame:
    """The longest item distance of each order."""
    return items.groupBy("order_id").agg(F.max("distance_km").alias("distance_km"))


def late_by_distance_band(
    orders: DataFrame, items: DataFrame, bands: Bands = DISTANCE_BANDS
) -> DataFrame:
    distances = order_distances(items).filter(F.col("distance_km").isNotNull())
    counts = (
        in_scope(orders)
        .select("order_id", "is_late")
        .join(distances, "order_id")
        .groupBy(
            bands.label("distance_km").alias("distance_bucket"),
            bands.position("distance_km").alias("_position"),
        )
        .agg(order_count().alias("orders"), late_count().alias("late_orders"))
    )
    return _late_rates(counts, "late_pct", 1).orderBy("_position").drop("_position")


def median_distance_by_state(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    place: str = PLACE,
    limit: int | None = 10,
) -> DataFrame:
    scoped = in_scope(orders).select("order_id", "customer_id")
    distances = order_distances(items).filter(F.col("distance_km").isNotNull())
    placed = with_place(scoped.join(distances, "order_id"), customers, place)
    medians = exact_quantiles(
        placed.select(place, "distance_km"),
        [place],
        {"_median": ("distance_km", 0.5)},
        sums={"orders": F.lit(1)},
        few_groups=True,
    )
    ranked = medians.select(
        place,
        "orders",
        round_half_away("_median", 0).alias("median_distance_km"),
    ).orderBy(F.desc("orders"), F.asc_nulls_last(place))
    return ranked if limit is None else ranked.limit(limit)


def states_at_same_distance(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    place: str = PLACE,
    window: tuple[str | None, str | None] = EPISODE,
    distance_km: tuple[float, float] = SAME_DISTANCE_KM,
    floor: int = PLACE_FLOOR,
) -> DataFrame:
    """Late rate per place among orders that travelled a similar distance."""
    scoped = in_scope(orders, *window).select("order_id", "customer_id", "is_late")
    distances = order_distances(items).filter(F.col("distance_km").between(*distance_km))
    placed = with_place(scoped.join(distances, "order_id"), customers, place)
    medians = exact_quantiles(
        placed.select(place, "distance_km", "is_late"),
        [place],
        {"_median": ("distance_km", 0.5)},
        sums={"orders": F.lit(1), "late_orders": F.col("is_late").cast("int")},
        few_groups=True,
    )
    return (
        _late_rates(medians)
        .filter(F.col("orders") >= floor)
        .select(
            place,
            "orders",
            "late_orders",
            "late_rate_pct",
            round_half_away("_median", 0).alias("median_distance_km"),
        )
        .orderBy(F.desc("late_rate_pct"), F.asc_nulls_last(place))
    )


# -- months ---------------------------------------------------------------------


def late_by_month(orders: DataFrame) -> DataFrame:
    months = in_scope(orders).select(month_of(PURCHASED).alias("month"), "is_late")
    return _late_rates(months.transform(_count("month"))).orderBy("month")


def promised_vs_actual_by_month(orders: DataFrame, since: str | None = TIMELINE_START) -> DataFrame:
    """Median days to deliver and promised days per purchase month."""
    hours = in_scope(orders, since).select(
        month_of(PURCHASED).alias("month"),
        hour_boundaries(PURCHASED, "order_delivered_customer_date").alias("actual"),
        hour_boundaries(PURCHASED, "order_estimated_delivery_date").alias("promised"),
    )
    # Whole hours: the distinct values per month are few, so counts fit one task.
    medians = median_of_few_values(hours, ["month"], ["actual", "promised"])
    return (
        medians.select(
            "month",
            round_half_away(F.col("actual") / F.lit(24.0), 1).alias("actual_days"),
            round_half_away(F.col("promised") / F.lit(24.0), 1).alias("promised_days"),
        )
        .withColumn("gap_days", round_half_away(F.col("promised_days") - F.col("actual_days"), 1))
        .orderBy("month")
    )


def place_months(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Orders and late orders per month and place: the base of all comparisons."""
    scoped = in_scope(orders, start, end).select(
        "customer_id", month_of(PURCHASED).alias("month"), "is_late"
    )
    return (
        with_place(scoped, customers, place)
        .transform(_count("month", place))
        .withColumnRenamed(place, "place")
    )


def late_rate_by_month_pivot(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    entities: Sequence[str] = COMPARED,
    since: str | None = TIMELINE_START,
) -> DataFrame:
    """One late-rate column per named place."""

    def rate(entity: str) -> Column:
        mine = F.col("place") == entity
        late, all_ = F.sum(F.when(mine, F.col("late_orders"))), F.sum(F.when(mine, F.col("orders")))
        return percent(late, all_, 1).alias(_column_prefix(entity))

    months = place_months(orders, customers, place, since)
    return months.groupBy("month").agg(*[rate(e) for e in entities]).orderBy("month")


def focal_months(months: DataFrame, focal: str) -> DataFrame:
    """Per month: the focal place's counts, everybody else's, and their late rate."""
    mine, others = F.col("place") == focal, F.col("place") != focal

    def total(which: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col(column))), F.lit(0))

    return (
        months.groupBy("month")
        .agg(
            total(mine, "orders").alias("focal_orders"),
            total(mine, "late_orders").alias("focal_late"),
            total(others, "orders").alias("rest_orders"),
            total(others, "late_orders").alias("rest_late"),
        )
        .withColumn("expected", F.col("focal_orders") * ratio("rest_late", "rest_orders"))
    )


def entity_vs_rest_by_month(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    focal: str = FOCAL,
    since: str | None = TIMELINE_START,
) -> DataFrame:
    p = _column_prefix(focal)
    months = focal_months(place_months(orders, customers, place, since), focal)
    return (
        months.select(
            "month",
            F.col("focal_orders").alias(f"{p}_orders"),
            percent("focal_late", "focal_orders").alias(f"{p}_late_pct"),
            "rest_orders",
            percent("rest_late", "rest_orders").alias("rest_late_pct"),
        )
        .withColumn(f"{p}_vs_rest", round_half_away(ratio(f"{p}_late_pct", "rest_late_pct"), 1))
        .orderBy("month")
    )


def excess_by_month(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    focal: str = FOCAL,
    window: tuple[str | None, str | None] = EPISODE,
) -> DataFrame:
    """Late orders of the focal place beyond what the rest's rate would give."""
    p = _column_prefix(focal)
    return (
        focal_months(place_months(orders, customers, place, *window), focal)
        .select(
            "month",
            F.col("focal_orders").alias(f"{p}_orders"),
            F.col("focal_late").alias(f"{p}_late"),
            round_half_away("expected", 0).alias("expected_late"),
            round_half_away(F.col("focal_late") - F.col("expected"), 0).alias("excess_late"),
        )
        .orderBy("month")
    )


def episode_size(
    orders: DataFrame,
    customers: DataFrame,
    place: str = PLACE,
    focal: str = FOCAL,
    window: tuple[str | None, str | None] = EPISODE,
) -> DataFrame:
    """The episode as one row, against all late orders of the whole period."""
    p = _column_prefix(focal)
    all_late = in_scope(orders).agg(late_count()).scalar()
    totals = focal_months(place_months(orders, customers, place, *window), focal).agg(
        F.sum("focal_orders").alias(f"{p}_orders"),
        F.sum("focal_late").alias(f"{p}_late"),
        F.sum("expected").alias("_expected"),
    )
    excess = F.col(f"{p}_late") - F.col("_expected")
    return totals.select(
        f"{p}_orders",
        f"{p}_late",
        round_half_away("_expected", 0).alias("expected_late"),
        round_half_away(excess, 0).alias("excess_late"),
        percent(excess, all_late, 1).alias("pct_of_all_late"),
    )


# -- reviews --------------------------------------------------------------------


def review_by_delay_band(
    orders: DataFrame, reviews: DataFrame, bands: Bands = DELAY_BANDS
) -> DataFrame:
    counts = (
        in_scope(orders)
        .select("order_id", "delay_days")
        .join(reviews.select("order_id", "review_score"), "order_id")
        .groupBy(
            bands.label("delay_days").alias("delay_bucket"),
            bands.position("delay_days").alias("_position"),
        )
        .agg(
            order_count().alias("orders"),
            F.avg("review_score").alias("_score"),
            F.count_if(F.col("review_score") == 1).alias("_one_star"),
        )
    )
    return (
        counts.orderBy("_position")
        .select(
            "delay_bucket",
            "orders",
            round_half_away("_score", 2).alias("avg_score"),
            percent("_one_star", "orders", 1).alias("one_star_pct"),
        )
    )


def focal_scores(
    orders: DataFrame,
    customers: DataFrame,
    reviews: DataFrame,
    place: str,
    focal: str,
    window: tuple[str | None, str | None],
) -> DataFrame:
    """Outcome and review score of the focal place's orders in the window."""
    scoped = in_scope(orders, *window).select("order_id", "customer_id", "is_late")
    residents = customers.filter(F.col(place) == focal)
    return with_place(scoped, residents, place).join(
        reviews.select("order_id", "review_score"), "order_id"
    )


def review_cost_of_lateness(
    orders: DataFrame,
    customers: DataFrame,
    reviews: DataFrame,
    place: str = PLACE,
    focal: str = FOCAL,
    window: tuple[str | None, str | None] = EPISODE,
) -> DataFrame:
    """Average score of on-time and late orders of one place in a window."""
    scores = focal_scores(orders, customers, reviews, place, focal, window)
    return scores.groupBy("is_late").agg(
        order_count().alias("orders"),
        round_half_away(F.avg("review_score"), 2).alias("avg_score"),
    )


def promised_and_actual_days() -> dict[str, Column]:
    """Per-order days to deliver and days promised, from crossed clock hours."""
    return {
        "actual_days": days_between_hours(PURCHASED, "order_delivered_customer_date"),
        "promised_days": days_between_hours(PURCHASED, "order_estimated_delivery_date"),
    }
