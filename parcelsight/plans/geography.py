"""Coordinates per zip prefix and seller-to-customer distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.delivery import great_circle_km
from parcelsight.operators.quality import duplicate_keys, require
from parcelsight.operators.quantiles import exact_quantiles
from parcelsight.operators.rows import join_many_to_one

PREFIX = "geolocation_zip_code_prefix"
LAT, LNG = "geolocation_lat", "geolocation_lng"

# The box that holds every real point, in degrees, ends included.
LAT_BOX = (-34, 6)
LNG_BOX = (-75, -28)


def points_in_box(geolocation: DataFrame) -> DataFrame:
    """Points of a known prefix inside the box; the rest are geocoding errors."""
    return geolocation.filter(
        F.col(LAT).between(*LAT_BOX) & F.col(LNG).between(*LNG_BOX) & F.col(PREFIX).isNotNull()
    )


def coordinates_by_prefix(geolocation: DataFrame) -> DataFrame:
    """Median coordinate of the in-box points of each known zip prefix."""
    # A prefix is a number of five digits: 100,000 groups at most.
    medians = exact_quantiles(
        points_in_box(geolocation), [PREFIX], {LAT: (LAT, 0.5), LNG: (LNG, 0.5)}, few_groups=True
    )
    return medians.select(PREFIX, LAT, LNG)


def add_coordinates(
    df: DataFrame, zip_column: str, coordinates: DataFrame, prefix: str, *, validate: bool = False
) -> DataFrame:
    """Attach ``<prefix>_lat`` and ``<prefix>_lng``; an uncovered prefix stays unknown.

    The NULL-safe condition matches nothing more, as no coordinate has an unknown
    prefix. It gives both sides an exchange of their own, which lets Spark split a
    hot prefix even where the coordinates come straight out of an aggregate.
    """
    places = coordinates.filter(F.col(PREFIX).isNotNull()).select(
        F.col(PREFIX).alias("_prefix"),
        F.col(LAT).alias(f"{prefix}_lat"),
        F.col(LNG).alias(f"{prefix}_lng"),
    )
    if validate:
        require({f"{PREFIX} is unique": duplicate_keys(places, ["_prefix"])})
    return df.join(places, df[zip_column].eqNullSafe(places["_prefix"]), "left").drop("_prefix")


def with_distance(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    *,
    validate: bool = False,
) -> DataFrame:
    """Items with ``distance_km`` from their seller to the order's customer.

    The customer's point is joined to orders, not to the more numerous items, so
    items meet one small and one large table only: orders first, as items often lie by order.
    """
    destinations = join_many_to_one(
        orders.select("order_id", "customer_id"),
        customers.select("customer_id", "customer_lat", "customer_lng"),
        "customer_id",
        validate=validate,
    ).drop("customer_id")
    placed = join_many_to_one(items, destinations, "order_id", validate=validate)
    origins = join_many_to_one(
        placed,
        sellers.select("seller_id", "seller_lat", "seller_lng"),
        "seller_id",
        validate=validate,
    )
    distance = great_circle_km("seller_lat", "seller_lng", "customer_lat", "customer_lng")
    return origins.select(*items.columns, distance.alias("distance_km"))


def item_distances(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    *,
    validate: bool = False,
) -> DataFrame:
    """One straight-line distance per order item."""
    keys = items.select("order_id", "order_item_id", "seller_id")
    return with_distance(keys, orders, customers, sellers, validate=validate).drop("seller_id")
