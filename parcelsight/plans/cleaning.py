"""Raw tables to clean tables. Everything is a lazy projection or one join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.delivery import (
    delay_days,
    is_late,
    missed_deadline,
    out_of_order,
    stage_hours,
)
from parcelsight.operators.rows import join_many_to_one, latest_per_key, lookup_with_overrides

# Categories the translation table lacks.
MISSING_TRANSLATIONS = {
    "pc_gamer": "gaming_pc",
    "portateis_cozinha_e_preparadores_de_alimentos": "small_appliances_kitchen_and_food_preparation",
}

PURCHASED = "order_purchase_timestamp"
APPROVED = "order_approved_at"
HANDED_OVER = "order_delivered_carrier_date"
DELIVERED = "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


def clean_orders(orders: DataFrame) -> DataFrame:
    """Add delay, lateness, three stage durations and two contradiction flags."""
    return orders.withColumn("delay_days", delay_days(DELIVERED, PROMISED)).withColumns(
        {
            "is_late": is_late("delay_days"),
            "approval_hours": stage_hours(PURCHASED, APPROVED),
            "preparation_hours": stage_hours(APPROVED, HANDED_OVER),
            "transit_hours": stage_hours(HANDED_OVER, DELIVERED),
            "carrier_before_approved": out_of_order(APPROVED, HANDED_OVER),
            "delivered_before_carrier": out_of_order(HANDED_OVER, DELIVERED),
        }
    )


def clean_order_items(
    items: DataFrame, orders: DataFrame, *, validate: bool = False
) -> DataFrame:
    """Add the missed-deadline flag; the hand-over date itself stays with orders."""
    dates = orders.select("order_id", HANDED_OVER)
    missed = missed_deadline("shipping_limit_date", HANDED_OVER)
    return join_many_to_one(items, dates, "order_id", validate=validate).select(
        *items.columns, missed.alias("missed_shipping_deadline")
    )


def clean_products(
    products: DataFrame,
    translation: DataFrame,
    overrides: Mapping[str, str] = MISSING_TRANSLATIONS,
    *,
    validate: bool = False,
) -> DataFrame:
    """Reduce products to one translated category each; no category stays none."""
    return lookup_with_overrides(
        products.select("product_id", "product_category_name"),
        translation,
        key="product_category_name",
        value="product_category_name_english",
        output="product_category",
        overrides=overrides,
        validate=validate,
    ).select("product_id", "product_category")


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """One score per order: that of the latest answer."""
    ties = ["review_id"] if "review_id" in reviews.columns else []
    latest = latest_per_key(reviews, "order_id", "review_answer_timestamp", ties)
    return latest.select("order_id", F.col("review_score"))
