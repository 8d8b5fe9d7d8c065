"""What a first look at the raw tables asks: summaries, integrity, coverage, anomalies."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.scalars import ratio, round_half_away
from parcelsight.operators import profile as P
from parcelsight.operators import quality as Q
from parcelsight.plans import geography as G
from parcelsight.plans.cleaning import APPROVED, DELIVERED, HANDED_OVER, PURCHASED

# Columns whose values are counted, and numbers that are summarised, by raw table.
COUNTED = {"orders": ["order_status"], "reviews": ["review_score"], "payments": ["payment_type"]}
SUMMARISED = {
    "order_items": ["price", "freight_value"],
    "payments": ["payment_value"],
    "products": ["product_weight_g"],
}


def summaries(table: str, df: DataFrame) -> dict[str, DataFrame]:
    """Value counts and numeric summaries of the columns the table is known for."""
    counted = [c for c in COUNTED.get(table, []) if c in df.columns]
    summed = [c for c in SUMMARISED.get(table, []) if c in df.columns]
    return {f"values of {c}": P.value_counts(df, c) for c in counted} | {
        f"summary of {c}": P.describe(df, c) for c in summed
    }


def out_of_order(orders: DataFrame) -> DataFrame:
    """(check_name, violations): orders whose steps are dated in the wrong order."""
    pairs = {
        "approved before purchased": (PURCHASED, APPROVED),
        "carrier before approved": (APPROVED, HANDED_OVER),
        "delivered before carrier": (HANDED_OVER, DELIVERED),
    }
    return Q.count_violations(
        {name: Q.out_of_order_rows(orders, *pair) for name, pair in pairs.items()}
    )


def referential_integrity(
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    reviews: DataFrame,
    orders: DataFrame,
    translation: DataFrame,
) -> DataFrame:
    """(check_name, violations): keys without a row in the table they point to."""
    category = "product_category_name"
    links = {
        "items to products": (items, products, "product_id"),
        "items to sellers": (items, sellers, "seller_id"),
        "reviews to orders": (reviews, orders, "order_id"),
        "categories to translation": (products, translation, category),
    }
    found = [
        Q.as_lines(
            Q.key_census({"child": (child, key), "parent": (parent, key)}), {name: Q.orphans("child", "parent")}
        )
        for name, (child, parent, key) in links.items()
    ]
    return reduce(DataFrame.unionAll, found)


def orphan_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders without an item."""
    return Q.orphan_keys(orders, "order_id", items, "order_id")


def orphan_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The status of the orders without an item, counted."""
    return P.value_counts(
        Q.rows_with_keys(orders, "order_id", orphan_orders(orders, items)), "order_status"
    )


def coverage(customers: DataFrame, sellers: DataFrame, points: DataFrame) -> DataFrame:
    """How many zip prefixes of each side have no point."""
    census = Q.key_census(
        {
            "customers": (customers, "customer_zip_code_prefix"),
            "sellers": (sellers, "seller_zip_code_prefix"),
            "points": (points, G.PREFIX),
        }
    )
    sides = ("customers", "sellers")
    totals = census.agg(
        *[Q.known_keys(side).alias(f"{side}_keys") for side in sides],
        *[Q.orphans(side, "points").alias(f"{side}_uncovered") for side in sides],
    )
    lines = [
        F.struct(F.lit(side).alias("side"), F.col(f"{side}_keys").alias("keys"), F.col(f"{side}_uncovered").alias("uncovered"))
        for side in sides
    ]
    share = ratio("uncovered", "keys")
    return totals.select(F.inline(F.array(*lines))).withColumn(
        "uncovered_pct", round_half_away(share * F.lit(100.0), 1)
    )


def checks(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All checks that need more than one raw table."""
    orders, items = tables["orders"], tables["order_items"]
    points = tables["geolocation"]
    return {
        "integrity": referential_integrity(
            items, tables["products"], tables["sellers"], tables["reviews"], orders, tables["translation"]
        ),
        "steps out of order": out_of_order(orders),
        "status of orders without items": orphan_status(orders, items),
        "zip coverage": coverage(tables["customers"], tables["sellers"], points),
        "zip coverage inside the box": coverage(
            tables["customers"], tables["sellers"], G.points_in_box(points)
        ),
    }
