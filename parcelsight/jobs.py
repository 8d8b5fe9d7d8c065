"""The batch jobs: clean each raw table, load the model, export the star.

Every job reads files and replaces files, so a job can be run again at any time.
Raw tables are ``<raw>/<table>.csv``; clean and model tables ``<dir>/<table>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelsight.operators.profile import describe, distinct_count, value_counts
from parcelsight.operators.quality import duplicate_keys, raise_if_violated, require
from parcelsight.plans import cleaning as C
from parcelsight.plans import geography as G
from parcelsight.plans.model import (
    attach_distances,
    conform_model,
    read_model,
    save_model,
    validate_model,
    write_model,
)
from parcelsight.plans.star import build_star, write_star
from parcelsight.sources.checked import stage
from parcelsight.sources.files import (
    read_parquet,
    write_observed,
    write_parquet,
)

Report = dict[str, int | DataFrame]


def _raw(spark: SparkSession, raw: str, clean: str, table: str) -> DataFrame:
    """A raw table, typed and staged below ``clean`` in one pass over its files.

    Cells that could not be read are listed in ``<clean>/_rejects/<table>`` (file, line, column,
    text); the job stops if there are any.
    """
    found = stage(spark, f"{raw}/{table}.csv", table, f"{clean}/_staged/{table}")
    if write_parquet(found.rejects, f"{clean}/_rejects/{table}"):
        raise_if_violated(found.counts().withColumn("check_name", F.concat(F.lit(f"{table}: "), "check_name")))
    return found.rows


def clean_orders(spark: SparkSession, raw: str, clean: str) -> Report:
    orders = C.clean_orders(_raw(spark, raw, clean, "orders"))
    flags = ("carrier_before_approved", "delivered_before_carrier")
    return write_observed(orders, f"{clean}/orders", {f: F.count_if(F.col(f)) for f in flags})


def clean_order_items(spark: SparkSession, raw: str, clean: str) -> Report:
    """Needs the clean orders for their hand-over dates."""
    dates = read_parquet(spark, f"{clean}/orders", ["order_id", C.HANDED_OVER])
    items = C.clean_order_items(_raw(spark, raw, clean, "order_items"), dates, validate=True)
    missed = F.col("missed_shipping_deadline")
    return write_observed(
        items,
        f"{clean}/order_items",
        {
            "missed_shipping_deadline": F.count_if(missed),
            "unknown_carrier_date": F.count_if(missed.isNull()),
        },
    )


def clean_products(spark: SparkSession, raw: str, clean: str) -> Report:
    products = C.clean_products(
        _raw(spark, raw, clean, "products"), _raw(spark, raw, clean, "translation"), validate=True
    )
    path, category = f"{clean}/products", F.col("product_category")
    report = write_observed(products, path, {"without_category": F.count_if(category.isNull())})
    return report | {"categories": distinct_count(spark.read.parquet(path), "product_category")}


def clean_reviews(spark: SparkSession, raw: str, clean: str) -> Report:
    path, seen = f"{clean}/reviews", Observation()
    # A review without an answer date counts as the latest, so say how many there are.
    undated = F.count_if(F.col("review_answer_timestamp").isNull()).alias("unknown_answer_date")
    reviews = _raw(spark, raw, clean, "reviews").observe(
        seen, F.count(F.lit(1)).alias("raw_rows"), undated
    )
    report = write_observed(C.clean_reviews(reviews), path)
    scores = value_counts(spark.read.parquet(path), "review_score", by_value=True)
    return report | seen.get | {"scores": scores}


def clean_geography(spark: SparkSession, raw: str, clean: str) -> Report:
    """Needs the clean orders and items."""
    report: Report = {}
    coordinates = G.coordinates_by_prefix(_raw(spark, raw, clean, "geolocation"))
    report["prefixes"] = write_parquet(coordinates, f"{clean}/geolocation")
    # Read back: the stored size lets Spark pick the join, and the medians run once.
    coordinates = spark.read.parquet(f"{clean}/geolocation")
    located, orders = {}, read_parquet(spark, f"{clean}/orders", ["order_id", "customer_id"])
    # What the joins rely on is proved on the stored keys, not on joined rows.
    unique = {f"{G.PREFIX} is unique": duplicate_keys(coordinates, [G.PREFIX])}
    unique["order_id is unique"] = duplicate_keys(orders, ["order_id"])
    for table, side in (("customers", "customer"), ("sellers", "seller")):
        report[table] = write_parquet(_raw(spark, raw, clean, table), f"{clean}/{table}")
        people = spark.read.parquet(f"{clean}/{table}")
        unique[f"{side}_id is unique"] = duplicate_keys(people, [f"{side}_id"])
        located[table] = G.add_coordinates(people, f"{side}_zip_code_prefix", coordinates, side)
    require(unique)
    items = read_parquet(
        spark, f"{clean}/order_items", ["order_id", "order_item_id", "seller_id"]
    )
    distances = G.item_distances(items, orders, located["customers"], located["sellers"])
    path = f"{clean}/order_distances"
    unknown = F.count_if(F.col("distance_km").isNull())
    written = write_observed(distances, path, {"unknown_distance": unknown})
    report |= {"order_items": written["rows"], "unknown_distance": written["unknown_distance"]}
    return report | {"distances": describe(spark.read.parquet(path), "distance_km")}


CLEANING = {
    "orders": clean_orders,
    "order_items": clean_order_items,
    "products": clean_products,
    "reviews": clean_reviews,
    "geography": clean_geography,
}


def load_model(
    spark: SparkSession, clean: str, model: str, stored: tuple[str, int] | None = None
) -> dict[str, int]:
    """Clean tables to the checked model; a broken rule stops before writing.

    ``stored`` (database, buckets) keeps the model as catalog tables too, bucketed by order.
    """
    names = ("customers", "sellers", "products", "geolocation", "orders", "reviews")
    tables = {name: spark.read.parquet(f"{clean}/{name}") for name in names}
    tables["order_items"] = attach_distances(
        spark.read.parquet(f"{clean}/order_items"), spark.read.parquet(f"{clean}/order_distances")
    )
    conformed = conform_model(tables)
    validate_model(conformed)
    written = write_model(conformed, model)
    if stored:
        save_model(read_model(spark, model), *stored)
    return written


def export_star(spark: SparkSession, model: str, out: str) -> dict[str, int]:
    """The seven export tables, published together once what was written has been checked."""
    tables = read_model(spark, model)
    return write_star(build_star(spark, tables), tables, out)
