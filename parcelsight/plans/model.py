"""The typed model: clean tables, conformed, linked and checked."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.operators import quality as Q
from parcelsight.operators.profile import table_counts
from parcelsight.plans.cleaning import clean_order_items, clean_orders, clean_products, clean_reviews
from parcelsight.plans.geography import add_coordinates, coordinates_by_prefix, with_distance
from parcelsight.sources.files import conform, read_footers, write_parquet
from parcelsight.sources.schemas import MODEL, STRING

Model = dict[str, DataFrame]


def attach_distances(items: DataFrame, distances: DataFrame) -> DataFrame:
    """Items plus their separately stored distance (one row each side per item)."""
    return items.join(
        distances.select("order_id", "order_item_id", "distance_km"),
        ["order_id", "order_item_id"],
        "left",
    )


def build_model(
    raw: Mapping[str, DataFrame],
    *,
    key_type: T.DataType = STRING,
    translations: Mapping[str, str] | None = None,
) -> Model:
    """All model tables from the raw tables, as one lazy plan each."""
    orders = clean_orders(raw["orders"])
    geolocation = coordinates_by_prefix(raw["geolocation"])
    customers = add_coordinates(
        raw["customers"], "customer_zip_code_prefix", geolocation, "customer"
    )
    sellers = add_coordinates(raw["sellers"], "seller_zip_code_prefix", geolocation, "seller")
    # Joins on order_id come first: items that lie by order are dealt out once more, by seller.
    items = with_distance(clean_order_items(raw["order_items"], orders), orders, customers, sellers)
    overrides = {} if translations is None else {"overrides": translations}
    tables = {
        "customers": raw["customers"],
        "sellers": raw["sellers"],
        "products": clean_products(raw["products"], raw["translation"], **overrides),
        "geolocation": geolocation,
        "orders": orders,
        "reviews": clean_reviews(raw["reviews"]),
        "order_items": items,
    }
    return conform_model(
        {name: frame.select(*MODEL[name].columns) for name, frame in tables.items()}, key_type
    )


def conform_model(tables: Mapping[str, DataFrame], key_type: T.DataType = STRING) -> Model:
    """Every table with exactly its model columns and types, matched by name."""
    return {name: conform(tables[name], spec.schema(key_type)) for name, spec in MODEL.items()}


def model_violations(model: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key, required-column, range and reference rule of the model.

    Tables whose key another table points to, and tables that share their key, meet in one
    census per key: uniqueness, references and the tables' own rules all follow from it.
    """
    found = []
    for parent, spec in MODEL.items():
        if len(spec.key) > 1:
            found.append(Q.count_table_violations(model[parent], parent, spec.key, spec.required, spec.ranges))
            continue
        if MODEL[parent].references.get(spec.key[0]):
            continue  # counted with the table it points to
        sides, rules = {parent: (model[parent], spec.key[0])}, {}
        keyed = [parent]
        for child, other in MODEL.items():
            for column, target in other.references.items():
                if target == parent:
                    sides[child] = (model[child], column)
                    keyed += [child] if other.key == (column,) else []
        for name in keyed:
            rules[name] = {
                rule: F.coalesce(broken, F.lit(False)).cast("int")
                for rule, broken in Q.broken_rules(MODEL[name].required, MODEL[name].ranges).items()
            }
        checks = {f"{name}: key {MODEL[name].key[0]}": Q.repeated_or_unknown(name) for name in keyed}
        checks |= {f"{name}: {rule}": F.sum(f"`{name}.{rule}`") for name in keyed for rule in rules[name]}
        for child, (_, column) in sides.items():
            if child != parent:
                checks[f"{child}: {column} in {parent}"] = Q.orphans(child, parent)
        found.append(Q.as_lines(Q.key_census(sides, rules), checks))
    return reduce(DataFrame.unionAll, found)


def validate_model(model: Mapping[str, DataFrame]) -> None:
    """Raise with the failing rules and their counts if any is broken."""
    Q.raise_if_violated(model_violations(model))


def write_model(model: Mapping[str, DataFrame], out_dir: str) -> dict[str, int]:
    """One parquet table per model table; returns the rows written."""
    return {name: write_parquet(frame, f"{out_dir}/{name}") for name, frame in model.items()}


def read_model(spark: SparkSession, model_dir: str) -> Model:
    """The stored model; KPIs on it scan only the columns they use."""
    return {name: spark.read.parquet(f"{model_dir}/{name}") for name in MODEL}


def model_counts(model: Mapping[str, DataFrame]) -> DataFrame:
    return table_counts(model)


def stored_counts(spark: SparkSession, model_dir: str) -> DataFrame:
    """Rows per table of a stored model, from the footers of its files."""
    return table_counts({name: read_footers(spark, f"{model_dir}/{name}") for name in MODEL})


def register_views(model: Mapping[str, DataFrame]) -> None:
    """Name the model's tables for SQL: ``spark.sql("select ... from orders")``."""
    for name, frame in model.items():
        frame.createOrReplaceTempView(name)


# The tables that meet on order_id in most questions.
BY_ORDER = ("orders", "order_items", "reviews")


def save_model(model: Mapping[str, DataFrame], database: str, buckets: int) -> None:
    """Store the model as catalog tables, those of BY_ORDER bucketed by order_id.

    Joins and counts on order_id between them then need no exchange. Choose about
    one bucket per gigabyte of the largest table. Each bucket is written by one
    task, so this layout is for tables without a hot order.
    """
    for name, frame in model.items():
        table = f"{database}.{name}"
        if name in BY_ORDER:
            spread = frame.repartition(buckets, "order_id")
            spread.write.mode("overwrite").bucketBy(buckets, "order_id").sortBy(
                "order_id"
            ).saveAsTable(table)
        else:
            frame.write.mode("overwrite").saveAsTable(table)


def open_model(spark: SparkSession, database: str) -> Model:
    return {name: spark.table(f"{database}.{name}") for name in MODEL}


#: Number of a range of an order's items.
PART = "order_part"


def in_parts(model: Mapping[str, DataFrame], items: int) -> Model:
    """The tables of BY_ORDER with an order's items cut into ranges of so many (PART).

    An order stands once for each range that it has, so order and items meet on (order_id,
    PART) as they do on order_id; for questions on orders alone, part 0 has each order once. A
    review belongs to part 0. Item numbers rise from 1 within an order.
    """
    part = F.floor((F.col("order_item_id") - 1) / items).cast("int")
    lines = model["order_items"].withColumn(PART, part)
    last = lines.groupBy("order_id").agg(F.max(PART).alias("_last"))
    orders = model["orders"].join(last, "order_id", "left")
    numbers = F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0))))
    return {
        "orders": orders.withColumn(PART, numbers).drop("_last"),
        "order_items": lines,
        "reviews": model["reviews"].withColumn(PART, F.lit(0)),
    }


def save_parts(model: Mapping[str, DataFrame], database: str, buckets: int, items: int = 10_000) -> None:
    """Store the model as `save_model` does, but bucketed by (order_id, PART): for tables with
    hot orders. However many items an order has, no task writes or joins more of them than the
    ranges that fall into its bucket, and joins of BY_ORDER need no exchange."""
    parted = in_parts(model, items)
    for name, frame in (dict(model) | parted).items():
        table = f"{database}.{name}"
        if name in BY_ORDER:
            spread = frame.repartition(buckets, "order_id", PART)
            spread.write.mode("overwrite").bucketBy(buckets, "order_id", PART).sortBy("order_id", PART).saveAsTable(table)
        else:
            frame.write.mode("overwrite").saveAsTable(table)


def open_parts(spark: SparkSession, database: str) -> Model:
    """The stored tables; ``orders`` has PART, and ``orders_once`` each order once."""
    found = open_model(spark, database)
    return found | {"orders_once": found["orders"].filter(F.col(PART) == 0).drop(PART)}
