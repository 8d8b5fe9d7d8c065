"""Every KPI, export, cleaning step and check, run on the derived test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight import jobs
from parcelsight.functions.scalars import round_half_away
from parcelsight.operators import profile as P
from parcelsight.operators import quality as Q
from parcelsight.plans import alerts as A
from parcelsight.plans import cleaning as C
from parcelsight.plans import exploration as E
from parcelsight.plans import geography as G
from parcelsight.plans import kpis as K
from parcelsight.plans import model as M
from parcelsight.plans import star as S
from parcelsight.session import tune
from parcelsight.sources.checked import Checked, stage
from parcelsight.sources.files import read_catalog
from parcelsight.testbed.tables import (
    EPISODE,
    EPISODE_REGION,
    KEY_TYPE,
    STATES,
    TIMELINE_START,
    TRANSLATIONS,
    TestTables,
)

REGION = "customer_region"
REGIONS = ("AMERICA", "ASIA", "EUROPE", "AFRICA")
RULE = A.Rule(floor=20)
WHOLE_PERIOD = (None, None)


def _micro(name: str) -> Column:
    """Six decimals, where the two engines' math libraries differ in the last digits."""
    return round_half_away(name, 6).alias(name)


class Clean(TestTables):
    """The clean tables, each built only when a query asks for it."""

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self.orders()

    @cached_property
    def clean_orders(self) -> DataFrame:
        return C.clean_orders(self.raw_orders)

    @cached_property
    def coordinates(self) -> DataFrame:
        return G.coordinates_by_prefix(self.geolocation())

    @cached_property
    def customers_located(self) -> DataFrame:
        return G.add_coordinates(
            self.customers(), "customer_zip_code_prefix", self.coordinates, "customer"
        )

    @cached_property
    def sellers_located(self) -> DataFrame:
        return G.add_coordinates(
            self.sellers(), "seller_zip_code_prefix", self.coordinates, "seller"
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.order_items().drop("item_ship_ts", "src_discount")

    @cached_property
    def lines(self) -> DataFrame:
        """Items for questions that do not ask for the item's number."""
        return self.order_items(numbered=False)

    def _with_distance(self, items: DataFrame) -> DataFrame:
        return G.with_distance(
            items, self.raw_orders, self.customers_located, self.sellers_located
        )

    @cached_property
    def items_with_distance(self) -> DataFrame:
        return self._with_distance(self.items)

    @cached_property
    def lines_with_distance(self) -> DataFrame:
        return self._with_distance(self.lines.select("order_id", "seller_id"))

    @cached_property
    def clean_products(self) -> DataFrame:
        return C.clean_products(self.products(), self.translation(), TRANSLATIONS)

    @cached_property
    def clean_reviews(self) -> DataFrame:
        return C.clean_reviews(self.reviews())

    def model(self) -> M.Model:
        raw = self.raw() | {"customers": self.customers().drop(REGION)}
        return M.build_model(raw, key_type=KEY_TYPE, translations=TRANSLATIONS)


def _stored_model(t: Clean) -> M.Model:
    """The model written and read back: what checks read are its columns, not the plans behind it."""
    folder = t.new_folder("model")
    M.write_model(t.model(), folder)
    return M.read_model(t.spark, folder)


def _violations(t: Clean) -> DataFrame:
    model = _stored_model(t)
    fact = S.fact_orders(
        model["orders"], model["customers"], model["order_items"], model["reviews"]
    )
    extra = {
        "lineitem: key l_orderkey, l_linenumber": Q.primary_key_violations(
            t.table("lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "raw reviews: review_answer_timestamp is known": Q.null_violations(
            t.reviews(False), ["review_answer_timestamp"]
        ),
        "fact_orders: one row per order": Q.duplicate_keys(fact.select("order_id"), ["order_id"]),
    }
    enriched = Q.row_count_change(
        "order_items: rows kept by enrichment", t.order_items(), model["order_items"]
    )
    return M.model_violations(model).unionAll(Q.count_violations(extra)).unionAll(enriched)


def _table_counts(t: Clean) -> DataFrame:
    return M.model_counts(t.model())


def _order_items_model(t: Clean) -> DataFrame:
    items = C.clean_order_items(t.items_with_distance, t.raw_orders)
    return items.withColumn("distance_km", _micro("distance_km"))


def _attached_distances(t: Clean) -> DataFrame:
    distances = G.item_distances(t.items, t.raw_orders, t.customers_located, t.sellers_located)
    items = t.items.select("order_id", "order_item_id", "seller_id")
    return M.attach_distances(items, distances).select(
        "order_id", "order_item_id", "seller_id", _micro("distance_km")
    )


def _describe(df: DataFrame, column: str) -> DataFrame:
    return P.describe(df, column).select("statistic", _micro("value"))


def _cleaning_report(t: Clean) -> DataFrame:
    """Flags counted while cleaning: how often true, how often unknown."""
    orders = P.flag_counts(t.clean_orders, ["carrier_before_approved", "delivered_before_carrier"])
    items = P.flag_counts(
        C.clean_order_items(t.lines, t.raw_orders), ["missed_shipping_deadline"]
    )
    parts = [
        part.unpivot([], part.columns, "measure", "rows").withColumn("table_name", F.lit(name))
        for name, part in (("orders", orders), ("order_items", items))
    ]
    return parts[0].unionAll(parts[1])


def _fact_orders(t: Clean) -> DataFrame:
    fact = S.fact_orders(
        t.clean_orders, t.customers(), t.lines_with_distance, t.clean_reviews
    )
    return fact.withColumn("distance_km", _micro("distance_km"))


def _dim_state(t: Clean) -> DataFrame:
    """The reference data of the states that the nation table names."""
    keys = t.nations().select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("state_code"))
    return keys.join(S.dim_state(t.spark, STATES), "state_code")


def _round_trip(t: Clean) -> DataFrame:
    """The model, written, read back and checked: rows per table. Checked as stored, where a key is a
    column to scan; before, each rule would run the joins behind its table again."""
    folder = t.new_folder("model")
    M.write_model(t.model(), folder)
    M.validate_model(M.read_model(t.spark, folder))
    return M.stored_counts(t.spark, folder)


def _read_back(t: Clean, tables: dict[str, DataFrame], table: str) -> Checked:
    folder = t.written_csv(tables)
    return stage(t.spark, f"{folder}/{table}.csv", table, t.new_folder("staged"))


def _as_numbers(df: DataFrame, *names: str) -> DataFrame:
    """Identifiers are text in raw files."""
    return df.withColumns({n: F.col(n).cast(KEY_TYPE) for n in names})


def _csv_orders(t: Clean) -> DataFrame:
    found = _read_back(t, {"orders": t.raw_orders}, "orders")
    return _as_numbers(found.rows, "order_id", "customer_id")


def _csv_reviews(t: Clean) -> DataFrame:
    found = _read_back(t, {"reviews": t.commented_reviews()}, "reviews")
    return _as_numbers(found.rows, "review_id", "order_id")


def _csv_rejects(t: Clean) -> DataFrame:
    """Cells that are no numbers or dates, planted in the items, by column and text."""
    k = F.col("order_id") + F.col("order_item_id")
    items = t.items.withColumns(
        {
            "price": F.when(k % 50 == 0, F.lit("n/k")).otherwise(F.col("price").cast("string")),
            "shipping_limit_date": F.when(k % 70 == 0, F.lit("31/31/1999")).otherwise(
                F.col("shipping_limit_date").cast("string")
            ),
            "freight_value": F.when(k % 90 == 0, F.lit("NaN")).otherwise(F.col("freight_value").cast("string")),
        }
    )
    found = _read_back(t, {"order_items": items}, "order_items")
    return found.rejects.groupBy("column", "text").agg(F.count(F.lit(1)).alias("rejects"))


def _catalog_counts(t: Clean) -> DataFrame:
    raw = t.raw()
    folder = t.written_csv(raw)
    return P.table_counts(read_catalog(t.spark, {name: f"{folder}/{name}.csv" for name in raw}))


def _geography_job(t: Clean) -> DataFrame:
    """Raw files to distances by the batch jobs; the distances they stored."""
    needed = ("orders", "order_items", "customers", "sellers", "geolocation")
    raw, clean = t.written_csv({name: t.raw()[name] for name in needed}), t.new_folder("clean")
    for job in ("orders", "order_items", "geography"):
        jobs.CLEANING[job](t.spark, raw, clean)
    stored = t.spark.read.parquet(f"{clean}/order_distances")
    return _as_numbers(stored, "order_id").withColumn("distance_km", _micro("distance_km"))


def _star_export(t: Clean) -> DataFrame:
    """All tables of the published star: rows per table."""
    model = _stored_model(t)
    wide = model | {"customers": t.customers()}
    focus = S.Focus(REGION, EPISODE_REGION, EPISODE, TIMELINE_START, RULE, tuple(STATES))
    star = S.build_star(t.spark, wide, focus) | {
        name: build(model["orders"], model["customers"], *more)
        for name, build, more in (
            ("fact_orders", S.fact_orders, (model["order_items"], model["reviews"])),
            ("fact_stage_hours", S.fact_stage_hours, ()),
        )
    }
    folder = t.new_folder("star")
    S.write_star(star, wide, folder)
    return P.table_counts(S.read_star(t.spark, folder))


def _star_round_trip(t: Clean) -> DataFrame:
    """The order fact of the exported star, read back."""
    model = t.model()
    fact = S.fact_orders(model["orders"], model["customers"], model["order_items"], model["reviews"])
    folder = t.new_folder("star")
    S.write_star({"fact_orders": fact}, model, folder)
    stored = S.read_star(t.spark, folder)["fact_orders"]
    return stored.withColumn("distance_km", _micro("distance_km"))


def _episodes(t: Clean) -> DataFrame:
    return A.alert_episodes(t.clean_orders, t.customers(), REGION, TIMELINE_START, RULE)


FOCUS = {"place": REGION, "focal": EPISODE_REGION}

QUERIES: dict[str, Callable[[Clean], DataFrame]] = {
    # questions
    "late_rate_baseline": lambda t: K.late_rate_baseline(t.clean_orders),
    "stage_medians": lambda t: K.stage_medians(t.clean_orders),
    "late_by_state": lambda t: K.late_by_state(t.clean_orders, t.customers()),
    "late_by_seller_volume": lambda t: K.late_by_seller_volume(t.clean_orders, t.lines),
    "late_by_seller_rate": lambda t: K.late_by_seller_rate(t.clean_orders, t.lines),
    "late_by_category": lambda t: K.late_by_category(
        t.clean_orders, t.lines, t.clean_products
    ),
    "late_by_distance_band": lambda t: K.late_by_distance_band(
        t.clean_orders, t.lines_with_distance
    ),
    "median_distance_by_state": lambda t: K.median_distance_by_state(
        t.clean_orders, t.customers(), t.lines_with_distance
    ),
    "late_by_month": lambda t: K.late_by_month(t.clean_orders),
    "promised_vs_actual_by_month": lambda t: K.promised_vs_actual_by_month(
        t.clean_orders, TIMELINE_START
    ),
    "late_rate_by_month_pivot": lambda t: K.late_rate_by_month_pivot(
        t.clean_orders, t.customers(), REGION, REGIONS, TIMELINE_START
    ),
    "entity_vs_rest_by_month": lambda t: K.entity_vs_rest_by_month(
        t.clean_orders, t.customers(), **FOCUS, since=TIMELINE_START
    ),
    "states_at_same_distance": lambda t: K.states_at_same_distance(
        t.clean_orders, t.customers(), t.lines_with_distance, window=WHOLE_PERIOD, floor=1
    ),
    "episode_size": lambda t: K.episode_size(
        t.clean_orders, t.customers(), **FOCUS, window=EPISODE
    ),
    "review_by_delay_band": lambda t: K.review_by_delay_band(t.clean_orders, t.clean_reviews),
    "review_cost_of_lateness": lambda t: K.review_cost_of_lateness(
        t.clean_orders, t.customers(), t.clean_reviews, **FOCUS, window=EPISODE
    ),
    "excess_by_month": lambda t: K.excess_by_month(
        t.clean_orders, t.customers(), **FOCUS, window=EPISODE
    ),
    "alerts": lambda t: A.alerts(t.clean_orders, t.customers(), REGION, TIMELINE_START, RULE),
    # consecutive months
    "alert_episodes": _episodes,
    "alert_runs": lambda t: A.alert_runs(_episodes(t), RULE),
    "excess_after_alert": lambda t: A.excess_after_alert(
        t.clean_orders,
        t.customers(),
        t.clean_reviews,
        **FOCUS,
        window=EPISODE,
        since=TIMELINE_START,
        rule=RULE,
    ),
    # export
    "fact_orders": _fact_orders,
    "fact_stage_hours": lambda t: S.fact_stage_hours(t.clean_orders, t.customers()),
    "dim_date": lambda t: S.dim_date(t.clean_orders),
    "dim_state": _dim_state,
    "seller_rates": lambda t: S.seller_rates(t.clean_orders, t.lines),
    "entity_excess": lambda t: K.excess_by_month(
        t.clean_orders, t.customers(), **FOCUS, window=(TIMELINE_START, None)
    ),
    # cleaning and model
    "clean_orders": lambda t: t.clean_orders,
    "clean_order_items": lambda t: C.clean_order_items(t.items, t.raw_orders),
    "clean_order_items_checked": lambda t: C.clean_order_items(
        t.items, t.raw_orders, validate=True
    ),
    "clean_products": lambda t: t.clean_products,
    "clean_reviews": lambda t: t.clean_reviews,
    "geo_by_prefix": lambda t: t.coordinates.select(
        G.PREFIX, _micro(G.LAT), _micro(G.LNG)
    ),
    "customers_located": lambda t: t.customers_located.withColumns(
        {c: _micro(c) for c in ("customer_lat", "customer_lng")}
    ),
    "sellers_located": lambda t: t.sellers_located.withColumns(
        {c: _micro(c) for c in ("seller_lat", "seller_lng")}
    ),
    "item_distances": lambda t: G.item_distances(
        t.items, t.raw_orders, t.customers_located, t.sellers_located
    ).withColumn("distance_km", _micro("distance_km")),
    "items_with_attached_distance": _attached_distances,
    "order_items_model": _order_items_model,
    "table_counts": _table_counts,
    "model_round_trip": _round_trip,
    "star_round_trip": _star_round_trip,
    "star_export": _star_export,
    # raw files
    "csv_orders": _csv_orders,
    "csv_reviews": _csv_reviews,
    "csv_rejects": _csv_rejects,
    "catalog_counts": _catalog_counts,
    "geography_job": _geography_job,
    # checks
    "violations": _violations,
    "out_of_order_rows": lambda t: E.out_of_order(t.raw_orders),
    "orphan_orders": lambda t: E.orphan_orders(t.raw_orders, t.lines),
    "orphan_status": lambda t: E.orphan_status(t.raw_orders, t.lines),
    "referential_integrity": lambda t: E.referential_integrity(
        t.lines, t.products(), t.sellers(), t.reviews(False), t.raw_orders, t.translation()
    ),
    "zip_coverage": lambda t: E.coverage(t.customers(), t.sellers(), t.geolocation()),
    "coordinate_coverage": lambda t: E.coverage(
        t.customers(), t.sellers(), G.points_in_box(t.geolocation())
    ),
    "cleaning_report": _cleaning_report,
    # profiling
    "profile_orders": lambda t: P.profile(t.clean_orders),
    "status_counts": lambda t: P.value_counts(t.raw_orders, "order_status"),
    "score_counts": lambda t: P.value_counts(t.clean_reviews, "review_score", by_value=True),
    "nulls_by_status": lambda t: P.null_counts_by(
        t.raw_orders, "order_status", [C.HANDED_OVER, C.APPROVED, C.DELIVERED]
    ),
    "product_nulls": lambda t: P.null_counts(t.products(), t.products().columns),
    "category_count": lambda t: P.distinct_count(
        t.clean_products, "product_category", "categories"
    ),
    "category_preview": lambda t: P.preview(
        P.value_counts(t.clean_products, "product_category"), 3
    ),
    "describe_price": lambda t: _describe(t.lines, "price"),
    "describe_distance": lambda t: _describe(t.items_with_distance, "distance_km"),
    "rows_per_prefix": lambda t: P.rows_per_key(t.geolocation(), G.PREFIX),
    "duplicate_points": lambda t: P.duplicate_rows(t.geolocation()),
    "duplicate_reviews": lambda t: P.duplicate_rows(
        t.reviews(False).select("order_id", "review_answer_timestamp")
    ),
}


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name](Clean(tune(spark), sf_dir))

    return query
