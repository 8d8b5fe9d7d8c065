"""The raw delivery tables derived from the TPC-H-like test tables.

The test tables hold no promised dates, reviews or coordinates. They follow from
the keys here, with unknown values, contradictions, duplicates and an episode
planted on purpose; see FIXTURES.md.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_TYPE = T.LongType()

# The planted episode and the categories left untranslated.
EPISODE_REGION = "AMERICA"
EPISODE = ("1997-10-01", "1998-04-01")
TIMELINE_START = "1995-01-01"
TRANSLATIONS = {"promo": "promo_goods", "small": "small_goods"}
# The reference data of the state codes: the nations of the test tables, by their rule.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
STATES = [(f"{i:02}", f"NATION_{i}", REGIONS[i % 5]) for i in range(25)]

# Lines of an order up to which one task numbers them, and part keys per tile beyond.
HOT_LINES = 10_000
TILE_WIDTH = 1000

# Columns of the test tables. A declared schema saves the footer
# job that inference would run for every scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


class TestTables:
    """Lazy raw tables over one directory of test parquet files."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def new_folder(self, name: str) -> str:
        """A folder that does not exist yet, below the one that driver and executors share."""
        root = self.spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not self.spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = Path(tempfile.mkdtemp(prefix="parcelsight-")).as_uri()
        return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def written_csv(self, tables: Mapping[str, DataFrame]) -> str:
        """A new folder with the tables as CSV, as the raw files come: quoted, with a header."""
        folder = self.new_folder("raw")
        for name, frame in tables.items():
            frame.write.options(header=True, quote='"', escape='"').csv(f"{folder}/{name}.csv")
        return folder

    def commented_reviews(self) -> DataFrame:
        """Reviews with free text: quotes, commas and line breaks, or none."""
        number = F.col("review_id")
        text = (
            F.when(number % 4 == 0, F.concat(F.lit('Said "'), number.cast("string"), F.lit('", then\n\nleft, "quietly"')))
            .when(number % 4 == 1, F.concat(F.lit("two lines\n"), number.cast("string")))
            .when(number % 4 == 2, F.lit("plain, with a comma"))
        )
        return self.reviews().withColumn("review_comment_message", text)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def nations(self) -> DataFrame:
        region = self.table("region")
        return (
            self.table("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )

    def orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        customers = (
            self.table("customer")
            .join(self.nations(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "r_name")
        )
        shipped = (
            self.table("lineitem")
            .select(F.col("l_orderkey").alias("o_orderkey"))
            .distinct()
            .withColumn("_shipped", F.lit(True))
        )
        start, end = (F.lit(day).cast("timestamp_ntz") for day in EPISODE)
        purchase = F.col("o_orderdate")
        x = k * 7 % 30
        episode = (F.col("r_name") == EPISODE_REGION) & (purchase >= start) & (purchase < end)
        late_days = (
            F.when(x == 0, 20)
            .when(x == 1, 10)
            .when(x == 2, 2)
            .when(episode & (x < 12), 5)
            .otherwise(-x)
        )
        # Each step only names columns of the step before, so that nothing is
        # evaluated once per use.
        handed_over = 24 + k * 13 % 240
        on_the_way = (
            F.when(k % 61 == 0, -72)
            .when(F.col("_late_days") > 0, 288 + k * 11 % 600)
            .otherwise(48 + k * 11 % 600)
        )
        sent = F.col("_shipped")
        promised = F.when(sent, F.floor(F.col("_delivered") / 24) - F.col("_late_days"))
        return (
            self.table("orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(shipped, "o_orderkey", "left")
            .withColumns({"_late_days": late_days, "_handed_over": handed_over})
            .withColumn("_delivered", F.col("_handed_over") + on_the_way)
            .select(
                k.alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.when(F.col("o_orderstatus") == "P", "shipped")
                .otherwise("delivered")
                .alias("order_status"),
                purchase.alias("order_purchase_timestamp"),
                F.when(k % 97 != 0, purchase + _hours(k % 72)).alias("order_approved_at"),
                F.when(sent, purchase + _hours(F.col("_handed_over"))).alias(
                    "order_delivered_carrier_date"
                ),
                F.when(sent, purchase + _hours(F.col("_delivered"))).alias(
                    "order_delivered_customer_date"
                ),
                (purchase + _days(F.coalesce(promised, F.lit(20)))).alias(
                    "order_estimated_delivery_date"
                ),
            )
        )

    def numbered_lines(self) -> DataFrame:
        """Order lines with their position within the order; lines of an unknown key have none.

        Lines are dealt out by order once, and joins on the order need no further exchange.
        That would gather a hot order in one task, so orders are counted first: those of more
        than HOT_LINES lines, at most one in so many lines, are numbered by tiles.
        """
        lines = self.table("lineitem").filter("l_orderkey is not null")
        sizes = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
        hot = F.broadcast(sizes.filter(F.col("_n") > HOT_LINES).select("l_orderkey"))
        order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
        numbered = (
            lines.join(hot, "l_orderkey", "left_anti")
            .withColumn("order_item_id", F.row_number().over(order))
            .filter("l_linenumber is not null and l_partkey is not null")
        )
        tiled = self._numbered_by_tiles(lines.join(hot, "l_orderkey", "left_semi"))
        return numbered.unionByName(tiled.select(numbered.columns))

    def _numbered_by_tiles(self, lines: DataFrame) -> DataFrame:
        """Lines are numbered within a tile (line number and part range), and each tile starts
        where the counts of the order's earlier tiles end: no task holds an order's lines."""
        lines = lines.withColumn("_tile", F.floor(F.col("l_partkey") / TILE_WIDTH))
        tile = ["l_orderkey", "l_linenumber", "_tile"]
        order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "_tile")
        starts = (
            lines.groupBy(*tile)
            .agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_start", F.sum("_n").over(order) - F.col("_n"))
        )
        in_tile = W.partitionBy(*tile).orderBy("l_partkey", "l_suppkey", "l_shipdate")
        return (
            lines.withColumn("_position", F.row_number().over(in_tile))
            .join(starts, tile)
            .withColumn("order_item_id", (F.col("_start") + F.col("_position")).cast("int"))
        )

    def order_items(self, numbered: bool = True) -> DataFrame:
        """Items; without their number they are one scan and one join."""
        purchases = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
        )
        lines = self.numbered_lines() if numbered else self.table("lineitem")
        return lines.join(purchases, "l_orderkey").select(
            F.col("l_orderkey").alias("order_id"),
            *(["order_item_id"] if numbered else []),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            (F.col("o_orderdate") + _days(4 + F.col("l_quantity").cast("int") % 8)).alias(
                "shipping_limit_date"
            ),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
            F.col("l_shipdate").alias("item_ship_ts"),
            F.col("l_discount").alias("src_discount"),
        )

    def customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.nations(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_unique_id"),
                (F.col("c_custkey") % 53).cast("int").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.col("n_name").alias("customer_state"),
                F.col("r_name").alias("customer_region"),
            )
        )

    def sellers(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                (F.col("s_suppkey") % 59).cast("int").alias("seller_zip_code_prefix"),
                F.col("s_name").alias("seller_city"),
                F.col("n_name").alias("seller_state"),
            )
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 50 != 0, F.lower("p_type")).alias("product_category_name"),
            F.col("p_size").alias("product_weight_g"),
        )

    def translation(self) -> DataFrame:
        name = F.lower("p_type")
        return (
            self.table("part")
            .filter(~F.col("p_type").isin("PROMO", "SMALL"))
            .select(
                name.alias("product_category_name"),
                F.concat(name, F.lit("_goods")).alias("product_category_name_english"),
            )
            .distinct()
        )

    def geolocation(self) -> DataFrame:
        k = F.col("c_custkey")
        z = (k % 53).cast("int")
        outside = (z == 52) | (k % 40 == 0)
        lat = -25 + (z * 37 % 53).cast("double") * 0.25 + (k % 7).cast("double") * 0.01
        lng = -55 + (z * 29 % 53).cast("double") * 0.3 + (k % 5).cast("double") * 0.01
        return self.table("customer").select(
            z.alias("geolocation_zip_code_prefix"),
            F.when(outside, 45.0).otherwise(lat).alias("geolocation_lat"),
            F.when(outside, 121.0).otherwise(lng).alias("geolocation_lng"),
        )

    def reviews(self, numbered: bool = True) -> DataFrame:
        """One review per item; without their id they need no item number."""
        review_id = (F.col("order_id") * 100 + F.col("order_item_id")).alias("review_id")
        return self.order_items(numbered).select(
            *([review_id] if numbered else []),
            "order_id",
            (1 + F.round(F.col("src_discount") * 100).cast("int") % 5).alias("review_score"),
            F.col("item_ship_ts").alias("review_answer_timestamp"),
        )

    def raw(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders(),
            "order_items": self.order_items(),
            "customers": self.customers(),
            "sellers": self.sellers(),
            "products": self.products(),
            "translation": self.translation(),
            "geolocation": self.geolocation(),
            "reviews": self.reviews(),
        }
