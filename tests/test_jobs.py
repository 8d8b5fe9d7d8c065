"""The whole chain from CSV files through the command line."""

import csv

import pytest

from parcelsight import jobs
from parcelsight.__main__ import main
from parcelsight.operators.quality import QualityError
from parcelsight.plans.catalog import QUESTIONS
from parcelsight.plans.model import read_model
from parcelsight.plans.star import read_star

ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
]
TABLES = {
    "orders": [
        ORDER_COLUMNS,
        ["o1", "c1", "delivered", "2017-10-02 10:56:33", "2017-10-02 11:07:15", "2017-10-04 19:55:00", "2017-10-10 21:25:13", "2017-10-18 00:00:00"],
        ["o2", "c2", "delivered", "2017-10-24 20:41:37", "2017-10-26 03:24:27", "2017-10-26 14:31:00", "2017-11-27 15:27:45", "2017-11-13 00:00:00"],
        ["o3", "c2", "canceled", "2017-11-24 20:41:37", "", "", "", "2017-12-13 00:00:00"],
    ],
    "order_items": [
        ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
        ["o1", "1", "p1", "s1", "2017-10-06 11:07:15", "29.99", "8.72"],
        ["o1", "2", "p2", "s1", "2017-10-04 11:07:15", "9.99", "0"],
        ["o2", "1", "p2", "s1", "2017-10-30 03:24:27", "118.7", "22.76"],
    ],
    "customers": [
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
        ["c1", "u1", "01001", "sao paulo", "SP"],
        ["c2", "u2", "20001", "rio de janeiro", "RJ"],
    ],
    "sellers": [
        ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
        ["s1", "1001", "sao paulo", "SP"],
    ],
    "products": [
        ["product_id", "product_category_name", "product_weight_g"],
        ["p1", "cama_mesa_banho", "100"],
        ["p2", "pc_gamer", ""],
        ["p3", "", "7"],
    ],
    "translation": [
        ["product_category_name", "product_category_name_english"],
        ["cama_mesa_banho", "bed_bath_table"],
    ],
    "geolocation": [
        ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
        ["1001", "-23.5505", "-46.6333"],
        ["1001", "45.0", "121.0"],
    ],
    "reviews": [
        ["review_id", "order_id", "review_score", "review_comment_message", "review_answer_timestamp"],
        ["r1", "o1", "4", "first\nthen more", "2017-10-12 03:43:48"],
        ["r2", "o2", "5", "", "2017-11-28 10:00:00"],
        ["r3", "o2", "1", 'so "late"', "2017-11-30 10:00:00"],
    ],
    "payments": [["order_id", "payment_type"], ["o1", "credit_card"], ["o2", "boleto"]],
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for table, rows in TABLES.items():
        with open(folder / f"{table}.csv", "w", newline="", encoding="utf-8") as file:
            csv.writer(file).writerows(rows)
    return str(folder)


def test_the_chain_from_csv_to_star(spark, raw, tmp_path, capsys):
    clean, model, out = (str(tmp_path / name) for name in ("clean", "model", "star"))
    main(["explore", raw, "orders", "payments"])
    main(["clean", raw, clean])
    main(["load", clean, model])
    main(["ask", model, "late_rate_baseline", "late_by_state"])
    main(["export", model, out])
    text = capsys.readouterr().out
    for line in (
        "orders: rows = 3",
        "orders: carrier_before_approved = 0",
        "order_items: missed_shipping_deadline = 1",
        "products: without_category = 1",
        "reviews: raw_rows = 3",
        "reviews: unknown_answer_date = 0",
        "geography: unknown_distance = 1",
        "model: order_items = 3",
        "star: fact_orders = 2",
        "star: dim_state = 27",
    ):
        assert line in text
    items = {(r.order_id, r.order_item_id): r for r in read_model(spark, model)["order_items"].collect()}
    assert items["o1", 1].distance_km == 0.0 and items["o2", 1].distance_km is None
    assert [items[k].missed_shipping_deadline for k in sorted(items)] == [False, True, False]
    scores = {r.order_id: r.review_score for r in read_model(spark, model)["reviews"].collect()}
    assert scores == {"o1": 4, "o2": 1}
    fact = {r.order_id: r for r in read_star(spark, out)["fact_orders"].collect()}
    assert (fact["o2"].delay_days, fact["o2"].delay_bucket, fact["o2"].distance_bucket) == (14, "8-14 days late", None)
    for question in QUESTIONS.values():
        question(read_model(spark, model)).collect()


def test_cleaning_can_be_run_again(spark, raw, tmp_path):
    for _ in range(2):
        assert jobs.clean_orders(spark, raw, str(tmp_path))["rows"] == 3


def test_loading_stops_at_a_broken_rule(spark, raw, tmp_path):
    clean = str(tmp_path / "clean")
    main(["clean", raw, clean])
    spark.read.parquet(f"{clean}/customers").limit(1).write.mode("overwrite").parquet(f"{clean}/few")
    spark.read.parquet(f"{clean}/few").write.mode("overwrite").parquet(f"{clean}/customers")
    with pytest.raises(QualityError, match="customer_id in customers"):
        jobs.load_model(spark, clean, str(tmp_path / "model"))
    assert not (tmp_path / "model").exists()


def test_a_job_stops_at_a_broken_timestamp_with_a_count(spark, raw, tmp_path):
    rows = [list(r) for r in TABLES["orders"]]
    rows[1][6] = "10/10/2017 21:25"
    with open(tmp_path / "orders.csv", "w", newline="", encoding="utf-8") as file:
        csv.writer(file).writerows(rows)
    with pytest.raises(QualityError, match="orders: order_delivered_customer_date is readable: 1 violations"):
        jobs.clean_orders(spark, str(tmp_path), str(tmp_path / "clean"))
    assert not (tmp_path / "clean" / "orders").exists()
    (reject,) = spark.read.parquet(str(tmp_path / "clean" / "_rejects" / "orders")).collect()
    assert (reject.line, reject.column, reject.text) == (2, "order_delivered_customer_date", "10/10/2017 21:25")
    assert reject.file.endswith("orders.csv")


def test_no_row_and_no_column_of_a_report_is_cut(spark, capsys, monkeypatch, tmp_path):
    import parcelsight.__main__ as cli

    long = spark.range(1_001).selectExpr("id", "concat('place ', id) as place")
    wide = spark.createDataFrame([tuple(range(25))], [f"c{i}" for i in range(25)])
    cli._report("t", {"long": long, "columns": cli.profile(wide)})
    lines = capsys.readouterr().out.splitlines()
    assert sum(line.endswith(f"place {i}") for i, line in enumerate(lines[2:1_003])) == 1_001
    cells = [line.split("\t") for line in lines]
    assert all(any(f"c{i}" in row for row in cells) for i in range(25))
    monkeypatch.setattr(cli, "QUESTIONS", {"long": lambda model: long})
    monkeypatch.setattr(cli, "read_model", lambda spark, path: {})
    main(["ask", "any", "--out", str(tmp_path)])
    assert "long: rows = 1001" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "long")).count() == 1_001


def test_the_command_line_sets_partitions_and_keeps_tables(spark, raw, tmp_path, capsys):
    clean, model = str(tmp_path / "clean"), str(tmp_path / "model")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.sql("create database if not exists kept")
    try:
        main(["clean", raw, clean])
        main(["--shuffle-bytes", str(40_000 * 2**20), "load", clean, model, "--database", "kept", "--buckets", "2"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        spark.conf.set("spark.sql.shuffle.partitions", before)
        main(["ask", "any", "late_rate_baseline", "--database", "kept"])
        assert "late_rate_baseline" in capsys.readouterr().out
    finally:
        for key in ("shuffle.partitions", "files.maxPartitionBytes", "adaptive.advisoryPartitionSizeInBytes", "adaptive.coalescePartitions.parallelismFirst"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("drop database kept cascade")


def test_explore_checks_all_tables(spark, raw, capsys):
    main(["explore", raw])
    text = capsys.readouterr().out
    for line in ("orders: values of order_status", "order_items: summary of price", "tables: integrity", "tables: zip coverage", "orders: unreadable cells"):
        assert line in text
    assert "categories to translation\t1" in text and "delivered\t2" in text
