"""CSV and parquet sources and sinks, and the name-based conform step."""

import pytest
from helpers import ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.sources import files
from parcelsight.sources.schemas import BRAZIL_STATES, MODEL


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_columns_are_typed_by_name(spark, tmp_path):
    path = write(
        tmp_path / "orders.csv",
        '"order_estimated_delivery_date","order_id","order_purchase_timestamp"',
        '"2018-01-03 00:00:00","a","2018-01-01 10:30:05"',
        "2018-01-04,b,",
    )
    df = files.read_csv(spark, path, "orders")
    assert dict(df.dtypes) == {
        "order_estimated_delivery_date": "timestamp_ntz",
        "order_id": "string",
        "order_purchase_timestamp": "timestamp_ntz",
    }
    a, b = df.orderBy("order_id").collect()
    assert tuple(a) == (ts("2018-01-03"), "a", ts("2018-01-01 10:30:05"))
    assert tuple(b) == (ts("2018-01-04"), "b", None)


def test_csv_numbers_and_missing_texts(spark, tmp_path):
    path = write(
        tmp_path / "g.csv",
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city",
        "01037,-23.5,-46.6,sao paulo",
        "NA,NaN,,null",
    )
    rows = files.read_csv(spark, path, "geolocation").collect()
    assert tuple(rows[0]) == (1037, -23.5, -46.6, "sao paulo")
    assert tuple(rows[1]) == (None, None, None, None)


def test_csv_reviews_may_hold_line_breaks_and_quotes(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        "review_id,order_id,review_score,review_comment_message,review_answer_timestamp",
        'r1,a,5,"good, very ""good""',
        'second line",2018-01-01 10:00:00',
        "r2,b,1,,2018-01-02 11:00:00",
    )
    first, second = files.read_csv(spark, path, "reviews").orderBy("review_id").collect()
    assert first.review_comment_message == 'good, very "good"\nsecond line'
    assert (first.review_score, first.review_answer_timestamp) == (5, ts("2018-01-01 10:00"))
    assert second.review_comment_message is None


def test_a_text_in_a_number_column_is_unknown_and_counted(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,customer_zip_code_prefix", "a,many", "b,7")
    rows = {r.customer_id: r.customer_zip_code_prefix for r in files.read_csv(spark, path, "customers").collect()}
    assert rows == {"a": None, "b": 7}
    found = {r.check_name: r.violations for r in files.unreadable_cells(spark, path, "customers").collect()}
    assert found == {"customers: customer_zip_code_prefix is readable": 1}


def test_files_of_a_folder_must_have_one_header(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    write(folder / "a.csv", "seller_id,seller_city,seller_state", "x,rio,RJ")
    write(folder / "b.csv", "seller_id,seller_city,seller_state", "y,sao paulo,SP")
    rows = files.read_csv(spark, str(folder), "sellers").orderBy("seller_id").collect()
    assert [tuple(r) for r in rows] == [("x", "rio", "RJ"), ("y", "sao paulo", "SP")]
    write(folder / "c.csv", "seller_id,seller_state,seller_city", "z,BA,salvador")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(folder), "sellers").collect()


def test_reviews_may_be_many_files(spark, tmp_path):
    folder = tmp_path / "reviews.csv"
    folder.mkdir()
    for i in range(4):
        write(folder / f"{i}.csv", "review_id,review_comment_message", f'r{i},"one', f'two {i}"')
    df = files.read_csv(spark, str(folder), "reviews")
    assert sorted(r.review_comment_message for r in df.collect()) == [f"one\ntwo {i}" for i in range(4)]


def test_texts_that_are_no_timestamps_are_counted(spark, tmp_path):
    lines = ["order_id,order_purchase_timestamp,order_approved_at"]
    lines += ["a,2018-01-05 09:00:00,", "b,05/01/2018 09:00,NA", "c,2018-02-30 00:00:00,soon"]
    path = write(tmp_path / "orders.csv", *lines)
    found = {r.check_name: r.violations for r in files.unreadable_cells(spark, path, "orders").collect()}
    assert found == {
        "orders: order_purchase_timestamp is readable": 2,
        "orders: order_approved_at is readable": 1,
    }
    assert files.unreadable_cells(spark, write(tmp_path / "t.csv", "a", "b"), "translation").collect() == []


def test_catalog_names_its_tables(spark, tmp_path):
    path = write(tmp_path / "p.csv", "payment_type", "boleto")
    catalog = files.read_catalog(spark, {"payments": path})
    assert [r.payment_type for r in catalog["payments"].collect()] == ["boleto"]


def test_conform_matches_by_name_and_casts(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = files.conform(spark.createDataFrame([(7, "3")], "b int, a string"), schema)
    assert df.dtypes == [("a", "int"), ("b", "string")]
    assert tuple(df.collect()[0]) == (3, "7")
    for columns in ("a string", "a string, b string, c string"):
        with pytest.raises(ValueError, match="columns do not match"):
            files.conform(spark.createDataFrame([], columns), schema)


def test_parquet_sink_replaces_and_counts_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.write_parquet(spark.range(7), path) == 7
    metrics = files.write_observed(spark.range(5), path, {"even": F.count_if(F.col("id") % 2 == 0)})
    assert metrics == {"rows": 5, "even": 3}
    assert files.read_parquet(spark, path, ["id"]).count() == 5


def test_model_tables_and_states():
    assert {name: len(spec.columns) for name, spec in MODEL.items()} == {
        "customers": 5,
        "sellers": 4,
        "products": 2,
        "geolocation": 3,
        "orders": 15,
        "reviews": 2,
        "order_items": 9,
    }
    assert all(set(s.key) | set(s.required) <= set(s.columns) for s in MODEL.values())
    assert len(BRAZIL_STATES) == len({code for code, *_ in BRAZIL_STATES}) == 27
