"""What may not grow faster than the tables: exchanges of the lines, and work done twice."""

import contextlib
from datetime import datetime

import pytest

from parcelsight.plans import model as M
from parcelsight.sources import checked, records
from parcelsight.testbed import queries as testbed
from parcelsight.testbed import tables


@pytest.fixture
def folder(spark, tmp_path):
    """Tables with a few lines per order, one order of many, and keys that are unknown or repeat."""
    day = datetime(1997, 10, 5)
    lines = [(o, o * 7 % 90, o % 5, n, 1.0 + n, 10.0 * n, 0.01 * n, 0.02, "N", "O", day) for o in range(40) for n in (1, 1, 2)]
    lines += [(7, p * 13, p % 5, p % 3, 2.0, 5.0, 0.03, 0.01, "N", "O", day) for p in range(300)]
    lines += [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", day), (8, None, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", day)]
    made = {
        "region": [(0, "AFRICA"), (1, "AMERICA")],
        "nation": [(n, f"NATION_{n}", n % 2) for n in range(4)],
        "customer": [(c, f"C{c}", c % 4, 1.0, "X") for c in range(10)],
        "supplier": [(s, f"S{s}", s % 4, 1.0) for s in range(5)],
        "part": [(p, f"P{p}", "B", "PROMO", 1, 1.0) for p in range(4000)],
        "orders": [(o, o % 10, "F", 1.0, day, "1") for o in range(40)],
        "lineitem": lines,
    }
    for name, rows in made.items():
        spark.createDataFrame(rows, tables.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


@contextlib.contextmanager
def exchanged_joins(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        yield
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_numbered_lines_meet_their_orders_in_one_exchange(spark, folder):
    with exchanged_joins(spark):
        items = testbed.Clean(spark, folder).order_items()
        items.collect()
        exchanges = [line for line in final_plan(items).splitlines() if "- Exchange hashpartitioning" in line]
    # The lines, the orders, and the number of lines per order.
    assert len(exchanges) <= 3, exchanges


def test_hot_orders_get_the_numbers_of_others(spark, folder, monkeypatch):
    def numbers():
        found = testbed.Clean(spark, folder).numbered_lines()
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "order_item_id"]
        return sorted(map(tuple, found.select(*keys).collect()))

    plain = numbers()
    monkeypatch.setattr(tables, "HOT_LINES", 50)
    assert numbers() == plain and len(plain) == 420
    hot = [n for order, *_, n in plain if order == 7]
    assert sorted(hot) == list(range(1, 304))
    monkeypatch.setattr(tables, "HOT_LINES", 0)
    assert numbers() == plain


def test_an_unknown_order_of_a_line_is_no_hot_order(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "HOT_LINES", 0)
    assert testbed.Clean(spark, folder).numbered_lines().filter("l_orderkey is null").count() == 0


def test_the_round_trip_checks_the_stored_model(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "validate_model", lambda model: seen.append({n: len(f.inputFiles()) for n, f in model.items()}))
    monkeypatch.setattr(M, "write_model", lambda model, out, write=M.write_model: seen.append("written") or write(model, out))
    counts = {r.table_name: r.rows for r in testbed.run("model_round_trip")(spark, folder).collect()}
    assert seen[0] == "written" and set(seen[1]) == set(M.MODEL) and counts["orders"] == 40 and counts["order_items"] == 420


def test_violations_read_stored_columns(spark, folder):
    found = testbed.run("violations")(spark, folder)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    # No rule numbers the lines again.
    assert "row_number" not in text
    assert found.filter("check_name = 'order_items: rows kept by enrichment'").first().violations == 0


@pytest.mark.parametrize("lines", [1, 3, 32_768])
def test_chunks_of_any_size_give_the_same_records(spark, tmp_path, monkeypatch, lines):
    monkeypatch.setattr(records, "CHUNK", lines)
    rows = [f'r{i},"a\x01b ""{i}""\n\nx\x01a",\x01' if i % 3 else f"r{i},plain," for i in range(50)]
    (tmp_path / "r.csv").write_text("a,b,c\n" + "\n".join(rows) + "\n")
    found = records.quoted_lines(records.lines(spark, str(tmp_path / "r.csv"))).orderBy("_place")
    assert [r.text for r in found.collect()] == ["a,b,c", *rows]


def test_lines_are_exchanged_as_chunks(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a\n" + '"x\ny"\n' * 500)
    chunks = records._chunks(records.lines(spark, str(tmp_path / "r.csv")))
    assert [len(r.text.split("\n")) for r in chunks.collect()] == [1001]


def test_rejects_are_placed_without_dealing_out_the_table(spark, tmp_path):
    (tmp_path / "s.csv").write_text("seller_id,seller_zip_code_prefix\ns1,x\ns2,1\n")
    with exchanged_joins(spark):
        found = checked.stage(spark, str(tmp_path / "s.csv"), "sellers", str(tmp_path / "staged"))
        rejects = found.rejects
        assert [(r.line, r.text) for r in rejects.collect()] == [(2, "x")]
        assert "BroadcastHashJoin" in final_plan(rejects)
