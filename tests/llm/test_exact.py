"""Streaming exact dedup against plain grouping."""

import re

from pyspark.sql import functions as F

from parcelsight.llm import exact
from parcelsight.llm.common import shared_folder

ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (4, "a b "), (7, None), (6, ""), (8, " "), (10, "\n\r "),
    (11, "A b"), (12, "x y"), (13, "x y"), (2, "twice"), (2, "twice"), (2, "other"), (14, "long " * 9_000),
    (15, "long " * 9_000),
]


def plain(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for ids in groups.values():
        for i, doc_id in enumerate(sorted(ids)):
            out.append((doc_id, min(ids), len(ids), i == 0))
    return sorted(out)


def decided(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_groups_of_equal_texts(table):
    assert decided(exact.decisions(table(ROWS))) == plain(ROWS)


def test_rows_under_one_digest_are_told_apart_by_their_bytes(table):
    weak = lambda text: F.unhex(F.sha2(F.length(text).cast("string"), 256))
    assert decided(exact.decisions(table(ROWS), weak)) == plain(ROWS)


def test_a_hot_group_is_spread_over_salts(table, monkeypatch):
    monkeypatch.setattr(exact, "SALT_ROWS", 10)
    rows = [(i, "copy" if i % 3 else f"own {i}") for i in range(300)]
    assert decided(exact.decisions(table(rows))) == plain(rows)


def test_repeated_rows_meet_the_kept_text_once(table, monkeypatch):
    met, given = [], exact._met
    monkeypatch.setattr(exact, "_met", lambda *a: (met.append(given(*a).count()), given(*a))[1])
    rows = [(1, "twice")] * 40 + [(None, "no id")] * 50 + [(2, "alone")]
    made = exact.decisions(table(rows)).collect()
    assert met == [90]
    assert sorted((r.doc_id or 0, r.group_size, r.kept) for r in made if r.kept) == [(0, 50, True), (1, 40, True), (2, 1, True)]
    assert len(made) == 91


def test_what_stays_keeps_all_columns(table):
    kept = exact.keep_first(table(ROWS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in plain(ROWS) if r[3])


def test_state_goes_on_over_runs(spark, table):
    records, state = shared_folder(spark, "t-records"), shared_folder(spark, "t-state")
    sizes = []
    for rows in ([(5, "a"), (6, "b")], [(2, "a"), (9, "c")]):
        made = exact.key_records(table(rows))
        made.write.mode("append").parquet(records)
        exact.advance(spark, records, made.schema, state)
        sizes.append({(r.first.doc_id, r.size) for r in exact.state_table(spark, state).collect()})
    assert sizes == [{(5, 1), (6, 1)}, {(2, 2), (6, 1), (9, 1)}]


def test_an_empty_table(table):
    assert exact.decisions(table([])).collect() == []
    assert exact.keep_first(table([])).collect() == []


def test_clashing_columns_stay(table):
    names = ["_row", "_id", "_n", "_own", "domain", "copies", "node"]
    docs = table([(1, "one text of words here", "en", "src1"), (2, "other words in this text", "de", "src2")])
    for i, name in enumerate(names):
        docs = docs.selectExpr("*", f"{i} as `{name}`")
    made = exact.keep_first(docs)
    assert made.columns == docs.columns
    assert all([r[n] for n in names] == list(range(7)) for r in made.collect())
