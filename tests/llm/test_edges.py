"""Long texts, null and repeated ids, and columns with the operators' own inner names."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
from parcelsight.llm import counts, exact, mixing, near, phrases, secrets
from pyspark.sql import functions as F

WORDS = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
#: Long ones with one changed word, nulls, empty ones, repeated rows, null and repeated ids.
ROWS = [
    (1, WORDS, "en", "src0"), (2, WORDS + " end", "en", "src1"), (None, WORDS, "en", "src0"), (3, None, None, None), (4, "", "de", "src2"),
    (5, "some plain words stand here in a row", "en", "src1"), (5, "some plain words stand here in a row", "en", "src1"),
    (None, None, None, None), (None, "no id but words of its own are here", "de", "src2"), (5, "another text under the same id as before", "en", "src1"),
]
INNER = ["_row", "_ID", "node", "digest", "found", "owner", "n_tokens", "text_digest", "fingerprint", "Score", "copies", "IDS", "bands"]


def wide(table, rows=ROWS):
    df = table(rows)
    for name in INNER:
        df = df.withColumn(name, F.lit("extra"))
    return df


def rows_of(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def ids(rows=ROWS):
    return Counter((r[0],) for r in rows)


def test_mixing(table):
    assert rows_of(mixing.chosen(wide(table)), "doc_id") == ids()
    sizes = {r.n_tokens for r in mixing.chosen(wide(table)).where("doc_id = 1").collect()}
    assert sizes == {40_000}
    assert mixing.mixed(wide(table), mixing.Targets(hundredths=100, epochs=3)).columns[-len(INNER) :] == INNER


def test_secrets(table):
    value = "token = Zx81kQpL9wYtR3vN"
    rows = [*ROWS, (70, WORDS + " " + value, "en", "src0"), (None, value, "en", "src0"), (71, None, "en", "src0")]
    found = secrets.scan(wide(table, rows), F.col("source"), F.col("lang")).collect()
    assert Counter((r.doc_id,) for r in found) == ids(rows)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found if r.n_assign}
    assert set(spans) == {70, None}
    assert spans[70][0] == ("assign", len(WORDS) + 1, len(WORDS) + 1 + len(value))


def test_counts(table):
    model = counts.tokenizer(public_tokenizers.path(counts.MODEL))
    got = rows_of(counts.token_counts(wide(table)), "doc_id", "n_bytes", "n_tokens")
    assert got == Counter((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in ROWS)


def test_phrases(table):
    got = rows_of(phrases.with_next(wide(table, ROWS[:6])), "doc_id", "n_chars", "fingerprint")
    assert got == Counter((i, len(t or ""), phrases.fingerprint(t or "")) for i, t, *_ in ROWS[:6])


def test_near_copies_of_long_texts(table):
    found = near.classes(wide(table)).collect()
    assert Counter((r.doc_id,) for r in found) == ids()
    long = {r.root for r in found if r.doc_id in (1, 2)}
    assert len(long) == 1 and sum(r.root in long for r in found) == 3


def test_exact_copies(table):
    found = exact.decisions(wide(table)).collect()
    assert Counter((r.doc_id,) for r in found) == ids()
    assert sum(r.kept for r in found) == len({t or "" for _, t, *_ in ROWS})


def test_the_whole_pipeline(spark, table):
    known = [(100 + i, f"the dog and the cat run over hill number {i} in the rain", "en", "src0") for i in range(60)]
    known += [(200 + i, f"der Hund und die Katze laufen im Regen am Berg {i} entlang", "de", "src2") for i in range(60)]
    docs, kept = wide(table, [*ROWS, *known]), None
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, ""), f"test-{name}")
        if name != "token_ids":
            assert set(docs.columns) >= {"doc_id", "text", "lang", "source", "n_chars", *INNER}
            kept = docs
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    assert texts and all(t for _, t in texts)
    out = docs.collect()
    assert len(out) == sum(texts.values()) and all(r.round_trip for r in out)
