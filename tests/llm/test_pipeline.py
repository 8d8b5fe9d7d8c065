"""The pipeline's stages, each on what its predecessor kept, and the registered queries."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import __spark_entry__ as entry
from parcelsight.llm import bpe, mixing
from test_exact import plain as plain_copies
from test_mixing import plain as plain_mix
from test_near import plain_classes

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        if name != "token_ids":
            assert docs.columns == COLUMNS
        seen.append(docs.collect())
    given, known, single, apart, mixed, ids = seen
    assert {r.doc_id for r in known} == {r.doc_id for r in given}  # all clean here
    rows = lambda part: [(r.doc_id, r.text, r.lang, r.source) for r in part]
    assert sorted(r.doc_id for r in single) == sorted(r[0] for r in plain_copies(rows(known)) if r[3])
    assert sorted(r.doc_id for r in apart) == sorted({c for _, c in plain_classes(rows(single))})
    want = [d for d, n in plain_mix(rows(apart), corpus_pipeline.MIX) for _ in range(n)]
    assert sorted(r.doc_id for r in mixed) == sorted(want)
    codec = bpe.codec(public_tokenizers.path(bpe.RANKS))
    texts = {r.doc_id: r.text for r in mixed}
    assert sorted(r.doc_id for r in ids) == sorted(want)
    assert all(r.round_trip and r.ids == codec.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in ids)
    assert isinstance(corpus_pipeline.MIX, mixing.Targets)


def test_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = Path(entry.__file__).parent
    for path in ("__spark_entry__.py", "check_oracle.py"):
        (tmp_path / path).write_text((root / path).read_text())
    for path in (root / "parcelsight").rglob("*.py"):
        if "llm" not in path.parts:
            copy = tmp_path / path.relative_to(root)
            copy.parent.mkdir(parents=True, exist_ok=True)
            copy.write_text(path.read_text())
    code = "import __spark_entry__ as e; assert 'alerts' in e.queries() and 'pipeline' not in e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
