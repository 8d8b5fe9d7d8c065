"""Lexical search against scoring every document, and the algorithm's own steps."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from parcelsight.llm import search as s

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, queries, k=10):
    held = [(d[0], Counter(plain_terms(d[1]))) for d in docs]
    held = [(i, c) for i, c in held if c]
    n, every = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        scores = []
        for doc_id, own in held:
            m = 100 - 75 + (75 * sum(own.values()) * n) // every
            total = 0
            for t in plain_terms(text):
                if tf := own.get(t):
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    total += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if total > 0:
                scores.append((-total, doc_id is None, doc_id or 0, doc_id))
        out += [(item, at, d, -score) for at, (score, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def tables(spark, docs, queries):
    d = spark.createDataFrame([(*x, "n", 1) for x in docs], "doc_id long, text string, n_terms string, score long").repartition(4)
    q = spark.createDataFrame([(*x, 5, "z") for x in queries], "item_id long, text string, query long, term string").repartition(2)
    return d, q


def check(spark, docs, queries, **options):
    found = s.ranked(*tables(spark, docs, queries), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs, queries, options.get("k", 10))


def corpus(rng, n, words=60, longest=40):
    pick = lambda: f"W{min(int(rng.paretovariate(0.7)), words)}"
    return [(i, " ".join(pick() for _ in range(rng.randrange(1, longest)))) for i in range(n)]


def test_against_scoring_every_document(spark):
    rng = random.Random(1)
    docs = corpus(rng, 400)
    queries = [(i, " ".join(f"w{rng.randrange(1, 70)}" for _ in range(rng.randrange(1, 12)))) for i in range(20)]
    check(spark, docs, queries)
    check(spark, docs, queries, k=3, most=90)  # several blocks of queries


def test_ties_copies_nulls_empty_and_repeated_rows(spark):
    docs = [(i, "one two three") for i in range(40)] + [(7, "one two three"), (None, "one two three"), (None, None)]
    docs += [(50, None), (51, ""), (52, " .,;\n"), (None, "two two É é 中文 a中b"), (53, "É é"), (54, "x" * 200_000 + " one")]
    docs += [(55, "one " * 60_000), (56, "Naïve naïve-ONE_two9")]
    queries = [(1, "ONE two"), (1, "ONE two"), (2, None), (3, ""), (4, "nowhere"), (None, "é two"), (5, "one one one two"), (6, "中文 naïve two9")]
    check(spark, docs, queries, k=60)


def test_empty_tables(spark):
    assert s.ranked(*tables(spark, [], [(1, "a")])).collect() == []
    assert s.ranked(*tables(spark, [(1, "a")], [])).collect() == []
    assert s.ranked(*tables(spark, [(1, None)], [(1, "a")])).collect() == []


def test_terms_are_those_of_the_pattern():
    every = "".join(map(chr, [*range(0x500), 0x2028, 0x3000, 0xFFFD, 0x1F600]))
    for text in (every, every[::-1], "a\x85b\xa0c"):
        assert [t.decode() for t in s.terms(text.encode())] == plain_terms(text)


def shard_of(rng, docs, vocabulary, mean):
    held = [sorted(rng.choice(vocabulary, size=min(vocabulary, 1 + rng.poisson(mean)), replace=False)) for _ in range(docs)]
    starts = np.append(0, np.cumsum([len(h) for h in held]))
    return s.Shard(starts, np.concatenate(held).astype(np.int64), rng.integers(0, 1000, starts[-1]), vocabulary)


@pytest.mark.parametrize("seed", range(6))
def test_the_k_best_of_a_shard_with_all_ties(seed):
    rng = np.random.default_rng(seed)
    shard = shard_of(rng, 2_000, 300, 20)
    wanted, times = np.sort(rng.choice(300, 8, replace=False)), rng.integers(1, 3, 8)
    factor = np.zeros(301, np.int64)
    factor[wanted] = times
    totals = np.add.reduceat(factor[shard.held] * shard.impacts, shard.starts[:-1])
    docs, scores, _ = s.best_positions(shard, wanted, times, 10)
    kth = np.sort(totals)[-10]
    assert sorted(zip(docs, scores)) == [(d, t) for d, t in enumerate(totals) if t >= kth]
    floor = int(np.sort(totals)[-4])
    docs, scores, fewer = s.best_positions(shard, wanted, times, 10, floor)
    assert sorted(zip(docs, scores)) == [(d, t) for d, t in enumerate(totals) if t >= floor]


def test_reading_stops_early_where_one_document_leads():
    rng = np.random.default_rng(9)
    shard = shard_of(rng, 5_000, 50, 10)
    leaders = np.flatnonzero(np.isin(shard.held, [3, 4]))[:200]
    shard.impacts[leaders] = 10_000_000 + np.arange(len(leaders))
    shard = s.Shard(shard.starts, shard.held, shard.impacts, 50)
    _, _, looked_up = s.best_positions(shard, np.array([3, 4]), np.array([1, 1]), 10)
    assert looked_up < 200


def test_direct_accesses_move_the_best_position():
    # Document 0 leads list 0, document 1 list 1; each is second in the other.
    shard = s.Shard(np.array([0, 2, 4]), np.array([0, 1, 0, 1]), np.array([9, 5, 8, 7]), 2)
    docs, scores, looked_up = s.best_positions(shard, np.array([0, 1]), np.array([1, 1]), 1)
    assert (docs.tolist(), scores.tolist(), looked_up) == ([1], [15], 2)


def test_blocks_keep_their_bound(spark):
    _, queries = tables(spark, [], [(i, " ".join(f"t{i}x{j}" for j in range(1 + i % 7))) for i in range(60)])
    made = list(s.blocks(s.query_terms(queries), 50))
    assert sum(len(b.queries) for b in made) == 60
    assert all(sum(len(w) for w, _ in b.queries.values()) <= 50 for b in made)
