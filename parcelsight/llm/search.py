"""Ranked lexical search: the best documents of every query by the Best Position Algorithm.

Terms are runs of ASCII letters and digits and of all signs beyond ASCII, A-Z lower-cased. A
document's impact for a term is the term's weight times its damped frequency, in whole numbers
(`weight`, `impact`); a document's score for a query is the sum over the query's terms, repeats
included. Scores are exact, so ties are real; they go to the smaller doc_id.

Best Position Algorithm: a query has one list per term, documents by falling impact. Each round
reads the next unseen positions of all lists; every document met there is looked up
directly in the other lists too, which adds its whole score and marks its positions as seen. A
list's best position is the last one before the first that is unseen. No unseen document can
score more than the impacts behind the best positions add up to. These fall faster than those of the positions
last read, as direct accesses fill the gaps. Reading stops when that bound is strictly
below the k-th score, so equal scores are never lost.

In Spark: one pass over the texts keeps, for each document, its length and its
counts of the queries' terms. Lengths and document frequencies are summed over all documents. Then
each task takes its documents in shards of SHARD, builds the lists of a shard and runs the
algorithm for every query, with the k-th score of its earlier shards as a further floor; the k
best of the tasks are merged, first within a few parts of a query, then per query. No list of a
term is ever in one place, so a term that all documents hold is no hot key, and copies of one text are spread like other rows.

Queries are taken in blocks of about TERMS (query, term) rows: a block's terms are broadcast,
and each block reads the documents once. So what is sent is bounded whatever the number of queries
(a single query beyond the bound is a block of its own).

Null and empty texts have no term: as documents they count in no statistic and are never found;
as queries they give no row. Long texts are read whole. Repeated documents
rank one after the other, each with its own row; repeated queries each get their rows. A null doc_id comes after
all others of its score. An empty table of either side gives an empty result. Only doc_id, item_id and
text are read; other columns may have any name but these, in any case of letters.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parcelsight.llm.common import sliced, stored, text_of

BEST = 10
#: (query, term) rows of a block of queries.
TERMS = 500_000
#: Documents, and counts of terms, that a task searches together.
SHARD, ENTRIES = 8_192, 1_000_000
#: Positions of each list in the first round; every further round reads twice as many.
FIRST = 8
#: Parts in which a query's results are merged first.
PARTS = 64

#: Bytes that end a term become a blank, A-Z become a-z, all others stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8. Signs beyond ASCII have only bytes of 128 or more."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(n_terms: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """A document's m, from its number of terms."""
    return 25 + (75 * n_terms.astype(np.int64) * n_docs) // max(1, n_all)


def impact(weights: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    counts = counts.astype(np.int64)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


# The algorithm on one shard


class Shard:
    """The postings of some documents: by document, and by term with falling impact."""

    def __init__(self, starts: np.ndarray, held: np.ndarray, impacts: np.ndarray, vocabulary: int):
        """starts: first posting of each document, and the end; held: terms of the postings."""
        self.starts, self.held, self.impacts = starts, held, impacts
        owners = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        order = np.lexsort((-impacts, held))
        self.owners, self.falling = owners[order], impacts[order]
        self.first = np.searchsorted(held[order], np.arange(vocabulary + 1))
        self.places = np.empty(len(order), np.int32)
        self.places[order] = np.arange(len(order), dtype=np.int32)

    def postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: all postings of the documents, and the place of their document in docs."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        own = np.repeat(np.arange(len(docs)), sizes)
        return np.arange(len(own)) - (ends - sizes)[own] + self.starts[docs][own], own


def best_positions(shard: Shard, wanted: np.ndarray, times: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents (numbers in the shard) and scores that hold the k best above 0 with all ties of the
    last, but for documents below the floor; and the number of documents looked up.

    wanted: the query's distinct terms; times: how often it has each."""
    first, end = shard.first[wanted], shard.first[wanted + 1]
    lists = np.flatnonzero(end > first)
    lists = lists[shard.falling[first[lists]] > 0]
    first, end, wanted, times = first[lists], end[lists], wanted[lists], times[lists]
    factor = np.zeros(len(shard.first), np.int64)
    factor[wanted] = times
    met = np.zeros(len(shard.starts) - 1, bool)
    seen = np.zeros(len(shard.held), bool)
    best, step, looked_up = first.copy(), FIRST, 0
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    while True:
        bound = sum(int(t) * int(shard.falling[at]) for t, at, to in zip(times, best, end) if at < to)
        kth = max(floor, int(scores.min()) if len(scores) >= k else 1)
        if bound < kth:
            return docs, scores, looked_up
        read = [shard.owners[at : min(at + step, to)] for at, to in zip(best, end)]
        new = np.unique(np.concatenate(read))
        new = new[~met[new]]
        met[new] = True
        looked_up += len(new)
        at, own = shard.postings(new)
        gain = factor[shard.held[at]]
        taken = gain > 0
        at, own, gain = at[taken], own[taken], gain[taken]
        seen[shard.places[at]] = True
        sums = np.append(0, np.cumsum(gain * shard.impacts[at]))
        total = np.diff(sums[np.searchsorted(own, np.arange(len(new) + 1))])
        enough = total >= kth
        docs, scores = np.append(docs, new[enough]), np.append(scores, total[enough])
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            docs, scores = docs[scores >= least], scores[scores >= least]
        for j, to in enumerate(end):
            rest = seen[best[j] : to]
            best[j] = to if rest.all() else best[j] + rest.argmin()
        step *= 2


# Queries


class Block:
    """Queries with their terms as numbers."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        """rows: number of the query, term, how often."""
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for _, t, _ in rows}))}
        self.queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        own: dict[int, list[tuple[int, int]]] = {}
        for query, term, times in rows:
            own.setdefault(query, []).append((self.vocabulary[term], times))
        for query, found in sorted(own.items()):
            found = np.array(sorted(found), np.int64)
            self.queries[query] = found[:, 0], found[:, 1]


def query_terms(queries: DataFrame) -> DataFrame:
    """query, item_id, term, times: the distinct terms of each row of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(terms(t)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(c) for c in found]))
            made = [pa.array([t for c in found for t in c], pa.binary()), pa.array([n for c in found for n in c.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("query").take(at), batch.column("item_id").take(at), *made], ["query", "item_id", "term", "times"])

    kind = queries.schema["item_id"].dataType.simpleString()
    # Written first: the numbers of the rows must not change when they are read again.
    rows = stored(queries.select(F.monotonically_increasing_id().alias("query"), "item_id", text_of().alias("text")), "search-queries")
    return stored(rows.mapInArrow(run, f"query long, item_id {kind}, term binary, times long"), "search-terms")


def blocks(found: DataFrame, most: int = TERMS) -> Iterator[Block]:
    """Blocks of whole queries with at most so many rows each, or with one query."""
    sizes = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    n, largest, total = sizes.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    if not n:
        return
    parts = -(-total // most)
    block = lambda: F.pmod(F.xxhash64("query"), F.lit(parts))
    # More parts until what is sent keeps its bound.
    while parts < 64 * n and sizes.groupBy(block().alias("b")).agg(F.sum("n").alias("n")).where(F.col("n") > max(most, largest)).limit(1).count():
        parts *= 2
    for at in range(parts):
        rows = found.where(block() == at).select("query", "term", "times").collect()
        if rows:
            yield Block([(r["query"], bytes(r["term"]), r["times"]) for r in rows])


# Documents


def postings(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id, n_terms and the counts of the block's terms in each document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in sliced(batches):
            sizes, held, counts, lengths = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = terms(text)
                own = Counter(map(number, found))
                own.pop(None, None)
                lengths.append(len(found))
                sizes.append(len(own))
                held += own
                counts += own.values()
            ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            made = [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in (held, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), *made], ["doc_id", "n_terms", "held", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = rows.mapInArrow(run, "doc_id long, n_terms long, held array<int>, counts array<int>")
    return stored(found.where("n_terms > 0"), "search-postings")


def frequencies(found: DataFrame, n: int) -> np.ndarray:
    """In how many documents each of the block's n terms is. The sums have one row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(n, np.int64)
        for batch in batches:
            own += np.bincount(batch.column("held").flatten().to_numpy(), minlength=n)
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], ["term", "df"])

    counted = found.select("held").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(n, np.int64)
    for row in counted.toLocalIterator():
        df[row["term"]] = row["df"]
    return df


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, entries = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            held.append(part)
            rows, entries = rows + part.num_rows, entries + len(part.column("held").flatten())
            if rows >= SHARD or entries >= ENTRIES:
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _best(scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, unknown, -scores))[:k]
    return scores[order], ids[order], unknown[order]


def searched(found: DataFrame, block: Block, k: int = BEST) -> DataFrame:
    """query, doc_id and score: the k best of each query, from the postings of all documents."""
    spark = found.sparkSession
    n_docs, n_all = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = frequencies(found, len(block.vocabulary))
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    sent = spark.sparkContext.broadcast((block.queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = sent.value
        nothing = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        kept = {}
        for table in _shards(batches):
            table = table.combine_chunks()
            ids = table.column("doc_id")
            unknown, ids = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
            held, counts = (table.column(c).combine_chunks() for c in ("held", "counts"))
            sizes = np.diff(held.offsets.to_numpy())
            starts = np.append(0, np.cumsum(sizes))
            held, counts = held.flatten().to_numpy(), counts.flatten().to_numpy()
            m = damping(table.column("n_terms").to_numpy(), n_docs, n_all)
            shard = Shard(starts, held, impact(weights[held], counts, np.repeat(m, sizes)), len(weights))
            for query, (wanted, times) in queries.items():
                before = kept.get(query, nothing)
                floor = int(before[0][-1]) if len(before[0]) == k else 0
                docs, scores, _ = best_positions(shard, wanted, times, k, floor)
                both = [np.append(a, b) for a, b in zip(before, (scores, ids[docs], unknown[docs]))]
                kept[query] = _best(*both, k)
        for query, (scores, ids, unknown) in kept.items():
            made = [pa.array(np.full(len(ids), query)), pa.array(ids, mask=unknown), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(made, ["query", "doc_id", "score"])

    rows = found.mapInArrow(run, "query long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy("query", "_part").orderBy(*order))
    rows = rows.withColumn("_part", part).withColumn("_n", first).where(F.col("_n") <= k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return rows.select("query", "doc_id", "score").withColumn("rank", rank).where(F.col("rank") <= k)


def ranked(docs: DataFrame, queries: DataFrame, k: int = BEST, most: int = TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of each row of queries."""
    spark: SparkSession = docs.sparkSession
    asked = query_terms(queries)
    kind = asked.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], "query long, doc_id long, score long, rank int")
    for block in blocks(asked, most):
        found = found.unionByName(stored(searched(postings(docs, block), block, k), "search-found"))
    names = asked.select("query", "item_id").distinct()
    return found.join(names, "query").select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")


def sql(k: int = BEST) -> str:
    """The same by scoring every document, in DuckDB's SQL."""

    def counted(table: str, name: str) -> str:
        lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"""
  select r, {name}, term, count(*) as tf
  from (select r, {name}, unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
        from (select row_number() over () as r, * from {table}))
  group by all"""

    return f"""
with held as ({counted("documents", "doc_id")}
), asked as ({counted("benchmark", "item_id")}
), lengths as (select r, sum(tf)::bigint as n from held group by r),
totals as (select count(*) as docs, sum(n)::bigint as every from lengths),
damped as (select r, 25 + (75 * n * docs) // every as m from lengths, totals),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from held, totals group by term
), scored as (
  select a.r, a.item_id, h.r as d, h.doc_id, sum(a.tf * w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * m)))::bigint as score
  from asked a join held h using (term) join weights using (term) join damped on damped.r = h.r
  group by a.r, a.item_id, h.r, h.doc_id
)
select item_id, (row_number() over (partition by r order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0
qualify rank <= {k}
"""
