"""Near duplicates: consistent weighted samples of TF-IDF shingles, banded, then verified.

Two texts are near duplicates if the weighted Jaccard similarity of their shingles (five
words) is LEAST or more. A shingle weighs its count in the text times 1 + ln(1 / share),
where share is the part of all texts that hold it, but COMMON at least: shingles in a
smaller part of the texts all weigh alike, so only common ones need a table. At most
4/3 * (mean shingles per text) / COMMON shingles can pass its prefilter, whatever
the corpus size; that bounds what is broadcast. The counts are exact: blocks of texts report shingles
held by a quarter of COMMON of their texts, sums bound the share of each from above, and a
second pass counts those that may reach COMMON over all texts.

Improved consistent weighted sampling draws BANDS x ROWS samples per text; a sample of two
texts agrees with the probability of their similarity. Texts that agree in all rows of a
band meet in a bucket. At similarity 0.8 a pair meets with probability 0.9992.

Equal texts (lower case, blanks as one space) are one node. Each bucket has a leader, the
node that shares most buckets, and every node of it is compared with the leader: one
comparison per node, however large the group. A node that is not linked to its leader is
far from it; far nodes are compared with all nodes that are linked to that leader and with its
other far nodes, in cells of FAR far nodes and PART others. So two nodes that meet in a bucket
are either compared or both linked to one leader: no link that counts is lost, and no
group meets in one task. Linked nodes form the classes (alternating star contraction, in Spark).

Null and empty texts are equal to each other, so they are one class. Repeated rows are in
one class. The class id is the smallest doc_id in it (null only if all are). Other columns
are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelsight.llm import shingles as sh
from parcelsight.llm.common import BLANKS, released, sliced, stored, text_of, whole_row

LEAST = 0.8
COMMON = 0.005
BANDS, ROWS = 10, 3
#: Nodes that are compared together: far ones, and those they are compared with.
FAR, PART = 64, 512
#: Texts of a block that reports common shingles.
TEXTS = 4_096


def body() -> Column:
    """Lower case, one space between words."""
    return F.trim(F.regexp_replace(F.lower(text_of()), BLANKS, " "))


def nodes_of(docs: DataFrame) -> DataFrame:
    """doc_id, body and node (digest of the body) of each row."""
    return docs.select("doc_id", body().alias("body")).select("doc_id", "body", F.unhex(F.md5("body")).alias("node"))


# Shares of common shingles


def _reported(texts: list[bytes], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that at least so many of the texts hold, and how many do."""
    held = [sh.counted(block)[0] for block in sh.blocks(texts)]
    numbers, counts = np.unique(np.concatenate(held), return_counts=True)
    often = counts >= least
    return numbers[often], counts[often]


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def common_shares(bodies: DataFrame, common: float = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that a share of at least `common` of the texts hold, and their shares."""
    spark = bodies.sparkSession

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column("body"))
            for part in np.array_split(np.arange(len(texts)), -(-len(texts) // TEXTS)):
                numbers, counts = _reported([texts[i] for i in part], common / 4 * len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers.view(np.int64)), pa.array(counts), pa.array(np.full(len(counts), len(part)))],
                    ["shingle", "held", "texts"],
                )

    one = bodies.select("body")
    total = bodies.count()
    reports = one.mapInArrow(lambda batches: released(report(batches)), "shingle long, held long, texts long")
    # Blocks that did not report a shingle hold it less often than their threshold.
    most = F.sum("held") + F.lit(common / 4) * (total - F.sum("texts"))
    may = reports.groupBy("shingle").agg(most.alias("most")).where(F.col("most") >= common * total)
    wanted = np.sort(np.array([r[0] for r in may.select("shingle").toLocalIterator()], np.int64).view(np.uint64))
    if not len(wanted):
        return wanted, np.zeros(0)
    sent = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for block in sh.blocks(_texts(batch.column("body"))):
                places, found = _lookup(sent.value, sh.counted(block)[0])
                own += np.bincount(places[found], minlength=len(own))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], ["place", "held"])

    sums = one.mapInArrow(lambda batches: released(count(batches)), "place long, held long").groupBy("place").agg(F.sum("held").alias("held"))
    held = np.zeros(len(wanted))
    for row in sums.toLocalIterator():
        held[row["place"]] = row["held"]
    enough = held >= common * total
    return wanted[enough], held[enough] / total


def _lookup(table: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.minimum(np.searchsorted(table, numbers), max(0, len(table) - 1))
    return places, (table[places] == numbers if len(table) else np.zeros(len(numbers), bool))


class Weights:
    """Weights of shingles from the shares of the common ones."""

    def __init__(self, numbers: np.ndarray, shares: np.ndarray, common: float = COMMON):
        self.numbers, self.rare = numbers, 1 + np.log(1 / common)
        self.factors = 1 + np.log(1 / shares)

    def __call__(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        factors = np.full(len(numbers), self.rare)
        if len(self.numbers):
            places, found = _lookup(self.numbers, numbers)
            factors[found] = self.factors[places[found]]
        return counts * factors


# Samples


def samples(numbers: np.ndarray, weights: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """n consistent weighted samples of each run of shingles (starts: first place of each).

    For a shingle of weight w and sample k, with r, c from Gamma(2, 1) and b uniform, all
    drawn from the shingle's number and k: t = floor(ln w / r + b), y = exp(r (t - b)), and
    the shingle with the least c / (y exp r) is the sample, together with its t.
    """
    out = np.empty((n, len(starts)), np.uint64)
    log_w = np.log(weights).astype(np.float32)
    sizes = np.diff(np.append(starts, len(numbers)))
    value, level = np.empty(len(numbers), np.float32), np.empty(len(numbers), np.float32)
    for k in range(n):
        seed = np.uint64(0x632BE59BD9B4E019 * (k + 1) % (1 << 64))
        for at in range(0, len(numbers), 8192):
            part = slice(at, at + 8192)
            a = sh.mix(numbers[part] + seed)
            b = sh.mix(a ^ seed)
            u1, u2, u3 = _uniform(a, 0), _uniform(a, 21), _uniform(a, 42)
            r = -np.log(u1 * u2)
            beta = _uniform(b, 0)
            t = np.floor(log_w[part] / r + beta)
            level[part] = t
            value[part] = np.log(-np.log(u3 * _uniform(b, 21))) - r * (t - beta) - r
        least = np.minimum.reduceat(value, starts)
        place = np.flatnonzero(value == np.repeat(least, sizes))
        first = place[np.searchsorted(place, starts)]
        out[k] = sh.mix(numbers[first] + level[first].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def _uniform(x: np.ndarray, shift: int) -> np.ndarray:
    return (((x >> np.uint64(shift)) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-21)


def signatures(nodes: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, node and the band keys of each row; no keys for a text without words."""
    sent = nodes.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keys: list[list[int]] = []
            for block in sh.blocks(_texts(batch.column("body"))):
                keys += _band_keys(block, sent.value)
            made = pa.array(keys, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), made], ["doc_id", "node", "bands"])

    kind = nodes.schema["doc_id"].dataType.simpleString()
    return nodes.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, node binary, bands array<long>")


def _band_keys(texts: list[bytes], weights: Weights) -> list[list[int]]:
    numbers, owners, counts = sh.counted(texts)
    keys: list[list[int]] = [[] for _ in texts]
    if len(numbers):
        present, starts = np.unique(owners, return_index=True)
        drawn = samples(numbers, weights(numbers, counts), starts, BANDS * ROWS)
        bands = np.zeros((BANDS, len(present)), np.uint64)
        for row in range(ROWS):
            bands = sh.mix(bands + drawn[row::ROWS] * np.uint64(0xD6E8FEB86659FD93))
        bands = sh.mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None])
        for owner, own in zip(present.tolist(), bands.T.view(np.int64).tolist()):
            keys[owner] = own
    return keys


# Verification


def similarity(left: bytes, right: bytes, weights: Weights) -> float:
    """Weighted Jaccard similarity of two texts."""
    numbers, owners, counts = sh.counted([left, right])
    weight = weights(numbers, counts)
    a, b = owners == 0, owners == 1
    _, i, j = np.intersect1d(numbers[a], numbers[b], assume_unique=True, return_indices=True)
    both = np.minimum(weight[a][i], weight[b][j]).sum()
    total = weight.sum() - both
    return float(both / total) if total else 1.0


def _verified(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """left, right and likeness of each pair of nodes."""
    sent = pairs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            both = zip(_texts(batch.column("left_body")), _texts(batch.column("right_body")))
            made = pa.array([similarity(x, y, sent.value) for x, y in both], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("left"), batch.column("right"), made], ["left", "right", "likeness"])

    found = pairs.join(texts.select(F.col("node").alias("left"), F.col("body").alias("left_body")), "left").join(
        texts.select(F.col("node").alias("right"), F.col("body").alias("right_body")), "right"
    )
    return found.select("left", "right", "left_body", "right_body").mapInArrow(
        lambda batches: released(run(batches)), "left binary, right binary, likeness double"
    )


def links(members: DataFrame, texts: DataFrame, weights: Weights, least: float = LEAST) -> DataFrame:
    """Links (left, right) that connect all nodes that alike pairs of one bucket connect.

    members: bucket, node; texts: node, body of each."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    shared = members.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("shared"))
    leaders = members.join(shared, "node").groupBy("bucket").agg(F.max(F.struct("shared", "node")).node.alias("leader"))
    pairs = members.join(leaders, "bucket").where("node != leader")
    pairs = pairs.select(F.col("leader").alias("left"), F.col("node").alias("right")).distinct()
    seen = stored(_verified(pairs, texts, weights), "near-pairs")
    linked = seen.where(F.col("likeness") >= least).select("left", "right")
    return linked.unionByName(_far_links(seen, texts, weights, least))


def _rooted(df: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """The component of a node column, which is the node itself if it has no link."""
    own = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
    return df.join(own, node, "left").withColumn(name, F.coalesce("_root", node)).drop("_root")


def _far_links(seen: DataFrame, texts: DataFrame, weights: Weights, least: float) -> DataFrame:
    """Links of the nodes that are far from a leader: one to the nodes linked to that leader, if
    any is alike, and one to every other far node that is. seen: leader, node, likeness."""
    sent = seen.sparkSession.sparkContext.broadcast(weights)
    near_it = F.col("likeness") >= least
    every = seen.select(
        F.col("left").alias("root"), F.col("right").alias("node"), F.when(near_it, F.col("left")).otherwise(F.col("right")).alias("home")
    )
    far = every.where("home = node")
    # The leader itself has been compared with all of them.
    sizes = every.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(far.groupBy("root").agg(F.count(F.lit(1)).alias("n_far")), "root")
    sizes = sizes.where("n > 1").select(
        "root", F.ceil(F.col("n_far") / FAR).cast("int").alias("blocks"), F.ceil(F.col("n") / PART).cast("int").alias("parts")
    )
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    blocks = far.join(sizes, "root").select("root", "node", "home", own("blocks").alias("block"), numbers("parts").alias("part"))
    parts = every.join(sizes, "root").select("root", "node", "home", numbers("blocks").alias("block"), own("parts").alias("part"))
    cells = blocks.withColumn("is_far", F.lit(True)).unionByName(parts.withColumn("is_far", F.lit(False)))

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        return _compared(cell, sent.value, least)

    return cells.join(texts, "node").groupBy("root", "block", "part").applyInPandas(compare, "left binary, right binary")


def _compared(cell: pd.DataFrame, weights: Weights, least: float) -> pd.DataFrame:
    """Links of the far nodes of a cell to the others, one for each home."""
    far, others = cell[cell["is_far"]], cell[~cell["is_far"]]
    found = []
    if len(far) and len(others):
        numbers, owners, counts = sh.counted([b.encode() for b in others["body"]])
        heavy = weights(numbers, counts)
        known, places = np.unique(numbers, return_inverse=True)
        totals = np.bincount(owners, heavy, len(others))
        for node, home, body in zip(far["node"], far["home"], far["body"]):
            own, _, own_counts = sh.counted([body.encode()])
            own_heavy = weights(own, own_counts)
            dense = np.zeros(len(known) + 1)
            at, there = _lookup(known, own)
            dense[at[there]] = own_heavy[there]
            both = np.bincount(owners, np.minimum(heavy, dense[places]), len(others))
            alike = both / np.maximum(totals + own_heavy.sum() - both, 1e-300) >= least
            first = {}
            for other, other_home in zip(others["node"][alike], others["home"][alike]):
                if other_home != home:
                    first.setdefault(other_home, other)
            found += [(min(node, other), max(node, other)) for other in first.values()]
    return pd.DataFrame(found, columns=["left", "right"])


def components(edges: DataFrame) -> DataFrame:
    """node and root (least node of its component) of every node with a link, but the roots."""
    edges = stored(edges, "near-edges")
    while True:
        both = edges.select("left", "right").union(edges.select(F.col("right"), F.col("left"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("left"), F.col("v").alias("right"))
        large = stored(large, "near-large")
        # Now the smaller neighbours of each node are tied to the least of them.
        least = large.groupBy("right").agg(F.min("left").alias("m"))
        tied = large.join(least, "right")
        ties = F.explode(F.array(F.struct("m", F.col("left").alias("n")), F.struct("m", F.col("right").alias("n"))))
        small = tied.select(ties.alias("t")).select(F.col("t.m").alias("left"), F.col("t.n").alias("right"))
        edges = stored(small.where("left != right").distinct(), "near-edges")
        # All is done when every node is tied to one other, which is tied to none.
        sides = F.explode(F.array(F.struct(F.col("left").alias("n"), F.lit(0).alias("tied")), F.struct(F.col("right").alias("n"), F.lit(1).alias("tied"))))
        ends = edges.select(sides.alias("s")).select("s.n", "s.tied").groupBy("n")
        open_ends = ends.agg(F.sum("tied").alias("ties"), F.min("tied").alias("least")).where("ties > 1 or (ties = 1 and least = 0)")
        if open_ends.isEmpty():
            return edges.select(F.col("right").alias("node"), F.col("left").alias("root"))


def classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per row of docs: doc_id, node, root, class_id, class_size and kept (see `keep_one`).
    The root tells classes apart, also those whose smallest id is the same or null."""
    nodes = nodes_of(docs)
    weights = Weights(*common_shares(nodes))
    signed = stored(signatures(nodes, weights), "near-signatures")
    holders = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    members = holders.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stored(members.join(shared, "bucket"), "near-members")
    wanted = holders.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", "node")
    wanted = wanted.select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    texts = nodes.join(wanted.hint("shuffle_hash"), F.expr("doc_id <=> _id and node = _node"))
    texts = stored(texts.select("node", "body").dropDuplicates(["node"]), "near-texts")
    roots = components(links(members, texts, weights, least))
    rooted = _rooted(signed.select("doc_id", "node"), roots, "node", "root")
    sized = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rooted.join(sized, "root").select(
        "doc_id", "node", "root", "class_id", "class_size", F.expr("doc_id <=> class_id").alias("kept")
    )


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row of each class, that with the smallest id, with all columns of docs. Of rows of a
    class that share this id, the one with the least node and then any of the equal ones stays."""
    chosen = classes(docs, least).where("kept").groupBy("root", "class_id").agg(F.min("node").alias("_node"))
    chosen = chosen.select(F.col("class_id").alias("_id"), "_node")
    own = docs.select(whole_row(docs), "doc_id", F.unhex(F.md5(body())).alias("_own"))
    found = own.join(chosen.hint("shuffle_hash"), F.expr("doc_id <=> _id and _own = _node"))
    repeated = F.row_number().over(Window.partitionBy("_id", "_node").orderBy("_id"))
    return found.withColumn("_n", repeated).where("_n = 1").select("_row.*")
