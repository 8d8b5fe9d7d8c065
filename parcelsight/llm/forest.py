"""Near duplicates of embeddings: a forest of random projection trees with overlap.

Two vectors of one label link if their cosine is LEAST or more. Equal vectors are one node with
the number of its copies. Every tree splits the nodes of a group (label and number of
components) again and again at a random direction. Nodes near a split go to both sides
(spill): the overlap is so wide that a pair just at LEAST is parted by a split with a
probability of MISS at most. A cell ends as a leaf when it has LEAF nodes, or where a split
would put more than SPILL of them on both sides: such a cell is so dense that splitting
would lose links. Within each leaf all nodes are compared in double precision; a leaf of more than
BLOCK nodes is compared in pairs of blocks, so no task holds a leaf, and none is left out.

A tree of depth d finds a pair at the threshold with a probability of at least (1 - MISS) ** d, TREES
trees together miss 2e-6 of them at depth 4 and 3 % at depth 20; closer pairs are missed less.
Every link is exact, none is below LEAST.

Links are never emitted as pairs. Each node knows all leaves it is in; a link is counted in
the least leaf that holds both ends, and each leaf emits one row per node: how many nodes it
links to there, and one node of its linked part of the leaf. From these come the number of links and,
joined over leaves (star contraction), the components.

Trees are fitted in rounds, in Spark, on about SAMPLE nodes of every cell that is open: those with
the least hashes, which are spread evenly as nodes are distinct. A fitted tree is a list of
seeds, thresholds and widths; directions are drawn anew from the seeds. Nodes meet the trees of their
cell in blocks of BLOCK, so a label with a third of all rows is spread like others.

Vectors that are null, empty, zero, or hold null or non-finite components, and those without a
label, link with nothing. Vectors of unequal length do not link. Repeated rows are copies of
each other. A null vec_id is no component's name unless it has no other; its row is kept if the
component has none. Ties have no part in the result. Long vectors are read whole. An empty table gives an empty
table. Other columns are ignored and may have any name but vec_id, embedding and label in any case of letters.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelsight.llm.common import stored
from parcelsight.llm.near import components

LEAST = 0.93
TREES = 8
LEAF, BLOCK = 512, 1_024
#: Nodes on which a cell's splits are fitted, and the least number for one split.
SAMPLE, FEW = 4_096, 32
#: Largest probability that a split parts a pair at LEAST, and largest share in both sides.
MISS, SPILL = 0.05, 0.3
#: Directions tried for a split; that with the fewest nodes near the middle is taken.
TRIED = 6

_SPLITS = "array<struct<tree:int,path:string,seed:long,at:double,width:double>>"
_CELL = ["group", "tree", "path"]


# Splits


def direction(seed: int, size: int) -> np.ndarray:
    drawn = np.random.Generator(np.random.PCG64(seed)).standard_normal(size)
    return drawn / np.linalg.norm(drawn)


def _seed(*parts: object) -> int:
    text = "/".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(text, digest_size=7).digest(), "big")


def spread(least: float, size: int) -> float:
    """Standard deviation of the gap between a pair of that cosine in a random direction."""
    return math.sqrt(max(0.0, 2 - 2 * least) / size)


def half_width(near: float, gap: float, miss: float = MISS) -> float:
    """How far to each side of a split nodes go to both sides. near: share of the nodes within
    half a gap of the split. The chance that a pair with a normal gap is parted is
    near * E[(|z| - r)+] where the overlap is r gaps wide."""
    if near <= 0:
        return 0.0
    low, high = 0.0, 6.0
    for _ in range(40):
        r = (low + high) / 2
        beyond = 2 * (math.exp(-r * r / 2) / math.sqrt(2 * math.pi) - r * math.erfc(r / math.sqrt(2)) / 2)
        low, high = (r, high) if near * beyond > miss else (low, r)
    return high * gap / 2


def fitted(units: np.ndarray, total: float, tree: int, path: str, least: float, leaf: int = LEAF) -> list[tuple]:
    """Splits of a cell (tree, path, seed, threshold, half width), fitted on a sample of its
    unit vectors. total: nodes of the cell. Cells without a split are leaves, or left to the
    next round where the sample is too small to tell."""
    size, made = units.shape[1], []
    gap, scale = spread(least, size), total / max(1, len(units))
    todo = [(path, np.arange(len(units)))]
    while todo:
        at, own = todo.pop()
        if len(own) * scale <= leaf or len(own) < FEW:
            continue
        best = None
        for attempt in range(TRIED):
            seed = _seed(tree, at, attempt)
            along = units[own] @ direction(seed, size)
            middle = float(np.median(along))
            near = float(np.mean(np.abs(along - middle) <= gap / 2))
            if best is None or near < best[0]:
                best = (near, seed, along, middle)
        near, seed, along, middle = best
        width = half_width(near, gap)
        left, right = own[along < middle + width], own[along >= middle - width]
        if len(left) + len(right) > (1 + SPILL) * len(own) or max(len(left), len(right)) == len(own):
            continue
        made.append((tree, at, seed, middle, width))
        todo += [(at + "0", left), (at + "1", right)]
    return made


def routed(units: np.ndarray, splits: dict[str, tuple], path: str) -> Iterator[tuple[str, np.ndarray]]:
    """The cells that the unit vectors of a cell fall into, with their numbers."""
    todo = [(path, np.arange(len(units)))]
    while todo:
        at, own = todo.pop()
        if not len(own):
            continue
        if at not in splits:
            yield at, own
            continue
        seed, middle, width = splits[at]
        along = units[own] @ direction(seed, units.shape[1])
        todo += [(at + "0", own[along < middle + width]), (at + "1", own[along >= middle - width])]


# Nodes


def _floats(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column])


def _units(column: pd.Series) -> np.ndarray:
    found = _floats(column)
    # Scaled first, so that squares neither overflow nor vanish.
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def noded(vectors: DataFrame) -> DataFrame:
    """vec_id, group, node and vector (bytes of doubles) of each row; the last three are null for
    a row that links with nothing. Equal vectors of a group have one node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, nodes, kept = [], [], []
            for label, values in zip(batch.column("label").to_pylist(), batch.column("embedding")):
                own = values.values if values.is_valid else None
                made = None
                if label is not None and own is not None and len(own) and not own.null_count:
                    found = own.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zero
                    if np.isfinite(found).all() and found.any():
                        made = found.tobytes()
                group = None if made is None else f"{len(made) // 8}/{label}"
                groups.append(group)
                kept.append(made)
                nodes.append(None if made is None else hashlib.md5(group.encode() + b"\0" + made).digest())
            columns = [pa.array(groups, pa.string()), pa.array(nodes, pa.binary()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *columns], ["vec_id", "group", "node", "vector"])

    given = vectors.select("vec_id", "embedding", F.col("label").cast("string").alias("label"))
    kind = given.schema["vec_id"].dataType.simpleString()
    return given.mapInArrow(run, f"vec_id {kind}, group string, node binary, vector binary")


# Rounds


def _share() -> "F.Column":
    """A number in [0, 1) that spreads nodes evenly."""
    return F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / (1 << 30)


def _fitted_cells(rows: DataFrame, sizes: DataFrame, least: float, trees: int | None) -> DataFrame:
    """The splits of each open cell. rows: group, tree, path, node, vector; sizes: n of each cell.
    trees: how many trees begin in each cell (first round)."""

    def fit(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("node")
        units, total = _units(sample["vector"]), float(sample["n"].iloc[0])
        group, tree, path = key
        made = []
        for number in range(trees) if trees else [int(tree)]:
            made += fitted(units, total, number, path, least)
        found = [{"tree": t, "path": p, "seed": s, "at": a, "width": w} for t, p, s, a, w in made]
        return pd.DataFrame({"group": [group], "tree": [tree], "path": [path], "splits": [found]})

    sample = rows.join(sizes, _CELL).where(_share() < F.lit(float(SAMPLE)) / F.col("n"))
    return sample.groupBy(*_CELL).applyInPandas(fit, f"group string, tree int, path string, splits {_SPLITS}")


def _routed_cells(rows: DataFrame, sizes: DataFrame, cells: DataFrame, trees: int | None) -> DataFrame:
    """Rows (group, tree, path, node, vector) in the cells that the splits make of theirs."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = rows.join(sizes, _CELL).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")).drop("n")
    cells = cells.join(sizes, _CELL).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")

    def route(key: tuple, members: pd.DataFrame, splits: pd.DataFrame) -> pd.DataFrame:
        group, tree, path, _ = key
        found = []
        if len(members):
            units = _units(members["vector"])
            own: dict[int, dict[str, tuple]] = {t: {} for t in (range(trees) if trees else [int(tree)])}
            for part in splits["splits"].iloc[0] if len(splits) else []:
                own[part["tree"]][part["path"]] = part["seed"], part["at"], part["width"]
            whole = [number for number, parts in own.items() if not parts]
            if whole:  # the cell is a leaf, which needs no other tree
                own = {whole[0]: {}}
            for number, parts in own.items():
                for at, chosen in routed(units, parts, path):
                    some = members[["node", "vector"]].iloc[chosen]
                    found.append(some.assign(group=group, tree=number, path=at, open=len(parts) > 0))
        columns = [*_CELL, "node", "vector", "open"]
        return pd.concat(found)[columns] if found else pd.DataFrame(columns=columns)

    made = dealt.groupBy(*_CELL, "block").cogroup(cells.groupBy(*_CELL, "block"))
    return made.applyInPandas(route, "group string, tree int, path string, node binary, vector binary, open boolean")


def leaves(nodes: DataFrame, least: float = LEAST, trees: int = TREES) -> DataFrame:
    """node and leaf (a number) of each node in each of its leaves. nodes: group, node, vector."""
    done = []
    rows = nodes.select("group", F.lit(0).alias("tree"), F.lit("").alias("path"), "node", "vector")
    first: int | None = trees
    while True:
        sizes = stored(rows.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n")), "forest-sizes")
        large = sizes.where(F.col("n") > LEAF)
        ready = rows.join(sizes.where(F.col("n") <= LEAF).select(*_CELL), _CELL, "left_semi")
        done.append(ready.select(*_CELL, "node"))
        if large.isEmpty():
            break
        open_rows = rows.join(large.select(*_CELL), _CELL, "left_semi")
        cells = stored(_fitted_cells(open_rows, large, least, first), "forest-splits")
        rows = stored(_routed_cells(open_rows, large, cells, first), "forest-cells")
        # A cell that no split helps is a leaf of any size.
        done.append(rows.where("not open").select(*_CELL, "node"))
        rows, first = rows.where("open").drop("open"), None
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.select("node", F.xxhash64(*_CELL).alias("leaf"))


# Links


def _linked(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which rows of two tables of vectors have a cosine of at least `least`."""
    size = lambda x: np.sqrt((x * x).sum(axis=1))
    left, right = (x / np.abs(x).max(axis=1, keepdims=True) for x in (left, right))
    a, b = size(left), size(right)
    cosine = (left @ right.T) / a[:, None] / b[None, :]
    linked = cosine >= least
    # A sum in another order could fall on the other side: near the bound it is made exactly.
    for i, j in zip(*np.nonzero(np.abs(cosine - least) < 1e-12)):
        exact = [math.fsum(x * y) for x, y in ((left[i], right[j]), (left[i], left[i]), (right[j], right[j]))]
        linked[i, j] = exact[0] / (math.sqrt(exact[1]) * math.sqrt(exact[2])) >= least
    return linked


def _first_common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least common leaf of pairs. Each side: sorted leaves of one pair's node per row, filled up with
    the largest number there is, which is no leaf both have."""
    most = np.iinfo(np.int64).max
    found = np.full(len(left), most)
    for column in range(left.shape[1]):
        same = (left[:, column, None] == right).any(axis=1)
        found = np.minimum(found, np.where(same, left[:, column], most))
    return found


def _padded(lists: pd.Series) -> np.ndarray:
    most = max(map(len, lists))
    return np.array([sorted(x) + [np.iinfo(np.int64).max] * (most - len(x)) for x in lists], np.int64)


def compared(cell: pd.DataFrame, leaf: int, least: float) -> pd.DataFrame:
    """node, links and other of the members of a leaf, or of two blocks of one: links that are
    counted here, and one node of the member's connected part of the cell. cell: node, vector,
    copies, leaves, block. Of two blocks only pairs across them are compared."""
    cell = cell.sort_values(["block", "node"], kind="stable").reset_index(drop=True)
    blocks = cell["block"].to_numpy()
    other = blocks != blocks[0]
    a, b = (np.flatnonzero(~other), np.flatnonzero(other)) if other.any() else (np.arange(len(cell)),) * 2
    vectors, copies, known = _floats(cell["vector"]), cell["copies"].to_numpy(), _padded(cell["leaves"])
    links, part = np.zeros(len(cell), np.int64), np.arange(len(cell))
    linked = _linked(vectors[a], vectors[b], least)
    if not other.any():
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    for at in range(0, len(i), 50_000):
        x, y = a[i[at : at + 50_000]], b[j[at : at + 50_000]]
        here = _first_common(known[x], known[y]) == leaf
        np.add.at(links, x[here], copies[y[here]])
        if other.any():
            np.add.at(links, y[here], copies[x[here]])
    # The least number reaches all members of a part, two steps at a time.
    while len(i):
        least_part = part.copy()
        np.minimum.at(least_part, a[i], part[b[j]])
        np.minimum.at(least_part, b[j], part[a[i]])
        least_part = least_part[least_part]
        if (least_part == part).all():
            break
        part = least_part
    met = (links > 0) | (part != np.arange(len(cell)))
    nodes = cell["node"].to_numpy()
    return pd.DataFrame({"node": nodes[met], "links": links[met], "other": nodes[part[met]]})


def partial_links(nodes: DataFrame, held: DataFrame, least: float = LEAST) -> DataFrame:
    """node, links and other, several rows per node. nodes: node, vector, copies; held: node, leaf."""
    held = stored(held, "forest-leaves")
    many = held.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    own = held.groupBy("node").agg(F.collect_list("leaf").alias("leaves"))
    rows = nodes.select("node", "vector", "copies").join(own, "node").withColumn("leaf", F.explode("leaves"))
    rows = rows.join(many, "leaf").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
    # A block meets itself and each other block once.
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")})

    def compare(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        if key[1] != key[2] and cell["block"].nunique() < 2:
            return pd.DataFrame(columns=["node", "links", "other"])
        return compared(cell, int(key[0]), least)

    return rows.groupBy("leaf", "low", "high").applyInPandas(compare, "node binary, links long, other binary")


def linked(vectors: DataFrame, least: float = LEAST, trees: int = TREES) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors (vec_id, embedding, label)."""
    rows = stored(noded(vectors), "forest-rows")
    whole = rows.where("node is not null")
    nodes = whole.groupBy("group", "node").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("id"))
    nodes = stored(nodes, "forest-nodes")
    found = stored(partial_links(nodes, leaves(nodes.select("group", "node", "vector"), least, trees), least), "forest-links")
    roots = components(found.where("node != other").select(F.col("other").alias("left"), F.col("node").alias("right")).distinct())
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "copies", "id").join(counts, "node", "left").join(roots, "node", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "node")), "forest-known")
    names = known.groupBy("root").agg(F.min("id").alias("component_id"))
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    known = stored(known.join(names, "root").select("node", links, "component_id", F.lit(True).alias("_known")), "forest-components")
    all_rows = rows.select("vec_id", "node").join(known, "node", "left")
    name = F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return all_rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"), name.eqNullSafe(F.col("vec_id")).alias("kept")
    )


def sql(least: float = LEAST) -> str:
    """All pairs of a label in DuckDB's SQL."""
    return f"""
with recursive whole as (
  select row_number() over () as r, vec_id, label, embedding::double[] as v
  from embeddings
), able as (
  select * from whole
  where label is not null and v is not null and len(v) > 0 and list_count(v) = len(v)
    and len(list_filter(v, lambda x: not isfinite(x))) = 0 and len(list_filter(v, lambda x: x != 0)) > 0
), pairs as (
  select a.r as r, b.r as o, b.vec_id as other
  from able a join able b on a.label = b.label and len(a.v) = len(b.v) and a.r != b.r
  where list_cosine_similarity(a.v, b.v) >= {least}
), reached as (
  select r, r as o from able
  union
  select reached.r, pairs.o from reached join pairs on pairs.r = reached.o
), named as (
  select reached.r, min(whole.vec_id) as component_id from reached join whole on whole.r = reached.o group by reached.r
), counted as (select r, count(*) as n from pairs group by r)
select vec_id, coalesce(n, 0) as n_links, case when named.r is null then vec_id else component_id end as component_id,
       vec_id is not distinct from (case when named.r is null then vec_id else component_id end) as kept
from whole left join named using (r) left join counted using (r)
"""
