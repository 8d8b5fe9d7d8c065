"""Merkle manifest of a dataset, whose parents keep the SHA states before each child.

Each row is a leaf: sha256 (H, lowercase hex) of its fields. Per group (lang) the leaves ascend
by id; every ARITY consecutive nodes become one parent, H of their digests as text, until one
is left, the group's subroot. The subroots, ordered by group, make a tree in the same way;
its last node is the root.

SHA midstate tree: while a parent hashes its children it keeps a copy of the state before each
of them. To fold a changed leaf, the copy of its slot goes on with the new digest and the
siblings to its right; what stands to its left is not hashed again. States live
in the task that holds the parent. What a task sends upwards is one digest, and what it
gets from above is the siblings of its node on each level, from which it makes
those states once for all of its rows.

A tree is built in rounds of LEVELS levels. A task has a chunk of ARITY ** LEVELS consecutive nodes of
a group, however many the group has, so a group with a third of all rows is spread like any
other. Rounds follow until each group has one node: two for 16 million rows, four for 10 ** 14.
Nodes get their positions from a range exchange (`ranks.positioned`), not from a window
over a group. Stored tables end lineage after each step; texts are read once, and only
ids and digests are exchanged.

Nulls: a null field is hashed as `-`; null ids come first in their group, and the null
group before all others. Empty texts hash as `0:`. Rows with one id are ordered by
their leaf; equal rows are leaves of their own, with equal digests. Long texts are
hashed whole. An empty table gives an empty table. Other columns have no part and may have
any name but one of the five that are read, in any case of its letters (Spark refuses those as ambiguous).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from parcelsight.llm.common import crc_of_id, stored
from parcelsight.llm.ranks import positioned

ARITY = 8
#: Levels of a tree that one task builds from its chunk.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """`-` for null, else the bytes of the value's text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def lowered(text: Column) -> Column:
    """A-Z only become a-z."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# A chunk of a tree


class Tree:
    """A chunk: consecutive nodes of a group and what is built over them."""

    def __init__(self, digests: Sequence[bytes], levels: int):
        """digests: hex text of the nodes in order; levels: how many stand above them."""
        self.nodes, self.states = [list(digests)], []
        for _ in range(levels):
            below, above, states = self.nodes[-1], [], []
            for at in range(0, len(below), ARITY):
                parent = hashlib.sha256()
                for child in below[at : at + ARITY]:
                    states.append(parent.copy())
                    parent.update(child)
                above.append(parent.hexdigest().encode())
            self.nodes.append(above)
            self.states.append(states)

    @property
    def top(self) -> bytes:
        return self.nodes[-1][0]

    def sides(self, at: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of a node in its run, on each level from below."""
        found = []
        for below in self.nodes[:-1]:
            first = at - at % ARITY
            found.append((b"".join(below[first:at]), b"".join(below[at + 1 : first + ARITY])))
            at //= ARITY
        return found

    def folded(self, at: int, digest: bytes) -> bytes:
        """The top after a node is replaced: on each level the state of its slot goes on."""
        for below, states in zip(self.nodes, self.states):
            state = states[at].copy()
            state.update(digest)
            state.update(b"".join(below[at + 1 : at - at % ARITY + ARITY]))
            digest = state.hexdigest().encode()
            at //= ARITY
        return digest


class Path:
    """The way from a chunk's top to the root: a state before the slot on each level."""

    def __init__(self, sides: Sequence[tuple[bytes, bytes]]):
        self.steps = [(hashlib.sha256(left), right) for left, right in sides]
        self.siblings = b"".join(left + right for left, right in sides)

    def folded(self, digest: bytes) -> bytes:
        for before, right in self.steps:
            state = before.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        return digest


def levels_of(size: int, most: int) -> int:
    """Levels that a round of at most so many builds above nodes of a group of this size."""
    levels = 0
    while size > 1 and levels < most:
        size, levels = -(-size // ARITY), levels + 1
    return levels


# Rounds


def _parents(nodes: DataFrame, most: int) -> DataFrame:
    """The next round's nodes: one for each chunk. nodes: group, position, size, digest."""

    def top(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("position")
        size = int(chunk["size"].iloc[0])
        tree = Tree([d.encode() for d in chunk["digest"]], levels_of(size, most))
        made = (chunk["group"].iloc[0], int(chunk["chunk"].iloc[0]), -(-size // ARITY**most), tree.top.decode())
        return pd.DataFrame([made], columns=["group", "position", "size", "digest"])

    return _chunked(nodes, most).groupBy("group", "chunk").applyInPandas(top, "group string, position long, size long, digest string")


def _chunked(nodes: DataFrame, most: int) -> DataFrame:
    return nodes.withColumn("chunk", F.floor(F.col("position") / ARITY**most).cast("long"))


def rounds(nodes: DataFrame, name: str, most: int = LEVELS) -> list[DataFrame]:
    """The nodes of each round, from the given ones to one node per group."""
    made = [nodes]
    while not made[-1].where("size > 1").isEmpty():
        made.append(stored(_parents(made[-1], most), f"{name}-{len(made)}"))
    return made


def paths(made: Sequence[DataFrame], upper: DataFrame, name: str, most: int = LEVELS) -> DataFrame:
    """(group, position, path) of the nodes of the second round: sides on all levels from there
    to the root. upper: group, path of each group's last node."""
    above = upper.select("group", F.lit(0).cast("long").alias("position"), "path")
    for at in range(len(made) - 1, 0, -1):
        above = stored(_sides(made[at], above, most), f"{name}-{at}")
    return above


def _sides(nodes: DataFrame, above: DataFrame, most: int) -> DataFrame:
    """The path of each node, given those of the nodes of the round above (of itself if it is
    its group's only one)."""

    def run(key: tuple, chunk: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("position")
        tree = Tree([d.encode() for d in chunk["digest"]], levels_of(int(chunk["size"].iloc[0]), most))
        rest = [(x["left"], x["right"]) for x in upper["path"].iloc[0]]
        made = [[(a.decode(), b.decode()) for a, b in tree.sides(i)] + rest for i in range(len(chunk))]
        found = [[{"left": a, "right": b} for a, b in path] for path in made]
        return pd.DataFrame({"group": chunk["group"], "position": chunk["position"], "path": found})

    return _with_upper(_chunked(nodes, most), above).applyInPandas(run, f"group string, position long, path {_PATH}")


def _with_upper(chunked: DataFrame, above: DataFrame):
    """Chunks cogrouped with the path of their top. The null group meets itself, as in groupBy."""
    return chunked.groupBy("group", "chunk").cogroup(above.withColumnRenamed("position", "chunk").groupBy("group", "chunk"))


def manifest(docs: DataFrame, changed: Column | None = None, most: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row of docs.

    changed: the text that is folded in for the row's own, over the columns of docs; without
    it nothing is changed. proof_sha256 is H of all siblings of the row's nodes from
    its leaf to the root; verified tells if the folded leaf gives the root. most: levels of a round.
    """
    given = {c: F.col(c) for c in FIELDS}
    other = leaf([*list(given.values())[:-1], changed]) if changed is not None else leaf(list(given.values()))
    leaves = docs.select("doc_id", F.col("lang").cast("string").alias("group"), leaf(list(given.values())).alias("digest"), other.alias("other"))
    # Equal rows are told apart by a number, so that they can be dealt to several tasks.
    leaves = stored(leaves.withColumn("n", F.monotonically_increasing_id()), "manifest-leaves")
    rows = stored(positioned(leaves, "group", ["doc_id", "digest", "n"], "manifest-sorted").drop("n"), "manifest-nodes")
    made = rounds(rows.select("group", "position", "size", "digest"), "manifest-round", most)
    subroots = made[-1].select("group", F.col("digest").alias("subroot"))

    tops = stored(subroots.select(F.lit("").alias("all"), "group", F.col("subroot").alias("digest")), "manifest-subroots")
    tops = stored(positioned(tops, "all", ["group"], "manifest-groups"), "manifest-tops")
    crown = rounds(tops.select(F.col("all").alias("group"), "position", "size", "digest"), "manifest-crown", most)
    end = crown[-1].select("group", F.array().cast(_PATH).alias("path"))
    ways = _sides(crown[0], paths(crown, end, "manifest-crown-paths", most), most) if len(crown) > 1 else end.withColumn("position", F.lit(0).cast("long"))
    upper = tops.select(F.col("group").alias("name"), F.col("digest").alias("subroot"), "position").join(ways.select("position", "path"), "position")
    root = crown[-1].select(F.col("digest").alias("root"))
    # One row per group, with the one row of the root.
    upper = stored(upper.withColumn("root", root.scalar()).withColumnRenamed("name", "group"), "manifest-upper")

    ids = rows.schema["doc_id"].dataType.simpleString()
    above = paths(made, upper.select("group", "path"), "manifest-paths", most)
    above = above.join(upper.select(F.col("group").alias("_group"), "subroot", "root"), F.expr("group <=> _group")).drop("_group")

    def run(key: tuple, chunk: pd.DataFrame, way: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("position")
        tree = Tree([d.encode() for d in chunk["digest"]], levels_of(int(chunk["size"].iloc[0]), most))
        path = Path([(x["left"].encode(), x["right"].encode()) for x in way["path"].iloc[0]])
        root = way["root"].iloc[0]
        proofs, folded = [], []
        for at, other in enumerate(chunk["other"]):
            own = b"".join(left + right for left, right in tree.sides(at))
            proofs.append(hashlib.sha256(own + path.siblings).hexdigest())
            folded.append(path.folded(tree.folded(at, other.encode())).decode())
        return pd.DataFrame(
            {
                "doc_id": chunk["doc_id"], "leaf": chunk["digest"], "subroot": way["subroot"].iloc[0], "root": root,
                "proof_sha256": proofs, "folded_root": folded, "verified": np.array(folded, object) == root,
            }
        )

    kinds = f"doc_id {ids}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    # A null id must not turn a column of ids into floats on its way through pandas.
    chunks = _chunked(rows, most).withColumn("doc_id", F.col("doc_id").cast("string"))
    found = _with_upper(chunks, above).applyInPandas(run, kinds.replace(f"doc_id {ids}", "doc_id string"))
    return found.withColumn("doc_id", F.col("doc_id").cast(ids))


def tampered() -> Column:
    """The text, lower-cased where 3 divides the crc32 of the id."""
    return F.when(crc_of_id() % 3 == 0, lowered(F.col("text"))).otherwise(F.col("text"))


def sql(levels: int = 21) -> str:
    """The manifest in DuckDB's SQL, for trees of at most so many levels."""
    crc = (
        "xor(4294967295, list_reduce(list_transform(range(length(id) + 1), lambda i: case when i = 0 then 4294967295::bigint "
        "else ord(id[i])::bigint end), lambda a, b: list_reduce(list_transform(range(9), lambda j: case when j = 0 then xor(a, b) "
        "else 0 end), lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)))"
    )

    def hashed(text: str) -> str:
        size = "strlen({0})::varchar || ':' || {0}"
        parts = [f"coalesce({size.format(f'{c}::varchar')}, '-')" for c in FIELDS[:-1]] + [f"coalesce({size.format(text)}, '-')"]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, start: str) -> str:
        """Nodes (level, grp, pos, n, digest) over a start, with both sides of each."""
        return f"""
{name} as (
  {start}
  union all
  select level + 1, grp, pos // {ARITY}, (any_value(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' order by pos))
  from {name} where n > 1 and level < {levels} group by level, grp, pos // {ARITY}
), {name}_sides as (
  select a.level, a.grp, a.pos,
         coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as lefts,
         coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as rights
  from {name} a join {name} b on a.level = b.level and a.grp is not distinct from b.grp and a.pos // {ARITY} = b.pos // {ARITY}
  where a.n > 1 group by a.level, a.grp, a.pos
)"""

    return f"""
with recursive ids as (
  select *, coalesce(doc_id::varchar, '') as id from documents
), leaves as (
  select doc_id, lang, {hashed("text")} as leaf,
         {hashed(f"case when {crc} % 3 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end")} as other
  from ids
), placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as spot, count(*) over (partition by lang) as n
  from leaves
), {tree("nodes", "select 0 as level, lang as grp, spot as pos, n, leaf as digest from placed")},
subroots as (select grp as lang, digest as subroot from nodes where n = 1),
tops as (
  select 0 as level, true as grp, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n, subroot as digest, lang
  from subroots
), {tree("crown", "select level, grp, pos, n, digest from tops")},
roots as (select digest as root from crown where n = 1),
proofs as (
  select p.doc_id, p.spot, p.lang, string_agg(s.lefts || s.rights, '' order by s.level) as own
  from placed p join nodes_sides s on s.grp is not distinct from p.lang and s.pos = p.spot // ({ARITY} ** s.level)::bigint
  group by all
), upper_proofs as (
  select t.lang, string_agg(s.lefts || s.rights, '' order by s.level) as own
  from tops t join crown_sides s on s.pos = t.pos // ({ARITY} ** s.level)::bigint group by t.lang
), folds as (
  select lang, spot, 0 as level, other as digest from placed
  union all
  select f.lang, f.spot, f.level + 1, sha256(s.lefts || f.digest || s.rights)
  from folds f join nodes_sides s on s.grp is not distinct from f.lang and s.level = f.level and s.pos = f.spot // ({ARITY} ** f.level)::bigint
), top_folds as (
  select f.lang, f.spot, t.pos, 0 as level, f.digest
  from (select lang, spot, arg_max(digest, level) as digest from folds group by lang, spot) f join tops t on t.lang is not distinct from f.lang
  union all
  select f.lang, f.spot, f.pos, f.level + 1, sha256(s.lefts || f.digest || s.rights)
  from top_folds f join crown_sides s on s.level = f.level and s.pos = f.pos // ({ARITY} ** f.level)::bigint
), folded as (select lang, spot, arg_max(digest, level) as folded_root from top_folds group by lang, spot)
select p.doc_id, p.leaf, s.subroot, r.root, sha256(coalesce(o.own, '') || coalesce(u.own, '')) as proof_sha256,
       f.folded_root, f.folded_root = r.root as verified
from placed p
join subroots s on s.lang is not distinct from p.lang
cross join roots r
join folded f on f.lang is not distinct from p.lang and f.spot = p.spot
left join proofs o on o.lang is not distinct from p.lang and o.spot = p.spot
left join upper_proofs u on u.lang is not distinct from p.lang
"""
