"""Lempel-Ziv phrase fingerprints.

A text is parsed from left to right: each phrase is the shortest piece that was no phrase
before (the last one may be known). Texts with much in common share many phrases, as compressors
find. The fingerprint is the MinHash signature of the phrase set: SIZE least values under
SIZE hash functions, as hex. The share of equal values estimates the Jaccard
similarity of two phrase sets.

All phrases that begin a text stay the same when its end is changed, so an edited text is
parsed from where it departs from the first.

The phrase dictionary holds every prefix of its phrases, so the longest known piece at a
place is found by probing lengths up or down from the last one's. Phrases are hashed
all at once from running sums over the text.

Null text is empty; the fingerprint of an empty text is the empty string, whose likeness is
1 to another empty one and 0 to any other. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from parcelsight.llm.common import sliced, stored, text_of
from parcelsight.llm.shingles import _powers_to, mix

SIZE = 64
_rng = np.random.default_rng(20240229)
_TIMES = (_rng.integers(0, 1 << 31, SIZE, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_PLUS = _rng.integers(0, 1 << 32, SIZE, np.uint32)[:, None]


def parse(text: str, known: set[str], at: int = 0) -> list[int]:
    """Where each phrase from `at` on ends; `known` holds the phrases before and gets the new."""
    ends, size, guess = [], len(text), 4
    add, note = known.add, ends.append
    while at < size:
        end = at + guess
        if end < size and text[at:end] in known:
            end += 1
            while end < size and text[at:end] in known:
                end += 1
        else:
            end = min(end, size) - 1
            while end > at and text[at:end] not in known:
                end -= 1
            end += 1
        add(text[at:end])
        note(end)
        guess = end - at
        at = end
    return ends


def least_values(text: str, at: int, ends: list[int]) -> np.ndarray:
    """Least value of the phrases from `at` on under each hash function."""
    least = np.full(SIZE, np.iinfo(np.uint32).max, np.uint32)
    if not ends:
        return least
    codes = np.frombuffer(text[at:].encode("utf-32-le", "surrogatepass"), np.uint32)
    power, inverse = _powers_to(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    stop = np.array(ends, np.int64) - at
    start = np.append(0, stop[:-1])
    numbers = (mix((sums[stop] - sums[start]) * inverse[start]) >> np.uint64(32)).astype(np.uint32)
    for first in range(0, len(numbers), 1024):
        values = _TIMES * numbers[first : first + 1024]
        values += _PLUS
        np.minimum(least, values.min(1), out=least)
    return least


class Printed:
    """A text with its fingerprint, and what its edited text shares with it."""

    def __init__(self, text: str):
        self.text = text
        ends = parse(text, set())
        n = int(np.searchsorted(ends, len(text) - len(text) // 3, side="right"))
        self.ends, self.at = ends[:n], ends[n - 1] if n else 0
        self.shared = least_values(text, 0, self.ends)
        self.print = _bytes(text, np.minimum(self.shared, least_values(text, self.at, ends[n:])))

    def edited(self, following: str) -> tuple[str, bytes]:
        """The edited text and its fingerprint. The phrases in the part that stays are the same;
        one that ends the text early was known before, so it is no phrase of its own there."""
        text = edited(self.text, following)
        starts = [0, *self.ends[:-1]]
        known = {self.text[i:j] for i, j in zip(starts, self.ends)}
        more = parse(text, known, self.at)
        return text, _bytes(text, np.minimum(self.shared, least_values(text, self.at, more)))


def fingerprint(text: str) -> str:
    return Printed(text).print.hex()


def _bytes(text: str, least: np.ndarray) -> bytes:
    return least.astype(">u4").tobytes() if text else b""


def likeness(left: bytes, right: bytes) -> float:
    """Share of equal values of two fingerprints (as bytes)."""
    if not left or not right:
        return float(left == right)
    return float((np.frombuffer(left, ">u4") == np.frombuffer(right, ">u4")).mean())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


# On a table: every text with the next one by descending id

_ROW = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _result(own: Printed, following: Printed) -> dict:
    text, changed = own.edited(following.text)
    return {
        "n_chars": len(own.text),
        "edited_sha256": hashlib.sha256(text.encode()).digest(),
        "fingerprint": own.print,
        "edited_fingerprint": changed,
        "near_edited": likeness(own.print, changed),
        "near_next": likeness(own.print, following.print),
    }


def with_next(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next, where the next document is that with the
    next smaller id (after the last: the first).

    Rows are dealt by ranges of descending ids and sorted there; rows of one id are ordered by
    a hash of their text, and a null id comes last. A task goes through its rows with one row in hand, and
    hands its first text on, with its last one open. These ends, one pair per task, meet in a
    second, small step. A single document is its own next one.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    given = docs.select("doc_id", text_of().alias("text"))
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in sliced(batches):
            id_type, rows = batch.schema.field("doc_id").type, []
            for doc_id, text, task in zip(*(batch.column(c) for c in ("doc_id", "text", "task"))):
                own = Printed(text.as_py())
                if held is None:
                    rows.append({"task": task.as_py(), "first_text": own.text})
                else:
                    rows.append({"doc_id": held[0]} | _result(held[1], own))
                held = (doc_id.as_py(), own, task.as_py())
            yield _batch(rows, id_type)
        if held is not None:
            yield _batch([{"doc_id": held[0], "task": held[2], "last_text": held[1].text}], id_type)

    made = dealt.mapInArrow(run, f"doc_id {kind}, task int, first_text string, last_text string, {_ROW}")
    made = stored(made, "phrase-rows")
    inside = made.where("task is null").drop("task", "first_text", "last_text")
    firsts = made.where("first_text is not null").select("task", F.col("first_text").alias("following"))
    numbers = firsts.select("task")
    around = numbers.select(
        F.col("task").alias("last_task"),
        F.coalesce(F.lead("task").over(Window.orderBy("task")), F.min("task").over(Window.partitionBy())).alias("task"),
    )
    lasts = made.where("last_text is not null").select("doc_id", "last_text", F.col("task").alias("last_task"))
    open_rows = lasts.join(around, "last_task").join(firsts, "task").select("doc_id", "last_text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"doc_id": r["doc_id"]} | _result(Printed(r["last_text"]), Printed(r["following"]))
                for r in batch.to_pylist()
            ]
            yield _batch(rows, batch.schema.field("doc_id").type, ends=False)

    closed = open_rows.mapInArrow(close, f"doc_id {kind}, {_ROW}")
    digests = {n: F.lower(F.hex(n)) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return inside.unionByName(closed).withColumns(digests)


_TYPES = {"n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64(), "task": pa.int32()}
_TYPES |= {n: pa.binary() for n in ("edited_sha256", "fingerprint", "edited_fingerprint")}
_NAMES = [part.split()[0] for part in _ROW.split(", ")]


def _batch(rows: list[dict], id_type: pa.DataType, ends: bool = True) -> pa.RecordBatch:
    names = ["doc_id", *(["task", "first_text", "last_text"] if ends else []), *_NAMES]
    columns = [pa.array([r.get(n) for r in rows], id_type if n == "doc_id" else _TYPES.get(n, pa.string())) for n in names]
    return pa.RecordBatch.from_arrays(columns, names)
