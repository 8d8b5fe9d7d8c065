"""Secret scans with corpus-wide ownership.

Candidates are found in every text by three patterns; a candidate is known by the hash of its
value. Per value the distinct repositories and owners that hold it are counted over the
whole corpus. A value that looks like a credential (enough distinct signs) and is held by
few owners in few repositories is live-looking: a span of kind `live` is added over it. A value that many
owners, or many repositories even of one owner, hold is a copied example and gets a span of kind `example`. What does not look like a
credential gets no span beside its base ones.

Spans are kind:start:end in code points, end exclusive, ordered by start, then kind.
Base spans are whole matches, leftmost and not overlapping per kind, matches that are too
short left out.

Texts cross to Python once; there, plain substring searches decide which patterns run.
Counting shuffles only values that were found, pre-aggregated to one record per value,
owner and repository, so a value in a third of all documents costs no more than its owners.

Null text is empty. Null owners and repositories count as one unnamed one. Repeated rows
get equal answers and count once. Empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelsight.llm.common import stored, text_of

# Fixed values of the contract: patterns, least sizes, order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ["assign", "access", "hex", "live", "example"]

#: A value that this many owners or this many repositories hold, or more, is a copied example.
OWNERS, REPOSITORIES = 3, 8
#: Distinct signs that a credential has at least.
SIGNS = 6
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_HEX_SIGNS = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def candidates(text: str) -> list[tuple[str, int, int, int, int]]:
    """kind, start and end of each base match, start and end of its value."""
    found = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append(("access", m.start(), m.end(), m.start(), m.end()))
    if b"x" * HEX_LEAST in text.encode().translate(_HEX_SIGNS):
        for m in HEX.finditer(text):
            found.append(("hex", m.start(), m.end(), m.start(), m.end()))
    return sorted(found, key=lambda c: (c[1], KINDS.index(c[0])))


def looks_live(value: str) -> bool:
    """Enough different signs, digits and letters both."""
    return len(set(value)) >= SIGNS and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_FOUND = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, text_digest binary, "
    "found array<struct<kind: string, start: int, end: int, from: int, to: int, value: binary, live: boolean>>"
)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, owner, repository, counts, digests and candidates of each row (doc_id, owner,
    repository, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "text_digest", "found")}
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                found = candidates(text)
                for kind in ("assign", "access", "hex"):
                    rows[f"n_{kind}"].append(sum(c[0] == kind for c in found))
                rows["base_sha256"].append(hashlib.sha256(written([c[:3] for c in found]).encode()).hexdigest())
                rows["text_digest"].append(hashlib.blake2b(text.encode(), digest_size=16).digest() if found else b"")
                rows["found"].append([_record(text, *c) for c in found])
            kept = [batch.column(c) for c in ("doc_id", "owner", "repository")]
            value = pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("from", pa.int32()), ("to", pa.int32()), ("value", pa.binary()), ("live", pa.bool_())]
            )
            made = [pa.array(rows[f"n_{k}"], pa.int64()) for k in ("assign", "access", "hex")]
            made += [pa.array(rows["base_sha256"], pa.string()), pa.array(rows["text_digest"], pa.binary()), pa.array(rows["found"], pa.list_(value))]
            yield pa.RecordBatch.from_arrays([*kept, *made], ["doc_id", "owner", "repository", *rows])

    given = docs.select("doc_id", "owner", "repository", "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:3])
    return given.mapInArrow(run, f"{kinds}, {_FOUND}")


def _record(text: str, kind: str, start: int, end: int, value_from: int, value_to: int) -> dict:
    value = text[value_from:value_to]
    digest = hashlib.blake2b(value.encode(), digest_size=16).digest()
    return {"kind": kind, "start": start, "end": end, "from": value_from, "to": value_to, "value": digest, "live": looks_live(value)}


def ownership(found: DataFrame) -> DataFrame:
    """value, owners and repositories: how many distinct ones hold each value."""
    held = found.select("owner", "repository", F.explode("found.value").alias("value")).distinct()
    per_owner = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return per_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def scan(docs: DataFrame, owner: Column, repository: Column, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, n_live, n_example
    and all spans in order (array of kind, start, end).

    repository must name its owner too where two owners can have one of the same name."""
    given = docs.select(
        "doc_id",
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        text_of().alias("text"),
    )
    rows = stored(scanned(given), "secret-candidates")
    holding = rows.where(F.size("found") > 0)
    held = ownership(holding)
    each = holding.select("doc_id", "text_digest", F.explode("found").alias("c"))
    each = each.select("doc_id", "text_digest", "c.from", "c.to", "c.value", "c.live").distinct()
    copied = (F.col("owners") >= owners) | (F.col("repositories") >= repositories)
    judged = each.join(held, "value").where(F.col("live") | copied)
    kind = F.when(copied, F.lit("example")).otherwise(F.lit("live"))
    spans = F.struct(F.col("from").alias("start"), kind.alias("kind"), F.col("to").alias("end"))
    added = judged.groupBy("doc_id", "text_digest").agg(F.collect_set(spans).alias("added"))
    added = added.select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest"), "added")
    joined = holding.join(added, F.expr("doc_id <=> _id and text_digest = _digest"), "left")
    none = rows.where(F.size("found") == 0).withColumn("added", F.lit(None).cast(added.schema["added"].dataType))
    every = joined.select(*rows.columns, "added").unionByName(none)
    return every.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        _number("live").alias("n_live"),
        _number("example").alias("n_example"),
        _all_spans().alias("spans"),
    )


def _number(kind: str) -> Column:
    return F.coalesce(F.size(F.filter("added", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")


def _all_spans() -> Column:
    """Base and added spans by start, then kind as listed."""
    ranks = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def record(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.element_at(ranks, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")
        )

    base = F.transform("found", record)
    added = F.transform(F.coalesce("added", F.array().cast("array<struct<start:int,kind:string,end:int>>")), record)
    ordered = F.array_sort(F.concat(base, added))
    return F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def joined(spans: str = "spans") -> Column:
    """Spans as kind:start:end, joined by commas."""
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")
