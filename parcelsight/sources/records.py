"""Records of CSV files, found in parallel inside one file, also where cells hold line breaks.

A file is read as lines, split at any byte range that Spark likes. Whether a line starts inside a
quoted cell follows from the number of quotes before it: an odd number means inside, as an
escaped quote is two. So neighbouring lines of a range are packed to chunks with the number of their
quotes; the sums of the earlier chunks, a small table, give the parity at the start of each
chunk, and the lines of a chunk are put together to records there. Only a record that crosses the
end of a chunk meets its continuation in a second, small step.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BREAK = "\n"
#: Where a record starts: its file, the start of the byte range, and its place among those read.
WHERE = ["_file", "_block", "_place"]
#: Lines of a chunk. A range of 128 MB with lines of 40 bytes has a hundred chunks, which a task gathers without a sort.
CHUNK = 32_768
_CHUNK = ["_file", "_block", "_chunk"]
#: Marks in a chunk's text: the end of a record, and the mark's first character where a file holds it.
_MARK, _END, _KEPT = "\x01", "\x01b", "\x01a"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line as it stands, with the place where it does."""
    text = spark.read.option("lineSep", BREAK).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
        F.col("value").alias("text"),
    )


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line of one file."""
    first = spark.read.option("lineSep", BREAK).text(path).filter("value != ''").first()
    return next(csv.reader([first.value.rstrip("\r")])) if first else []


def _count(text: str | Column, found: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(found), F.lit("")))


def _chunks(found: DataFrame) -> DataFrame:
    """Neighbouring lines of a range as one row: the place of the first, and their text."""
    # A line goes with five digits of its place before it, by which the lines of a chunk sort.
    in_task = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    line = F.concat(F.lpad((in_task % CHUNK).cast("string"), 5, "0"), F.col("text"))
    numbered = found.withColumn("_chunk", F.floor(in_task / CHUNK))
    packed = numbered.groupBy(*_CHUNK).agg(F.sort_array(F.collect_list(line)).alias("_lines"), F.min("_place").alias("_place"))
    text = F.array_join(F.transform("_lines", lambda line: F.substr(line, F.lit(6))), BREAK)
    return packed.filter("_place >= 0").select(*_CHUNK, "_place", text.alias("text"))


def _pieces(chunks: DataFrame) -> DataFrame:
    """A chunk's text cut at the line breaks outside of quotes. ``_starts``: whether a record starts
    with the piece; ``_whole``: whether it also ends with it, so that no other chunk shares it."""
    parts = F.split(F.replace(F.col("text"), F.lit(_MARK), F.lit(_KEPT)), '"')
    outside = (F.col("_before") % 2).cast("int")
    marked = F.transform(
        parts, lambda part, i: F.when((i + outside) % 2 == 0, F.replace(part, F.lit(BREAK), F.lit(_END))).otherwise(part)
    )
    cut = chunks.withColumn("_open", (F.col("_before") + _count("text", '"')) % 2 == 1).withColumn(
        "_cut", F.split(F.array_join(marked, '"'), _END)
    )
    exploded = cut.select("_file", "_block", "_place", "_before", "_open", F.size("_cut").alias("_n"), F.posexplode("_cut").alias("_i", "_piece"))
    starts = (F.col("_i") > 0) | (F.col("_before") % 2 == 0)
    text = F.replace(F.col("_piece"), F.lit(_KEPT), F.lit(_MARK))
    return exploded.select(
        "_file",
        "_block",
        (F.col("_place") + F.col("_i")).alias("_place"),
        text.alias("text"),
        (_count("_piece", BREAK) + 1).cast("long").alias("lines"),
        starts.alias("_starts"),
        (starts & ~((F.col("_i") == F.col("_n") - 1) & F.col("_open"))).alias("_whole"),
    )


def _same(names: list[str], right: DataFrame) -> tuple[DataFrame, Column]:
    """NULL-safe, so that no filter goes below the exchange that both sides read."""
    renamed = right.withColumnsRenamed({n: f"{n}_r" for n in names})
    return renamed, reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{n}_r")) for n in names])


def single_lines(found: DataFrame) -> DataFrame:
    """Every line as a record: nothing is exchanged. ``lines`` is how many lines it has."""
    return found.select(*WHERE, F.regexp_replace("text", "\r$", "").alias("text"), F.lit(1).cast("long").alias("lines"))


def quoted_lines(found: DataFrame) -> DataFrame:
    """Lines put together to records by quote parity.

    The lines are exchanged once, gathered to chunks on their way into the exchange, and no later
    step sorts or buffers lines. A file
    with CRLF line ends has them inside cells as plain line breaks.
    """
    chunks = _chunks(found)
    earlier = W.partitionBy("_file").orderBy("_block", "_chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = chunks.select(*_CHUNK, _count("text", '"').cast("long").alias("_quotes")).select(
        *_CHUNK, F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)).alias("_before")
    )
    sums, same = _same(_CHUNK, sums)
    pieces = _pieces(chunks.join(sums, same).select(*WHERE, "text", "_before"))
    closed = pieces.filter("_whole").select(*WHERE, "text", "lines")
    in_file = W.partitionBy("_file").orderBy("_block", "_place")
    chain = F.count_if("_starts").over(in_file.rowsBetween(W.unboundedPreceding, W.currentRow))
    ends = F.sort_array(F.collect_list(F.struct("_block", "_place", "text")))
    joined = (
        pieces.filter("not _whole")
        .withColumn("_chain", chain)
        .groupBy("_file", "_chain")
        .agg(ends.alias("_ends"), F.sum("lines").alias("lines"))
        .select(
            "_file",
            F.col("_ends")[0]["_block"].alias("_block"),
            F.col("_ends")[0]["_place"].alias("_place"),
            F.array_join(F.transform("_ends", lambda p: p["text"]), BREAK).alias("text"),
            "lines",
        )
    )
    records = closed.unionByName(joined)
    text = F.col("text")
    plain = F.replace(F.regexp_replace(text, "\r$", ""), F.lit("\r\n"), F.lit(BREAK))
    return records.withColumn("text", F.when(text.endswith("\r"), plain).otherwise(text))


def cells(records: DataFrame, names: list[str]) -> DataFrame:
    """The records' cells as text columns, and ``_header``, ``_broken``: whether a record is a
    header line, and whether it has another number of cells than the header. ``_blank`` marks
    lines without a cell."""
    kinds = ", ".join(f"`{n}` string" for n in names)
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    parsed = F.from_csv("text", f"{kinds}, _corrupt string", options)
    rows = records.withColumn("_cells", parsed)
    is_header = reduce(Column.__and__, [F.col("_cells")[n].eqNullSafe(F.lit(n)) for n in names])
    return rows.select(
        *WHERE,
        "lines",
        "text",
        F.coalesce(is_header, F.lit(False)).alias("_header"),
        (F.trim("text") == "").alias("_blank"),
        F.coalesce(F.col("_cells")["_corrupt"].isNotNull(), F.lit(False)).alias("_broken"),
        *[F.col("_cells")[n].alias(n) for n in names],
    )
