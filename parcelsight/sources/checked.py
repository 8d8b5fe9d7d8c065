"""Typed reading of raw CSV in one pass, with a table of what could not be read.

The files are parsed once, into a staged parquet table: typed columns, and for each record the cells
that hold a text but no value of their type. From it come the typed rows, where
such cells are unknown, and the rejects (file, line, column, text); neither reads the CSV
again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.functions.scalars import parse_timestamp
from parcelsight.operators.quality import QualityError
from parcelsight.sources import records as R
from parcelsight.sources.schemas import MISSING_TEXTS, MULTI_LINE, RAW_TYPES


def known_text(name: str) -> Column:
    """A cell's text, NULL where it stands for no value."""
    return F.when(~F.col(name).isin(MISSING_TEXTS), F.col(name))


def typed(name: str, kind: T.DataType) -> Column:
    """A cell's value; a text that is no value of the type is unknown."""
    known = known_text(name)
    if isinstance(kind, T.TimestampNTZType):
        return parse_timestamp(known).alias(name)
    return (known if isinstance(kind, T.StringType) else known.try_cast(kind)).alias(name)


@dataclass(frozen=True)
class Checked:
    """A raw table as read: its typed rows, and what its files hold besides."""

    rows: DataFrame
    staged: DataFrame

    @property
    def rejects(self) -> DataFrame:
        """file, line (from 1), column and text of each cell that could not be read; a record with
        too few or too many cells is one reject without a column, and its text."""
        bad = self.staged.filter(F.size("_rejects") > 0)
        # One row per byte range at most: broadcast, or the whole table would be dealt out to meet them.
        ranges = F.broadcast(bad.select("_file", "_block").distinct())
        # Lines before a range: sums per range. Lines before a record: only in ranges with rejects.
        counts = self.staged.groupBy("_file", "_block").agg(F.sum("lines").alias("_n"))
        earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
        starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
        before = W.partitionBy("_file", "_block").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
        inside = self.staged.select("_file", "_block", "_place", "lines", "_rejects").join(ranges, ["_file", "_block"], "left_semi")
        inside = inside.withColumn("_line", F.coalesce(F.sum("lines").over(before), F.lit(0))).filter(F.size("_rejects") > 0)
        line = (F.col("_start") + F.col("_line") + 1).alias("line")
        placed = inside.join(starts, ["_file", "_block"]).select(F.col("_file").alias("file"), line, F.inline("_rejects"))
        return placed

    def counts(self) -> DataFrame:
        """(check_name, violations) per column with rejects."""
        name = F.coalesce(F.concat("column", F.lit(" is readable")), F.lit("records are whole"))
        cells = self.staged.select(F.inline("_rejects"))
        return cells.groupBy(name.alias("check_name")).agg(F.count(F.lit(1)).alias("violations"))


def _rejected(names: list[str], kinds: dict[str, T.DataType]) -> Column:
    """The cells of a record that hold a text and no value."""

    def bad(name: str) -> Column:
        unread = known_text(name).isNotNull() & typed(name, kinds[name]).isNull()
        return F.when(unread, F.struct(F.lit(name).alias("column"), F.col(name).alias("text")))

    broken = F.when(F.col("_broken"), F.struct(F.lit(None).cast("string").alias("column"), F.col("text")))
    cells = [bad(n) for n in names if n in kinds]
    found = F.filter(F.array(broken, *cells), lambda cell: cell.isNotNull())
    nothing = F.array().cast("array<struct<column:string,text:string>>")
    return F.when(F.col("_header") | F.col("_blank"), nothing).otherwise(found)


def stage(spark: SparkSession, path: str, table: str, staged: str) -> Checked:
    """Read a raw table from a file or a folder of files into ``staged`` and check its files.

    The names come from the header of one file. Every file must have that header in its
    first range, or reading stops: a file with other columns or another order is not this table.
    A later line that equals the header is a header too, so files may be put together.
    """
    names = R.header(spark, path)
    kinds = {n: k for n, k in RAW_TYPES[table].items() if n in names}
    found = R.lines(spark, path)
    found = (R.quoted_lines if table in MULTI_LINE else R.single_lines)(found)
    parsed = R.cells(found, names)
    columns = [typed(n, kinds.get(n, T.StringType())) for n in names]
    parsed.select(*R.WHERE, "lines", "_header", "_blank", _rejected(names, kinds).alias("_rejects"), *columns).write.mode(
        "overwrite"
    ).parquet(staged)
    written = spark.read.parquet(staged)
    headless = written.groupBy("_file").agg(F.max("_header").alias("_has")).filter("not _has").limit(3).collect()
    if headless:
        raise QualityError(f"{table}: no header {names} in " + ", ".join(r["_file"] for r in headless))
    return Checked(written.filter("not _header and not _blank").select(*names), written)
