"""Publishing several tables at once: written beside the old ones, checked, then switched.

``<out>/versions/<version>/<table>`` holds the tables, ``<out>/manifests/<version>`` one row per table.
A version counts once its manifest is there, and a manifest is one file that appears whole or not at all.
So a run that fails or is lost leaves what was published before, and readers never see
tables of two versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.sources.files import write_parquet

_MANIFEST = "version string, number long, table_name string, rows long"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _manifests(spark: SparkSession, out: str) -> DataFrame:
    files, place = _files(spark, f"{out}/manifests")
    if not files.exists(place):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(f"{out}/manifests/*")


def versions(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(number, version) of all published versions, the latest first."""
    found = _manifests(spark, out).select("number", "version").distinct().collect()
    return sorted(((r["number"], r["version"]) for r in found), reverse=True)


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    out: str,
    check: Callable[[Mapping[str, DataFrame]], None] = lambda written: None,
) -> dict[str, int]:
    """Write the tables as a new version, run ``check`` on what was written, and switch to it.

    Returns the rows per table. If ``check`` raises, the version written before stays the published one.
    """
    number = max([n for n, _ in versions(spark, out)], default=0) + 1
    version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{out}/versions/{version}"
    counts = {name: write_parquet(frame, f"{folder}/{name}") for name, frame in tables.items()}
    check({name: spark.read.parquet(f"{folder}/{name}") for name in tables})
    rows = [(version, number, name, n) for name, n in counts.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(f"{out}/manifests/{version}")
    return counts


def read_published(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the latest published version."""
    found = versions(spark, out)
    if not found:
        raise FileNotFoundError(f"nothing is published in {out}")
    version = found[0][1]
    names = _manifests(spark, out).filter(F.col("version") == version).collect()
    return {r["table_name"]: spark.read.parquet(f"{out}/versions/{version}/{r['table_name']}") for r in names}


def drop_old(spark: SparkSession, out: str, keep: int = 2) -> None:
    """Delete all published versions but the latest ``keep``; first their manifests."""
    for part in ("manifests", "versions"):
        for _, version in versions(spark, out)[keep:] if part == "manifests" else _unlisted(spark, out):
            files, place = _files(spark, f"{out}/{part}/{version}")
            files.delete(place, True)


def _unlisted(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """Versions without a manifest: dropped ones, and those of runs that failed. Not to be called while another run publishes."""
    files, place = _files(spark, f"{out}/versions")
    listed = {version for _, version in versions(spark, out)}
    there = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    return [(0, version) for version in there if version not in listed]
