"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Needed for right results: zone-less timestamps must never meet a zone with gaps.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Needed for scale. A key holding a third of a join's rows is split by the
# skew-join rule; the force flag lets it split even where that costs one more
# exchange. Whether a side is broadcast is decided from its measured size.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


MB = 1024 * 1024


def sized_for(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for a job whose widest exchange moves about so many bytes.

    Partitions of some 400 MB sort in an executor's memory; at least three per core
    keep the cluster busy, and adaptive execution merges those that turn out small.
    Past a hundred thousand partitions the driver's bookkeeping (map tasks times
    partitions) costs more than the spilling of larger ones.
    """
    partitions = min(100_000, max(3 * cores, -(-shuffled_bytes // (400 * MB))))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(512 * MB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def tune(spark: SparkSession, extra: Mapping[str, str] | None = None) -> SparkSession:
    """Apply the run-time settings to a session and hand it back."""
    for key, value in {**REQUIRED, **ADAPTIVE, **(extra or {})}.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int = 8,
    partitions: int | None = None,
    memory: str = "8g",
    options: Mapping[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests, the bench and trial runs."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelsight")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**REQUIRED, **ADAPTIVE, **(options or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
