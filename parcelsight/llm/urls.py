"""URL filters by hash prefixes of host-suffix and path-prefix expressions.

A rule names a host and a path and fits that host, its subdomains, and every path that
starts with the rule's. So a url fits a rule exactly if the rule is among the url's
expressions: each suffix of its host at a dot, with each prefix of its path. Only
path lengths that rules have need to be expanded. Expressions meet rules by an equi-join on the
first PREFIX hex digits of their digests, then the full digests are compared, and the
longest rule wins (of equally long ones that with the longer host). Each distinct url is
expanded once. Rules are a table of any size; Spark broadcasts it if it is known to be small.

The host is what stands after the first `://` up to `/`, `?`, `#` or the end, with A-Z in
lower case; the path goes on up to `?`, `#` or the end. A null url, or one without `://`, has
an empty host and path and no rule. Repeated rules count once; rules with a null part
or another verdict than allow or block are refused by `rules_of`. Rows are kept as they
are, with all other columns. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_of(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table (host, path, verdict) from a list."""
    for host, path, verdict in rules:
        if host is None or path is None or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {(host, path, verdict)}")
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _expression(host: Column, path: Column) -> Column:
    """Host and path apart, as a host holds no line feed of its own here."""
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX)


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """url, digest of each expression of a url (host, path), for paths of the given lengths."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.col("path").substr(F.lit(1), n))
    return (
        urls.select("url", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("url", "suffix", F.explode("prefixes").alias("prefix"))
        .select("url", _expression(F.col("suffix"), F.col("prefix")).alias("digest"))
    )


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, rule and verdict for each distinct url (url, host, path) that some rule fits."""
    rules = rules.groupBy("host", "path").agg(F.min(F.struct((F.col("verdict") != "block").alias("o"), "verdict")).verdict.alias("verdict"))
    listed = rules.select("host", "path", "verdict", _expression(F.col("host"), F.col("path")).alias("full"))
    listed = listed.withColumn("short", _prefix(F.col("full")))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    if not lengths:
        lengths = [0]
    made = expressions(urls, lengths).withColumn("short", _prefix(F.col("digest")))
    hits = made.join(listed, "short").where(F.col("digest") == F.col("full"))
    rank = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict")
    best = hits.groupBy("url").agg(F.max(rank).alias("best"))
    return best.select("url", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """All columns of pages with host, path, rule (or null) and verdict of each url. Columns that
    have one of these names already, in any case of letters, are refused."""
    clash = {"host", "path", "rule", "verdict"} & {c.lower() for c in pages.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; rename them")
    url = F.col("url")
    urls = pages.where(F.instr(url, "://") > 0).select("url").distinct()
    found = fitting_rules(urls.select("url", host_of(url).alias("host"), path_of(url).alias("path")), rules)
    return (
        pages.join(found, "url", "left")
        .withColumn("host", host_of(url))
        .withColumn("path", path_of(url))
        .withColumn("verdict", F.coalesce("verdict", F.lit(otherwise)))
    )
