"""URL rules against trying each of them."""

import random

import duckdb
import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from parcelsight.llm import urls
from parcelsight.llm.queries import URL_RULES

SF = "/root/testdata/sf0.001"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    tail = rest[n:]
    return host, tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]


def plain(url, rules):
    host, path = split(url)
    fits = [r for r in rules if ("." + host).endswith("." + r[0]) and path.startswith(r[1])] if url and "://" in url else []
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


ODD = [
    None, "", "no scheme", "http://", "http://NET", "http://net/", "http://a.net/x?q#f", "HTTPS://WWW.Example.NET/en/a",
    "http://example.net/en", "http://example.net?/en/", "ftp://x.org/fr/1", "http://org/fr/", "http://notorg/fr/",
    "x://a.example.com/de/", "http://éxample.com/de/\nz", "http://a..net/", "http://.net/", "http://net./", "a://b://c.net/",
    "http://example.net:80/en/", "http://example.com/de/" + "x" * 20_000, "\n://a.net/", "http://a.net/\nb",
]


def judged(spark, found, rules):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(found)], "page_id long, url string, html string")
    rows = urls.judged(pages, urls.rules_of(spark, rules)).orderBy("page_id").collect()
    assert len(rows) == len(found)
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


def test_the_rules_of_the_contract(spark):
    assert judged(spark, ODD + ODD, URL_RULES) == [plain(u, URL_RULES) for u in ODD + ODD]


def test_many_random_rules(spark):
    rng = random.Random(3)
    labels, parts = ["a", "b", "c", "com"], ["/", "/x", "/x/", "/xy", "/y/z", ""]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    rules = list({(host(), rng.choice(parts)): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(*k, v) for k, v in rules]
    found = [f"http://{host()}{rng.choice(parts)}{rng.choice(['', 'x', 'y/z?q'])}" for _ in range(300)]
    assert judged(spark, found, rules) == [plain(u, rules) for u in found]


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.net/"], []) == [("a.net", "/", None, "allow")]
    assert judged(spark, [], URL_RULES) == []


def test_repeated_and_wrong_rules(spark):
    assert judged(spark, ["http://a.net/"], [("net", "/", "block")] * 2 + [("net", "/", "allow")])[0][3] == "block"
    with pytest.raises(ValueError):
        urls.rules_of(spark, [("net", "/", "maybe")])
    with pytest.raises(ValueError):
        pages = spark.createDataFrame([(1, "u", "r")], "page_id long, url string, rule string")
        urls.judged(pages, urls.rules_of(spark, URL_RULES))


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_queries_equal_their_sql(spark, name):
    con: duckdb.DuckDBPyConnection = connect(SF)
    assert compare(spark, con, SF, name) is None
