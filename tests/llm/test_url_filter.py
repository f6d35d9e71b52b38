import random

import pytest
from pyspark.sql import functions as F

from moodindex.llm import queries, sql, url_filter as U

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("b.com", "", "block"), ("Mixed.net", "/A", "block")]


def plain(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = {}
    for h, p, v in rules:
        if not h or p is None or v is None:
            continue
        h = h.lower()
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits[h + p] = max(v, fits.get(h + p, ""))
    best = max(fits, key=lambda k: (len(k), k), default=None)
    return host, path, best, fits.get(best, default)


def urls():
    rng = random.Random(5)
    hosts = ["org", "example.org", "a.example.org", "example.organic", "xexample.org", "com", "b.com", "q.b.com",
             "B.COM", "É.com", "mixed.net", "MIXED.NET", "", "a..org", "org.", "x.org:80", "me@x.org"]
    paths = ["", "/", "/es", "/es/", "/en/1", "/en/12/3", "/fr/", "/de/x", "/A", "/a", "//es/", "/es/?q=/en/1", "/#://org/"]
    out = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths]
    out += [None, "", "org/", "http:/org/", "a://b://org/", "x\n://exa\nmple.org/es/", "http://org?x=/de/",
            "http://" + "a." * 30_000 + "example.org/es/" + "z" * 100_000]
    return out + out[:40]


def frame(spark, rules=RULES):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


@pytest.mark.parametrize("bits", [U.MAX_BITS, 0])
def test_against_plain_rules(spark, bits):
    us = urls()
    rules = RULES + [("b.com", "", "allow"), ("", "/", "block"), (None, "/", "block"), ("com", None, "block"), ("org", "/zz", None)]
    pages = spark.createDataFrame([(k, u, "r", "v") for k, u in enumerate(us)], "page_id long, url string, rule string, _hits string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           U.url_filter(pages, frame(spark, rules), max_bits=bits).collect()}
    assert got == {k: plain(u, rules) for k, u in enumerate(us)}


def test_cascade_is_exact_with_several_levels(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter("pmod(xxhash64(key), 10) < 3")
    cascade = U.build_cascade(universe, listed)
    assert len(cascade) > 4
    bits = sum(x.bits for x in cascade)
    n = listed.count()
    assert bits <= 1.2 * U.cascade_bits(n, 20_000 - n)
    wrong = universe.filter(U.contains(cascade, F.col("key")) != (F.pmod(F.xxhash64("key"), F.lit(10)) < 3))
    assert wrong.count() == 0


def test_size_follows_the_list_not_the_urls(spark):
    sizes = []
    for rows in (2_000, 200_000):
        universe = spark.range(rows).select(F.concat(F.lit("k"), "id").alias("key"))
        cascade = U.build_cascade(universe, universe.filter("key IN ('k1', 'k7', 'k30', 'k99', 'k100')"))
        sizes.append(sum(x.bits for x in cascade))
    assert sizes[1] <= 2 * sizes[0] <= 4096


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.url_filter(pages, frame(spark)).collect() == []
    one = spark.createDataFrame([(1, "http://org/")], "page_id long, url string")
    for rules in ([], [("net", "/", "block")]):
        got = U.url_filter(one, frame(spark, rules), default="block").first()
        assert (got.rule, got.verdict) == (None, "block")


def test_native(spark):
    plan = queries.QUERIES["op13_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_query_against_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.execute(sql.ORACLE["op13_url_filter"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op13_url_filter"](spark, sf).collect()]
    assert sorted(got) == sorted(want)
    assert {r[4] for r in got} == {"allow", "block"}
