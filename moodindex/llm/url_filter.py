"""URL filters by a Bloom filter cascade, in native expressions only.

A rule names a host and a path (``example.org`` ``/en/``) and a verdict,
``allow`` or ``block``.  It fits the urls of its host and of all subdomains
whose path starts with the rule's; of the rules that fit a url the longest
(host and path together) wins; a url that no rule fits gets the default.

A url has one candidate key for each *shape* of the rules (labels of the host,
characters of the path): its last labels and the start of its path.  So a rule
fits exactly if its own key is among the candidates, and what is left to ask
of each candidate is whether it is listed.

The distinct candidates of all urls are the complete universe of keys that can
ever be asked for, so the list is kept as a cascade: level 0 is a Bloom filter
of the listed keys; level 1 one of the keys of the universe that level 0 holds
though they are not listed; level 2 one of the listed keys that level 1 holds,
and so on until a level has no false hit.  A key is listed if the first level
that lacks it is an odd one.  This is exact for every key of the universe, and
the urls are judged where they are scanned, by constants of the plan, without a
join.  One cascade holds the keys to block, one the keys to allow.

Level 0 has a share of false hits of about listed / (universe * sqrt 2), the others
one half, so all levels together take about 1.44 * log2(universe / listed) + 5 bits
a *listed* key, whatever the number of urls.  That size is computed before
anything is built; a list that would take more than ``MAX_BITS`` is looked up by
a salted join instead (same results, tested).

Defined results: a null url, or one without ``://``, has an empty host and path;
no rule fits it.  A key that is listed with both verdicts blocks.  Rules with a null part
or an empty host fit nothing.  Rows are judged one by one, so ties and repeated rows need no
rule; an empty table gives an empty table; an empty list gives every url the
default.  Other columns are carried along; those named like a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import fresh

MAX_BITS = 1 << 25
MAX_LEVELS = 200
SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """A Bloom filter: its bits as 64-bit words in decimal, joined by commas."""
    bits: int
    probes: int
    words: str


def with_address(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lowered) and ``path``."""
    u = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("host", "path")]
    return df.select(*keep, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER).alias("host"),
                     F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def listed_keys(rules: DataFrame) -> DataFrame:
    """``key, verdict, labels, chars`` of the rules, each key once."""
    r = rules.filter("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    return (r.groupBy(F.concat("host", "path").alias("key"), _labels(F.col("host")).alias("labels"),
                      F.length("path").alias("chars"))
            .agg(F.max("verdict").alias("verdict")))  # block before allow


def candidates(shapes: list[tuple[int, int]], host: Column, path: Column) -> Column:
    """The keys of a url under which a rule that fits it could be listed."""
    if not shapes:
        return F.array().cast("array<string>")
    labels, chars = _labels(host), F.length(path)
    return F.filter(F.array(*[
        F.when((labels >= k) & (chars >= n),
               F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, n)))
        for k, n in shapes]), lambda c: c.isNotNull())


# -- the cascade -------------------------------------------------------------

def _cell(key: Column, level: int, probe: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), probe, key), F.lit(bits))


def _probes(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def holds(f: Level, level: int, key: Column) -> Column:
    words = F.split(F.lit(f.words), ",").cast("array<bigint>")

    def bit(i):
        c = _cell(key, level, i, f.bits)
        return F.getbit(F.get(words, F.floor(c / 64).cast("int")), F.pmod(c, F.lit(64)).cast("int")) == 1

    return F.forall(_probes(f.probes), bit)


def contains(cascade: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    out = F.lit(False)
    for n in range(len(cascade) - 1, -1, -1):
        out = holds(cascade[n], n, key) & ~out
    return out


def _size(keys: int, share: float) -> tuple[int, int]:
    """Bits (whole words) and probes for a share of false hits."""
    bits = 64 * max(1, math.ceil(keys * 1.4427 * math.log2(1 / share) / 64))
    return bits, max(1, min(30, round(0.6931 * bits / keys)))


def first_share(listed: int, others: int) -> float:
    return min(0.5, listed / (math.sqrt(2) * max(1, others)))


def cascade_bits(listed: int, others: int) -> int:
    """About the bits of all levels; what decides between cascade and join."""
    if not listed:
        return 0
    return _size(listed, first_share(listed, others))[0] + 8 * listed


def _level(keys: DataFrame, n: int, share: float, level: int) -> Level:
    bits, probes = _size(n, share)
    cells = keys.select(F.explode(F.transform(_probes(probes), lambda i: _cell(F.col("key"), level, i, bits))).alias("c"))
    rows = (cells.groupBy(F.floor(F.col("c") / 64).alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(pmod(c, 64) AS INT)))").alias("v")).collect())  # bits / 64 at most
    words = ["0"] * (bits // 64)
    for r in rows:
        words[r["w"]] = str(r["v"])
    return Level(bits, probes, ",".join(words))


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels for the listed keys of ``universe`` (both: distinct ``key``)."""
    take = universe.join(listed.select("key"), "key", "left_semi").checkpoint()
    rest = universe.join(listed.select("key"), "key", "left_anti")
    n, share, out = take.count(), None, []
    while n:
        if len(out) == MAX_LEVELS:
            raise RuntimeError("two keys share every cell")
        share = 0.5 if out else first_share(n, rest.count())
        level = len(out)
        out.append(_level(take, n, share, level))
        hits = rest.filter(holds(out[level], level, F.col("key"))).checkpoint()
        take, rest, n = hits, take, hits.count()
    return out


# -- the filter --------------------------------------------------------------

def _by_join(d: DataFrame, keys: str, hits: str, listed: DataFrame) -> DataFrame:
    """The way for lists beyond the bound: rows and their listed candidates,
    by a join on key and salt, put together again by row."""
    row, salt, key = fresh(d, "_row"), fresh(d, "_salt"), fresh(d, "_key")
    d = d.withColumn(row, F.monotonically_increasing_id()).checkpoint()
    asked = d.select(row, F.explode(keys).alias(key)).withColumn(salt, F.pmod(F.col(row), F.lit(SALTS)))
    found = asked.join(listed.select(F.col("key").alias(key), "verdict",
                                     F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias(salt)), [key, salt])
    best = found.groupBy(row).agg(F.max(F.struct(F.length(key).alias("n"), F.col(key).alias("key"),
                                                 (F.col("verdict") == "block").alias("block"))).alias(hits))
    return d.join(best, row, "left").drop(row)


def url_filter(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule
    that decides, or null) and ``verdict``.  ``rules``: ``host, path, verdict``."""
    listed = listed_keys(rules).checkpoint()
    shapes = [(r["labels"], r["chars"]) for r in listed.select("labels", "chars").distinct()
              .orderBy("labels", "chars").collect()]  # labels of a host x characters of a path at most
    result = ("rule", "verdict")
    d = with_address(pages, url_col)
    d = d.select(*[F.col(f"`{c}`") for c in d.columns if c.lower() not in result])
    keys, hits = fresh(d, "_keys"), fresh(d, "_hits")
    asked = candidates(shapes, F.col("host"), F.col("path"))
    universe = d.select(F.explode(asked).alias("key")).distinct().checkpoint()
    block, allow = listed.filter("verdict = 'block'"), listed.filter("verdict = 'allow'")
    total = universe.count()
    if cascade_bits(block.count(), total) + cascade_bits(allow.count(), total) <= max_bits:
        blocked, allowed = build_cascade(universe, block), build_cascade(universe, allow)
        tried = F.transform(asked, lambda c: F.struct(
            F.length(c).alias("n"), c.alias("key"), contains(blocked, c).alias("block"), contains(allowed, c).alias("allow")))
        d = d.withColumn(hits, F.array_max(F.filter(tried, lambda t: t["block"] | t["allow"])))
    else:
        d = _by_join(d.withColumn(keys, asked), keys, hits, listed).drop(keys)
    h = F.col(hits)
    return (d.withColumn("rule", h["key"])
            .withColumn("verdict", F.when(h.isNull(), default).when(h["block"], "block").otherwise("allow"))
            .drop(hits))
