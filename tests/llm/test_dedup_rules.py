import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from moodindex.llm import exact_dedup, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


ROWS = [(5, "a b"), (3, "a \t\n b"), (4, "a  b "), (7, None), (6, ""), (8, "  "), (9, " "), (10, "é x"), (10, "é x"),
        (None, "z"), (None, "z"), (11, "z"), (12, "q w"), (13, "q w"), (14, "long text " * 20_000)]


def test_decisions(make_docs):
    d = make_docs(ROWS).withColumn("hash", F.lit(1)).repartition(4)
    got = exact_dedup.exact_dedup(d).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(norm(t), []).append(i)
    assert len(got) == len(ROWS)
    want = Counter()
    for t, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        want.update((i, least, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.text_sha256).hex()) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_hot_group_and_plain_rows(spark):
    d = spark.range(20_000).select(F.col("id").alias("doc_id"),
                                   F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t ', id div 2) END").alias("text"))
    got = exact_dedup.exact_dedup(d).toPandas()
    want = d.toPandas().groupby("text").doc_id.agg(["min", "size"])
    m = got.merge(d.toPandas()).merge(want, left_on="text", right_index=True)
    assert (m.keep_id == m["min"]).all() and (m.group_size == m["size"]).all() and len(m) == 20_000


def test_stage_keeps_columns(make_docs):
    d = make_docs(ROWS).withColumn("_hash", F.lit("h")).withColumn("_maybe", F.lit("m"))
    got = exact_dedup.drop_copies(d)
    assert got.columns == d.columns
    rows = got.collect()
    assert len(rows) == len({norm(t) for _, t in ROWS})
    assert {r.doc_id for r in rows} == {3, 6, 8, 4, 10, 11, 12, 13, 14}
    assert exact_dedup.drop_copies(make_docs([])).count() == 0
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0


def test_full_filter_gives_the_same(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 8)
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 8)
    assert exact_dedup.drop_copies(make_docs(ROWS)).count() == len({norm(t) for _, t in ROWS})


def test_hash_ranges_give_the_same_and_keep_the_filter_sparse(spark, make_docs):
    d = make_docs(ROWS)
    assert exact_dedup.ranges_of(33_000_000) == 1 and exact_dedup.ranges_of(1_000_000_000) == 33
    whole = exact_dedup.exact_dedup(d).toPandas().sort_values(["text_sha256", "doc_id", "kept"], ignore_index=True)
    cut = exact_dedup.exact_dedup(d, max_bits=64).toPandas().sort_values(["text_sha256", "doc_id", "kept"], ignore_index=True)
    assert whole.equals(cut)
    assert sorted(map(str, exact_dedup.drop_copies(d, max_bits=64).collect())) == sorted(map(str, exact_dedup.drop_copies(d).collect()))
    # 4,000 single rows and 50 copies, 1,024 bits a range: without ranges every cell would be set twice
    many = spark.range(4_050).select(F.sha2(F.least("id", F.lit(4_000)).cast("string"), 256).alias("x"))
    h = many.select(F.unhex("x").alias("h")).checkpoint()
    flagged = exact_dedup.flag_repeated(h, h, "h", "maybe", 4_050, 1 << 10)
    assert flagged.count() == 4_050
    copies = flagged.groupBy("h").agg(F.count("*").alias("n"), F.max("maybe").alias("m")).collect()
    assert len(copies) == 4_001 and all(r.m for r in copies if r.n > 1)
    assert sum(r.m for r in copies) < 400
    one = exact_dedup.with_maybe(h, "h", "maybe", exact_dedup.repeated_cells(h, "h", 1 << 10))
    assert one.filter("maybe").count() > 3_900


def measures(t):
    t = t or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t", "a", "one two three four five six seven eight nine ten", "a b c d e a b c d e f",
         "x " * 30, "l1\nl1\n \n\nl1 \nl2", "# * $ | < > é😀   a", "\x0ba\x0cb\x1cc", "the same line here now\n" * 6,
         "a a a a a a", "word " * 9 + "word", " ".join(f"w{i % 7}" for i in range(60)), " ".join(f"v{i}" for i in range(20_000))]


def test_measures_equal_brute_force(spark, make_docs):
    d = make_docs(list(enumerate(TEXTS))).withColumn("WORDS_", F.lit(1)).withColumn("n_words", F.lit(-1))
    got = {r.doc_id: r for r in quality_rules.quality_rules(d).collect()}
    for i, t in enumerate(TEXTS):
        r, m = got[i], measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m, repr(t)[:50]
        assert r.base_failed == (m[0] < 10 or 100 * m[4] > 20 * m[0])
        assert not (r.base_failed and r.kept)
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in quality_rules.with_measures(real).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(r.text_)


def test_order_changes_no_verdict(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = quality_rules.with_measures(d)
    order = [{"rule": r} for r in quality_rules.RULES]
    a = m.withColumn("k", quality_rules.verdict(order)).select("doc_id", "k").collect()
    b = m.withColumn("k", quality_rules.verdict(order[::-1])).select("doc_id", "k").collect()
    assert sorted(a) == sorted(b) and {r.k for r in a} == {True, False}


def test_cascade_order(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = quality_rules.plan_cascade(d)
    gain = [p["rejected"] / p["cost"] for p in plan]
    assert gain == sorted(gain, reverse=True) and {p["rule"] for p in plan} == set(quality_rules.RULES)


def test_rules_stage_is_native_and_keeps_columns(spark, make_docs):
    d = make_docs([(1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, "!!! " * 20)]
                  ).withColumn("_row", F.lit(1))
    got = quality_rules.keep_good(d)
    assert got.columns == d.columns and [r.doc_id for r in got.collect()] == [1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality_rules.keep_good(make_docs([])).count() == 0
    assert quality_rules.quality_rules(make_docs([])).count() == 0


def test_stage_keeps_what_the_query_keeps(spark, make_docs):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for d in (real, make_docs(list(enumerate(TEXTS)))):
        want = {r.doc_id for r in quality_rules.quality_rules(d).filter("kept").collect()}
        assert {r.doc_id for r in quality_rules.keep_good(d).collect()} == want
    for r in real.filter("text IS NOT NULL").collect():
        m = measures(r.text)
        if m[0] < 10 or 100 * m[4] > 20 * m[0]:
            assert r.doc_id not in {x.doc_id for x in quality_rules.keep_good(real.filter(F.col("doc_id") == r.doc_id)).collect()}
            break
    plan = quality_rules.plan_cascade(real, base=True)
    assert {p["rule"] for p in plan} == {*quality_rules.BASE_RULES, *quality_rules.RULES}
    gain = [p["rejected"] / p["cost"] for p in plan]
    assert gain == sorted(gain, reverse=True)


def test_repeats_are_measured_behind_the_rules_before(make_docs):
    d = make_docs([(1, "a b c")])
    order = [{"rule": r} for r in (quality_rules.FEW_WORDS, quality_rules.REPEATS)]
    behind = quality_rules.with_repeats(quality_rules.with_words(d).filter(quality_rules.passes(order[:1])))
    plan = behind.filter(quality_rules.passes(order[1:]))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    words, windows = (next(i for i, x in enumerate(plan) if y in x and "AS " + y in x) for y in ("words_", "windows_"))
    between = [x for x in plan[windows:words] if "Filter" in x]
    assert between and "n_words" in between[0]


def test_rules_on_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    r = (quality_rules.quality_rules(d).join(lab, "doc_id").groupBy("quality")
         .agg(F.avg(F.col("kept").cast("int"))).collect())
    share = dict(map(tuple, r))
    assert share[1] > 0.97 and share[0] < 0.05
