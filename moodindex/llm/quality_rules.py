"""Quality rules as a short-circuit cascade, in native expressions only.

Base measures (words are runs of characters other than U+0020 and U+0009 to
U+000D) are computed for every row: ``n_words``, ``word_chars`` (code points
in words), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines
with a word, equal to an earlier line), ``n_repeat_words`` (words inside a
5-word window that occurs twice or more in the text, first one included).

A row that fails a base rule is rejected.  The rules of ``RULES`` follow as a
cascade (in :func:`keep_good`, which hands out no measures, the base rules are part of it, and the dear measure of
repeats is computed only for rows that come so far): on a sample each rule's cost (time of a run over the cached sample,
less the time of a run without rule) and selectivity (share of rows that it
rejects) are estimated, and the rules are put in the order of rejections per
cost, so that a row usually leaves before the expensive rules are evaluated.  The order changes the
work, never the verdict: a row is kept if no rule rejects it.

Defined results: a null or empty text has no words, so the base rejects it;
an empty table gives an empty table; rows are judged one by one, so ties and
repeated rows need no rule; extra columns are carried along if asked for.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import fresh

SAMPLE_ROWS = 2000
# A cost is the least of as many runs over the sample.
TIMINGS = 4
WINDOW = 5

_TRIM = r"trim(BOTH ' \t\n\u000b\u000c\r' FROM {})"


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL over the measures and ``text_`` (the text)."""
    name: str
    rejects: str


# Thresholds follow the common heuristics for web text, with room for short
# documents and for languages with long words.
RULES = (
    Rule("mean_word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", "n_symbols * 4 > n_words"),
    Rule("dup_lines", "n_dup_lines > 1 AND n_dup_lines * 10 > 3 * (length(text_) - length(replace(text_, '\n', '')) + 1)"),
    Rule("digits", "4 * (length(text_) - length(translate(text_, '0123456789', ''))) > word_chars"),
    Rule("exclamations", "length(text_) - length(replace(text_, '!', '')) > n_words"),
    Rule("letters", "2 * length(regexp_replace(text_, '[^\\\\p{L}]+', '')) < word_chars"),
    Rule("shouting", "2 * length(regexp_replace(text_, '[^\\\\p{Lu}]+', ''))"
                     " > length(regexp_replace(text_, '[^\\\\p{L}]+', ''))"),
)


def _once(sql: str) -> Column:
    """The value of ``sql``, computed once a row: an expression that counts as
    not deterministic is neither inlined into the lambdas that use it nor
    copied into a filter that the optimizer pushes down."""
    return F.expr(f"CASE WHEN monotonically_increasing_id() >= 0 THEN {sql} END")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines")


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``text_``, ``words_`` and the measures of one walk over the text; every other
    column stays.  A column of the input with the name of a measure is replaced."""
    own = {"text_", *MEASURES, "n_repeat_words", "words_", "lines_", "windows_", "sorted_", "at_"}
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]
    d = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_"))
    trimmed = _TRIM.format("text_")
    d = d.withColumn("words_", _once(
        rf"CASE WHEN {trimmed} = '' THEN CAST(array() AS array<string>) "
        rf"ELSE split({trimmed}, '[ \\t-\\r]+') END"))
    d = d.withColumn("lines_", _once(
        "filter(split(text_, '\\n'), l -> " + _TRIM.format("l") + " <> '')"))
    return d.select(
        *keep, "text_", "words_",
        _once("CAST(size(words_) AS LONG)").alias("n_words"),
        _once("CAST(length(array_join(words_, '')) AS LONG)").alias("word_chars"),
        _once("CAST(length(text_) - length(translate(text_, '#*$%&|<>', '')) AS LONG)")
        .alias("n_symbols"),
        _once("CAST(size(lines_) - size(array_distinct(lines_)) AS LONG)").alias("n_dup_lines"))


def with_repeats(d: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` to rows of :func:`with_words`; ``words_`` goes."""
    keep = [F.col(f"`{c}`") for c in d.columns if c != "words_"]
    at = ", ".join(f"words_[i + {k}]" if k else "words_[i]" for k in range(WINDOW))
    d = d.withColumn("windows_", _once(
        f"CASE WHEN size(words_) > {WINDOW} THEN transform(sequence(0, size(words_) - {WINDOW}),"
        f" i -> xxhash64({at})) END"))
    # only texts with a repeated window pay for the sort
    d = d.withColumn("sorted_", _once(
        "CASE WHEN size(array_distinct(windows_)) < size(windows_) THEN"
        " sort_array(transform(windows_, (w, i) -> struct(w AS w, i AS i))) END"))
    d = d.withColumn("at_", _once(
        "sort_array(transform(filter(sorted_, (s, j) -> get(sorted_, j - 1).w = s.w"
        " OR get(sorted_, j + 1).w = s.w), s -> s.i))"))
    return d.select(*keep, _once(
        f"CAST(CASE WHEN at_ IS NULL THEN 0 ELSE aggregate(sequence(1, size(at_) - 1),"
        f" {WINDOW}, (a, j) -> a + least({WINDOW}, at_[j] - at_[j - 1])) END AS LONG)").alias("n_repeat_words"))


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``text_`` and all base measures."""
    return with_repeats(with_words(docs, text_col))


FEW_WORDS = Rule("few_words", "n_words < 10")
REPEATS = Rule("repeats", "100 * n_repeat_words > 20 * n_words")
BASE_RULES = (FEW_WORDS, REPEATS)
BASE_FAILED = " OR ".join(r.rejects for r in BASE_RULES)


def sample_of(docs: DataFrame, text_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows, each row drawn on its own: copies of one text come in their share."""
    share = min(1.0, rows / max(1, docs.count()))
    return docs.select(F.col(text_col)).sample(share, seed=0)


def plan_cascade(docs: DataFrame, text_col: str = "text", rules=RULES,
                 rows: int = SAMPLE_ROWS, base: bool = False) -> list[dict]:
    """The rules in the order of rejections per cost, with both figures.  A share
    that the sample can't tell from none counts as half a row, so of such rules the cheap
    ones come first.  ``base``: the base rules take part in the order (the rule on repeats costs what its
    measure costs); otherwise rows that they reject are left out of the sample."""
    s = with_words(sample_of(docs, text_col, rows), text_col).persist()
    part = None
    try:
        if not s.count():
            return [{"rule": r, "cost": 0.0, "rejected": 0.0} for r in ((*BASE_RULES, *rules) if base else rules)]
        full = with_repeats(s.withColumn("_words", F.col("words_"))).withColumnRenamed("_words", "words_")
        part = (full if base else full.filter(f"NOT ({BASE_FAILED})")).persist()
        rules = (*BASE_RULES, *rules) if base else rules
        n = part.count()
        hits = part.agg(*[F.count_if(F.expr(r.rejects)).alias(r.name) for r in rules]).first()
        plain = part.drop("n_repeat_words")

        def seconds(rule: Rule | None) -> float:
            d = with_repeats(plain) if rule is REPEATS else plain
            best = float("inf")
            for _ in range(TIMINGS):
                began = time.perf_counter()
                d.agg(F.count_if(F.expr(rule.rejects if rule else "true"))).collect()
                best = min(best, time.perf_counter() - began)
            return best

        idle = seconds(None)
        out = [{"rule": r, "cost": max(1e-6, (seconds(r) - idle) / max(1, n)),
                "rejected": (hits[r.name] + 0.5) / (n + 1)} for r in rules]
    finally:
        s.unpersist()
        if part is not None:
            part.unpersist()
    return sorted(out, key=lambda x: -x["rejected"] / x["cost"])


def passes(order: list[dict]) -> str:
    """Nested CASE: a rule is evaluated only for rows that the rules before it let pass."""
    sql = "true"
    for x in reversed(order):
        sql = f"CASE WHEN {x['rule'].rejects} THEN false ELSE {sql} END"
    return sql


def verdict(order: list[dict]) -> Column:
    """Kept or not, for rows that have all measures."""
    return F.expr(f"CASE WHEN {BASE_FAILED} THEN false ELSE {passes(order)} END")


def quality_rules(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``."""
    order = plan_cascade(docs, text_col, rules)
    return (with_measures(docs, text_col)
            .withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("kept", verdict(order)).drop("text_"))


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that every rule lets pass, columns as they were."""
    box = fresh(docs, "_row")
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(box),
                        F.col(text_col).alias("text"))
    order = plan_cascade(docs, text_col, rules, base=True)
    at = next(i for i, x in enumerate(order) if x["rule"] is REPEATS)
    # the measure of repeats is computed for rows that the rules before it let pass
    d = with_repeats(with_words(boxed, "text").filter(passes(order[:at])))
    return d.filter(passes(order[at:])).select(f"{box}.*")
