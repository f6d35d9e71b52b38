"""Quality classifier: hierarchical empirical Bayes.

A logistic classifier over text measures gives each document its evidence,
a log likelihood ratio.  Its host and path (the section of a site) give it a
prior: the share of good documents there, estimated by grouped aggregation of the
documents' own probabilities and shrunk, the path toward its host and the host
toward the global share.  How strongly is estimated from the groups themselves: a
Beta prior whose strength matches the variance between groups (method of
moments), so sites with few documents stay near the prior and sites that agree with
each other shrink more.  The posterior is prior odds times evidence.

The classifier is fitted on at most ``SAMPLE_ROWS`` labelled rows, taken by a
hash of the id, with their whole texts; group statistics and scores cover every row.

Host and path: of a source that is a URL, its host and first path segment;
of any other source, the source itself and the language.

Defined results: a null or empty text has the measures of an empty text; a
null source or language is a group of its own; without labels of both kinds
no evidence counts and every document keeps the prior; an empty table gives
an empty table; repeated rows are scored alike; other columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import fresh

SAMPLE_ROWS = 20_000
KEEP_AT = 0.5
# Groups beyond this number are joined by a salted shuffle instead of a
# broadcast (a row is under 200 bytes, so the broadcast stays under 20 MB).
BROADCAST_GROUPS = 100_000
SALTS = 32
# Bounds of a Beta prior's strength, in documents.
MIN_STRENGTH, MAX_STRENGTH = 5.0, 10_000.0
# One document's evidence counts up to these log odds.
MAX_EVIDENCE = 12.0

_N = "greatest(1, words)"
# Measures of ``t`` (the text) with ``words`` and ``distinct`` words, ``lines`` and
# ``distinct_lines``, each bounded.
MEASURES = {
    "symbols": f"least(2.0, (length(t) - length(translate(t, '#*$%&<>', ''))) / {_N})",
    "pipes": f"least(1.0, (length(t) - length(replace(t, '|', ''))) / {_N})",
    "exclamations": f"least(2.0, (length(t) - length(replace(t, '!', ''))) / {_N})",
    "capitals": r"(length(t) - length(regexp_replace(t, '\\p{Lu}+', ''))) / greatest(1, length(t))",
    "digits": "(length(t) - length(translate(t, '0123456789', ''))) / greatest(1, length(t))",
    "variety": "ln(1 + distinct) / ln(1 + greatest(1, words))",
    "repeats": f"1 - distinct / {_N}",
    "line_repeats": "1 - distinct_lines / greatest(1, lines)",
    "size": "least(8.0, ln(1 + words))",
    "word_length": f"least(20.0, length(t) / {_N})",
}


def _once(sql: str) -> Column:
    """Not deterministic by name, so computed once and never copied."""
    return F.expr(f"CASE WHEN monotonically_increasing_id() >= 0 THEN {sql} END")


def host_of(col: str) -> str:
    return f"CASE WHEN {col} LIKE '%://%' THEN lower(regexp_extract({col}, '://([^/?#]+)', 1)) ELSE {col} END"


def path_of(source: str, other: str) -> str:
    return f"CASE WHEN {source} LIKE '%://%' THEN regexp_extract({source}, '://[^/]+/([^/?#]*)', 1) ELSE {other} END"


def with_measures(docs: DataFrame, text_col: str = "text", into: str = "x") -> DataFrame:
    """Add ``into``: the measures of the text as an array of doubles."""
    t, s, m = (fresh(docs, n) for n in ("_t", "_sets", "_m"))
    d = docs.withColumn(t, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    d = d.withColumn(s, _once(
        f"named_struct('w', filter(split({t}, '[ \\\\t-\\\\r]+'), v -> v <> ''), 'l', split({t}, '\\n'))"))
    d = d.withColumn(m, _once(
        f"named_struct('words', size({s}.w), 'distinct', size(array_distinct({s}.w)),"
        f" 'lines', size({s}.l), 'distinct_lines', size(array_distinct({s}.l)))"))
    import re
    sub = {"t": t} | {k: f"{m}.{k}" for k in ("words", "distinct", "lines", "distinct_lines")}
    parts = [re.sub(r"\b(t|words|distinct|lines|distinct_lines)\b(?!')", lambda x: sub[x[0]], v)
             for v in MEASURES.values()]
    arr = "array(" + ", ".join(f"CAST({p} AS DOUBLE)" for p in parts) + ")"
    return d.withColumn(into, _once(arr)).drop(t, s, m)


@dataclass
class Classifier:
    """Standardised measures, weights and the base rate of good documents."""
    mean: list[float]
    scale: list[float]
    weights: list[float]
    bias: float
    base: float

    def evidence(self, x: str) -> Column:
        """Log likelihood ratio good : bad of the measures in column ``x``."""
        z = " + ".join(f"{w!r}D * (`{x}`[{i}] - {m!r}D) / {s!r}D" for i, (w, m, s) in
                       enumerate(zip(self.weights, self.mean, self.scale, strict=True)))
        prior = float(np.log(self.base / (1 - self.base)))
        return F.expr(f"greatest(-{MAX_EVIDENCE}D, least({MAX_EVIDENCE}D,"
                      f" ({self.bias - prior!r}D) + {z or '0.0D'}))")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """``labels``: ``doc_id`` and ``quality`` (1 good, 0 bad)."""
    lab = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
           .groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").cast("int").alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(lab), "id")
    # one row an id, so the sample bounds what the driver gets; in the order of ids, so a re-run adds up alike
    one = with_measures(d, "text", "x").groupBy("id").agg(F.min(F.struct("x", "y")).alias("m"))
    got = one.select("id", "m.x", "m.y").toPandas().sort_values("id")
    k = len(MEASURES)
    if got["y"].nunique() < 2:
        return Classifier([0.0] * k, [1.0] * k, [0.0] * k, 0.0, 0.5)
    x, y = np.stack(got["x"].to_numpy()), got["y"].to_numpy(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    f = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, ridge = np.zeros(k + 1), np.diag([1e-6] + [1.0] * k)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        g = f.T @ (y - p) - ridge @ w
        h = (f * (p * (1 - p))[:, None]).T @ f + ridge + 1e-6 * np.eye(k + 1)
        w = w + np.clip(np.linalg.solve(h, g), -1, 1)
    base = float(np.clip(y.mean(), 0.01, 0.99))
    return Classifier(mean.tolist(), scale.tolist(), w[1:].tolist(), float(w[0]), base)


def with_evidence(docs: DataFrame, model: Classifier, text_col: str = "text", source_col: str = "source",
                  section_col: str = "lang", names=("evidence", "host", "path")) -> DataFrame:
    x = fresh(docs, "_x")
    e, h, p = names
    return (with_measures(docs, text_col, x).withColumn(e, model.evidence(x)).drop(x)
            .withColumn(h, F.expr(host_of(f"`{source_col}`")))
            .withColumn(p, F.expr(path_of(f"`{source_col}`", f"`{section_col}`"))))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Strength of the Beta prior over the groups' shares: matches the variance of
    the shares around ``mean`` beyond what groups of their sizes show by chance."""
    r = groups.select(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2)).alias("between"),
        F.sum(mean * (1 - mean)).alias("chance"),
        F.sum(F.col("n") * mean * (1 - mean)).alias("most")).first()
    if not r or r["between"] is None or r["between"] <= r["chance"]:
        return MAX_STRENGTH
    share = (r["between"] - r["chance"]) / max(r["most"] - r["chance"], 1e-9)
    return float(np.clip(1 / max(share, 1e-9) - 1, MIN_STRENGTH, MAX_STRENGTH))


def group_priors(evidence: DataFrame, model: Classifier) -> DataFrame:
    """``host, path, prior``: the shrunken share of good documents of each
    path.  Rows are summed in the map tasks, so a hot host is a few rows."""
    base = float(np.log(model.base / (1 - model.base)))
    p = 1 / (1 + F.exp(-(F.col("evidence") + base)))
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good")).checkpoint()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).checkpoint()
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    share = float(np.clip((total[1] or 0.0) / (total[0] or 1), 0.01, 0.99)) if total[0] else 0.5
    m = _strength(hosts, F.lit(share))
    hosts = hosts.select("host", ((F.col("good") + m * share) / (F.col("n") + m)).alias("of_host"))
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"]).checkpoint()
    k = _strength(both, F.col("of_host"))
    return both.select("host", "path", "n", ((F.col("good") + k * F.col("of_host")) / (F.col("n") + k)).alias("prior"))


def _with_prior(d: DataFrame, priors: DataFrame, names) -> DataFrame:
    e, h, p = names
    g = priors.select(F.col("host").alias("_gh"), F.col("path").alias("_gp"), "prior")
    on = F.col(h).eqNullSafe(F.col("_gh")) & F.col(p).eqNullSafe(F.col("_gp"))
    if g.count() <= BROADCAST_GROUPS:
        return d.join(F.broadcast(g), on, "left").drop("_gh", "_gp")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    g = g.withColumn("_gs", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return (d.withColumn("_ds", salt).join(g, on & (F.col("_ds") == F.col("_gs")), "left")
            .drop("_gh", "_gp", "_gs", "_ds"))


def _posterior(evidence: str, prior: str) -> Column:
    return F.expr(f"1 / (1 + exp(-(`{evidence}` + ln(`{prior}` / (1 - `{prior}`)))))")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", section_col: str = "lang", keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: id, ``host``, ``path``, ``evidence``, ``prior``,
    ``score`` (probability of good) and ``kept``."""
    model = fit(docs, labels, id_col, text_col)
    d = docs.select(*{c: F.col(f"`{c}`") for c in (id_col, text_col, source_col, section_col)}.values())
    ev = with_evidence(d, model, text_col, source_col, section_col).select(
        id_col, "host", "path", "evidence").checkpoint()
    d = _with_prior(ev, group_priors(ev, model), ("evidence", "host", "path"))
    d = d.withColumn("score", _posterior("evidence", "prior"))
    return d.withColumn("kept", F.col("score") >= keep_at)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", section_col: str = "lang", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that are good with a probability of ``keep_at`` or more, columns as they were."""
    model = fit(docs, labels, id_col, text_col)
    names = tuple(fresh(docs, n) for n in ("_evidence", "_host", "_path"))
    d = with_evidence(docs, model, text_col, source_col, section_col, names)
    ev = d.select(*(F.col(a).alias(b) for a, b in zip(names, ("evidence", "host", "path"), strict=True)))
    box = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = _with_prior(d.select(box, *names), group_priors(ev, model), names)
    return d.filter(_posterior(names[0], "prior") >= keep_at).select("row.*")
