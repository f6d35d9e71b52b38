"""Toxicity by a weighted finite-state pattern grammar.

The words of a clause become symbols: insult, threat, target, negation,
report (a verb of reported speech), quote mark, or other.  Five small weighted
transducers read the symbols, each also the weight that those before it emit:

* negation - lowers what follows for a few words after "not" and the like;
* report   - lowers what stands after a verb of saying or inside quotes;
* threat   - emits a threat only together with a target: if the target follows, then there, with
  the weight that the threat had where it stood (of several that wait the greatest);
* target   - raises the insults that follow in the clause once a person is addressed;
* insult   - emits the weight of insults and threats, and nothing for other words.

``compose`` builds the product
automaton of all five, with one weight per state and symbol; a clause is scored by one run of
it, so the score belongs to the matched clause and not to isolated words.  A clause begins
inside quotes if a quote mark is open there that is closed later in the text.

The insult lexicon is a set of word beginnings with weights.  A few public
English words are given; the others are learned from labels: beginnings (or
whole words) that are much more frequent in toxic than in other texts, by
their log odds.  The learning sample is bounded by ``SAMPLE_ROWS``
labelled rows, taken by a hash of the id, with their whole texts; scoring covers every row and whole texts.  The
scores of the sample's texts then fix a logistic curve.

Defined results: a null, empty or wordless text has no clause and gets the
score of a text without any match; rows with a null id or label are not
learned from; without labels of both kinds a fixed curve is used; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_left
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import fresh
from moodindex.llm.langid import remainder

SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
# A learned beginning has so many characters, so many toxic sample texts (or this
# share of them) and log odds of at least MIN_ODDS.
MIN_STEM, MAX_STEM = 3, 8
MIN_TEXTS, MIN_SHARE, MIN_ODDS = 3, 0.01, 3.5
# Of a whole word so many characters are compared, in learning and in scoring.
WHOLE = 24
# Beginnings are learned in rounds; in each, toxic texts that are explained already don't count.
ROUNDS = 4

# Seed words (public, plain) by symbol.
INSULTS = ("idiot moron stupid loser scum trash worthless pathetic disgusting dumb imbecile "
           "bastard asshole bitch").split()
THREATS = "kill hurt destroy murder beat punch stab shoot".split()
TARGETS = ("you your yours you're u he she they him her them his their du dich dir ihr euch dein "
           "tu te toi vous ton votre usted ustedes vosotros").split()
NEGATIONS = "not never no isn't aren't don't nicht kein keine nie jamais nunca".split()
REPORTS = ("said says say wrote writes called calls quoted claimed according sagte schrieb dit "
           "écrit dijo escribió").split()
QUOTES = '"“”«»„'

I, T, G, N, R, Q, O = range(7)  # symbols
SEED_WEIGHT, THREAT_WEIGHT = 7.0, 7.0
TARGET_GAIN, NEGATION_LOSS, REPORT_LOSS = 1.5, 0.1, 0.15
# A clause of a lower score is no match: a denied or reported insult.
MATCH = 2.0
# Words added to a text's length before its density is taken, so that one hit in a short text says less.
DENSITY_WORDS = 50
NEGATION_WORDS = 3

_CLAUSE = re.compile(r"[.!?;\n|]+")
_QUOTE = re.compile(f"[{QUOTES}]")
_WORD = re.compile(rf"[^\W\d_]+(?:['’][^\W\d_]+)*|[{QUOTES}]")


def _negation(s, x, w):
    if x == N:
        return NEGATION_WORDS, w
    return max(0, s - 1), w * NEGATION_LOSS if s else w


def _report(s, x, w):  # 0 plain, 1 after a verb of saying, 2 in quotes, 3 both
    if x == R:
        return s | 1, w
    if x == Q:
        return s ^ 2, w
    return s, w * REPORT_LOSS if s else w


# The weights that a threat can have, greatest first.
LEVELS = tuple(sorted((1.0, REPORT_LOSS, NEGATION_LOSS, NEGATION_LOSS * REPORT_LOSS), reverse=True))


def _threat(s, x, w):  # 0 nobody addressed, 1 somebody, 2 + k a threat of LEVELS[k] waits for somebody
    if x == G:
        return 1, LEVELS[s - 2] if s >= 2 else 0.0
    if x == T:
        if s == 1:
            return 1, w
        k = LEVELS.index(w)
        return 2 + (min(k, s - 2) if s else k), 0.0
    return s, w


def _target(s, x, w):  # 0 nobody addressed, 1 somebody
    return int(s or x == G), w * TARGET_GAIN if s and x == I else w


def _insult(s, x, w):
    return s, w if x in (I, T, G) else 0.0


MACHINES = ((_negation, NEGATION_WORDS + 1), (_report, 4), (_threat, 2 + len(LEVELS)), (_target, 2), (_insult, 1))


def compose(machines=MACHINES) -> tuple[np.ndarray, np.ndarray]:
    """The product automaton: next state and weight by state and symbol."""
    states = list(product(*(range(n) for _, n in machines)))
    index = {s: i for i, s in enumerate(states)}
    step = np.zeros((len(states), O + 1), np.int32)
    weight = np.zeros((len(states), O + 1))
    for s in states:
        for x in range(O + 1):
            w, moved = 1.0, []
            for (f, _), a in zip(machines, s, strict=True):
                a, w = f(a, x, w)
                moved.append(a)
            step[index[s], x] = index[tuple(moved)]
            weight[index[s], x] = w
    return step, weight


class Grammar:
    """The lexicon and the automaton; scores texts by their matched clauses."""

    def __init__(self, stems: dict[str, float]):
        import ahocorasick
        self.stems = dict(stems)  # "abc" begins a word, "abc$" is a word
        self.words = {w: G for w in TARGETS} | {w: N for w in NEGATIONS} | {w: R for w in REPORTS} \
            | {q: Q for q in QUOTES} | {w: T for w in THREATS}
        step, weight = compose()
        self.step, self.weight = step.tolist(), weight.tolist()
        self.quoted = self.step[0][Q]  # the state at a clause's beginning inside quotes
        self.find = ahocorasick.Automaton()
        for s in {s.rstrip("$") for s in self.stems} | set(THREATS):
            self.find.add_word(s, len(s))
        self.find.make_automaton()
        self.curve = (-5.0, 0.0, 4.0)

    def symbol(self, word: str) -> tuple[int, float]:
        x = self.words.get(word)
        if x is not None:
            return x, THREAT_WEIGHT if x in (T, G) else 0.0
        best = self.stems.get(word[:WHOLE] + "$", 0.0)
        for n in range(MIN_STEM, min(len(word), WHOLE) + 1):
            best = max(best, self.stems.get(word[:n], 0.0))
        return (I, best) if best else (O, 0.0)

    def clause(self, text: str, quoted: bool = False) -> float:
        s, score = self.quoted if quoted else 0, 0.0
        for w in _WORD.findall(text):
            x, own = self.symbol(w)
            score += own * self.weight[s][x]
            s = self.step[s][x]
        return score

    def total(self, text: str) -> tuple[float, int]:
        """Sum over the matched clauses, and how many matched."""
        low = text.lower()
        at = [end + 1 - n for end, n in self.find.iter(low)]
        at = [a for a in at if not a or not low[a - 1].isalpha()]  # at a word's beginning
        if not at:
            return 0.0, 0
        marks = [m.start() for m in _QUOTE.finditer(low)]
        score, matched, done = 0.0, 0, 0
        for a in sorted(at):
            if a < done:
                continue
            start = done
            for m in _CLAUSE.finditer(low, done, a):
                start = m.end()
            end = _CLAUSE.search(low, a)
            done = end.end() if end else len(low)
            before = bisect_left(marks, start)
            s = self.clause(low[start:end.start() if end else len(low)], before % 2 == 1 and before < len(marks))
            if s >= MATCH:
                score += s
                matched += 1
        return score, matched

    def features(self, text: str) -> tuple[float, float, int]:
        """Log of the total, log of the total per 100 words, matched clauses."""
        total, matched = self.total(text)
        words = len(text.split()) if matched else 0
        return float(np.log1p(total)), float(np.log1p(100 * total / (words + DENSITY_WORDS))), matched

    def scores(self, features: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-(a + b * features[:, 0] + c * features[:, 1])))


def _labelled(docs, labels, id_col, text_col, rows):
    """At most about ``rows`` labelled texts, by a hash of the id."""
    lab = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id") != 2))
           .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic")))
    lab = lab.orderBy(F.xxhash64("id"), "id").limit(rows)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return text.join(F.broadcast(lab), "id").select("text", "toxic")


def _beginnings(text: str) -> set[str]:
    out = set()
    for w in set(_WORD.findall(text.lower())):
        out.add(w[:WHOLE] + "$")
        out.update(w[:n] for n in range(MIN_STEM, min(len(w), MAX_STEM) + 1))
    return out


def _learn(rows: DataFrame, stems: dict[str, float]) -> dict[str, float]:
    """Beginnings that tell toxic texts, not yet explained, from the others."""
    known = rows.sparkSession.sparkContext.broadcast(stems)

    def count(batches):
        g, pos, neg, kinds = Grammar(known.value), Counter(), Counter(), Counter()
        for b in batches:
            for text, toxic in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if toxic and g.total(text)[0] > 0:
                    continue
                kinds[toxic] += 1
                (pos if toxic else neg).update(_beginnings(text))
        keys = list(pos.keys() | neg.keys())
        for k in range(0, len(keys), 50_000):
            part = keys[k:k + 50_000]
            yield pa.record_batch([pa.array(part), pa.array([pos[x] for x in part], pa.int64()),
                                   pa.array([neg[x] for x in part], pa.int64())], names=["stem", "pos", "neg"])
        yield pa.record_batch([pa.array([""]), pa.array([kinds[1]], pa.int64()),
                               pa.array([kinds[0]], pa.int64())], names=["stem", "pos", "neg"])

    counts = (rows.mapInArrow(count, "stem string, pos long, neg long").groupBy("stem")
              .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).checkpoint()
    total = counts.filter("stem = ''").first()
    if not total or not total["pos"] or not total["neg"]:
        return {}
    p, n = total["pos"], total["neg"]
    odds = F.log((F.col("pos") + 0.5) / (p + 1)) - F.log((F.col("neg") + 0.5) / (n + 1))
    # All that qualify: each stands in MIN_SHARE of the sample's toxic texts at least, so there are at most
    # 1 / MIN_SHARE times as many as one of these has on average.
    best = (counts.filter((F.col("stem") != "") & (F.col("pos") >= max(MIN_TEXTS, MIN_SHARE * p)))
            .withColumn("odds", odds).filter(F.col("odds") >= MIN_ODDS)
            .collect())
    out: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (-r["pos"] * r["odds"], len(r["stem"]), r["stem"])):
        s = r["stem"].rstrip("$")
        if not any(s[:k] in out for k in range(1, len(s) + 1)):
            out[r["stem"]] = float(r["odds"])
    return out


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic curve by Newton's method, with a small ridge."""
    f = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(f.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        g = f.T @ (y - p) - 1e-2 * w
        h = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, g), -1, 1)
    return tuple(map(float, w))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> Grammar:
    """``labels``: ``doc_id`` and ``toxic`` (0 or 1)."""
    rows = _labelled(docs, labels, id_col, text_col, sample_rows).checkpoint()
    stems = dict.fromkeys(INSULTS, SEED_WEIGHT)
    for _ in range(ROUNDS):
        new = {k: v for k, v in _learn(rows, stems).items() if k not in stems}
        if not new:
            break
        stems |= new
    grammar = Grammar(stems)
    shared = rows.sparkSession.sparkContext.broadcast(stems)

    def measure(batches):
        g = Grammar(shared.value)
        for b in batches:
            x = [g.features(t) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([v[0] for v in x], pa.float64()),
                                   pa.array([v[1] for v in x], pa.float64()),
                                   b.column(1).cast(pa.int32())], names=["total", "density", "toxic"])

    got = rows.mapInArrow(measure, "total double, density double, toxic int").toPandas()  # bounded by the sample
    if got["toxic"].nunique() == 2:
        grammar.curve = _fit(got[["total", "density"]].to_numpy(), got["toxic"].to_numpy(float))
    return grammar


# The grammar that this worker scores with, by the digest of its stems and curve.
_LOADED: dict[str, Grammar] = {}


def score_toxicity(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``clauses`` (matched) and ``predicted``."""
    parts = (grammar.stems, grammar.curve)
    digest = hashlib.sha256(pickle.dumps(parts)).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    own = ["score", "clauses", "predicted"]

    @F.pandas_udf("score double, clauses int, predicted int")
    def score(texts: pd.Series) -> pd.DataFrame:
        g = _LOADED.get(digest)
        if g is None:
            _LOADED.clear()
            g = _LOADED[digest] = Grammar(shared.value[0])
            g.curve = shared.value[1]
        x = np.array([g.features(t) for t in texts.fillna("")]).reshape(-1, 3)
        p = g.scores(x)
        return pd.DataFrame({"score": p, "clauses": x[:, 2].astype(int),
                             "predicted": (p >= THRESHOLD).astype(int)})

    s = fresh(docs, "_s")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]
    return (docs.select(*keep, score(F.col(text_col).cast("string")).alias(s))
            .select(*keep, *[F.col(f"{s}.{c}").alias(c) for c in own]))
