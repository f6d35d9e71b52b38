"""ANSI-SQL (DuckDB dialect) forms of the registered queries.

Written independently of the DataFrame code: these are the plain,
row-level definitions (one window per entity-year for the change rate,
``row_number`` for sampling), used as an oracle on small data.  Regular
expressions come from the same fixed-value constants as the Spark side.
"""

from __future__ import annotations

from moodindex.functions.text import (BERT_DROP_RE, NON_SPACE_RUN_RE, SPACE_RUN_RE, TAG_RE,
                                      TFIDF_DROP_RE, TOKEN_RE, URL_FLAG_RE, URL_RUN_RE,
                                      WORD_COUNT_DROP_RE)
from moodindex.plans import params as P


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def r8(x: str) -> str:
    """Same grid as the Spark side."""
    return f"(floor(({x}) * 1e8 + CAST(0.4142 AS DOUBLE)) / 1e8)"


def r4(x: str) -> str:
    """Price-scale values (about 1e5) keep 4 decimals."""
    return f"(floor(({x}) * 1e4 + CAST(0.4142 AS DOUBLE)) / 1e4)"


def strip_markup(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, {_q(TAG_RE)}, '', 'g'), "
            f"{_q(URL_RUN_RE)}, '', 'g')")


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {_q(SPACE_RUN_RE)}, ' ', 'g'), ' ')"


def clean_tfidf(x: str) -> str:
    return collapse(f"regexp_replace({strip_markup(x)}, {_q(TFIDF_DROP_RE)}, '', 'g')")


def clean_bert(x: str) -> str:
    return collapse(f"regexp_replace({strip_markup(x)}, {_q(BERT_DROP_RE)}, '', 'g')")


def nospace(x: str) -> str:
    return f"regexp_replace({x}, {_q(SPACE_RUN_RE)}, '', 'g')"


def contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {_q(w)})" for w in dict.fromkeys(words)) + ")"


def hit_count(x: str, words) -> str:
    x = f"coalesce({x}, '')"
    return ("CAST((" + " + ".join(f"CASE WHEN contains({x}, {_q(w)}) THEN 1 ELSE 0 END"
                                  for w in dict.fromkeys(words)) + ") AS INTEGER)")


def many_hits(x: str, words) -> str:
    """The same for lists too long for one sum of cases."""
    ws = ", ".join(_q(w) for w in dict.fromkeys(words))
    return f"CAST(len(list_filter([{ws}], lambda w: contains(coalesce({x}, ''), w))) AS INTEGER)"


def has_url(x: str) -> str:
    return f"regexp_matches({x}, {_q(URL_FLAG_RE)})"


# -- shared views ------------------------------------------------------------

SCORED = """
scored AS (
  SELECT event_id AS comment_id, event_type AS stock_code, ts AS time,
         round(ef / (ef + en + eg), 4) AS prob_fear,
         round(en / (ef + en + eg), 4) AS prob_neutral,
         round(eg / (ef + en + eg), 4) AS prob_greed,
         CAST(CASE WHEN ef / (ef + en + eg) >= en / (ef + en + eg)
                    AND ef / (ef + en + eg) >= eg / (ef + en + eg) THEN 0
                   WHEN en / (ef + en + eg) >= eg / (ef + en + eg) THEN 1
                   ELSE 2 END AS INTEGER) AS pred_label
  FROM (SELECT *, exp(lf - m) AS ef, exp(ln0 - m) AS en, exp(lg - m) AS eg
        FROM (SELECT *, greatest(lf, ln0, lg) AS m
              FROM (SELECT event_id, event_type, ts, value / CAST(100 AS DOUBLE) AS lf,
                           CAST(1 AS DOUBLE) AS ln0,
                           CAST(hour(ts) AS DOUBLE) / CAST(8 AS DOUBLE) AS lg
                    FROM events))))
"""

# score in integer units of 0.01 (100 x greed, 2 decimals)
SCORE_UNITS = "CAST(round((prob_greed * 100) * 100) AS BIGINT)"


def prob_units(c: str) -> str:
    return f"CAST(round({c} * 10000) AS BIGINT)"


COMMENTS = """
comments AS (
  SELECT d.doc_id AS comment_id, d.source AS stock_code, d.text AS text, e.ts AS time
  FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id)
"""


def preprocessed(words=P.TOPIC_WORDS) -> str:
    return f"""
pre AS (
  SELECT comment_id, stock_code, text AS raw_text, {clean_tfidf('text')} AS text_tfidf,
         {clean_bert('text')} AS text_bert, time
  FROM comments
  WHERE text IS NOT NULL AND time IS NOT NULL
    AND NOT {contains_any(nospace('text'), words)} AND NOT {has_url('text')})
"""


def labeled(fear=P.FEAR_WORDS, greed=P.GREED_WORDS) -> str:
    return f"""
labeled AS (
  SELECT *, CAST(CASE WHEN fh > gh THEN 0 WHEN gh > fh THEN 2 ELSE 1 END AS INTEGER) AS label
  FROM (SELECT *, {hit_count('text_tfidf', fear)} AS fh,
               {hit_count('text_tfidf', greed)} AS gh FROM pre))
"""


LABELED = labeled()


def _bayes_ctes() -> str:
    """Closed-form multinomial Naive Bayes, trained on the split's training rows."""
    w = ", ".join(f"ln((c{c} + CAST(1 AS DOUBLE)) / (n{c} + v)) AS w{c}" for c in range(3))
    cs = ", ".join(f"count(*) FILTER (WHERE label = {c}) AS c{c}" for c in range(3))
    ds = ", ".join(f"ln(count(*) FILTER (WHERE label = {c}) / CAST(count(*) AS DOUBLE)) AS p{c}" for c in range(3))
    ts = ", ".join(f"coalesce(sum(tf * w{c}), 0) + any_value(p{c}) AS t{c}" for c in range(3))
    es = ", ".join(f"exp(t{c} - greatest(t0, t1, t2)) AS e{c}" for c in range(3))
    return f"""
split AS ({_split_sql("SELECT comment_id AS id, label FROM labeled", "comment_id")}),
train AS (SELECT comment_id, split.label, text_bert FROM labeled JOIN split USING (comment_id)
          WHERE split.split = 'train' AND length(text_bert) > 0),
tok AS (SELECT comment_id, unnest(regexp_extract_all(lower(coalesce(text_bert, '')), {_q(NON_SPACE_RUN_RE)})) AS term FROM pre),
cnt AS (SELECT term, {cs} FROM tok JOIN train USING (comment_id) GROUP BY term),
tot AS (SELECT count(*) AS v, sum(c0) AS n0, sum(c1) AS n1, sum(c2) AS n2 FROM cnt),
model AS (SELECT term, {w} FROM cnt, tot),
prior AS (SELECT {ds} FROM train),
tf AS (SELECT comment_id, term, count(*) AS tf FROM tok GROUP BY 1, 2),
sums AS (SELECT pre.comment_id, any_value(pre.stock_code) AS stock_code, any_value(pre.text_bert) AS text_bert, {ts}
         FROM pre LEFT JOIN (SELECT * FROM tf JOIN model USING (term)) x ON x.comment_id = pre.comment_id, prior
         GROUP BY pre.comment_id),
scored_nb AS (
  SELECT *, {es},
         CAST(CASE WHEN t0 >= t1 AND t0 >= t2 THEN 0 WHEN t1 >= t2 THEN 1 ELSE 2 END AS INTEGER) AS pred_label
  FROM sums)
"""


def _epoch_ctes() -> str:
    """Gradient descent written out, one set of tables an epoch: ``x`` holds the vectors, ``w{k}`` the weights that
    epoch k starts with, ``z{k}`` the logits, ``p{k}`` the probabilities, ``m{k}`` the metrics."""
    out = [f"""
split AS ({_split_sql("SELECT comment_id AS id, label FROM labeled", "comment_id")}),
src AS (SELECT comment_id, split.label AS y, split.split = 'valid' AS valid, text_bert FROM labeled JOIN split USING (comment_id)
        WHERE length(text_bert) > 0),
tok AS (SELECT comment_id, unnest(regexp_extract_all(lower(text_bert), {_q(NON_SPACE_RUN_RE)})) AS term FROM pre),
cnt AS (SELECT comment_id, CAST('0x' || substr(md5(term), 1, 4) AS INTEGER) AS b, count(*) AS c FROM tok GROUP BY 1, 2),
every AS MATERIALIZED (
  SELECT comment_id, b, c / sqrt(CAST(sum(c * c) OVER (PARTITION BY comment_id) AS DOUBLE)) AS x FROM cnt
  UNION ALL SELECT comment_id, 65536, CAST(1 AS DOUBLE) FROM pre),
x AS MATERIALIZED (SELECT comment_id, y, valid, b, x FROM every JOIN src USING (comment_id)),
w0 AS (SELECT DISTINCT b, CAST(0 AS DOUBLE) AS a0, CAST(0 AS DOUBLE) AS a1, CAST(0 AS DOUBLE) AS a2 FROM x)"""]
    z = ", ".join(f"sum(x * a{c}) AS z{c}" for c in range(3))
    e = " + ".join(f"exp(z{c})" for c in range(3))
    ps = ", ".join(f"exp(z{c}) / ({e}) AS p{c}" for c in range(3))
    g = ", ".join(f"sum(x * (p{c} - CASE WHEN y = {c} THEN 1 ELSE 0 END)) AS g{c}" for c in range(3))
    step = ", ".join(f"a{c} - {P.RATE} * coalesce(g{c}, 0) / (SELECT count(*) FROM src WHERE NOT valid) AS a{c}" for c in range(3))
    f1 = " + ".join(f"coalesce(count(*) FILTER (WHERE valid AND y = {c}) * 2.0 * count(*) FILTER (WHERE valid AND y = {c} AND best = {c})"
                    f" / nullif(CAST(count(*) FILTER (WHERE valid AND y = {c}) + count(*) FILTER (WHERE valid AND best = {c}) AS DOUBLE), 0), 0)"
                    for c in range(3))
    for k in range(P.EPOCHS + 1):
        out.append(f"""
z{k} AS MATERIALIZED (SELECT comment_id, y, valid, {z} FROM x JOIN w{k} USING (b) GROUP BY 1, 2, 3),
p{k} AS MATERIALIZED (SELECT *, -ln(CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END) AS loss,
                             CASE WHEN z0 >= z1 AND z0 >= z2 THEN 0 WHEN z1 >= z2 THEN 1 ELSE 2 END AS best
                      FROM (SELECT *, {ps} FROM z{k})),
m{k} AS (SELECT CAST({k} AS INTEGER) AS epoch, avg(loss) FILTER (WHERE NOT valid) AS train_loss, avg(loss) FILTER (WHERE valid) AS valid_loss,
                avg(CASE WHEN best = y THEN 1.0 ELSE 0.0 END) FILTER (WHERE valid) AS accuracy,
                ({f1}) / count(*) FILTER (WHERE valid) AS f1 FROM p{k}),
w{k + 1} AS MATERIALIZED (
  SELECT b, {step} FROM w{k} LEFT JOIN
    (SELECT b, {g} FROM x JOIN p{k} USING (comment_id, y, valid) WHERE NOT valid GROUP BY b) USING (b))""")
    return ",".join(out)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def daily_agg(where: str = "") -> str:
    return f"""
SELECT stock_code, CAST(time AS DATE) AS date,
       avg(prob_fear) AS fear_ratio,
       avg(prob_neutral) AS neutral_ratio,
       avg(prob_greed) AS greed_ratio
FROM scored {where} GROUP BY 1, 2"""


def hourly_agg(where: str = "") -> str:
    return f"""
SELECT stock_code, CAST(year(time) AS INTEGER) AS year, CAST(hour(time) AS INTEGER) AS hour,
       avg(prob_greed * 100) AS avg_score
FROM scored {where} GROUP BY 1, 2, 3"""


def change_agg(order: str, where: str = "") -> str:
    order_by = "hour(time), time, comment_id" if order == "hour" else "time, comment_id"
    return f"""
SELECT stock_code, year, hour, avg(dv) AS change_rate
FROM (SELECT stock_code, CAST(year(time) AS INTEGER) AS year, CAST(hour(time) AS INTEGER) AS hour,
             prob_greed * 100 - lag(prob_greed * 100) OVER (PARTITION BY stock_code, year(time)
                                                            ORDER BY {order_by}) AS dv
      FROM scored {where})
GROUP BY 1, 2, 3"""


def order_monthly(where: str = "") -> str:
    w = f"WHERE o_orderdate IS NOT NULL {('AND ' + where) if where else ''}"
    return f"""
SELECT o_orderstatus AS stock_code, strftime(o_orderdate, '%Y-%m') AS month,
       avg(o_totalprice) AS avg_score
FROM orders {w} GROUP BY 1, 2"""


MOVING = f"""
ma AS (
  SELECT stock_code, month, a AS avg_score,
         CASE WHEN count(a) OVER w7 = 7 THEN avg(a) OVER w7 END AS short_ma,
         CASE WHEN count(a) OVER w30 = 30 THEN avg(a) OVER w30 END AS long_ma
  FROM (SELECT stock_code, month, avg_score AS a FROM ({order_monthly()}))
  WINDOW w7 AS (PARTITION BY stock_code ORDER BY month ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY stock_code ORDER BY month ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
"""


def upsert_sql(target: str, update: str, keys: list[str], measures: list[str],
               prefix: tuple[str, ...] = (), rnd=None) -> str:
    """Plain full-outer-join merge; run timestamps as in params."""
    rnd = rnd or r8
    on = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    ks = ", ".join(f"coalesce(t.{k}, u.{k}) AS {k}" for k in keys)
    ms = ", ".join(f"{rnd(f'CASE WHEN u._in THEN u.{m} ELSE t.{m} END')} AS {m}" for m in measures)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return with_(*prefix, f"t AS (SELECT *, true AS _in FROM ({target}) WHERE {nn})",
                 f"u AS (SELECT *, true AS _in FROM ({update}) WHERE {nn})") + f"""
SELECT {ks}, {ms},
       CASE WHEN t._in THEN TIMESTAMP '{P.RUN1}' ELSE TIMESTAMP '{P.RUN2}' END AS created_at,
       CASE WHEN u._in THEN TIMESTAMP '{P.RUN2}' ELSE TIMESTAMP '{P.RUN1}' END AS updated_at
FROM t FULL OUTER JOIN u ON {on}"""


def oracle() -> dict[str, str]:
    BAYES = _bayes_ctes().strip() + "\n"
    S = with_(SCORED)
    SC = with_(SCORED, "d AS (" + daily_agg() + ")")
    PRE = with_(COMMENTS, preprocessed())
    LAB = with_(COMMENTS, preprocessed(), LABELED)
    nsp = nospace("text")
    q: dict[str, str] = {}

    q["softmax_argmax"] = S + """
SELECT comment_id, prob_fear, prob_neutral, prob_greed, pred_label FROM scored"""
    q["time_parts"] = S + """
SELECT comment_id, stock_code, CAST(time AS DATE) AS date, CAST(hour(time) AS INTEGER) AS hour,
       CAST(year(time) AS INTEGER) AS year, strftime(time, '%Y-%m') AS month FROM scored"""
    q["fear_greed_score"] = S + f"""
SELECT comment_id, stock_code, {r8('prob_greed * 100')} AS fear_greed_score FROM scored"""
    q["daily_sentiment"] = SC + f"""
SELECT stock_code, date, {r8('fear_ratio')} AS fear_ratio, {r8('neutral_ratio')} AS neutral_ratio,
       {r8('greed_ratio')} AS greed_ratio FROM d"""
    q["preview_daily"] = q["daily_sentiment"] + "\nORDER BY stock_code, date LIMIT 5"
    q["hourly_score"] = S + f"""
SELECT stock_code, year, hour, {r8('avg_score')} AS avg_score FROM ({hourly_agg()})"""
    q["monthly_score"] = S + f"""
SELECT stock_code, strftime(time, '%Y-%m') AS month,
       {r8('avg(prob_greed * 100)')} AS avg_score
FROM scored WHERE time IS NOT NULL GROUP BY 1, 2"""
    for order, key in (("hour", "change_rate_hourly"), ("arrival", "change_rate_arrival")):
        q[key] = S + f"""
SELECT stock_code, year, hour, {r8('change_rate')} AS change_rate FROM ({change_agg(order)})"""
    q["yearly_series"] = S + f"""
SELECT stock_code, year, hour, {r8('change_rate')} AS change_rate FROM ({change_agg('hour')})
WHERE year IS NOT NULL AND hour IS NOT NULL ORDER BY stock_code, year, hour"""
    q["distinct_years"] = S + f"""
SELECT DISTINCT stock_code, year FROM ({change_agg('hour')}) WHERE year IS NOT NULL"""
    q["indicators"] = S + f"""
SELECT coalesce(h.stock_code, c.stock_code) AS stock_code, coalesce(h.year, c.year) AS year,
       coalesce(h.hour, c.hour) AS hour, {r8('h.avg_score')} AS avg_score,
       {r8('c.change_rate')} AS change_rate
FROM ({hourly_agg()}) h FULL OUTER JOIN ({change_agg('hour')}) c
  ON h.stock_code = c.stock_code AND h.year = c.year AND h.hour = c.hour"""
    q["moving_average"] = with_(MOVING) + f"""
SELECT stock_code, month, {r4('avg_score')} AS avg_score, {r4('short_ma')} AS short_ma,
       {r4('long_ma')} AS long_ma FROM ma"""
    q["cross_signal"] = with_(MOVING) + f"""
SELECT stock_code, month, {r4('avg_score')} AS avg_score, {r4('short_ma')} AS short_ma,
       {r4('long_ma')} AS long_ma,
       CASE WHEN dd IS NULL OR pd IS NULL THEN NULL
            WHEN pd <= 0 AND dd > 0 THEN 'golden'
            WHEN pd >= 0 AND dd < 0 THEN 'dead' ELSE 'none' END AS signal
FROM (SELECT *, short_ma - long_ma AS dd,
             lag(short_ma - long_ma) OVER (PARTITION BY stock_code ORDER BY month) AS pd FROM ma)"""
    q["typed_indicators"] = S + f"""
SELECT stock_code, date, CAST(hour AS TINYINT) AS hour,
       CAST(CAST((2 * sf + nf) // (2 * nf) / CAST(10000 AS DOUBLE) AS DECIMAL(5,4)) AS DOUBLE)
         AS fear_ratio,
       CAST(CAST((2 * sn + nn) // (2 * nn) / CAST(10000 AS DOUBLE) AS DECIMAL(5,4)) AS DOUBLE)
         AS neutral_ratio,
       CAST(CAST((2 * sg + ng) // (2 * ng) / CAST(10000 AS DOUBLE) AS DECIMAL(5,4)) AS DOUBLE)
         AS greed_ratio,
       CAST(CAST((2 * sg + ng) // (2 * ng) / CAST(100 AS DOUBLE) AS DECIMAL(5,2)) AS DOUBLE)
         AS fear_greed_index,
       TIMESTAMP '{P.RUN1}' AS created_at
FROM (SELECT stock_code, CAST(time AS DATE) AS date, CAST(hour(time) AS INTEGER) AS hour,
             sum({prob_units('prob_fear')}) AS sf, count({prob_units('prob_fear')}) AS nf,
             sum({prob_units('prob_neutral')}) AS sn, count({prob_units('prob_neutral')}) AS nn,
             sum({prob_units('prob_greed')}) AS sg, count({prob_units('prob_greed')}) AS ng
      FROM scored WHERE time IS NOT NULL GROUP BY 1, 2, 3)"""
    q["typed_monthly"] = S + f"""
SELECT stock_code, CAST(y AS SMALLINT) AS year, CAST(m AS TINYINT) AS month,
       CAST(CAST((2 * s + n) // (2 * n) / CAST(100 AS DOUBLE) AS DECIMAL(5,2)) AS DOUBLE)
         AS avg_fear_greed,
       TIMESTAMP '{P.RUN1}' AS created_at
FROM (SELECT stock_code, year(time) AS y, month(time) AS m, sum({SCORE_UNITS}) AS s,
             count({SCORE_UNITS}) AS n
      FROM scored WHERE time IS NOT NULL GROUP BY 1, 2, 3)"""
    q["constraint_check"] = S + """
SELECT * FROM (
  SELECT 'duplicate_key' AS kind, 'stock_code,date,hour' AS "column", count(*) AS n
  FROM (SELECT stock_code, CAST(time AS DATE) AS d, hour(time) AS h FROM scored
        GROUP BY 1, 2, 3 HAVING count(*) > 1)
  UNION ALL SELECT 'null', 'stock_code', count(*) FILTER (WHERE stock_code IS NULL) FROM scored
  UNION ALL SELECT 'null', 'time', count(*) FILTER (WHERE time IS NULL) FROM scored
  UNION ALL SELECT 'null', 'prob_fear', count(*) FILTER (WHERE prob_fear IS NULL) FROM scored
  UNION ALL SELECT 'null', 'prob_neutral', count(*) FILTER (WHERE prob_neutral IS NULL) FROM scored
  UNION ALL SELECT 'null', 'prob_greed', count(*) FILTER (WHERE prob_greed IS NULL) FROM scored)
WHERE n > 0"""

    t_where = f"WHERE time < TIMESTAMP '{P.TARGET_END}'"
    u_where = f"WHERE time >= TIMESTAMP '{P.UPDATE_START}'"
    q["upsert_daily"] = upsert_sql(daily_agg(t_where), daily_agg(u_where),
                                   ["stock_code", "date"],
                                   ["fear_ratio", "neutral_ratio", "greed_ratio"], (SCORED,))
    q["upsert_hourly"] = upsert_sql(hourly_agg(t_where), hourly_agg(u_where),
                                    ["stock_code", "year", "hour"], ["avg_score"], (SCORED,))
    q["upsert_change_rate"] = upsert_sql(change_agg("hour", t_where),
                                         change_agg("hour", u_where),
                                         ["stock_code", "year", "hour"], ["change_rate"],
                                         (SCORED,))
    q["upsert_monthly"] = upsert_sql(
        order_monthly(f"o_orderdate < TIMESTAMP '{P.ORDERS_TARGET_END}'"),
        order_monthly(f"o_orderdate >= TIMESTAMP '{P.ORDERS_UPDATE_START}'"),
        ["stock_code", "month"], ["avg_score"], rnd=r4)

    q["publish_versions"] = upsert_sql(
        daily_agg(t_where), daily_agg(f"{u_where} AND stock_code <> {_q(P.FAILING_ENTITY)}"),
        ["stock_code", "date"], ["fear_ratio", "neutral_ratio", "greed_ratio"], (SCORED,))
    q["rerun_idempotent"] = q["indicators"]
    q["states_daily"] = q["daily_sentiment"]

    q["entity_filter"] = with_(COMMENTS) + f"""
SELECT comment_id, stock_code FROM comments WHERE stock_code = {_q(P.ENTITY)}"""
    q["url_filter"] = """
SELECT doc_id, source FROM documents WHERE text IS NULL OR NOT """ + has_url("text")
    q["topic_filter"] = f"""
SELECT doc_id, source FROM documents WHERE NOT {contains_any(f"coalesce({nsp}, '')", P.TOPIC_WORDS)}"""
    q["topic_anti_join"] = f"""
SELECT doc_id, source FROM documents WHERE text IS NULL OR NOT {contains_any(nsp, P.TOPIC_WORDS)}"""
    q["topic_semi_join"] = f"""
SELECT doc_id, source FROM documents WHERE {contains_any(nsp, P.TOPIC_WORDS)}"""
    q["clean_text_tfidf"] = f"SELECT page_id, {clean_tfidf('html')} AS text_tfidf FROM pages"
    q["clean_text_bert"] = f"SELECT page_id, {clean_bert('html')} AS text_bert FROM pages"
    q["preprocess"] = PRE + "SELECT * FROM pre"
    q["stage_counts"] = PRE + f"""
SELECT 'raw' AS stage, count(*) AS n FROM comments
UNION ALL SELECT 'with_text_and_time', count(*) FROM comments
  WHERE text IS NOT NULL AND time IS NOT NULL
UNION ALL SELECT 'off_topic', count(*) FROM comments
  WHERE text IS NOT NULL AND time IS NOT NULL AND NOT {contains_any(nsp, P.TOPIC_WORDS)}
UNION ALL SELECT 'filtered', count(*) FROM pre"""
    q["lexicon_hits"] = LAB + "SELECT comment_id, fh AS fear_hits, gh AS greed_hits FROM labeled"
    q["weak_label"] = LAB + "SELECT comment_id, stock_code, label FROM labeled"
    q["weak_label_files"] = with_(COMMENTS, preprocessed(), labeled(P.FEAR_WORDS_LONG, P.GREED_WORDS_LONG)) + """
SELECT comment_id, fh AS fear_hits, gh AS greed_hits, label FROM labeled"""
    raw = with_(COMMENTS, """
pre AS (SELECT comment_id, stock_code, text AS text_tfidf FROM comments WHERE time IS NOT NULL)
""", LABELED)
    q["weak_label_raw"] = raw + "SELECT comment_id, stock_code, label FROM labeled"
    raw_350 = with_(COMMENTS, """
pre AS (SELECT comment_id, stock_code, text AS text_tfidf FROM comments WHERE time IS NOT NULL)
""", labeled(P.FEAR_WORDS_LONG, P.GREED_WORDS_LONG))
    q["weak_label_raw_350"] = raw_350 + "SELECT comment_id, stock_code, label FROM labeled"
    hits = f"SELECT doc_id, {many_hits('text', P.WORDS_3500)} AS hits FROM documents"
    q["keyword_hits_3500"] = q["keyword_index_hits"] = hits
    q["topic_index_semi"] = q["topic_semi_join"]
    q["label_distribution_raw"] = raw + "SELECT label, count(*) AS n FROM labeled GROUP BY 1 ORDER BY 1"
    q["label_distribution"] = LAB + "SELECT label, count(*) AS n FROM labeled GROUP BY 1 ORDER BY 1"
    q["sample_n"] = S + f"""
SELECT comment_id, stock_code FROM (
  SELECT comment_id, stock_code, row_number() OVER (
    PARTITION BY stock_code ORDER BY md5(CAST(comment_id AS VARCHAR) || ':{P.SAMPLE_SEED}'),
    comment_id) AS rn FROM scored)
WHERE rn <= {P.SAMPLE_N}"""
    q["stratified_split"] = _split_sql(
        "SELECT doc_id AS id, quality AS label FROM labels", "doc_id")
    q["train_input"] = LAB + _split_sql(
        "SELECT comment_id AS id, label FROM labeled", "comment_id", with_kw=False,
        extra_where="id IN (SELECT comment_id FROM labeled WHERE text_bert IS NOT NULL "
                    "AND length(text_bert) > 0)")
    q["tokenize_words"] = PRE + f"""
SELECT comment_id AS doc_id, term, count(*) AS tf
FROM (SELECT comment_id, unnest(regexp_extract_all(lower(coalesce(text_tfidf, '')),
                                                   {_q(TOKEN_RE)})) AS term FROM pre)
GROUP BY 1, 2"""
    q["word_top50"] = PRE + f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(
        lower(regexp_replace(coalesce(text_tfidf, ''), {_q(WORD_COUNT_DROP_RE)}, '', 'g')),
        {_q(NON_SPACE_RUN_RE)})) AS word FROM pre)
GROUP BY 1 ORDER BY count DESC, word ASC LIMIT 50"""
    q["tfidf_top30"] = PRE + f""",
t AS (SELECT comment_id AS doc_id, unnest(regexp_extract_all(lower(coalesce(text_tfidf, '')),
                                                              {_q(TOKEN_RE)})) AS w FROM pre),
tf AS (SELECT doc_id, w, count(*) AS c FROM t GROUP BY 1, 2),
v AS (SELECT w, count(*) AS df, sum(c) AS tc FROM tf GROUP BY 1 ORDER BY tc DESC, w LIMIT 1000),
n AS (SELECT count(*) AS n FROM pre),
x AS (SELECT tf.doc_id, tf.w, tf.c * (ln((1.0 + n.n) / (1.0 + v.df)) + 1) AS s
      FROM tf JOIN v ON tf.w = v.w, n),
nm AS (SELECT doc_id, sqrt(sum(s * s)) AS z FROM x GROUP BY 1)
SELECT w AS term, {r8('sum(s / z)')} AS score FROM x JOIN nm ON x.doc_id = nm.doc_id
GROUP BY 1 ORDER BY score DESC, term LIMIT 30"""
    q["token_window"] = f"""
WITH t AS (SELECT conv_id, turn,
                  regexp_extract_all({clean_bert("coalesce(text, '')")}, {_q(NON_SPACE_RUN_RE)}) AS toks
           FROM conversations),
w AS (SELECT conv_id, turn, toks,
             unnest(range(0, greatest(1, CAST(ceil(len(toks) / 128) AS BIGINT)))) AS chunk FROM t)
SELECT conv_id, turn, CAST(chunk AS INTEGER) AS chunk,
       CAST(len(toks[chunk * 128 + 1 : chunk * 128 + 128]) AS INTEGER) AS n_real,
       array_to_string(list_resize(toks[chunk * 128 + 1 : chunk * 128 + 128], 128, '{P.PAD}'), ' ')
         AS window_text
FROM w"""
    q["scan_csv"] = "SELECT doc_id, source, CAST(length(text) AS INTEGER) AS n_chars FROM documents"
    q["scan_csv_split"] = q["scan_csv"]
    q["scan_rejects"] = """
SELECT event_id, CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing value' ELSE 'good' END AS status
FROM events"""
    nb = LAB + ",\n" + BAYES
    q["bayes_model"] = nb + f"SELECT term, {r8('w0')} AS w0, {r8('w1')} AS w1, {r8('w2')} AS w2 FROM model"
    q["bayes_score"] = nb + """
SELECT comment_id, stock_code, round(e0 / (e0 + e1 + e2), 4) AS prob_fear, round(e1 / (e0 + e1 + e2), 4) AS prob_neutral,
       round(e2 / (e0 + e1 + e2), 4) AS prob_greed, pred_label FROM scored_nb"""
    q["bayes_evaluate"] = nb + f"""
, v AS (SELECT s.*, split.label AS y FROM scored_nb s JOIN split USING (comment_id) WHERE split.split = 'valid' AND length(text_bert) > 0),
m AS (SELECT avg(CASE WHEN y = pred_label THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS accuracy,
             avg(-ln(greatest((CASE y WHEN 0 THEN e0 WHEN 1 THEN e1 ELSE e2 END) / (e0 + e1 + e2), 1e-15))) AS loss FROM v)
SELECT 'accuracy' AS metric, {r8('accuracy')} AS value FROM m UNION ALL SELECT 'logLoss', {r8('loss')} FROM m"""
    gd = LAB + "," + _epoch_ctes()
    cols = ("train_loss", "valid_loss", "accuracy", "f1")
    q["train_epochs"] = gd + " UNION ALL ".join(
        f"SELECT epoch, {', '.join(f'{r8(c)} AS {c}' for c in cols)} FROM m{k}" for k in range(P.EPOCHS + 1))
    z = ", ".join(f"sum(every.x * coalesce(a{c}, 0)) AS z{c}" for c in range(3))
    e = " + ".join(f"exp(z{c})" for c in range(3))
    ps = ", ".join(f"{r8(f'exp(z{c}) / ({e})')} AS prob_{n}" for c, n in enumerate(("fear", "neutral", "greed")))
    # the loss of these data falls in every epoch, so the last weights are the best
    q["epoch_score"] = gd + f"""
SELECT comment_id, stock_code, {ps} FROM pre JOIN (
  SELECT comment_id, {z} FROM every LEFT JOIN w{P.EPOCHS} USING (b) GROUP BY 1) USING (comment_id)"""
    q["observed_counts"] = q["stage_counts"] + """
UNION ALL SELECT 'labelled', count(*) FROM pre
UNION ALL SELECT * FROM (WITH """ + LABELED.strip() + """
SELECT 'label_' || c AS stage, (SELECT count(*) FROM labeled WHERE label = c) AS n FROM range(3) t(c))"""
    q["map_batches"] = f"""
SELECT conv_id, turn, CAST(length(coalesce(text, '')) AS INTEGER) AS n_chars,
       CAST(len(regexp_extract_all(coalesce(text, ''), {_q(NON_SPACE_RUN_RE)})) AS INTEGER) AS n_words
FROM conversations"""
    return q


def _split_sql(src: str, id_name: str, with_kw: bool = True, extra_where: str = "") -> str:
    seed = P.SPLIT_SEED
    body = f"""
s0 AS ({src}),
s AS (SELECT label, count(*) AS n, (SELECT count(*) FROM s0) AS tot FROM s0 GROUP BY 1),
u AS (SELECT *, CAST(ceil({P.TEST_SIZE} * tot) AS BIGINT) AS k FROM s),
r AS (SELECT *, (n * k) // tot AS b, (n * k) % tot AS rem FROM u),
q AS (SELECT label, b + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                              <= k - sum(b) OVER () THEN 1 ELSE 0 END AS quota FROM r),
ranked AS (SELECT s0.id, s0.label, row_number() OVER (
             PARTITION BY s0.label ORDER BY md5(CAST(s0.id AS VARCHAR) || ':{seed}'), s0.id) AS rn
           FROM s0)
SELECT ranked.id AS {id_name}, ranked.label,
       CASE WHEN ranked.rn <= q.quota THEN 'valid' ELSE 'train' END AS split
FROM ranked JOIN q ON ranked.label = q.label"""
    if extra_where:
        body += f"\nWHERE {extra_where.replace('id IN', 'ranked.id IN')}"
    return ("WITH " if with_kw else ",\n") + body.strip() + "\n"


# Temporal output columns per key, rendered as ISO text like the Spark side.
_D, _T = "%Y-%m-%d", "%Y-%m-%d %H:%M:%S.%f"
TEMPORAL = {
    "daily_sentiment": {"date": _D},
    "preview_daily": {"date": _D},
    "time_parts": {"date": _D},
    "typed_indicators": {"date": _D, "created_at": _T},
    "typed_monthly": {"created_at": _T},
    "upsert_daily": {"date": _D, "created_at": _T, "updated_at": _T},
    "publish_versions": {"date": _D, "created_at": _T, "updated_at": _T},
    "states_daily": {"date": _D},
    "upsert_hourly": {"created_at": _T, "updated_at": _T},
    "upsert_monthly": {"created_at": _T, "updated_at": _T},
    "upsert_change_rate": {"created_at": _T, "updated_at": _T},
    "preprocess": {"time": _T},
}


def presented(q: dict[str, str]) -> dict[str, str]:
    out = dict(q)
    for k, cols in TEMPORAL.items():
        if k in out:
            rep = ", ".join(f"strftime({c}, '{f}') AS {c}" for c, f in cols.items())
            out[k] = f"SELECT * REPLACE ({rep}) FROM ({out[k]})"
    return out
