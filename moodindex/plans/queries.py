"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator key of the build plan, over the test tables.

Floating outputs are cut to a grid of 1e-8 (prices: 1e-4) on both sides of
the oracle comparison, after a shift that is no simple fraction: a mean of
values with few decimals then never lies on a step of the grid, where the
order of a sum could decide.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodindex.operators import bayes, counts, epochs, filters, indicators as ind, keyword_index, lexicon, model, sampling, snapshots, states, text_stats
from moodindex.operators.upsert import constraint_check, upsert
from moodindex.plans import params as P
from moodindex.plans.jobs import Lexicons
from moodindex.session import remove_path, scratch_path
from moodindex.sources import io, split_csv, tables

Query = Callable[[SparkSession, str], DataFrame]


def r8(c: str) -> Column:
    return F.expr(f"floor(`{c}` * 1.0E8D + 0.4142D) / 1.0E8D")


def r4(c: str) -> Column:
    """Price-scale values (about 1e5) keep 4 decimals."""
    return F.expr(f"floor(`{c}` * 1.0E4D + 0.4142D) / 1.0E4D")


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


# Temporal columns leave the registered queries as ISO text, so that the
# oracle comparison does not depend on how each engine hands dates and
# timestamps to Python.  The library itself keeps DATE / TIMESTAMP types.
DATE_FMT = "yyyy-MM-dd"
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame) -> DataFrame:
    from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), DATE_FMT).alias(f.name))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), TS_FMT).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- indicator queries over scored events -----------------------------------

def q_softmax_argmax(spark, sf):
    return tables.scored_events(spark, sf).select(
        "comment_id", "prob_fear", "prob_neutral", "prob_greed", "pred_label")


def q_time_parts(spark, sf):
    from moodindex.functions.time import with_time_parts
    return with_time_parts(tables.scored_events(spark, sf)).select(
        "comment_id", "stock_code", "date", "hour", "year", "month")


def q_fear_greed_score(spark, sf):
    s = ind.with_score(tables.scored_events(spark, sf))
    return s.select("comment_id", "stock_code", r8(ind.SCORE).alias("fear_greed_score"))


def _daily(spark, sf):
    d = ind.daily_sentiment(tables.scored_events(spark, sf))
    return d.select("stock_code", "date", *[r8(c).alias(c) for c in
                                            ("fear_ratio", "neutral_ratio", "greed_ratio")])


def q_daily_sentiment(spark, sf):
    return _daily(spark, sf)


def q_preview_daily(spark, sf):
    return ind.preview(_daily(spark, sf), ["stock_code", "date"], 5)


def q_hourly_score(spark, sf):
    h = ind.hourly_score(tables.scored_events(spark, sf))
    return h.select("stock_code", "year", "hour", r8("avg_score").alias("avg_score"))


def q_monthly_score(spark, sf):
    m = ind.monthly_score(tables.scored_events(spark, sf))
    return ind.monthly_series(m).select("stock_code", "month", r8("avg_score").alias("avg_score"))


def _change(spark, sf, order="hour"):
    return ind.change_rate(tables.scored_events(spark, sf), order=order)


def q_change_rate_hourly(spark, sf):
    c = _change(spark, sf, "hour")
    return c.select("stock_code", "year", "hour", r8("change_rate").alias("change_rate"))


def q_change_rate_arrival(spark, sf):
    c = _change(spark, sf, "arrival")
    return c.select("stock_code", "year", "hour", r8("change_rate").alias("change_rate"))


def q_yearly_series(spark, sf):
    return ind.yearly_series(q_change_rate_hourly(spark, sf))


def q_distinct_years(spark, sf):
    return ind.distinct_years(_change(spark, sf))


def q_indicators(spark, sf):
    """Indicator job (E3): hourly score and change rate from one aggregate."""
    j = ind.score_and_change(tables.scored_events(spark, sf))
    return j.select("stock_code", "year", "hour", r8("avg_score").alias("avg_score"),
                    r8("change_rate").alias("change_rate"))


def _orders_ma(spark, sf):
    series = tables.order_series(spark, sf)
    monthly = ind.monthly_score(series, time_col="time", score="score")
    return ind.moving_average(monthly, P.MA_SHORT, P.MA_LONG)


def q_moving_average(spark, sf):
    ma = _orders_ma(spark, sf)
    return ma.select("stock_code", "month", *[r4(c).alias(c) for c in
                                              ("avg_score", "short_ma", "long_ma")])


def q_cross_signal(spark, sf):
    cs = ind.cross_signal(_orders_ma(spark, sf))
    return cs.select("stock_code", "month", *[r4(c).alias(c) for c in
                                              ("avg_score", "short_ma", "long_ma")], "signal")


def q_typed_indicators(spark, sf):
    return ind.typed_indicators(tables.scored_events(spark, sf), created_at=_ts(P.RUN1))


def q_typed_monthly(spark, sf):
    return ind.typed_monthly(tables.scored_events(spark, sf), created_at=_ts(P.RUN1))


def q_constraint_check(spark, sf):
    from moodindex.functions.time import with_time_parts
    s = with_time_parts(tables.scored_events(spark, sf))
    return constraint_check(s, ["stock_code", "date", "hour"],
                            ["stock_code", "time", "prob_fear", "prob_neutral", "prob_greed"])


# -- upserts: a first run (before TARGET_END) merged with a re-run ----------

def _two_runs(spark, sf, build, keys, measures, orders=False):
    rnd = r4 if orders else r8
    if orders:
        src = tables.order_series(spark, sf)
        t_src = src.where(F.col("time") < _ts(P.ORDERS_TARGET_END))
        u_src = src.where(F.col("time") >= _ts(P.ORDERS_UPDATE_START))
    else:
        src = tables.scored_events(spark, sf)
        t_src = src.where(F.col("time") < _ts(P.TARGET_END))
        u_src = src.where(F.col("time") >= _ts(P.UPDATE_START))
    first = upsert(None, build(t_src), keys, measures, _ts(P.RUN1))
    merged = upsert(first, build(u_src), keys, measures, _ts(P.RUN2))
    return merged.select(*keys, *[rnd(m).alias(m) for m in measures], "created_at", "updated_at")


def q_upsert_daily(spark, sf):
    return _two_runs(spark, sf, ind.daily_sentiment, ["stock_code", "date"],
                     ["fear_ratio", "neutral_ratio", "greed_ratio"])


def q_upsert_hourly(spark, sf):
    return _two_runs(spark, sf, ind.hourly_score, ["stock_code", "year", "hour"], ["avg_score"])


def q_upsert_change_rate(spark, sf):
    return _two_runs(spark, sf, ind.change_rate, ["stock_code", "year", "hour"], ["change_rate"])


def q_upsert_monthly(spark, sf):
    def build(df):
        return ind.monthly_score(df, score="score")
    return _two_runs(spark, sf, build, ["stock_code", "month"], ["avg_score"], orders=True)


def q_publish_versions(spark, sf):
    """The daily table after a second publishing in which one entity's batch
    breaks a rule: that entity keeps its first version, the others are merged."""
    path = scratch_path(spark, f"publish-{uuid.uuid4().hex}")
    src = tables.scored_events(spark, sf)
    keys, measures = ["stock_code", "date"], ["fear_ratio", "neutral_ratio", "greed_ratio"]
    first = ind.daily_sentiment(src.where(F.col("time") < _ts(P.TARGET_END)))
    second = ind.daily_sentiment(src.where(F.col("time") >= _ts(P.UPDATE_START)))
    second = second.unionByName(second.where(F.col("stock_code") == P.FAILING_ENTITY))
    snapshots.publish(spark, path, first, keys, measures, _ts(P.RUN1))
    snapshots.publish(spark, path, second, keys, measures, _ts(P.RUN2))
    out = snapshots.read_snapshot(spark, path).select(
        *keys, *[r8(m).alias(m) for m in measures], "created_at", "updated_at").checkpoint()
    remove_path(spark, path)
    return out


def _refreshed(spark, sf):
    """States of a first run before TARGET_END, then of every later day, twice;
    the source is partitioned by date."""
    base = scratch_path(spark, f"states-{uuid.uuid4().hex}")
    src = tables.scored_events(spark, sf)
    src.withColumn("date", F.to_date("time")).write.partitionBy("date").parquet(f"{base}/source")
    source = spark.read.parquet(f"{base}/source")
    states.refresh_days(source.where(F.col("time") < _ts(P.TARGET_END)), f"{base}/states")
    late = source.where(F.col("date") >= F.to_date(_ts(P.TARGET_END))).select("date").distinct()
    days = [r["date"] for r in late.collect()]  # days of a calendar
    for _ in range(2):
        states.refresh_days(source, f"{base}/states", days)
    out = states.read_states(spark, f"{base}/states").checkpoint()
    remove_path(spark, base)
    return out


def q_rerun_idempotent(spark, sf):
    """Hourly score and change rate folded from incremental states."""
    return states.fold_change(_refreshed(spark, sf)).select(
        "stock_code", "year", "hour", r8("avg_score").alias("avg_score"), r8("change_rate").alias("change_rate"))


def q_states_daily(spark, sf):
    """Daily ratios folded from incremental states."""
    return states.fold_daily(_refreshed(spark, sf)).select(
        "stock_code", "date", *[r8(c).alias(c) for c in states.RATIOS])


# -- text: filters, cleaning, labels ----------------------------------------

def _pre(spark, sf):
    return filters.preprocess(tables.comments(spark, sf), P.TOPIC_WORDS)


def _labeled(spark, sf):
    return lexicon.weak_label(_pre(spark, sf), P.FEAR_WORDS, P.GREED_WORDS, keep_hits=True)


def q_entity_filter(spark, sf):
    return io.entity_filter(tables.comments(spark, sf), P.ENTITY).select("comment_id", "stock_code")


def _docs(spark, sf):
    return tables.table(spark, sf, "documents")


def q_url_filter(spark, sf):
    return filters.url_filter(_docs(spark, sf)).select("doc_id", "source")


def q_topic_filter(spark, sf):
    return filters.topic_filter(_docs(spark, sf), P.TOPIC_WORDS, how="anti").select("doc_id", "source")


def _topic_lexicon(spark):
    return spark.createDataFrame([(w,) for w in P.TOPIC_WORDS], "keyword string")


def q_topic_anti_join(spark, sf):
    return filters.topic_filter_join(_docs(spark, sf), _topic_lexicon(spark),
                                     how="left_anti").select("doc_id", "source")


def q_topic_semi_join(spark, sf):
    return filters.topic_filter_join(_docs(spark, sf), _topic_lexicon(spark),
                                     how="left_semi").select("doc_id", "source")


def q_clean_text_tfidf(spark, sf):
    from moodindex.functions.text import clean_tfidf
    return tables.table(spark, sf, "pages").select("page_id", clean_tfidf("html").alias("text_tfidf"))


def q_clean_text_bert(spark, sf):
    from moodindex.functions.text import clean_bert
    return tables.table(spark, sf, "pages").select("page_id", clean_bert("html").alias("text_bert"))


def q_preprocess(spark, sf):
    return _pre(spark, sf)


def q_stage_counts(spark, sf):
    """Row counts of each filtering stage (A8), in one aggregation pass."""
    from moodindex.functions.text import contains_any_nospace, has_url
    c = tables.comments(spark, sf)
    ok = F.col("text").isNotNull() & F.col("time").isNotNull()
    on_topic = contains_any_nospace("text", P.TOPIC_WORDS)
    agg = c.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count(F.when(ok, 1)).alias("with_text_and_time"),
        F.count(F.when(ok & ~on_topic, 1)).alias("off_topic"),
        F.count(F.when(ok & ~on_topic & ~has_url("text"), 1)).alias("filtered"),
    )
    return agg.selectExpr("stack(4, 'raw', raw, 'with_text_and_time', with_text_and_time, "
                          "'off_topic', off_topic, 'filtered', filtered) as (stage, n)")


def q_observed_counts(spark, sf):
    """The same counts, and those of the labels, as a by-product of the plan that
    writes the labelled comments (A5, A8)."""
    seen = counts.Counts()
    pre = filters.preprocess(tables.comments(spark, sf), P.TOPIC_WORDS, counts=seen)
    lab = lexicon.weak_label(pre, P.FEAR_WORDS, P.GREED_WORDS)
    lab = seen.stage(lab, "labelled", **{f"label_{c}": F.col("label") == c for c in range(3)})
    path = scratch_path(spark, f"observed-{uuid.uuid4().hex}")
    io.write_table(lab, path)
    seen.ran()
    if not counts.checked(seen, "labelled", spark.read.parquet(path)):
        raise RuntimeError("a task before a shuffle ran twice: the counts are too high")
    remove_path(spark, path)
    return seen.table(spark)


def q_lexicon_hits(spark, sf):
    return _labeled(spark, sf).select("comment_id", "fear_hits", "greed_hits")


def q_weak_label(spark, sf):
    return _labeled(spark, sf).select("comment_id", "stock_code", "label")


def q_weak_label_files(spark, sf):
    """Labels from lexicon files of a real size (350 words of our own rule,
    written to the shared scratch folder, read back like any lexicon)."""
    base = scratch_path(spark, f"lexicon-{uuid.uuid4().hex}")
    words = {"topic": P.TOPIC_WORDS, "fear": P.FEAR_WORDS_LONG, "greed": P.GREED_WORDS_LONG}
    for name, ws in words.items():
        rows = [(w + " \t",) for w in ws] + [("  ",)]
        spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{base}/{name}")
    lex = Lexicons.from_files(spark, *[f"{base}/{n}" for n in words])
    remove_path(spark, base)
    pre = filters.preprocess(tables.comments(spark, sf), lex.topic)
    return lexicon.weak_label(pre, lex.fear, lex.greed, keep_hits=True).select(
        "comment_id", "fear_hits", "greed_hits", "label")


def q_weak_label_raw(spark, sf):
    """The baseline's own task: labels of the raw texts, without filters and cleaning."""
    c = tables.comments(spark, sf).where(F.col("time").isNotNull())
    return lexicon.weak_label(c, P.FEAR_WORDS, P.GREED_WORDS, "text").select("comment_id", "stock_code", "label")


def q_weak_label_raw_350(spark, sf):
    """The same with lexicons of 214 and 136 words."""
    c = tables.comments(spark, sf).where(F.col("time").isNotNull())
    return lexicon.weak_label(c, P.FEAR_WORDS_LONG, P.GREED_WORDS_LONG, "text").select("comment_id", "stock_code", "label")


def q_keyword_hits_3500(spark, sf):
    """Distinct keywords of a lexicon of 3,500 words in each raw text."""
    from moodindex.functions.text import lexicon_hit_count
    return _docs(spark, sf).select("doc_id", lexicon_hit_count("text", P.WORDS_3500).alias("hits"))


def _keyword_rows(spark, words):
    return spark.createDataFrame([(w,) for w in words], "keyword string")


def q_keyword_index_hits(spark, sf):
    """The same hits with the lexicon as a table, through its anchor index."""
    docs = _docs(spark, sf).select("doc_id", "text")
    return keyword_index.hit_counts(docs, _keyword_rows(spark, P.WORDS_3500), "doc_id", "text").drop("text")


def q_topic_index_semi(spark, sf):
    """Texts without white space that hold a topic keyword, through the anchor index."""
    from moodindex.functions.text import remove_space
    docs = _docs(spark, sf).select("doc_id", "source", remove_space("text").alias("text"))
    return keyword_index.mentioning(docs, _topic_lexicon(spark), "doc_id", "text", "left_semi").drop("text")


def q_label_distribution_raw(spark, sf):
    return lexicon.label_distribution(q_weak_label_raw(spark, sf))


def q_label_distribution(spark, sf):
    return lexicon.label_distribution(_labeled(spark, sf))


def q_sample_n(spark, sf):
    s = tables.scored_events(spark, sf)
    return sampling.sample_n(s, P.SAMPLE_N, P.SAMPLE_SEED, "comment_id").select(
        "comment_id", "stock_code")


def q_stratified_split(spark, sf):
    labels = tables.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return sampling.stratified_split(labels, "label", "doc_id", P.TEST_SIZE, P.SPLIT_SEED)


def _split_labeled(spark, sf):
    # The split reads the labelled comments three times, and every later pass reads
    # them with their split: texts are cleaned and labelled once, and both are
    # written to the checkpoint folder.
    lab = _labeled(spark, sf).select("comment_id", "stock_code", "text_bert", "label").checkpoint()
    return sampling.stratified_split(lab, "label", "comment_id", P.TEST_SIZE, P.SPLIT_SEED).checkpoint()


def q_train_input(spark, sf):
    return filters.train_input(_split_labeled(spark, sf)).select("comment_id", "label", "split")


def q_tokenize_words(spark, sf):
    return text_stats.term_frequencies(_pre(spark, sf), "comment_id", "text_tfidf")


def q_word_top50(spark, sf):
    # text_tfidf is the counting cleaner's output, hence normalized
    return text_stats.top_words(_pre(spark, sf), "text_tfidf", P.WORD_TOP_K, normalized=True)


def q_tfidf_top30(spark, sf):
    s = text_stats.tfidf_scores(_pre(spark, sf), "comment_id", "text_tfidf", P.TFIDF_MAX_FEATURES)
    s = s.select("term", r8("score").alias("score"))
    return text_stats.top_k(s, "score", "term", P.TFIDF_TOP_K)


def q_token_window(spark, sf):
    from moodindex.functions.text import clean_bert
    conv = tables.table(spark, sf, "conversations")
    w = text_stats.token_windows(conv, clean_bert(F.coalesce(F.col("text"), F.lit(""))),
                                 ["conv_id", "turn"], P.TOKEN_WINDOW, P.PAD)
    return w.select("conv_id", "turn", F.col("chunk").cast("int").alias("chunk"),
                    F.col("n_real").cast("int").alias("n_real"),
                    F.concat_ws(" ", "tokens").alias("window_text"))


def q_scan_csv(spark, sf):
    """CSV round trip of multi-line texts: written by Spark to the shared
    scratch folder, read back with the comment reader (S1–S3, K1)."""
    docs = _docs(spark, sf).select("doc_id", "source", "text")
    path = scratch_path(spark, f"scan_csv-{uuid.uuid4().hex}")
    io.write_csv(docs, path)
    back = io.read_csv(spark, path, docs.schema)
    back = back.select("doc_id", "source", F.length("text").cast("int").alias("n_chars")).checkpoint()
    remove_path(spark, path)
    return back


def q_scan_csv_split(spark, sf):
    """The same round trip, files read in byte ranges by many tasks: a task of the scan
    writes one file, which is larger than a split where the scan's own split was full."""
    docs = _docs(spark, sf).select("doc_id", "source", "text")
    path = scratch_path(spark, f"scan_csv_split-{uuid.uuid4().hex}")
    io.write_csv(docs, path)
    back = split_csv.read_csv_split(spark, path, docs.schema)
    back = back.select("doc_id", "source", F.length("text").cast("int").alias("n_chars")).checkpoint()
    remove_path(spark, path)
    return back


def q_scan_rejects(spark, sf):
    """Records that fit the schema and those that don't, with the reason: all rows once."""
    e = tables.table(spark, sf, "events")
    raw = e.select(F.col("event_id").cast("string").alias("event_id"), F.expr(
        "CASE event_type WHEN 'error' THEN 'n/a' WHEN 'signup' THEN NULL ELSE CAST(value AS STRING) END").alias("value"))
    path = scratch_path(spark, f"rejects-{uuid.uuid4().hex}")
    io.write_csv(raw, path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    good, bad = split_csv.scan_csv(spark, path, schema, required=["value"])
    out = good.select("event_id", F.lit("good").alias("status")).unionByName(
        bad.select(F.split("text", ",")[0].cast("long").alias("event_id"), F.col("reason").alias("status"))).checkpoint()
    remove_path(spark, path)
    return out


# -- Naive Bayes as tables ---------------------------------------------------

def _bayes(spark, sf):
    data = filters.train_input(_split_labeled(spark, sf))
    return bayes.train(data.where(F.col("split") == "train"), "comment_id", "text_bert", "label").checkpoint(), data


def q_bayes_model(spark, sf):
    m, _ = _bayes(spark, sf)
    return m.where("term IS NOT NULL").select("term", *[r8(f"w{c}").alias(f"w{c}") for c in bayes.CLASSES])


def q_bayes_score(spark, sf):
    m, _ = _bayes(spark, sf)
    pre = _pre(spark, sf).select("comment_id", "stock_code", "text_bert")
    return bayes.score(m, pre, "comment_id", "text_bert").select(
        "comment_id", "stock_code", *bayes.PROB_NAMES, "pred_label")


def q_bayes_evaluate(spark, sf):
    m, data = _bayes(spark, sf)
    valid = data.where(F.col("split") == "valid").select("comment_id", "label", "text_bert")
    return bayes.evaluate(bayes.score(m, valid, "comment_id", "text_bert")).select("metric", r8("value").alias("value"))


# -- training epoch by epoch --------------------------------------------------

def _epochs(labeled):
    data = filters.train_input(labeled)
    return epochs.train(epochs.features(data, "text_bert", "label", "split").checkpoint(), P.EPOCHS, P.RATE)


def q_train_epochs(spark, sf):
    """A row of metrics an epoch (M7, M8)."""
    m = _epochs(_split_labeled(spark, sf)).metrics(spark)
    return m.select("epoch", *[r8(c).alias(c) for c in ("train_loss", "valid_loss", "accuracy", "f1")])


def q_epoch_score(spark, sf):
    """Filtered comments scored by the weights of the best epoch."""
    # every filtered comment has an id (its time came by it), a label and a split: texts are cleaned once
    pre = _split_labeled(spark, sf)
    return epochs.score(pre.select("comment_id", "stock_code", "text_bert"), _epochs(pre), "text_bert").select(
        "comment_id", "stock_code", *[r8(c).alias(c) for c in ("prob_fear", "prob_neutral", "prob_greed")])


# -- model (rows-only checks) ------------------------------------------------

def _model_and_split(spark, sf):
    data = filters.train_input(_split_labeled(spark, sf))
    m = model.train(data.where(F.col("split") == "train"), "text_bert", "label")
    return m, data


def q_train_classifier(spark, sf):
    m, data = _model_and_split(spark, sf)
    valid = data.where(F.col("split") == "valid")
    return model.score(m, valid.select("comment_id", "label", "text_bert")).select(
        "comment_id", "label", "pred_label")


def q_evaluate_classifier(spark, sf):
    m, data = _model_and_split(spark, sf)
    return model.evaluate(m, data.where(F.col("split") == "valid"))


def q_score_comments(spark, sf):
    m, _ = _model_and_split(spark, sf)
    pre = _pre(spark, sf)
    return model.score(m, pre.select("comment_id", "stock_code", "time", "text_bert")).drop("text_bert")


def _batch_lengths(pdf: pd.DataFrame) -> pd.DataFrame:
    text = pdf["text"].fillna("")
    return pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"],
                         "n_chars": text.str.len().astype("int32"),
                         "n_words": text.str.split().str.len().astype("int32")})


def q_map_batches(spark, sf):
    conv = tables.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return model.map_batches(conv, _batch_lengths,
                             "conv_id long, turn long, n_chars int, n_words int", batch_size=32)


QUERIES: dict[str, Query] = {
    "daily_sentiment": q_daily_sentiment,
    "hourly_score": q_hourly_score,
    "monthly_score": q_monthly_score,
    "change_rate_hourly": q_change_rate_hourly,
    "change_rate_arrival": q_change_rate_arrival,
    "moving_average": q_moving_average,
    "cross_signal": q_cross_signal,
    "yearly_series": q_yearly_series,
    "distinct_years": q_distinct_years,
    "preview_daily": q_preview_daily,
    "indicators": q_indicators,
    "time_parts": q_time_parts,
    "fear_greed_score": q_fear_greed_score,
    "softmax_argmax": q_softmax_argmax,
    "typed_indicators": q_typed_indicators,
    "typed_monthly": q_typed_monthly,
    "constraint_check": q_constraint_check,
    "upsert_daily": q_upsert_daily,
    "upsert_hourly": q_upsert_hourly,
    "upsert_monthly": q_upsert_monthly,
    "upsert_change_rate": q_upsert_change_rate,
    "entity_filter": q_entity_filter,
    "url_filter": q_url_filter,
    "topic_filter": q_topic_filter,
    "topic_anti_join": q_topic_anti_join,
    "topic_semi_join": q_topic_semi_join,
    "clean_text_tfidf": q_clean_text_tfidf,
    "clean_text_bert": q_clean_text_bert,
    "preprocess": q_preprocess,
    "stage_counts": q_stage_counts,
    "observed_counts": q_observed_counts,
    "lexicon_hits": q_lexicon_hits,
    "weak_label": q_weak_label,
    "weak_label_files": q_weak_label_files,
    "weak_label_raw": q_weak_label_raw,
    "weak_label_raw_350": q_weak_label_raw_350,
    "keyword_hits_3500": q_keyword_hits_3500,
    "keyword_index_hits": q_keyword_index_hits,
    "topic_index_semi": q_topic_index_semi,
    "label_distribution_raw": q_label_distribution_raw,
    "label_distribution": q_label_distribution,
    "sample_n": q_sample_n,
    "stratified_split": q_stratified_split,
    "train_input": q_train_input,
    "tokenize_words": q_tokenize_words,
    "word_top50": q_word_top50,
    "tfidf_top30": q_tfidf_top30,
    "token_window": q_token_window,
    "scan_csv": q_scan_csv,
    "scan_csv_split": q_scan_csv_split,
    "scan_rejects": q_scan_rejects,
    "publish_versions": q_publish_versions,
    "rerun_idempotent": q_rerun_idempotent,
    "states_daily": q_states_daily,
    "bayes_model": q_bayes_model,
    "bayes_score": q_bayes_score,
    "bayes_evaluate": q_bayes_evaluate,
    "train_epochs": q_train_epochs,
    "epoch_score": q_epoch_score,
    "map_batches": q_map_batches,
    "train_classifier": q_train_classifier,
    "evaluate_classifier": q_evaluate_classifier,
    "score_comments": q_score_comments,
}
