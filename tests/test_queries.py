"""Every registered query against its DuckDB oracle on sf0.001, plus the
entry smoke check and rows-only checks of the model keys."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("orders events documents pages labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canon(df):
    cols = sorted(df.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "item"):
            v = v.item()
        return round(v, 9) if isinstance(v, float) else v
    rows = [tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[key]).df()
    assert canon(got) == canon(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["stock_code", "year", "hour", "avg_score", "change_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["map_batches", "score_comments", "evaluate_classifier"])
def test_rows_only_keys(spark, key):
    pdf = E.queries()[key](spark, SF).toPandas()
    assert len(pdf) > 0
    if key == "score_comments":
        s = pdf[["prob_fear", "prob_neutral", "prob_greed"]].sum(axis=1)
        assert ((s - 1).abs() < 2e-4).all()
        assert set(pdf["pred_label"]) <= {0, 1, 2}
        assert (pdf[["prob_fear", "prob_neutral", "prob_greed"]].max(axis=1) >= 0.9999).mean() < 0.5
    if key == "evaluate_classifier":
        assert sorted(pdf["metric"]) == ["accuracy", "f1", "logLoss"]
    if key == "map_batches":
        assert (pdf["n_chars"] >= 0).all()


def test_every_registered_key_has_oracle_or_is_rows_only():
    own = set(E._q.QUERIES)
    assert own == (set(E.oracle_sql()) & own) | E.ROWS_ONLY
