"""Versioned publishing: whole versions, entities that fail, conflicts, clean-up."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from moodindex.operators import snapshots as S

KEYS, MEAS = ["stock_code", "date"], ["ratio"]
SCHEMA = "stock_code string, date string, ratio double"


def ts(s):
    return F.lit(s).cast("timestamp_ntz")


def put(spark, table, rows, run="2024-02-01", **kw):
    return S.publish(spark, table, spark.createDataFrame(rows, SCHEMA), KEYS, MEAS, ts(run), **kw)


def rows_of(df):
    return sorted((r.stock_code, r.date, r.ratio) for r in df.collect())


@pytest.fixture
def table():
    return os.path.join(tempfile.mkdtemp(prefix="snap-", dir="/tmp"), "t")


def test_versions_are_whole_and_readable_side_by_side(spark, table):
    assert S.read_snapshot(spark, table) is None and S.versions(spark, table) == []
    put(spark, table, [("A", "d1", 0.1), ("B", "d1", 0.2)])
    old = S.read_snapshot(spark, table)
    put(spark, table, [("A", "d1", 0.5), ("C/ü %", "d1", None), (None, "d1", 9.0)], "2024-02-02")
    assert rows_of(old) == [("A", "d1", 0.1), ("B", "d1", 0.2)]  # its files are still there
    assert [r[:2] for r in rows_of(S.read_snapshot(spark, table))] == [("A", "d1"), ("B", "d1"), ("C/ü %", "d1")]
    assert rows_of(S.read_snapshot(spark, table, version=1)) == rows_of(old)
    assert rows_of(S.read_snapshot(spark, table, entities=["A"])) == [("A", "d1", 0.5)]
    a = S.read_snapshot(spark, table, entities=["A"]).first()
    assert str(a.created_at).startswith("2024-02-01") and str(a.updated_at).startswith("2024-02-02")


def test_an_entity_that_breaks_a_rule_keeps_its_version(spark, table):
    put(spark, table, [("A", "d1", 0.1), ("B", "d1", 0.2), ("C", "d1", 0.3)])
    state = put(spark, table, [("A", "d1", 1.0), ("B", "d2", 2.0), ("B", "d2", 3.0), ("C", "d1", None)], required=["ratio"])
    assert state == {"A": None, "B": "duplicate key", "C": "null ratio"}
    assert rows_of(S.read_snapshot(spark, table)) == [("A", "d1", 1.0), ("B", "d1", 0.2), ("C", "d1", 0.3)]
    assert put(spark, table, [("B", "d1", 1.0), ("B", "d1", 1.0)]) == {"B": "duplicate key"}
    assert S.versions(spark, table) == [1, 2]  # nothing to publish, no version


def test_a_job_that_dies_changes_nothing(spark, table, monkeypatch):
    put(spark, table, [("A", "d1", 0.1)])
    monkeypatch.setattr(S, "_write_manifest", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        put(spark, table, [("A", "d1", 0.9)])
    assert rows_of(S.read_snapshot(spark, table)) == [("A", "d1", 0.1)]
    monkeypatch.undo()
    put(spark, table, [("A", "d1", 0.7)])
    assert rows_of(S.read_snapshot(spark, table)) == [("A", "d1", 0.7)]


def test_the_second_of_two_writers_conflicts(spark, table, monkeypatch):
    put(spark, table, [("A", "d1", 0.1)])
    with pytest.raises(S.Conflict):
        put(spark, table, [("A", "d1", 0.2)], read_version=0)
    inner = S.broken_rules  # another writer publishes while this one works

    def meanwhile(*a):
        monkeypatch.undo()
        put(spark, table, [("B", "d1", 0.5)])
        return inner(*a)

    monkeypatch.setattr(S, "broken_rules", meanwhile)
    with pytest.raises(S.Conflict):
        put(spark, table, [("A", "d1", 0.9)])
    assert rows_of(S.read_snapshot(spark, table)) == [("A", "d1", 0.1), ("B", "d1", 0.5)]


def test_vacuum_keeps_what_versions_name(spark, table):
    for k in range(4):
        put(spark, table, [("A", "d1", float(k))] + ([("B", "d1", 0.0)] if not k else []))
    gone = S.vacuum(spark, table, keep=2)
    assert len(gone) == 1 and S.versions(spark, table) == [3, 4]  # the first folder still holds B
    assert rows_of(S.read_snapshot(spark, table)) == [("A", "d1", 3.0), ("B", "d1", 0.0)]
    assert rows_of(S.read_snapshot(spark, table, version=3)) == [("A", "d1", 2.0), ("B", "d1", 0.0)]


def test_updates_are_scanned_once(spark, table):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        reads.add(1)
        yield from batches

    rows = spark.createDataFrame([(e, f"d{k}", 0.5) for e in "ABCD" for k in range(3)], SCHEMA).coalesce(1)
    S.publish(spark, table, rows.mapInArrow(count, SCHEMA), KEYS, MEAS, ts("2024-02-01"))
    assert reads.value == 1
