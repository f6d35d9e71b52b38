"""One large quoted file, read by many tasks, equals the one-task reader."""

import csv
import os
import random
import tempfile

import pytest
from pyspark.sql import types as T

from moodindex.sources import io, split_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("n", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n", bom=""):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(bom)
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "text", "n"])
        w.writerows(rows)


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["plain", "two\nlines", 'say "hi"', "a,b", "\n\n", '""', "é\n공포", "x" * 300, "", "\n" * 40, "q" * 9000 + "\n" + "r" * 9000]
    return [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 4))), rng.choice([1.5, None, -2.0])) for k in range(n)]


@pytest.mark.parametrize("end,bom", [("\n", ""), ("\r\n", "﻿")])
def test_equals_the_one_task_reader(spark, small_splits, end, bom):
    folder = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    for k in range(2):
        write(os.path.join(folder, f"f{k}.csv"), texts(k, 500), end, bom)
    got = split_csv.read_csv_split(spark, folder, SCHEMA)
    assert split_csv._lines(spark, folder).rdd.getNumPartitions() >= 16
    want = io.read_csv(spark, folder, SCHEMA)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 1000


def test_empty_files_blank_lines_and_an_open_quote(spark, small_splits):
    folder = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    bodies = {"a": "", "b": "id,text,n\n", "c": "id,text,n\n\n1,x,2\n\r\n2,y,\n", "d": 'id,text,n\n3,"open,1\n4,z,2\n'}
    for k, v in bodies.items():
        with open(os.path.join(folder, k + ".csv"), "w", newline="") as f:
            f.write(v)
    rows = {(r.file[-5:], r.text) for r in split_csv.records(spark, folder).collect()}
    assert rows == {("c.csv", "1,x,2"), ("c.csv", "2,y,"), ("d.csv", '3,"open,1\n4,z,2\n')} or \
        rows == {("c.csv", "1,x,2"), ("c.csv", "2,y,"), ("d.csv", '3,"open,1\n4,z,2')}


def test_good_and_bad_are_all_rows(spark, small_splits):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-", dir="/tmp"), "f.csv")
    write(path, [(1, "ok", 1.0), (2, "two\nlines", "n/a"), ("x", "bad id", 2), (4, "", 1), (5, "no number", "")])
    with open(path, "a") as f:
        f.write("6,short\n7,long,1.0,extra\n")
    good, bad = split_csv.scan_csv(spark, path, SCHEMA, required=["n"])
    assert {r.id for r in good.collect()} == {1, 4}
    why = {r.text.split(",")[0]: r.reason for r in bad.collect()}
    assert why == {"2": "malformed", "x": "malformed", "5": "missing n", "6": "malformed", "7": "malformed"}
