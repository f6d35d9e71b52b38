"""Scans: multi-line CSV, bad times, byte-order mark, lexicons, entities."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from moodindex import schemas
from moodindex.functions.time import with_time_parts
from moodindex.sources import io


def tmpdir():
    return tempfile.mkdtemp(prefix="io-", dir="/tmp")


def test_multiline_csv_and_bad_time(spark):
    d = tmpdir()
    p = os.path.join(d, "apple_scored.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write('comment_id,stock_code,text,time\n1,apple,"one\ntwo, x",2024-01-02 03:04:05\n'
                '2,apple,plain,junk\n')
    df = io.read_csv(spark, p, schemas.RAW_COMMENTS)
    rows = with_time_parts(df).orderBy("comment_id").collect()
    assert len(rows) == 2 and rows[0]["text"] == "one\ntwo, x"
    assert rows[0]["hour"] == 3 and rows[1]["date"] is None


def test_entities_from_file_names(spark):
    d = tmpdir()
    for e in ("apple", "nvidia"):
        with open(os.path.join(d, f"{e}_scored.csv"), "w") as f:
            f.write("comment_id,stock_code,text,time\n1,x,t,2024-01-01 00:00:00\n")
    df = io.read_entities(spark, d, "_scored.csv", schema=schemas.RAW_COMMENTS)
    assert sorted(r["stock_code"] for r in df.collect()) == ["apple", "nvidia"]
    with pytest.raises(FileNotFoundError):
        io.read_entities(spark, d, "_scored.csv", on_missing="error")
    assert io.entity_filter(df, "apple", io.KNOWN_ENTITIES).count() == 1
    with pytest.raises(ValueError):
        io.entity_filter(df, "tesla", io.KNOWN_ENTITIES)


def test_lexicon_load(spark):
    d = tmpdir()
    p = os.path.join(d, "kw.txt")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("하락\n\n  공포 \n하락\n존버 \n")
    lex = io.read_lexicon(spark, p)
    assert [r["keyword"] for r in lex.collect()] == ["하락", "공포", "하락", "존버"]
    assert sorted(io.lexicon_words(io.read_lexicon(spark, p, distinct=True))) == ["공포", "존버", "하락"]


def test_csv_sink_roundtrip(spark):
    d = tmpdir()
    df = spark.createDataFrame([("a", "x\ny"), ("b", "z")], "stock_code string, text string")
    io.write_csv(df, os.path.join(d, "out"), partition_by=["stock_code"])
    back = io.read_csv(spark, os.path.join(d, "out")).select(F.col("text"))
    assert sorted(r["text"] for r in back.collect()) == ["x\ny", "z"]


def test_cluster_conf_scales_with_input():
    from moodindex.session import cluster_conf
    small = cluster_conf(10 << 20, 8)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (512 << 20)
