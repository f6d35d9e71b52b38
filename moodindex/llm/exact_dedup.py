"""Exact de-duplication with a two-pass Bloom filter.

Texts are equal when they are identical after each run of white space
(U+0020, U+0009 to U+000D) becomes one space; a null text counts as empty.

Pass 1 hashes every row and sets ``PROBES`` cells a hash in a bit array,
kept twice: cells set at least once and cells set at least twice.  Only
the second array leaves the pass.  Pass 2 looks every row up in it: a row
with a cell that was set once only has no copy and passes straight through;
the others ("possibly repeated") shuffle by their hash and are grouped
exactly, so a false hit of the filter costs a shuffled row and changes
nothing.

The array has 16 bits a row up to ``MAX_BITS`` (64 MiB, the proven bound of
the broadcast).  Beyond 33 million rows the hashes are cut into ranges of at most that many, and both
passes run once a range, each with a filter of its own: a billion rows take 33 passes over the
checkpointed hashes, and the share of rows that shuffle stays what it is for few.

Defined results: null text = ''; null id sorts after every id; of several
rows with the smallest id one stays; an empty table gives an empty table;
columns of the input may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import WS, fresh, text_of

PROBES = 2
BITS_PER_ROW = 16
MIN_BITS = 1 << 16
MAX_BITS = 1 << 29
SEGMENT_BITS = 1 << 20
# A group of copies counts as hot with a thousandth of all rows: so there
# are at most 1,000 hot groups, whose keys are broadcast instead of joined.
HOT_SHARE = 1000


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(text_of(col), WS + "+", " ")


def text_hash(col: str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalised(col).cast("binary"), 256))


def filter_bits(rows: int) -> int:
    """Bits of the filter: the next power of two above 16 a row, bounded."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (max(1, rows * BITS_PER_ROW) - 1).bit_length()))


def _cells(hashes: pa.Array, bits: int) -> np.ndarray:
    """(rows, PROBES) cells; the hashes are uniform, so their words serve."""
    raw = np.frombuffer(b"".join(hashes.to_pylist()), dtype="<u8").reshape(-1, 4)
    return (raw[:, :PROBES] % np.uint64(bits)).astype(np.int64)


def repeated_cells(hashed: DataFrame, hash_col: str, bits: int) -> np.ndarray:
    """Pass 1: the bit array of cells set by at least two rows."""
    seg_bits = min(bits, SEGMENT_BITS)

    def partial(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cells, counts = np.unique(_cells(b.column(0), bits), return_counts=True)
            seg = cells // seg_bits
            cuts = np.flatnonzero(np.diff(seg)) + 1
            parts = zip(np.split(cells % seg_bits, cuts), np.split(counts, cuts), strict=True)
            once, twice = [], []
            for c, n in parts:
                once.append(c.astype("<u4").tobytes())
                twice.append(c[n > 1].astype("<u4").tobytes())
            yield pa.record_batch([
                pa.array(seg[np.concatenate([[0], cuts])], pa.int64()),
                pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                names=["segment", "once", "twice"])

    def merged(batches):
        # rows arrive sorted by segment: one segment's two arrays at a time
        now, one, two = None, None, None

        def out():
            return pa.record_batch([pa.array([now], pa.int64()), pa.array(
                [np.packbits(two, bitorder="little").tobytes()], pa.binary())],
                names=["segment", "bits"])

        for b in batches:
            for s, c, t in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if s != now:
                    if now is not None:
                        yield out()
                    now, one, two = s, np.zeros(seg_bits, bool), np.zeros(seg_bits, bool)
                c = np.frombuffer(c, "<u4")
                two[c[one[c]]] = True
                one[c] = True
                two[np.frombuffer(t, "<u4")] = True
        if now is not None:
            yield out()

    rows = (hashed.select(hash_col)
            .mapInArrow(partial, "segment long, once binary, twice binary")
            .repartition("segment").sortWithinPartitions("segment")
            .mapInArrow(merged, "segment long, bits binary"))
    table = np.zeros(bits // 8, np.uint8)
    step = seg_bits // 8
    for r in rows.toLocalIterator():
        table[r["segment"] * step:(r["segment"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return table


def with_maybe(df: DataFrame, hash_col: str, flag: str, table: np.ndarray) -> DataFrame:
    """Pass 2: add the flag "possibly repeated"."""
    shared = df.sparkSession.sparkContext.broadcast(table.tobytes())
    bits = table.size * 8

    @F.pandas_udf("boolean")
    def maybe(h):
        import pandas as pd
        t = np.frombuffer(shared.value, np.uint8)
        cells = _cells(pa.array(h, pa.binary()), bits)
        return pd.Series(((t[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1))

    return df.withColumn(flag, maybe(F.col(hash_col)))


def ranges_of(rows: int, max_bits: int = MAX_BITS) -> int:
    """Hash ranges such that each has 16 bits a row within ``max_bits``, with a tenth to spare."""
    return 1 if rows * BITS_PER_ROW <= max_bits else -(-rows * BITS_PER_ROW * 11 // (max_bits * 10))


def _in_range(hash_col: str, k: int, of: int) -> Column:
    """Whether a hash is in range ``k``, by bytes that choose no cell of the filter."""
    number = F.conv(F.hex(F.substring(F.col(hash_col), 8 * PROBES + 1, 6)), 16, 10).cast("long")
    return number % of == k


def flag_repeated(df: DataFrame, hashed: DataFrame, hash_col: str, flag: str, total: int,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """Both passes: ``df`` with the flag "possibly repeated"; ``hashed`` holds the same hashes.
    Both should be checkpointed if there is more than one range."""
    of = ranges_of(total, max_bits)
    bits = min(max_bits, filter_bits(-(-total // of)))
    if of == 1:
        return with_maybe(df, hash_col, flag, repeated_cells(hashed, hash_col, bits))
    parts = [with_maybe(df.filter(_in_range(hash_col, k, of)), hash_col, flag,
                        repeated_cells(hashed.filter(_in_range(hash_col, k, of)), hash_col, bits)) for k in range(of)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _by_id(id_col: str) -> Column:
    return F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` (32 bytes).  Of equal texts the row with the smallest
    id stays."""
    hashed = docs.select(
        F.col(id_col).alias("id"), text_hash(text_col).alias("hash")
    ).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    total = hashed.count()
    flagged = flag_repeated(hashed, hashed, "hash", "maybe", total, max_bits)
    through = flagged.filter(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "hash")
    rows = flagged.filter("maybe").drop("maybe")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    groups = (rows.groupBy("hash")
              .agg(F.count("*").alias("n"), F.min_by(F.struct("id", "row"), order).alias("first"))
              .filter("n > 1").checkpoint())
    hot = groups.filter(F.col("n") * HOT_SHARE >= total)
    tried = rows.join(F.broadcast(hot), "hash", "left")
    plain = (tried.filter("n IS NULL").drop("n", "first")
             .join(groups.filter(F.col("n") * HOT_SHARE < total), "hash", "left"))
    both = tried.filter("n IS NOT NULL").unionByName(plain)
    grouped = both.select(
        "id", F.expr("CASE WHEN n IS NULL THEN id ELSE first.id END").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.expr("n IS NULL OR row = first.row").alias("kept"), "hash")
    return through.unionByName(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.col("hash").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were.  Only
    possibly repeated rows shuffle; of those, map tasks keep one a text: that with
    the smallest id, and of several rows with that id the least raw text's."""
    h, m = fresh(docs, "_hash"), fresh(docs, "_maybe")
    hashed = docs.select(text_hash(text_col).alias(h)).checkpoint()
    total = hashed.count()
    rows = docs.withColumn(h, text_hash(text_col))
    if ranges_of(total, max_bits) > 1:
        rows = rows.checkpoint()  # read once a range
    flagged = flag_repeated(rows, hashed, h, m, total, max_bits)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(_by_id(id_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    first = (flagged.filter(F.col(m)).groupBy(h)
             .agg(F.min_by(whole, order).alias("row")).select("row.*"))
    return flagged.filter(~F.col(m)).select(*docs.columns).unionByName(first)
