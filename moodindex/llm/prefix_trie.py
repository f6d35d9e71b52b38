"""Conversation prefix trie by burst tries.

A conversation is a sequence of turn ids; a turn id is the length of the text
in bytes (4 bytes) and a digest of role and text (16 bytes), so equal turns and
no others have one id.  A node of the trie is a distinct sequence of first d
turns; its members are the conversations that start with it.

1. *Sequences.*  One shuffle brings the turns (ids, never texts) of each family of
   conversations together, sorted; a task streams over them and writes one
   sequence a conversation.
2. *Copies.*  Equal sequences become one row with the number and the least of
   their conversation ids and the hash of all.  Ids are sorted by range, so a
   sequence that a third of all conversations have is spread over many tasks;
   these hand on chunks of up to ``CHUNK_IDS`` ids as text, which are hashed in order, as a
   stream (a SHA-256 is sequential).
3. *Bursting.*  All suffixes start in one container under the root head.  A
   container of more than ``CONTAINER_BYTES`` bytes of suffixes, and more than one
   suffix, bursts: the turns that all its suffixes share (a run of nodes of one child
   each) become the head's path, and each suffix goes on, by its next turn id, to the
   container of a child head.  So a round is needed for each level at which a
   large container really branches, however deep it is.
4. *Sweeping.*  The remaining containers are dealt to tasks by head, sorted, and swept:
   the common prefix with the suffix before tells which nodes end.
5. *Heads.*  What the containers sum up goes to the heads that burst, from the last
   round to the first.

Memory of a task: one conversation's turn ids (20 bytes a turn), one container.

Defined results: a null role or text is empty; turns are ordered by turn, null
first, then by turn id; repeated rows are turns of their own; rows with a null
conversation id belong to no conversation; an empty table has no root and gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os.path
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM = 20  # bytes of a turn id
CONTAINER_BYTES = 256 << 10
CHUNK_IDS = 8192
# Heads that burst in one round: beyond so many they are joined with salt, not broadcast.
BROADCAST_HEADS = 20_000
SALTS = 32
OUT_ROWS = 5000

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = OUT_ROWS, cost=lambda r: 0, most: int = 8 << 20):
    """Rows as batches of ``size`` rows or about ``most`` bytes."""
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += cost(r)
        if len(held) >= size or weight >= most:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), schema.types, strict=True)],
                                  schema=schema)
            held, weight = [], 0
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), schema.types, strict=True)],
                              schema=schema)


# -- 1. sequences ------------------------------------------------------------

def turn_ids(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """``conv, turn, item``: one row a turn with its id."""
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    by = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).cast("binary")
    size = F.octet_length(said)
    name = F.sha2(F.concat(F.octet_length(by).cast("string").cast("binary"), F.lit(":").cast("binary"), by, said), 256)
    item = F.unhex(F.concat(F.lpad(F.hex(size), 8, "0"), F.substring(name, 1, ITEM * 2 - 8)))
    return (conversations.filter(F.col(f"`{conv}`").isNotNull())
            .select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), item.alias("item")))


def whole(conv: int, turns: bytes, donor: bytes) -> bytes:
    """The conversation as it is."""
    return turns


def sequences(turns: DataFrame, rebuilt: Callable[[int, bytes, bytes], bytes] = whole, family: int = 1) -> DataFrame:
    """``conv, seq``: one row a conversation.  ``rebuilt(conv, turns, donor)``
    gives its sequence from its own turns and those of the conversation
    ``conv - conv % family`` (empty if that is absent)."""
    d = turns.withColumn("head", F.col("conv") - F.col("conv") % F.lit(family))
    schema = pa.schema([("conv", pa.int64()), ("seq", pa.binary())])

    def run(batches):
        def out():
            conv, head, items, donor = None, None, [], (None, b"")

            def done():
                nonlocal donor
                own = b"".join(items)
                if conv == head:
                    donor = (head, own)
                return conv, rebuilt(conv, own, donor[1] if donor[0] == head else b"")

            for c, h, item in _rows(batches):
                if c != conv:
                    if conv is not None:
                        yield done()
                    conv, head, items = c, h, []
                items.append(item)
            if conv is not None:
                yield done()

        yield from _batched(out(), schema, cost=lambda r: len(r[1]))

    return (d.repartition("head")
            .sortWithinPartitions("head", F.col("conv") != F.col("head"), "conv", F.asc_nulls_first("turn"), "item")
            .select("conv", "head", "item").mapInArrow(run, "conv long, seq binary"))


# -- 2. copies ---------------------------------------------------------------

def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """``conv, n, ends, seq``: each distinct sequence once, with its least
    conversation, their number and the hash of all their ids."""
    named = seqs.select(F.unhex(F.sha2("seq", 256)).alias("name"), "conv", "seq").checkpoint()
    chunk = pa.schema([("name", pa.binary()), ("conv", pa.int64()), ("n", pa.int64()), ("ids", pa.string()), ("seq", pa.binary())])

    def chunks(batches):
        def out():
            name, ids, seq = None, [], None
            for n, c, s in _rows(batches):
                if n != name or len(ids) >= CHUNK_IDS:
                    if ids:
                        yield name, ids[0], len(ids), ",".join(map(str, ids)), seq
                    name, ids, seq = n, [], s
                ids.append(c)
            if ids:
                yield name, ids[0], len(ids), ",".join(map(str, ids)), seq

        yield from _batched(out(), chunk, cost=lambda r: len(r[3]) + len(r[4]))

    one = pa.schema([("conv", pa.int64()), ("n", pa.int64()), ("ends", pa.string()), ("seq", pa.binary())])

    def joined(batches):
        def out():
            name, first, n, h, seq = None, None, 0, None, None
            for k, c, m, ids, s in _rows(batches):
                if k != name:
                    if name is not None:
                        yield first, n, h.hexdigest(), seq
                    name, first, n, h, seq = k, c, 0, hashlib.sha256(), s
                else:
                    h.update(b",")
                n += m
                h.update(ids.encode())
            if name is not None:
                yield first, n, h.hexdigest(), seq

        yield from _batched(out(), one, cost=lambda r: len(r[3]))

    return (named.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
            .mapInArrow(chunks, "name binary, conv long, n long, ids string, seq binary")
            .repartition("name").sortWithinPartitions("name", "conv")
            .mapInArrow(joined, "conv long, n long, ends string, seq binary"))


# -- 3. bursting -------------------------------------------------------------

def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their start."""
    return len(os.path.commonprefix([a, b])) // ITEM


def _burst(rows: DataFrame, limit: int):
    """One round: the containers of ``rows`` (``head, depth, up, parent, conv,
    n, ends, seq``) that stay, the heads that burst and the rows of their children."""
    stats = rows.groupBy("head").agg(
        F.first("depth").alias("depth"), F.first("up").alias("up"), F.first("parent").alias("parent"),
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.count("*").alias("rows"),
        F.sum(F.length("seq") + 1 - ITEM * F.col("depth")).alias("size"), F.min("seq").alias("low"), F.max("seq").alias("high"))
    common = F.udf(_common, "long")
    heads = (stats.filter((F.col("size") > limit) & (F.col("rows") > 1))
             .withColumn("until", common("low", "high"))
             .select("head", "depth", "up", "parent", "conv", "n", "until", F.col("low").alias("path"))).checkpoint()
    many = heads.count()
    if not many:
        return rows, None, None
    name = heads.select("head", "until", F.col("conv").alias("first"))
    if many <= BROADCAST_HEADS:
        met = rows.join(F.broadcast(name), "head", "left")
    else:
        salt = F.pmod(F.xxhash64("conv"), F.lit(SALTS)).cast("int").alias("salt")
        met = rows.select("*", salt).join(
            name.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")), ["head", "salt"], "left").drop("salt")
    met = met.checkpoint()
    stay = met.filter("until IS NULL").drop("until", "first")
    gone = met.filter("until IS NOT NULL")
    ends = gone.filter(F.length("seq") == ITEM * F.col("until")).select("head", "ends")  # one a head at most
    heads = heads.join(ends, "head", "left")
    below = F.col("until") + 1
    moved = (gone.filter(F.length("seq") > ITEM * F.col("until"))
             .select(F.unhex(F.sha2(F.expr(f"substring(seq, 1, cast({ITEM} * (until + 1) AS INT))"), 256)).alias("head"),
                     below.alias("depth"), F.col("head").alias("up"), F.col("first").alias("parent"),
                     "conv", "n", "ends", "seq"))
    return stay, heads, moved


# -- 4. sweeping -------------------------------------------------------------

class _Open:
    """A node on the current path."""
    __slots__ = ("depth", "cost", "conv", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, cost: int):
        self.depth, self.cost = depth, cost
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.waiting = NO_ENDS, []


def _sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of the containers; rows (``head, depth, up, parent, conv, n, ends, seq``)
    come sorted by head and sequence.  A container's first node carries ``up``."""
    head, top, up, parent, before, path = None, 0, None, None, b"", []

    def close():
        """The last open node is complete; its parent learns of it."""
        x = path.pop()
        leaves = x.leaves or 1
        saved = x.saved + (x.n - 1) * x.cost
        for node in x.waiting:
            yield (*node[:2], x.conv, *node[2:], None)
        node = (x.conv, x.depth, x.n, x.children, leaves, saved, x.ends)
        if not path:
            yield (*node[:2], parent, *node[2:], up)
            return
        y = path[-1]
        y.conv = x.conv if y.conv is None or x.conv < y.conv else y.conv
        y.n += x.n
        y.children += 1
        y.leaves += leaves
        y.saved += saved
        y.waiting.append(node)

    for h, depth, u, p, conv, n, ends, seq in rows:
        if h != head:
            while path:
                yield from close()
            head, top, up, parent, before = h, depth, u, p, seq
            shared = depth - 1
        else:
            shared = _common(before, seq)
            while path[-1].depth > shared:
                yield from close()
            before = seq
        for d in range(max(shared, top - 1) + 1, len(seq) // ITEM + 1):
            path.append(_Open(d, struct.unpack_from(">I", seq, ITEM * (d - 1))[0] if d else 0))
        last = path[-1]
        last.conv = conv if last.conv is None or conv < last.conv else last.conv
        last.n += n
        last.ends = ends
    while path:
        yield from close()


_SWEPT = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                    ("ends_sha256", pa.string()), ("up", pa.binary())])


def sweep(containers: DataFrame) -> DataFrame:
    def run(batches):
        yield from _batched(_sweep(_rows(batches)), _SWEPT)

    return (containers.select("head", "depth", "up", "parent", "conv", "n", "ends", "seq")
            .repartition("head").sortWithinPartitions("head", "seq").mapInArrow(run, NODES + ", up binary"))


# -- 5. heads ----------------------------------------------------------------

def _head_nodes(heads: DataFrame, below: DataFrame) -> DataFrame:
    """The nodes of heads that burst: the path from ``depth`` to ``until``."""
    sums = below.filter("up IS NOT NULL").groupBy(F.col("up").alias("head")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))

    def run(batches):
        def out():
            for depth, up, parent, conv, n, until, path, ends, children, leaves, saved in _rows(batches):
                for d in range(until, depth - 1, -1):
                    saved += (n - 1) * struct.unpack_from(">I", path, ITEM * (d - 1))[0] if d else 0
                    first = d == depth
                    yield (conv, d, parent if first else conv, n, children if d == until else 1, leaves, saved,
                           ends or NO_ENDS if d == until else NO_ENDS, up if first else None)

        yield from _batched(out(), _SWEPT)

    return (heads.join(sums, "head").select("depth", "up", "parent", "conv", "n", "until", "path", "ends",
                                            "children", "leaves", "saved")
            .mapInArrow(run, NODES + ", up binary"))


def prefix_trie(seqs: DataFrame, limit: int = CONTAINER_BYTES) -> DataFrame:
    """One row per node of the trie of ``seqs`` (``conv, seq``): ``conv_id`` (least
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of shared last texts in the subtree), ``ends_sha256``."""
    rows = distinct_sequences(seqs).select(
        F.unhex(F.sha2(F.lit(b""), 256)).alias("head"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("up"), F.lit(None).cast("long").alias("parent"),
        "conv", "n", "ends", "seq").checkpoint()
    containers, rounds = None, []
    while True:
        stay, heads, moved = _burst(rows, limit)
        containers = stay if containers is None else containers.unionByName(stay)
        if heads is None:
            break
        rounds.append(heads)
        rows = moved
    nodes = sweep(containers).checkpoint()
    out = nodes
    for heads in reversed(rounds):
        # children of these heads are containers or heads of the next round
        nodes = _head_nodes(heads, out).checkpoint()
        out = out.unionByName(nodes)
    return out.drop("up")
