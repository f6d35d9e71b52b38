"""N-gram Jaccard join with a token-group matrix.

Two documents link when their sets of 5-word shingles have a Jaccard
similarity of 0.75 or more; the result names each document's component of
links.  Sets are compared exactly (on 64-bit hashes of shingles), every set
against every set that could reach the threshold:

1. *Sets.*  Each text becomes its set; equal sets have one digest and count
   as one node, so exact copies cost a row of 16 bytes each.
2. *Matrix rows.*  In any fixed order of tokens, two sets at the threshold
   share k tokens among the first n - ceil(3n/4) + k of either, and those lie among the
   first n - ceil(6n/7) + k of the smaller one; k is 1 + n // 16 of the smaller of both
   figures.  The order puts tokens that are frequent in some scan task last.  These
   tokens go, packed, to the bucket of their hash.  A token with one node, or with
   no two nodes of compatible size, proves nothing and is dropped; equal rows of nodes are
   kept once, with their number.  A node with fewer than k shared tokens, for the smallest
   set that it could be similar to, has no partner and goes.
3. *Groups.*  A node's leader is, of the nodes that it shares a row with, the one
   with the largest share of shared tokens (of near copies the one edited least).
   If they have a similarity of ``LOOSE`` or more, the node joins the leader's group, else
   it is a group of its own; at the threshold the two are linked.  So the near copies
   of one text, however far apart, are one group.  A member that isn't linked to the leader is a
   query to its own group.  Where a row holds several groups, a node is a query to those
   with a lesser name.
4. *Bounds.*  The matrix keeps each group's token union as a bitmap.  A bit that a query
   has and the union lacks stands for a token that no member has, so the query's
   size less those bits bounds its overlap with every member.  Only queries and
   groups that the bound lets pass are opened: their sets are read again and meet in
   blocks of about ``BLOCK`` members, where subgroups of ``SUBGROUP`` members bound the overlap
   by their exact union before their sets are compared.  What is known to be connected is not
   compared again.
5. *Components.*  Links between different sets go through alternating
   large-star and small-star rounds until nothing changes.

Nothing is capped or sampled: frequency counts and leaders only choose the order of
work.  No step emits the pairs of a group: near copies of one text cost one
comparison each.

Defined results: a null text or one without words has an empty set, links
with nothing and is its own component; documents of equal non-empty sets
are linked; a text of fewer than five words has one shingle; a row with a
null id takes no part in linking and has a null component; rows may repeat,
each gets its row; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import freeing, fresh
from moodindex.llm.shingles import digest, mix, shingle_set

# A token is frequent with this share of the sets of a scan chunk; the order
# knows at most so many of them (8 bytes each; it is only an order).
FREQUENT_SHARE, FREQUENT_TOKENS = 0.002, 1 << 17
CHUNK_TOKENS = 2_000_000
# Packed tokens per bucket, in bytes, on average.
BUCKET_BYTES = 24 << 20
BLOCK, SUBGROUP = 1024, 32
# Members of a group have this similarity (as a fraction) to its leader.
LOOSE = (1, 4)
# One shared token more is asked for so many tokens of a set.
SHARED_STEP = 16
# Bits of a group's or a set's bitmap of tokens.
BITMAP = 4096
GROUPS_IN_TASK = 20_000
FILTER_MAX_BITS = 1 << 29
# Bits of the filter that one task sets at a time, and cells of nodes that a task collects before.
SEGMENT_BITS = 1 << 20
FILTER_CELLS = 250_000


def _rows(batches):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def needed(a, b):
    """The least overlap of sets of sizes a and b that reaches the threshold."""
    return -(-3 * (a + b) // 7)


# -- 1. sets -----------------------------------------------------------------

def _sizes(docs: DataFrame) -> DataFrame:
    """``id, n_shingles, node`` (null for an empty set)."""
    kind = docs.schema["id"].dataType

    def run(batches):
        for b in batches:
            sets = [shingle_set(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([digest(s) if len(s) else None for s in sets], pa.binary())],
                names=["id", "n_shingles", "node"])

    return docs.mapInArrow(freeing(run), f"id {kind.simpleString()}, n_shingles long, node binary")


def _distinct_sets(batches, at: int = 0):
    """``(node, set)`` of each text, equal sets of a task once."""
    seen: set[bytes] = set()
    for b in batches:
        for t in b.column(at).to_pylist():
            s = shingle_set(t)
            if len(s):
                d = digest(s)
                if d not in seen:
                    seen.add(d)
                    yield d, s


def frequent_tokens(docs: DataFrame) -> np.ndarray:
    """Tokens frequent in some scan chunk, the rarest first."""

    def run(batches):
        def flush(sets):
            tokens, n = np.unique(np.concatenate(sets), return_counts=True)
            keep = n >= max(3, FREQUENT_SHARE * len(sets))
            for k in range(0, int(keep.sum()), 100_000):
                yield pa.record_batch([pa.array(tokens[keep][k:k + 100_000].view(np.int64)),
                                       pa.array(n[keep][k:k + 100_000])], names=["token", "n"])

        sets, size = [], 0
        for _, s in _distinct_sets(batches):
            sets.append(s)
            size += len(s)
            if size >= CHUNK_TOKENS:
                yield from flush(sets)
                sets, size = [], 0
        if sets:
            yield from flush(sets)

    top = (docs.select("text").mapInArrow(freeing(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).toPandas())
    return top["token"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


# -- 2. matrix rows ----------------------------------------------------------

class TokenOrder:
    """Tokens by hash, the frequent ones behind them from rare to frequent."""

    def __init__(self, frequent: np.ndarray):
        at = np.argsort(frequent)
        self.sorted, self.rank = frequent[at], at

    def prefix(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        size = n - (3 * n + 3) // 4 + 1 + n // SHARED_STEP
        if not len(self.sorted):
            return s[:size]
        at = np.searchsorted(self.sorted, s)
        at[at == len(self.sorted)] = 0
        often = self.sorted[at] == s
        first = s[~often][:size]
        if len(first) == size:
            return first
        last = s[often][np.argsort(self.rank[at[often]], kind="stable")]
        return np.concatenate([first, last[:size - len(first)]])


_ROLE = np.uint16(1 << 15)  # marks a token in the shorter, indexed prefix
_FLUSH_SETS = 8192


def _postings(docs: DataFrame, order, buckets: int) -> DataFrame:
    """Packed prefix tokens by bucket: tokens, places in the list of nodes,
    nodes, sizes."""

    def run(batches):
        prefix = TokenOrder(order.value).prefix

        def flush(nodes, sizes, parts):
            tokens = np.concatenate(parts)
            who = np.repeat(np.arange(len(parts), dtype=np.uint16), [len(p) for p in parts])
            place = np.concatenate([np.arange(len(p)) for p in parts])
            n = sizes[who]
            who = np.where(place < n - (6 * n + 6) // 7 + 1 + n // SHARED_STEP, who | _ROLE, who)
            bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
            at = np.argsort(bucket, kind="stable")
            tokens, who, bucket = tokens[at], who[at], bucket[at]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            out = []
            for t, w, b in zip(np.split(tokens, cuts), np.split(who, cuts),
                               bucket[np.concatenate([[0], cuts])], strict=True):
                used, local = np.unique(w & ~_ROLE, return_inverse=True)
                out.append((int(b), t.tobytes(), (local.astype(np.uint16) | (w & _ROLE)).tobytes(),
                            b"".join(nodes[i] for i in used), sizes[used].astype("<i4").tobytes()))
            cols = list(zip(*out, strict=True))
            return pa.record_batch([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                   names=["bucket", "tokens", "who", "nodes", "sizes"])

        nodes, sizes, parts, size = [], [], [], 0
        for d, s in _distinct_sets(batches):
            nodes.append(d)
            sizes.append(len(s))
            parts.append(prefix(s))
            size += len(parts[-1])
            if size >= CHUNK_TOKENS or len(nodes) >= _FLUSH_SETS:
                yield flush(nodes, np.array(sizes), parts)
                nodes, sizes, parts, size = [], [], [], 0
        if nodes:
            yield flush(nodes, np.array(sizes), parts)

    return docs.select("text").mapInArrow(
        freeing(run), "bucket int, tokens binary, who binary, nodes binary, sizes binary")


_NODE = np.dtype([("a", ">u8"), ("b", ">u8")])  # sorts as the 16 bytes do


def _matrix_rows(batches):
    """One bucket's rows: ``row, node, size, n`` for every distinct set of nodes
    that share a token and could reach the threshold; n: so many tokens."""
    tokens, who, nodes, sizes, base = [], [], [], [], 0
    for t, w, n, z in _rows(batches):
        tokens.append(np.frombuffer(t, np.uint64))
        w = np.frombuffer(w, np.uint16)
        who.append(((w & ~_ROLE).astype(np.int64) + base) * 2 + (w >> 15))
        nodes.append(np.frombuffer(n, _NODE))
        sizes.append(np.frombuffer(z, "<i4"))
        base += len(nodes[-1])
    if not tokens:
        return
    tokens, who = np.concatenate(tokens), np.concatenate(who)
    nodes, first, same = np.unique(np.concatenate(nodes), return_index=True, return_inverse=True)
    sizes = np.concatenate(sizes)[first].astype(np.int64)
    role, who = who & 1, same[who >> 1]
    at = np.argsort(tokens, kind="stable")
    shared = np.ones(len(at), bool)  # tokens that occur once go first, they are the most
    t = tokens[at]
    shared[1:-1] = (t[1:-1] == t[:-2]) | (t[1:-1] == t[2:])
    if len(t) > 1:
        shared[0], shared[-1] = t[0] == t[1], t[-1] == t[-2]
    else:
        shared[:] = False
    at = at[shared]
    tokens, who, role = tokens[at], who[at], role[at]
    at = np.lexsort((who, sizes[who], tokens))
    tokens, who, role = tokens[at], who[at], role[at]
    once = np.ones(len(at), bool)
    once[1:] = (tokens[1:] != tokens[:-1]) | (who[1:] != who[:-1])
    tokens, who, role = tokens[once], who[once], role[once]
    if not len(who):
        return
    n = sizes[who]
    start = np.ones(len(who), bool)  # a new token, or a gap of sizes that no link can cross
    start[1:] = (tokens[1:] != tokens[:-1]) | (4 * n[:-1] < 3 * n[1:])
    starts = np.flatnonzero(start)
    count = np.diff(np.append(starts, len(who)))
    name = mix(nodes["a"].astype(np.uint64) ^ mix(nodes["b"].astype(np.uint64)))
    sign = np.add.reduceat(name[who], starts) + mix(count.astype(np.uint64))
    good = (count > 1) & (np.add.reduceat(role, starts) > 0)
    _, pick, often = np.unique(sign[good], return_index=True, return_counts=True)
    starts, count, sign = starts[good][pick], count[good][pick], sign[good][pick]
    raw = nodes.astype(_NODE).tobytes()  # concatenation may have changed the byte order
    byte = [raw[16 * i:16 * i + 16] for i in range(len(nodes))]
    for k in range(0, len(starts), 20_000):
        s, c = starts[k:k + 20_000], count[k:k + 20_000]
        flat = np.repeat(s - np.concatenate([[0], np.cumsum(c)[:-1]]), c) + np.arange(c.sum())
        w = who[flat]
        yield pa.record_batch(
            [pa.array(np.repeat(sign[k:k + 20_000], c).view(np.int64)), pa.array([byte[i] for i in w], pa.binary()),
             pa.array(sizes[w]), pa.array(np.repeat(often[k:k + 20_000], c).astype(np.int64))],
            names=["row", "node", "size", "n"])


def _bits_of(nodes: list[bytes], bits: int) -> np.ndarray:
    return (np.frombuffer(b"".join(nodes), "<u8").reshape(-1, 2) % np.uint64(bits)).astype(np.int64)


def _node_filter(leaders: DataFrame, count: int) -> bytes:
    """A Bloom filter of the nodes, 64 MiB at most; false hits only cost a row.  Tasks
    set the bits, segment by segment, and only finished segments reach the driver."""
    bits = min(FILTER_MAX_BITS, max(1 << 16, 1 << (16 * max(1, count) - 1).bit_length()))
    seg_bits = min(bits, SEGMENT_BITS)

    def cells(batches):
        """``segment, cells`` of many nodes at once."""
        held, size = [], 0

        def out():
            c = np.unique(np.concatenate(held))
            seg = c // seg_bits
            cuts = np.flatnonzero(np.diff(seg)) + 1
            return pa.record_batch([pa.array(seg[np.concatenate([[0], cuts])], pa.int64()),
                                    pa.array([x.astype("<u4").tobytes() for x in np.split(c % seg_bits, cuts)], pa.binary())],
                                   names=["segment", "cells"])

        for b in batches:
            if b.num_rows:
                held.append(_bits_of(b.column(0).to_pylist(), bits).ravel())
                size += len(held[-1])
                if size >= FILTER_CELLS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def merged(batches):
        # rows arrive sorted by segment: one segment's bits at a time
        now, have = None, None

        def out():
            return pa.record_batch([pa.array([now], pa.int64()), pa.array(
                [np.packbits(have, bitorder="little").tobytes()], pa.binary())], names=["segment", "bits"])

        for s, c in _rows(batches):
            if s != now:
                if now is not None:
                    yield out()
                now, have = s, np.zeros(seg_bits, bool)
            have[np.frombuffer(c, "<u4")] = True
        if now is not None:
            yield out()

    rows = (leaders.select("node").mapInArrow(freeing(cells), "segment long, cells binary")
            .repartition("segment").sortWithinPartitions("segment").mapInArrow(freeing(merged), "segment long, bits binary"))
    table = np.zeros(bits // 8, np.uint8)
    step = seg_bits // 8
    for r in rows.toLocalIterator():  # each segment once
        table[r["segment"] * step:(r["segment"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return table.tobytes()


def _sets_of(docs: DataFrame, table) -> DataFrame:
    """``node, tokens`` of the texts whose node the filter holds."""

    def run(batches):
        t = np.frombuffer(table.value, np.uint8)
        nodes, sets, size = [], [], 0

        def flush():
            cells = _bits_of(nodes, len(t) * 8)
            hit = ((t[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1)
            return pa.record_batch([pa.array([n for n, h in zip(nodes, hit, strict=True) if h], pa.binary()),
                                    pa.array([s.tobytes() for s, h in zip(sets, hit, strict=True) if h], pa.binary())],
                                   names=["node", "tokens"])

        for d, s in _distinct_sets(batches):
            nodes.append(d)
            sets.append(s)
            size += len(s)
            if size >= 250_000:
                yield flush()
                nodes, sets, size = [], [], 0
        if nodes:
            yield flush()

    return docs.select("text").mapInArrow(freeing(run), "node binary, tokens binary")


# -- 3. groups ---------------------------------------------------------------

def _bitmap(tokens: np.ndarray) -> np.ndarray:
    """Which of BITMAP cells the tokens fall into, as words."""
    out = np.zeros(BITMAP, bool)
    out[(tokens & np.uint64(BITMAP - 1)).astype(np.int64)] = True
    return np.packbits(out)


def _near_leader(members: DataFrame, heads: DataFrame) -> DataFrame:
    """``node, group, comp, size, bits``: the group is the leader if it is loosely similar,
    the component (as far as it is known) the leader if they link; else the node itself."""

    def run(batches):
        lead, of = None, None
        for b in batches:
            groups, comps, bits = [], [], []
            nodes, leaders, tokens, theirs = (c.to_pylist() for c in b.columns[:4])
            for n, g, t, u in zip(nodes, leaders, tokens, theirs, strict=True):
                if g != lead:
                    lead, of = g, np.frombuffer(u, np.uint64)
                t = np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(t, of, assume_unique=True))
                groups.append(g if LOOSE[1] * both >= LOOSE[0] * (len(t) + len(of) - both) else n)
                comps.append(g if both >= needed(len(t), len(of)) else n)
                bits.append(_bitmap(t).tobytes())
            yield pa.record_batch([b.column(0), pa.array(groups, pa.binary()), pa.array(comps, pa.binary()),
                                   b.column(4), pa.array(bits, pa.binary())],
                                  names=["node", "group", "comp", "size", "bits"])

    return (members.join(heads, "leader").select("node", "leader", "tokens", "theirs", "size")
            .mapInArrow(freeing(run), "node binary, group binary, comp binary, size long, bits binary"))


def _unions(near: DataFrame) -> DataFrame:
    """``group, bits, low, high, n``: the union bitmap and sizes of each group."""
    names = ["group", "bits", "low", "high", "n"]

    def record(groups):
        cols = list(zip(*((g, v[0].tobytes(), v[1], v[2], v[3]) for g, v in groups.items()), strict=True))
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, (
            pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=names)

    def run(batches):  # sums up in map tasks, then, sorted by group, for good
        groups: dict[bytes, list] = {}
        for g, bits, low, high, n in _rows(batches):
            bits, have = np.frombuffer(bits, np.uint8), groups.get(g)
            if have is None:
                if len(groups) >= GROUPS_IN_TASK:  # a sorted group is complete here
                    yield record(groups)
                    groups.clear()
                groups[g] = [bits.copy(), low, high, n]
            else:
                have[0] |= bits
                have[1], have[2], have[3] = min(have[1], low), max(have[2], high), have[3] + n
        if groups:
            yield record(groups)

    kind = "group binary, bits binary, low long, high long, n long"
    one = near.select("group", "bits", F.col("size").alias("low"), F.col("size").alias("high"), F.lit(1).cast("long").alias("n"))
    return (one.mapInArrow(freeing(run), kind).repartition("group").sortWithinPartitions("group").mapInArrow(freeing(run), kind))


def _qualified(visits: DataFrame, near: DataFrame, unions: DataFrame) -> DataFrame:
    """The visits ``node, group`` that the bound on the overlap lets pass."""
    q = visits.join(near.select("node", F.col("size"), F.col("bits").alias("own")), "node")
    q = q.join(unions.select("group", F.col("bits").alias("theirs"), "low", "high", F.col("n").alias("many")), "group")
    q = q.filter("4 * high >= 3 * size AND 4 * size >= 3 * low")

    @F.pandas_udf("boolean")
    def reaches(own, theirs, size, low, many):
        import pandas as pd
        if not len(own):
            return pd.Series([], dtype=bool)
        a = np.frombuffer(b"".join(own), np.uint64).reshape(len(own), -1)
        b = np.frombuffer(b"".join(theirs), np.uint64).reshape(len(own), -1)
        n, low = size.to_numpy(), low.to_numpy()
        least = np.maximum(-(-3 * n // 4), needed(n, low))  # for the smallest member
        mine = n - np.bitwise_count(a & ~b).sum(axis=1).astype(np.int64)
        # the union of one member alone bounds the overlap from its side as well
        theirs = low - np.bitwise_count(b & ~a).sum(axis=1).astype(np.int64)
        return pd.Series((mine >= least) & ((many.to_numpy() > 1) | (theirs >= least)))

    return q.filter(reaches("own", "theirs", "size", "low", "many")).select("node", "group")


# -- 4. opening blocks -------------------------------------------------------

class _Block:
    """Members of a block in subgroups with the unions of their tokens."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows, key=lambda r: (r[1], len(r[2]), r[0]))  # by component, then size
        self.up: dict[bytes, bytes] = {}  # components that links have joined
        self.parts = []
        for k in range(0, len(rows), SUBGROUP):
            nodes, comps, tokens = zip(*rows[k:k + SUBGROUP], strict=True)
            sets = [np.frombuffer(t, np.uint64) for t in tokens]
            sizes = np.array([len(t) for t in sets])
            flat = np.concatenate(sets)
            self.parts.append((np.unique(flat), flat, np.cumsum(sizes) - sizes, sizes, nodes, comps))

    def root(self, comp: bytes) -> bytes:
        up = self.up
        while (over := up.get(comp)) is not None:
            if (top := up.get(over)) is not None:
                up[comp] = top
            comp = over
        return comp

    def links(self, node: bytes, comp: bytes, tokens: np.ndarray):
        """Nodes similar to the query; of what is connected, the first found."""
        n, root = len(tokens), self.root
        least, own = -(-3 * n // 4), root(comp)
        for union, flat, starts, sizes, nodes, comps in self.parts:
            fits = (4 * sizes >= 3 * n) & (4 * n >= 3 * sizes)
            if not fits.any() or all(root(c) == own for c in set(comps)):
                continue
            at = np.searchsorted(union, tokens)
            at[at == len(union)] = 0
            if int((union[at] == tokens).sum()) < least:
                continue  # no member can reach the threshold
            at = np.searchsorted(tokens, flat)
            at[at == n] = 0
            both = np.add.reduceat(tokens[at] == flat, starts, dtype=np.int64)
            for i in np.flatnonzero(fits & (both >= needed(n, sizes))):
                other = root(comps[i])
                if other != own and nodes[i] != node:
                    self.up[other] = own
                    yield nodes[i]


def _open_blocks(batches):
    """Rows sorted by group and block, members first: links ``u, v``."""
    key, rows, block, out = None, [], None, []
    for group, number, query, node, comp, tokens in _rows(batches):
        if (group, number) != key:
            key, rows, block = (group, number), [], None
        if not query:
            rows.append((node, comp, tokens))
            continue
        if block is None:
            block = _Block(rows) if rows else None
            if block is None:
                continue
        out += [(node, m) for m in block.links(node, comp, np.frombuffer(tokens, np.uint64))]
        if len(out) >= 10_000:
            yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["u", "v"])
            out = []
    if out:
        yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["u", "v"])


def node_links(docs: DataFrame, total_shingles: int) -> DataFrame:
    """Links between nodes, ``u, v``, that connect what is similar.
    ``docs`` has ``text``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    order = sc.broadcast(frequent_tokens(docs))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total_shingles * 3 // BUCKET_BYTES)
    rows = (_postings(docs, order, tasks).repartitionById(tasks, F.col("bucket"))
            .select("tokens", "who", "nodes", "sizes")
            .mapInArrow(freeing(_matrix_rows), "row long, node binary, size long, n long")
            .groupBy("row", "node").agg(F.first("size").alias("size"), F.sum("n").alias("n"))).checkpoint()
    # the smallest set that a node could be similar to has three quarters of its size
    nodes = (rows.groupBy("node").agg(F.first("size").alias("size"), F.sum("n").alias("n"))
             .filter(f"n >= 1 + ceil(3 * size / 4) div {SHARED_STEP}")
             .select("node", F.struct((F.lit(256) * F.col("n") / F.col("size")).cast("int").alias("share"), "node").alias("as_lead")))
    rows = rows.join(nodes, "node").select("row", "node", "size", F.col("n").alias("tokens"), "as_lead")
    leads = rows.groupBy("row").agg(F.max("as_lead").alias("lead"), F.count("*").alias("n")).filter("n > 1")
    rows = rows.drop("as_lead").join(leads.select("row", "lead"), "row").checkpoint()
    leaders = (rows.groupBy("node").agg(F.max("lead").alias("lead"), F.first("size").alias("size"))
               .select("node", F.col("lead.node").alias("leader"), "size").checkpoint())

    def sets_of(nodes: DataFrame) -> DataFrame:
        table = sc.broadcast(_node_filter(nodes, nodes.count()))
        return _sets_of(docs, table).groupBy("node").agg(F.first("tokens").alias("tokens"))

    sets = sets_of(leaders)
    heads = leaders.select("leader").distinct().join(sets, F.col("leader") == F.col("node")).select(
        "leader", F.col("tokens").alias("theirs"))
    near = _near_leader(leaders.join(sets, "node"), heads).checkpoint()

    # queries: to the groups of a lesser name in the same row
    placed = rows.select("row", "node", "size", "tokens").join(near.select("node", "group"), "node")
    mixed = placed.groupBy("row").agg(F.min("group").alias("a"), F.max("group").alias("b")).filter("a <> b")
    placed = placed.join(mixed.select("row"), "row").select("row", "node", "size", "tokens", F.col("group").alias("own"))
    groups = placed.select("row", F.col("own").alias("group")).distinct()
    # a member could be similar only if the query shares k tokens with its group
    visits = (placed.join(groups, "row").filter("group < own").groupBy("node", "group")
              .agg(F.sum("tokens").alias("n"), F.first("size").alias("size"))
              .filter(f"n >= 1 + ceil(3 * size / 4) div {SHARED_STEP}").select("node", "group"))
    unions = _unions(near).checkpoint()
    visits = _qualified(visits, near, unions).checkpoint()

    # members that aren't linked to their leader: queries to their own group
    loose = near.filter("node <> group AND comp <> group").select("node", "group")
    visits = visits.unionByName(loose)
    comp = near.select("node", "comp")
    inside = near.select("node", "group").join(visits.select("group").distinct(), "group").select("node", "group").checkpoint()
    known = comp.join(sets_of(inside.select("node").unionByName(visits.select("node")).distinct().checkpoint()), "node")
    sized = unions.select("group", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    queries = (visits.join(sized, "group").select("node", "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
               .join(known, "node").select("group", "block", F.lit(True).alias("query"), "node", "comp", "tokens"))
    inside = (inside.join(sized, "group").join(known, "node")
              .select("group", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
                      F.lit(False).alias("query"), "node", "comp", "tokens"))
    found = (inside.unionByName(queries).repartition("group", "block")
             .sortWithinPartitions("group", "block", "query")
             .mapInArrow(freeing(_open_blocks), "u binary, v binary"))
    star = near.filter("node <> comp").select(F.col("node").alias("u"), F.col("comp").alias("v"))
    return star.unionByName(found).checkpoint()


# -- 5. components -----------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the least id reachable, of every id in ``edges``
    (``u, v``), by alternating large-star and small-star rounds."""
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = e.checkpoint()
    before = None
    while True:
        # large star: neighbours above a node go to the least of its neighbours and itself
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: a node and its lesser neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = (small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(least.select("u", F.col("m").alias("v"))).distinct()).checkpoint()
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    ids = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ids.unionByName(heads)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` and
    ``node`` (16 bytes that name the set; null for an empty one)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sizes = _sizes(d).checkpoint()
    named = sizes.filter("id IS NOT NULL AND node IS NOT NULL")
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    links = node_links(d.filter("id IS NOT NULL"), total)
    reps = named.groupBy("node").agg(F.min("id").alias("rep")).checkpoint()
    u = reps.select(F.col("node").alias("u"), F.col("rep").alias("ru"))
    v = reps.select(F.col("node").alias("v"), F.col("rep").alias("rv"))
    # an id that several rows carry joins the sets of all of them
    doubled = named.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("id")
    same = (named.join(doubled, "id").join(reps, "node").filter("id <> rep")
            .select(F.col("id").alias("u"), F.col("rep").alias("v")))
    edges = links.join(u, "u").join(v, "v").select(F.col("ru").alias("u"), F.col("rv").alias("v")).unionByName(same)
    comp = components(edges)
    heads = reps.join(comp, F.col("rep") == F.col("id"), "left").select(
        "node", F.coalesce("component", "rep").alias("component_id"))
    return (sizes.join(heads, "node", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"), "node"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, columns as they were: of each
    component one row, that with the smallest id (of several rows with that id, the least text's).  Rows
    that a filter of the other ids rules out pass without a shuffle; rows with a null id stay."""
    found = jaccard_components(docs, id_col, text_col).filter(f"`{id_col}` IS NOT NULL AND node IS NOT NULL")
    ids = (found.groupBy(F.col(id_col).alias("id"))
           .agg(F.count("*").alias("n"), F.min("component_id").alias("component_id"))
           .filter("n > 1 OR component_id <> id").checkpoint())
    name = F.unhex(F.md5(F.col("id").cast("string").cast("binary")))
    table = docs.sparkSession.sparkContext.broadcast(_node_filter(ids.select(name.alias("node")), ids.count()))

    @F.pandas_udf("boolean")
    def maybe(names):
        import pandas as pd
        t = np.frombuffer(table.value, np.uint8)
        cells = _bits_of(names.tolist(), len(t) * 8)
        return pd.Series(((t[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1))

    m, box = fresh(docs, "_maybe"), fresh(docs, "_row")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    flagged = docs.withColumn(m, maybe(F.unhex(F.md5(key))) & F.col(id_col).isNotNull())
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hit = flagged.filter(F.col(m)).select(whole.alias(box), F.col(id_col).alias("_key"))
    hit = hit.join(ids.select(F.col("id").alias("_key"), "component_id", F.lit(True).alias("known")), "_key", "left")
    single = hit.filter("known IS NULL")
    several = (hit.filter("known AND component_id = _key").groupBy("_key")
               .agg(F.min_by(box, F.coalesce(F.col(f"{box}.{text_col}"), F.lit(""))).alias(box)))
    return (flagged.filter(~F.col(m)).select(*docs.columns)
            .unionByName(single.select(f"{box}.*")).unionByName(several.select(f"{box}.*")))
