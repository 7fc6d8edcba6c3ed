"""Prefix trie of conversations: range minima over sorted longest common prefixes.

A conversation is a sequence of turn digests.  Distinct sequences are sorted; every node of the
trie is an interval of the sorted order, and candidate prefixes (a sequence and a depth at which
it differs from its predecessor) find it by themselves: a sparse table over the longest common
prefixes (LCP) of neighbours lets each search its left and its right extent binarily, all
candidates of a block at once, with no stack and no order between them.  What a node reports is a
difference of prefix sums or a range minimum over its interval.

Spark sorts by range into blocks of bounded size.  A block learns the LCPs across its two borders;
prefixes that reach over a border give partial sums, which are added up over the blocks by the
prefix's digest.  All of a node's figures are sums or minima of parts, so nothing is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

#: Turns in a block of sorted sequences, about.
BLOCK_TURNS = 200_000
#: Ids hashed by one row of the digest of a node's ends.
RUN = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


class SparseTable:
    """Range minima of an array in two look-ups."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def minimum(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Least of ``values[left..right]``, ends included; left <= right."""
        k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), dtype=self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            table = self.levels[level]
            out[at] = np.minimum(table[left[at]], table[right[at] - (1 << int(level)) + 1])
        return out

    def right_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last r with ``values[at+1..r] >= least``, by halving steps."""
        r, n = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            inside = r + step < n
            go = inside & (table[np.where(inside, r + 1, 0)] >= least)
            r += go * step
        return r

    def left_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first l with ``values[l+1..at] >= least``, by halving steps."""
        left = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            inside = left - step >= 0
            go = inside & (table[np.where(inside, left - step + 1, 0)] >= least)
            left -= go * step
        return left


def neighbour_lcp(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """LCP of every sequence with the one before it (the first: 0); ``flat`` holds the turns'
    digests, two words each."""
    lcp = np.zeros(len(size), dtype=np.int64)
    active, depth = np.arange(1, len(size)), 0
    while len(active):
        active = active[(size[active] > depth) & (size[active - 1] > depth)]
        active = active[(flat[start[active] + depth] == flat[start[active - 1] + depth]).all(axis=1)]
        depth += 1
        lcp[active] = depth
    return lcp


NODE = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, prefix binary, parent_prefix binary")


def block_nodes(table: pa.Table, root: int) -> pa.Table:
    """The nodes of one block of sequences; see ``NODE``.  ``prefix`` is set where the node goes
    on in another block (its figures are then this block's part of them).  ``root`` is the
    smallest of all conv_ids."""
    keys = [b"".join(t) for t in table.column("digests").to_pylist()]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
    n = len(order)
    size = np.array([len(keys[i]) // 16 for i in order], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    flat = np.frombuffer(b"".join(keys[i] for i in order), dtype=np.uint64).reshape(-1, 2)
    column = table.column("chars").combine_chunks()
    given = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.concatenate([values[given[i]:given[i + 1]] for i in order]) if n else values
    # characters of a sequence's first d turns: total[start + d] - total[start]
    total = np.concatenate([[0], np.cumsum(chars)])

    def pick(name):
        return table.column(name).to_numpy()[order]

    convs, least = pick("n"), pick("conv_id")
    lcp = neighbour_lcp(flat, start, size)
    left_border, right_border = int(pick("left_lcp")[0]), int(pick("right_lcp")[0])  # -1: none
    lcp[0] = left_border  # the root begins in the first block of all
    following = np.append(lcp[1:], right_border)
    of_lcp, of_conv = SparseTable(np.append(lcp, -1)), SparseTable(least)

    def to_depth(rows, depth):
        return total[start[rows] + depth] - total[start[rows]]

    whole = to_depth(np.arange(n), size)
    summed = [np.concatenate([[0], np.cumsum(v)]) for v in (
        convs, convs * whole, whole - to_depth(np.arange(n), np.maximum(lcp, 0)), following < size)]

    def between(which, left, right):
        return summed[which][right + 1] - summed[which][left]

    # candidates: the depths at which a sequence leaves its predecessor, and those carried in
    depths = [np.arange(lcp[i] + 1, size[i] + 1) for i in range(n)]
    if left_border >= 0:
        depths[0] = np.arange(0, size[0] + 1)
    at = np.repeat(np.arange(n), [len(d) for d in depths])
    depth = np.concatenate(depths)
    left, right = of_lcp.left_extent(at, depth), of_lcp.right_extent(at, depth)
    # the carried-in prefixes of row 0 end where the predecessor block's border cuts them
    first = (left == 0) & (depth <= left_border)
    last = (right == n - 1) & (depth <= right_border)
    shared = first | last
    own = depth - 1  # a node's own last turn is counted once, at its first sequence
    n_convs, before = between(0, left, right), to_depth(left, np.maximum(own, 0))
    distinct = np.where(first, between(2, left, right), between(2, left + 1, right) + whole[left] - before)
    saved = between(1, left, right) - n_convs * before - distinct
    # children: sequences of the interval that leave their predecessor just below the node
    pairs = np.sort(lcp.astype(np.int64) * (n + 1) + np.arange(n))
    equal = np.searchsorted(pairs, depth * (n + 1) + right, "right") - np.searchsorted(pairs, depth * (n + 1) + left)
    opens = (lcp[left] < depth) & (size[left] > depth)  # the interval's first sequence
    children = equal + opens
    ends = np.where((size[left] == depth) & ~first, left, -1)
    parent_at = of_lcp.left_extent(at, np.maximum(own, 0))
    parent_to = of_lcp.right_extent(at, np.maximum(own, 0))
    parent_shared = ((parent_at == 0) & (own <= left_border)) | ((parent_to == n - 1) & (own <= right_border))
    conv, parent = of_conv.minimum(left, right), of_conv.minimum(parent_at, parent_to)
    parent[own == 0] = root

    @lru_cache(maxsize=None)  # as many as there are prefixes over the borders
    def prefix(row, d):
        return hashlib.sha256(flat[start[row]:start[row] + d].tobytes()).digest()

    def prefixes(row, d, wanted):
        return pa.array([prefix(i, k) if w else None for i, k, w in
                         zip(row.tolist(), d.tolist(), wanted.tolist())], pa.binary())

    sha = table.column("ends_sha256").to_pylist()
    asked = (own > 0) & parent_shared
    return pa.table({
        "depth": depth, "conv_id": conv,
        "parent_conv_id": pa.array(parent, mask=(depth == 0) | asked),
        "n_convs": n_convs, "n_children": children, "n_leaves": between(3, left, right), "saved_tokens": saved,
        "ends_sha256": pa.array([sha[order[e]] if e >= 0 else None for e in ends.tolist()], pa.string()),
        "prefix": prefixes(left, depth, shared), "parent_prefix": prefixes(parent_at, own, asked)})


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (seq, conv_id) -> runs of at most RUN ids of one sequence."""
    seq, ids, done = None, [], []

    def close():
        if ids:
            done.append((seq, ids[0], ",".join(map(str, ids)), len(ids)))
            ids.clear()

    def rows():
        out = pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.string()), pa.array([d[3] for d in done], pa.int64())],
            ["seq", "first", "ids", "n"])
        done.clear()
        return out

    for batch in batches:
        for s, c in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if s != seq or len(ids) >= RUN:
                close()
                seq = s
            ids.append(c)
        if done:
            yield rows()
    close()
    if done:
        yield rows()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of (seq, first) -> (seq, hash of all ids, smallest id, number), streamed."""
    seq, sha, least, n, done = None, None, 0, 0, []

    def rows():
        out = pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string()),
             pa.array([d[2] for d in done], pa.int64()), pa.array([d[3] for d in done], pa.int64())],
            ["seq", "ends_sha256", "conv_id", "n"])
        done.clear()
        return out

    for batch in batches:
        for s, first, ids, k in zip(*(batch.column(c).to_pylist() for c in ("seq", "first", "ids", "n"))):
            if sha is None or s != seq:
                if sha is not None:
                    done.append((seq, sha.hexdigest(), least, n))
                seq, sha, least, n = s, hashlib.sha256(ids.encode()), first, k
            else:
                sha.update(b"," + ids.encode())
                n += k
        if done:
            yield rows()
    if sha is not None:
        done.append((seq, sha.hexdigest(), least, n))
        yield rows()


def _digest(*parts) -> F.Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def conversation_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order as structs of a 16-byte
    digest of role and text and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return (rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"),
                 _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
                 F.length(text).cast("long").alias("chars")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def trie_nodes(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the prefix trie of ``conversations`` (conv_id, turns as conversation_turns gives
    them, none allowed): one row per distinct prefix: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.  Conversations
    without turns belong to the root alone; repeated conversations count each; an empty table
    gives no rows.  A conversation's digests (24 bytes a turn) are one value."""
    spark = conversations.sparkSession
    ship_package(spark)
    given = cut_lineage(conversations.select(
        "conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"),
        F.unhex(F.substring(F.sha2(F.array_join(F.transform("turns.digest", F.hex), "").cast("binary"), 256), 1, 32)).alias("seq")))
    sums = given.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("digests")).alias("turns"),
                     F.min("conv_id").alias("root")).first()
    if not sums["n"]:
        return spark.createDataFrame([], NODE).select(*NODES)
    ends = (given.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
            .mapInArrow(_runs, "seq binary, first long, ids string, n long")
            .repartition("seq").sortWithinPartitions("seq", "first")
            .mapInArrow(_hashed, "seq binary, ends_sha256 string, conv_id long, n long"))
    distinct = given.groupBy("seq").agg(F.first("digests").alias("digests"), F.first("chars").alias("chars"))
    blocks = max(1, -(-(sums["turns"] or 0) // block_turns))
    key = F.array_join(F.transform("digests", F.hex), "")
    placed = cut_lineage(ends.join(distinct, "seq").drop("seq").repartitionByRange(blocks, key)
                         .withColumn("block", F.spark_partition_id()))
    # a row for each block that has any: LCPs across its borders
    order = Window.orderBy("block")
    both = placed.groupBy("block").agg(F.min(key).alias("low"), F.max(key).alias("high")).select(
        "block", "low", "high", F.lag("high").over(order).alias("before"))
    longest = F.least(F.length("low"), F.length("before"))
    # turns are 32 digits: the first one in which the keys differ ends the common prefix
    lcp = F.when(F.col("before").isNull(), -1).otherwise(F.coalesce(
        F.array_position(F.transform(F.sequence(F.lit(0), (longest / 32).cast("int")), lambda i: F.when(
            (i * 32 < longest) & (F.substr("low", i * 32 + 1, F.lit(32)) == F.substr("before", i * 32 + 1, F.lit(32))),
            0).otherwise(1)), 1) - 1, F.lit(0)))
    borders = both.select("block", lcp.cast("long").alias("left_lcp")).select(
        "block", "left_lcp", F.coalesce(F.lead("left_lcp").over(order), F.lit(-1)).cast("long").alias("right_lcp"))
    root = sums["root"]

    def nodes_of(table: pa.Table) -> pa.Table:
        return block_nodes(table, root)

    nodes = cut_lineage(placed.join(borders, "block").groupBy("block").applyInArrow(nodes_of, NODE))
    # parts of prefixes that reach over borders are added up; all their parents reach over, too
    parts = cut_lineage(nodes.where("prefix is not null").groupBy("prefix").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"), F.max("parent_prefix").alias("parent_prefix")))
    upper = parts.select(F.col("prefix").alias("parent_prefix"), F.col("conv_id").alias("upper"))
    every = nodes.where("prefix is null").drop("prefix").unionByName(parts.drop("prefix").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(root).cast("long"))))
    below = every.where("parent_prefix is not null").join(upper, "parent_prefix", "left").withColumn(
        "parent_conv_id", F.col("upper"))
    return every.where("parent_prefix is null").select(*NODES).unionByName(below.select(*NODES)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def with_shared_heads(turns: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % every, h = crc32(c) %
    heads, then c's own turns after its first h."""
    head = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, heads).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    rebuilt = (turns.withColumn("_base", F.col("conv_id") - F.col("conv_id") % every).withColumn("_h", h)
               .join(head, "_base", "left"))
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return rebuilt.select("conv_id", F.when(F.col("_head").isNull(), own).otherwise(
        F.concat(F.slice("_head", F.lit(1), F.col("_h")), own)).alias("turns"))
