"""Prefix trie against a dictionary of prefixes."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from lodestone.llm.prefix_trie import SparseTable, conversation_turns, trie_nodes, with_shared_heads
from lodestone.llm.queries import op12_range_minimum_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(sequences):
    """conv_id -> tuple of (role, text): the nodes as tuples."""
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        if p:
            up = p[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(sequences[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute_rebuilt(rows):
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + s[h:])
    return out


def rows_of(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def test_sparse_table_extents():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 64, 100):
        v = rng.integers(0, 4, n)
        table = SparseTable(v)
        for at in range(n):
            for least in range(5):
                r = at
                while r + 1 < n and v[r + 1] >= least:
                    r += 1
                left = at
                while left > 0 and v[left] >= least:
                    left -= 1
                a, d = np.array([at]), np.array([least])
                assert table.right_extent(a, d)[0] == r and table.left_extent(a, d)[0] == left
                assert table.minimum(np.array([left]), np.array([r]))[0] == v[left:r + 1].min()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    got = rows_of(op12_range_minimum_prefix_trie(spark, f"/root/testdata/{sf}"))
    rows = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = brute(brute_rebuilt(map(tuple, rows)))
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("block_turns", [1, 7, 40, 100_000])
def test_blocks_of_any_size(spark, block_turns):
    """Few different turns, so prefixes reach over many blocks; copies, prefixes of others, none."""
    rng = random.Random(block_turns)
    sequences = {c: tuple((rng.choice("ua"), rng.choice(["x", "yy", "😀é"])) for _ in range(rng.choice((0, 1, 2, 3, 3, 4, 9))))
                 for c in range(-5, 140)}
    sequences |= {c: (("u", "same"), ("a", "answer")) for c in range(1000, 1080)}
    sequences |= {c: (("u", "long"),) * (300 + c % 3) for c in range(2000, 2004)}
    rows = [(c, t, *turn) for c, s in sequences.items() for t, turn in enumerate(s)]
    turns = conversation_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    none = spark.createDataFrame([(c,) for c, s in sequences.items() if not s], "conv_id long").selectExpr(
        "conv_id", "cast(array() as array<struct<turn: long, digest: binary, chars: long>>) as turns")
    got = rows_of(trie_nodes(turns.unionByName(none), block_turns))
    want = brute(sequences)
    assert len(got) == len(want) and set(got) == want


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, "x"), (1, 1, "user", None), (2, None, "user", "first"), (None, 1, "user", "nowhere"),
            (3, 5, "", ""), (4, 5, None, None), (5, 1, "user", "w" * 100_000), (5, 1, "user", "w" * 100_000), (200, 0, "user", "only"),
            (201, 0, "user", "own"), (202, 0, "user", "own"), (299, 9, "assistant", "a"), (299, 10, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as seq", "'x' as digests", "2 as block", "3 as n", "'y' as turns", "4 as prefix")
    got = rows_of(trie_nodes(with_shared_heads(conversation_turns(df))))
    want = brute(brute_rebuilt(rows))
    assert len(got) == len(want) and set(got) == want
    assert trie_nodes(with_shared_heads(conversation_turns(df.limit(0)))).count() == 0
