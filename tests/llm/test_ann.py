"""Posting lists at hundreds of lists: what is visited, what is found, how full lists are."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import ann


def clusters(n, groups, dim=32, seed=4):
    """Clusters whose vectors have norms that differ by much."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(groups, dim))[rng.integers(0, groups, n)] + 0.3 * rng.normal(size=(n, dim))
    return x * rng.lognormal(0, 0.5, size=(n, 1))


def jittered(n, groups, dim=32, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(groups, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.repeat(x, n // groups, axis=0) + 0.02 * rng.normal(size=(n, dim))


def truth(x, of, k=20):
    s = x[of] @ x.T
    s[np.arange(len(of)), of] = -np.inf
    return np.argsort(-s, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("x", [clusters(40_000, 160, 64), jittered(30_000, 1_500)], ids=["mixed norms", "jittered"])
def test_few_lists_are_visited(x):
    largest = np.linalg.norm(x, axis=1).max() * (1 + 1e-9)
    lifted = ann.lift(x, largest)
    c, weight = ann.balanced_centroids(lifted, 300)
    graph = ann.CentroidGraph(c)
    own = ann.lists_of(lifted, c, weight)
    sizes = np.bincount([j for o in own for j in o], minlength=len(c))
    first = np.bincount([o[0] for o in own], minlength=len(c))
    assert len(c) >= 250 and first.max() <= 4 * len(x) / len(c)  # balanced
    assert 1.05 * len(x) < sum(map(len, own)) <= ann.REPLICAS * len(x)  # boundary replicas
    of = np.random.default_rng(1).permutation(len(x))[:400]
    queries, lists = ann.asked(x[of], largest), [[own[j] for j in row] for row in truth(x, of)]
    ratio = ann.measured_ratio(graph, queries[:200], lists[:200], sizes, 66)
    taken = [set(graph.within(q, ratio, sizes, 66)) for q in queries[200:]]
    assert np.mean([len(t) for t in taken]) < 0.15 * len(c)
    assert np.mean([not t.isdisjoint(o) for t, row in zip(taken, lists[200:]) for o in row]) >= 0.9


def test_walk_finds_the_nearest_of_many_lists():
    c = np.random.default_rng(2).normal(size=(3_000, 16))
    graph, sizes = ann.CentroidGraph(c), np.full(3_000, 100)
    queries = np.random.default_rng(3).normal(size=(200, 16))
    found = [graph.within(q, 0.0, sizes, 66)[0] == ((c - q) ** 2).sum(axis=1).argmin() for q in queries]
    assert np.mean(found) >= 0.95


def test_ratio_is_infinite_without_trials_and_takes_all_lists():
    graph, sizes = ann.CentroidGraph(np.eye(5)), np.ones(5, dtype=int)
    assert ann.measured_ratio(graph, np.empty((0, 5)), [], sizes, 1) == float("inf")
    assert sorted(graph.within(np.ones(5), float("inf"), sizes, 1)) == list(range(5))


def test_recall_over_hundreds_of_lists(spark):
    x = clusters(6_000, 60, dim=16)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, list_size=20).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    of = np.arange(0, 6_000, 20)
    assert set(got) == set(of.tolist()) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[int(q)]) & set(t.tolist())) / 20 for q, t in zip(of, truth(x, of))]) >= 0.9


def test_dimension_is_that_of_the_whole_table(spark):
    rows = [(i, [1.0 + i, 2.0]) for i in range(1, 10)] + [(20, [1.0, 1.0]), (40, [1.0] * 3), (60, [2.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert {r["query_id"] for r in got} == {20} and [r["vec_id"] for r in got] == list(range(9, 0, -1))


@pytest.mark.parametrize("scale", [1e-9, 1e9])
def test_scores_of_any_size(spark, scale):
    x = clusters(400, 5, dim=8) * scale
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect()}
    of = np.arange(0, 400, 20)
    assert all(got[int(q), j + 1] == t for q, row in zip(of, truth(x, of)) for j, t in enumerate(row.tolist()))
