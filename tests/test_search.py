"""k-NN search: exact against brute force, parent dedupe, filters, ANN recall (FIXTURES 2.8)."""

import numpy as np

from lodestone.operators import search as K

from .conftest import SF01


def brute(vecs, q, n):
    d = ((vecs - q) ** 2).sum(axis=1)
    return list(np.lexsort((np.arange(len(d)), d))[:n])


def test_knn_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((700, 16)).astype(np.float32)
    qs = rng.standard_normal((6, 16))
    vecs = spark.createDataFrame([(i, int(i % 7), x[i].tolist()) for i in range(700)],
                                 "chunk_id long, parent int, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(j, qs[j].tolist()) for j in range(6)],
                                    "query_id int, query_vec array<double>")
    got = K.knn(vecs, queries, 10).collect()
    for j in range(6):
        ids = [r.chunk_id for r in sorted((r for r in got if r.query_id == j), key=lambda r: r.rank)]
        assert ids == brute(x.astype(np.float64), qs[j], 10)
    per = K.knn(vecs, queries, 3, parent_col="parent", per_parent=True).collect()
    for j in range(6):
        rows = sorted((r for r in per if r.query_id == j), key=lambda r: r.rank)
        assert len({r.parent for r in rows}) == 3
        d = ((x.astype(np.float64) - qs[j]) ** 2).sum(axis=1)
        best = sorted({p: min(d[i] for i in range(700) if i % 7 == p) for p in range(7)}.items(),
                      key=lambda kv: kv[1])[:3]
        assert [r.parent for r in rows] == [p for p, _ in best]


def test_query_sets_over_the_bound_run_in_blocks(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 6)).astype(np.float32)
    qs = rng.standard_normal((23, 6))
    vecs = spark.createDataFrame([(i, x[i].tolist()) for i in range(120)],
                                 "chunk_id long, embedding array<float>")
    q = spark.createDataFrame([(j, qs[j].tolist()) for j in range(23)],
                              "query_id int, query_vec array<double>")
    got = K.knn(vecs, q, 3, block_bytes=500).collect()  # 23 queries, at most about 10 sent at a time
    assert len(got) == 23 * 3
    for j in range(23):
        ids = [r.chunk_id for r in sorted((r for r in got if r.query_id == j), key=lambda r: r.rank)]
        assert ids == brute(x.astype(np.float64), qs[j], 3)


def test_search_shape_filters_and_recall(spark):
    from lodestone.plans import views as V
    from lodestone.sources.tables import Tables
    t = Tables(spark, SF01)
    vec, q, meta = V.vector_chunks(t), V.label_centroids(t), V.label_metadata(t)
    post = K.search(vec, q, meta, 3, mode="post", id_col="vec_id", parent_col="label", category="VU",
                    metadata_fields=("kingdom", "iucn_red_list_category")).collect()
    pre = K.search(vec, q, meta, 3, mode="pre", id_col="vec_id", parent_col="label", category="VU",
                   metadata_fields=("kingdom", "iucn_red_list_category")).collect()
    for rows in (post, pre):
        assert all(r.metadata.iucn_red_list_category == "VU" for r in rows)
        for qid in {r.query_id for r in rows}:
            mine = sorted((r for r in rows if r.query_id == qid), key=lambda r: r.rank)
            assert len(mine) <= 3 and len({r.label for r in mine}) == len(mine)
            assert [r.score for r in mine] == sorted(r.score for r in mine)
    assert len(pre) == 3 * q.count() and len(post) <= len(pre)  # post-filter may lose rows
    none = K.search(vec, q, meta, 3, id_col="vec_id", parent_col="label",
                    equals={"no_such_column": "x"}).count()
    assert none == 0
    exact = K.knn(vec, q, 25, id_col="vec_id").collect()
    approx = K.knn_hashed(K.hash_buckets(vec.select("vec_id", "embedding"), 64, tables=16, bits=3),
                          K.hash_buckets(q, 64, tables=16, bits=3, vec_col="query_vec"), 25).collect()
    e = {(r.query_id, r.vec_id) for r in exact}
    a = {(r.query_id, r.vec_id) for r in approx}
    assert len(e & a) / len(e) >= 0.8


def test_per_parent_with_string_keys(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8)).astype(np.float32)
    q = rng.standard_normal((3, 8))
    vecs = spark.createDataFrame([(i, f"p{i % 11}", x[i].tolist()) for i in range(300)],
                                 "chunk_id long, parent string, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(j, q[j].tolist()) for j in range(3)],
                                    "query_id int, query_vec array<double>")
    got = K.knn(vecs, queries, 4, parent_col="parent", per_parent=True).collect()
    d64 = x.astype(np.float64)
    for j in range(3):
        d = ((d64 - q[j]) ** 2).sum(axis=1)
        best = sorted(((min(d[i] for i in range(300) if i % 11 == p), f"p{p}") for p in range(11)))[:4]
        rows = sorted((r for r in got if r.query_id == j), key=lambda r: r.rank)
        assert [r.parent for r in rows] == [p for _, p in best]


def test_repeated_query_ids_and_large_norms(spark):
    rng = np.random.default_rng(7)
    x = (rng.standard_normal((200, 4)) * 1e-3 + 1e6).astype(np.float64)  # neighbours far from the origin
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "chunk_id long, embedding array<double>")
    q = spark.createDataFrame([(1, x[5].tolist())] * 40, "query_id int, query_vec array<double>")
    got = K.knn(vecs, q, 3, block_bytes=200).collect()
    assert len(got) == 120 and {r.chunk_id for r in got if r.rank == 1} == {5}
    assert {r.chunk_id for r in got} == set(brute(x, x[5], 3))


def test_ninety_thousand_wide_queries(spark):
    """More query bytes than any one block: no limit on the query set."""
    from pyspark.sql import functions as F
    vecs = spark.createDataFrame([(0, [0.0] * 384), (1, [1.0] * 384)], "chunk_id long, embedding array<double>")
    q = spark.range(90_000).select(F.col("id").alias("query_id"), F.array_repeat((F.col("id") % 2).cast("double"), 384).alias("query_vec"))
    got = K.knn(vecs, q, 1)
    assert got.where("query_id % 2 = chunk_id and distance = 0").count() == 90_000


def test_a_task_holds_few_estimates():
    """Many queries against a large batch: the same neighbours as by brute force, in little memory."""
    import tracemalloc

    from lodestone.operators.search import _partition_topn
    rng = np.random.default_rng(3)
    q, x = rng.integers(-9, 9, (600, 4)).astype(float), rng.integers(-9, 9, (10_000, 4)).astype(float)
    ids = np.arange(len(x))
    tracemalloc.start()
    qi, found, _, dist = _partition_topn([(x[:7000], ids[:7000], ids[:7000]), (x[7000:], ids[7000:], ids[7000:])], q, 6, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6 and (qi == np.repeat(np.arange(600), 6)).all()
    for i in range(0, 600, 37):
        d = ((x - q[i]) ** 2).sum(axis=1)
        want = np.lexsort((ids, d))[:6]
        assert found[6 * i:6 * i + 6].tolist() == want.tolist() and dist[6 * i:6 * i + 6].tolist() == d[want].tolist()
