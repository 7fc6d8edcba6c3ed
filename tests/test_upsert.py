"""Keyed upsert and evidence (FIXTURES 2.6), checked against DuckDB ON CONFLICT."""

import random

import duckdb
from pyspark.sql import functions as F

from lodestone.operators import upsert as U

COLS = ["k", "v", "first"]
SCHEMA = "k string, v string, first string, o int"


def ev(res):
    r = res.evidence.first()
    return r.filas_antes, r.filas_despues, r.filas_nuevas, r.filas_actualizadas


def test_update_then_idempotent_rerun(spark):
    b = spark.createDataFrame([("a", "1", "x", 0)], SCHEMA)
    empty = U.empty_like(b.select(*COLS))
    r1 = U.upsert(empty, b, "k", "o", COLS, name="t")
    assert ev(r1) == (0, 1, 1, 0)
    b2 = spark.createDataFrame([("a", "2", "y", 0)], SCHEMA)
    r2 = U.upsert(r1.table, b2, "k", "o", COLS, ["first"], name="t")
    assert ev(r2) == (1, 1, 0, 1)
    assert [tuple(x) for x in r2.table.collect()] == [("a", "2", "x")]  # insert-only kept


def test_duplicate_key_in_batch_and_empty_batch(spark):
    b = spark.createDataFrame([("n", "1", "f1", 1), ("n", "2", "f2", 2)], SCHEMA)
    empty = U.empty_like(b.select(*COLS))
    r = U.upsert(empty, b, "k", "o", COLS, ["first"])
    assert ev(r) == (0, 1, 1, 1)
    assert [tuple(x) for x in r.table.collect()] == [("n", "2", "f1")]
    e = U.upsert(r.table, b.where(F.lit(False)), "k", "o", COLS)
    assert ev(e) == (1, 1, 0, 0)


def test_two_batches_keep_all(spark):
    a = spark.createDataFrame([(f"a{i}", "x", "x", 0) for i in range(5)], SCHEMA)
    b = spark.createDataFrame([(f"b{i}", "y", "y", 0) for i in range(5)], SCHEMA)
    r = U.upsert(U.upsert(U.empty_like(a.select(*COLS)), a, "k", "o", COLS).table, b, "k", "o", COLS)
    assert r.table.count() == 10 and ev(r) == (5, 10, 5, 0)


def test_random_against_duckdb_on_conflict(spark):
    rnd = random.Random(3)
    target = [(f"k{i}", f"t{i}", f"t{i}") for i in range(40)]
    batch = [(f"k{rnd.randrange(60)}", f"b{j}", f"b{j}", j) for j in range(120)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR PRIMARY KEY, v VARCHAR, first VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", target)
    for k, v, f, _ in batch:
        con.execute("INSERT INTO t VALUES (?, ?, ?) ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v",
                    [k, v, f])
    want = sorted(con.execute("SELECT * FROM t").fetchall())
    t = spark.createDataFrame(target, "k string, v string, first string")
    b = spark.createDataFrame(batch, SCHEMA)
    r = U.upsert(t, b, "k", "o", COLS, ["first"])
    assert sorted(tuple(x) for x in r.table.collect()) == want
    new = len({k for k, *_ in batch} - {k for k, *_ in target})
    assert ev(r) == (40, 40 + new, new, 120 - new)
    # the evidence from keys alone equals that of the upserts
    steps = [t.withColumn("o", F.lit(0)), b, b]
    table, want = U.empty_like(t), []
    for s in steps:
        done = U.upsert(table, s, "k", "o", COLS, ["first"])
        table = done.table
        want.append(ev(done))
    assert [tuple(x)[2:] for x in U.evidence_of_steps(steps, "k").orderBy("step").collect()] == want


def test_values_of_one_record_stay_together(spark):
    b = spark.createDataFrame([("a", "1", None, 1), ("a", None, "y", 1)], SCHEMA)
    row = tuple(U.upsert(U.empty_like(b.select(*COLS)), b, "k", "o", COLS).table.first())
    assert row in {("a", "1", None), ("a", None, "y")}


def test_hot_key_batch(spark):
    # a third of the batch is one key: collapsed map-side, last / first values exact
    rows = [("hot", f"v{i}", f"f{i}", i) for i in range(600)] + \
           [(f"k{i}", "c", "c", i) for i in range(1200)]
    b = spark.createDataFrame(rows, SCHEMA).repartition(6)
    t = spark.createDataFrame([("k0", "old", "keep")], "k string, v string, first string")
    r = U.upsert(t, b, "k", "o", COLS, ["first"])
    got = {x.k: x for x in r.table.collect()}
    assert (got["hot"].v, got["hot"].first) == ("v599", "f0")
    assert got["k0"].first == "keep" and ev(r) == (1, 1201, 1200, 600)


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    import os

    from lodestone.sources.store import BUCKET, TableStore
    store = TableStore(spark, str(tmp_path / "wh"))
    rnd = random.Random(9)
    first = [(f"k{i}", f"a{i}", f"a{i}", 0) for i in range(200)]
    e1 = store.upsert_bucketed("t", spark.createDataFrame(first, SCHEMA), "k", "o", COLS,
                               ["first"], buckets=16).first()
    assert (e1.filas_antes, e1.filas_despues, e1.filas_nuevas) == (0, 200, 200)
    batch = [(f"k{rnd.randrange(5)}", f"b{j}", f"b{j}", j) for j in range(20)] + [("new1", "n", "n", 99)]
    e2 = store.upsert_bucketed("t", spark.createDataFrame(batch, SCHEMA), "k", "o", COLS,
                               ["first"], buckets=16).first()
    assert (e2.filas_antes, e2.filas_despues, e2.filas_nuevas, e2.filas_actualizadas) == (200, 201, 1, 20)
    rows = {r.k: r for r in store.read_bucketed("t").collect()}
    assert len(rows) == 201 and rows["new1"].v == "n"
    last = {}
    for k, v, _, o in batch:
        last[k] = v
    for k, v in last.items():
        assert rows[k].v == v and (k == "new1" or rows[k].first == "a" + k[1:])
    # the second version holds only the touched buckets
    v2 = [d for d in os.listdir(store.path("t", 2)) if d.startswith(BUCKET)]
    v1 = [d for d in os.listdir(store.path("t", 1)) if d.startswith(BUCKET)]
    assert 0 < len(v2) <= 6 < len(v1)


def test_plain_table_cannot_switch_to_buckets(spark, tmp_path):
    from lodestone.sources.store import TableStore
    store = TableStore(spark, str(tmp_path / "wh"))
    b = spark.createDataFrame([("a", "1", "x", 0)], SCHEMA)
    store.upsert("t", b, "k", "o", COLS)
    try:
        store.upsert("t", b, "k", "o", COLS, buckets=8)
        raise AssertionError("expected a layout error")
    except ValueError as e:
        assert "without buckets" in str(e)
