"""The table store: commit records, linear hashing, joins without an exchange, deltas."""
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import summarize as S
from lodestone.sources.store import Commit, ConcurrentCommit, TableStore

SCHEMA = "k string, v string, first string, o int"
COLS = ["k", "v", "first"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_linear_hashing_state():
    """Addresses of a grown table: every bucket is in range, splits move keys to their new half only."""
    c = Commit(1, "bucketed", None)
    seen = [(c.modulus, c.split)]
    for n in range(2, 40):
        c = c.grown(n)
        assert c.buckets == n and 0 <= c.split < c.modulus
        seen.append((c.modulus, c.split))
    assert seen[:8] == [(1, 0), (2, 0), (2, 1), (4, 0), (4, 1), (4, 2), (4, 3), (8, 0)]
    assert c.grown(3) == c

    def address(state, h):
        return h % (2 * state.modulus) if h % state.modulus < state.split else h % state.modulus

    small, large = Commit(1, "bucketed", None, modulus=4, split=1), Commit(1, "bucketed", None).grown(11)
    for h in range(1000):
        a, b = address(small, h), address(large, h)
        assert a < 5 and b < 11 and h % small.resolution(a) == a and h % large.resolution(b) == b
        if small.resolution(a) == large.resolution(a):
            assert a == b  # a bucket of the same resolution keeps its keys
    assert small.buckets == 5


def test_growth_keeps_rows_and_bucket_size(spark, tmp_path):
    store, want, rnd = TableStore(spark, str(tmp_path), rows_per_bucket=50), {}, random.Random(3)
    for step in range(7):
        rows = [(f"k{rnd.randrange(900)}", f"{step}.{i}", f"{step}.{i}", i) for i in range((18, 200, 5, 600, 0, 900, 30)[step])]
        e = store.upsert_bucketed("t", frame(spark, rows), "k", "o", COLS, ["first"]).first()
        before = len(want)
        for k, v, first, _ in rows:
            want[k] = (v, want.get(k, (None, first))[1])
        assert (e.filas_antes, e.filas_despues, e.filas_actualizadas) == (before, len(want), len(rows) - (len(want) - before))
        got = {r.k: (r.v, r.first) for r in store.read("t").collect()}
        assert got == want and store.counts(["t"]).first()["count"] == len(want)
        sizes = store.bucket_rows("t")
        assert sum(sizes.values()) == len(want) and (not sizes or max(sizes.values()) <= 150)
        store.vacuum("t")
        assert {r.k for r in store.read("t").collect()} == set(want)
    assert store.current("t").buckets > 12
    for k in ("k1", "nowhere"):
        assert [r.v for r in store.lookup("t", "k", k).collect()] == ([want[k][0]] if k in want else [])


def test_a_large_table_grows_from_18_rows(spark, tmp_path):
    """5,000,000 rows over a table made with 18; afterwards a batch of three keys rewrites three buckets."""
    store = TableStore(spark, str(tmp_path), rows_per_bucket=250_000)
    rows = spark.range(5_000_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.lit(1).alias("o"))
    store.upsert_bucketed("t", rows.where("k < 18"), "k", "o", ["k", "v"])
    assert store.current("t").buckets == 1
    e = store.upsert_bucketed("t", rows, "k", "o", ["k", "v"]).first()
    sizes = store.bucket_rows("t")
    assert (e.filas_antes, e.filas_despues) == (18, 5_000_000) and len(sizes) == 21 and max(sizes.values()) < 400_000
    before = store.current("t")
    store.upsert_bucketed("t", spark.createDataFrame([(1, 0, 1), (2, 0, 1), (3, 0, 1)], "k long, v long, o int"), "k", "o", ["k", "v"])
    after = store.current("t")
    assert sum(after.parts[b] != before.parts[b] for b in before.parts) <= 3
    assert store.read("t").agg(F.sum("v")).first()[0] == 3 * (4_999_999 * 5_000_000 // 2) - 18


def test_target_is_joined_without_an_exchange(spark, tmp_path, monkeypatch):
    from lodestone.operators import upsert as U
    store, plans = TableStore(spark, str(tmp_path), rows_per_bucket=20), []
    rows = [(f"k{i}", "a", "a", 0) for i in range(150)]
    store.upsert_bucketed("t", frame(spark, rows), "k", "o", COLS)
    real = U.observed_write

    def watched(merged, write):
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return real(merged, write)

    monkeypatch.setattr(U, "observed_write", watched)
    store.upsert_bucketed("t", frame(spark, [("k1", "b", "b", 1), ("new", "b", "b", 1)]), "k", "o", COLS)
    target = [x for x in plans[0].split("SortMergeJoin")[1].split("\n") if "Exchange" in x or "Bucketed: true" in x or "FileScan" in x]
    assert "Bucketed: true" in plans[0] and sum("Exchange" in x for x in target) == 1, plans[0]
    assert store.read("t").count() == 151


def test_emptied_buckets_stay_empty(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), rows_per_bucket=3)
    lines = spark.createDataFrame([(f"k{i}", j) for i in range(8) for j in range(3)], "k string, n int")
    store.replace_keys("t", lines, "k")
    store.replace_keys("t", lines.limit(0), "k", gone=lines.where("k != 'k3'"))
    assert sorted(map(tuple, store.read("t").collect())) == [("k3", 0), ("k3", 1), ("k3", 2)]
    store.replace_keys("t", spark.createDataFrame([("k3", 9), ("new", 1)], "k string, n int"), "k")
    assert sorted(map(tuple, store.read("t").collect())) == [("k3", 9), ("new", 1)]
    store.replace_keys("t", lines.limit(0), "k", gone=store.read("t"))
    assert store.read("t").count() == 0 and store.exists("t")
    store.vacuum("t")
    assert store.read("t").count() == 0


def test_two_writers(spark, tmp_path):
    """Of two commits on the same version the second fails and shows nothing."""
    a, b = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    df = spark.createDataFrame([("x", 1)], "k string, n int")
    a.write("t", df)
    base, real = a.current("t"), b.current
    b.current = lambda table: base if table == "t" else real(table)  # b has read the table before a writes
    a.write("t", df.withColumn("n", F.lit(2)))
    with pytest.raises(ConcurrentCommit):
        b.write("t", df.withColumn("n", F.lit(3)))
    assert [r.n for r in TableStore(spark, str(tmp_path)).read("t").collect()] == [2]
    assert not [n for n in a._names(f"{tmp_path}/t/_log") if n.startswith("aside-")]


def test_partitions_replace_whole_batches(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", "R1"), ("b", "R2")], "record_key string, reason string")
    store.write_partition("quarantine", rows, "b1")
    store.write_partition("quarantine", rows.where("record_key = 'a'"), "b2")
    assert store.read("quarantine").groupBy("batch_id").count().orderBy("batch_id").collect() == [("b1", 2), ("b2", 1)]
    store.write_partition("quarantine", rows.limit(0), "b1")
    assert [tuple(r) for r in store.read("quarantine").collect()] == [("a", "R1", "b2")]
    assert store.tables() == ["quarantine"] and store.vacuum("quarantine") == 1
    assert [tuple(r) for r in store.read("quarantine").collect()] == [("a", "R1", "b2")]


def test_null_keys(spark, tmp_path):
    from lodestone.operators import upsert as U
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no k"):
        store.upsert_bucketed("t", frame(spark, [("a", "1", "x", 0), (None, "2", "x", 0)]), "k", "o", COLS)
    b = frame(spark, [("a", "1", "x", 0), (None, "2", "x", 0)])
    once = U.upsert(U.empty_like(b.select(*COLS)), b, "k", "o", COLS).table
    assert U.upsert(once, b, "k", "o", COLS).table.count() == 2  # a null key is one key in a plain upsert


def test_summary_state_by_deltas(spark, tmp_path):
    """Batches one by one, some applied twice, equal one pass over all."""
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot", "hot", *"abcdef"]), i, rnd.choice([None, "", "ES", "US", "MX", "PT"]), rnd.choice([None, "LC", "VU", "EN"]),
             rnd.choice([None, "2001-05-01", "2010-01-02", "1999-12-31"])) for i in range(400)]
    obs = spark.createDataFrame(rows, "k string, pos long, country string, cat string, d string").withColumn("d", F.to_timestamp("d"))
    want = sorted(map(str, S.summarize_observations(obs, "k", "pos", "country", "cat", "d").collect()))
    store = TableStore(spark, str(tmp_path), rows_per_bucket=10)
    order = [7, 1, 0, 3, 3, 2, 5, 4, 6, 7]
    done = [store.merge_delta("s", S.summary_state(obs.where(f"pos % 8 = {i}"), "k", "pos", "country", "cat", "d"), "k",
                              f"batch-{i}", S.merge_states) for i in order]
    assert done == [i not in order[:n] for n, i in enumerate(order)]
    assert sorted(map(str, S.summary_of_state(store.read("s"), "k").collect())) == want


def test_files_grow_with_the_buckets(spark, tmp_path):
    """A Spark bucket is one file, however many tasks write, and its Bloom filter is small."""
    store, confs = TableStore(spark, str(tmp_path), rows_per_bucket=50), {
        "spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {c: spark.conf.get(c) for c in confs}
    rows = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.lit(1).alias("o"))
    try:
        for c, v in confs.items():
            spark.conf.set(c, v)
        store.upsert_bucketed("t", rows, "k", "o", ["k", "v"])
        store.upsert_bucketed("t", rows.where("k % 3 = 0").withColumn("v", F.lit(0)), "k", "o", ["k", "v"])
        store.replace_keys("lines", rows.drop("o"), "k")
        store.replace_keys("lines", rows.drop("o").where("k < 10"), "k", gone=rows.where("k % 3 = 0"))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    for table in ("t", "lines"):
        now = store.current(table)
        for version in (1, 2):
            files = list((tmp_path / table / f"v={version:06d}").rglob("*.parquet"))
            assert len(files) <= 2 * now.buckets and sum(f.stat().st_size for f in files) < 500_000
    assert store.read("t").agg(F.count("k"), F.sum("v")).first()[:] == (3000, 3 * sum(k for k in range(3000) if k % 3))
    assert store.read("lines").count() == 2004
    assert [r.v for r in store.lookup("t", "k", 7).collect()] == [21] and not store.lookup("t", "k", 3000).count()


def _tasks_of_writes(store, monkeypatch):
    """The tasks that each later write of buckets has."""
    tasks, real = [], store._write_buckets

    def watched(table, rows, *rest):
        tasks.append(rows.rdd.getNumPartitions())
        return real(table, rows, *rest)

    monkeypatch.setattr(store, "_write_buckets", watched)
    return tasks


def test_a_grown_table_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A batch that outgrows a table of two files is not dealt to two tasks."""
    store = TableStore(spark, str(tmp_path), rows_per_bucket=20_000)
    rows = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.lit(1).alias("o"))
    store.upsert_bucketed("t", rows.where("k < 18"), "k", "o", ["k", "v"])
    tasks = _tasks_of_writes(store, monkeypatch)
    store.upsert_bucketed("t", rows, "k", "o", ["k", "v"])
    assert tasks[0] >= 4 and store.read("t").agg(F.sum("v")).first()[0] == 3 * (99_999 * 50_000)


def test_tasks_do_not_grow_with_the_buckets(spark, tmp_path, monkeypatch):
    """A replaced table of 150 buckets is written and listed by few tasks: each sends its result to the driver."""
    store, rows = TableStore(spark, str(tmp_path), rows_per_bucket=2), spark.range(300).selectExpr("id k", "id * 2 v")
    tasks = _tasks_of_writes(store, monkeypatch)
    store.replace_keys("t", rows, "k")
    store.replace_keys("t", rows.withColumn("v", F.lit(0)).where("k < 100"), "k", gone=rows.where("k >= 250"))
    assert store.current("t").buckets == 200 and max(tasks) <= 16
    spark.sparkContext.setJobGroup("listing", "")
    assert store.read("t").agg(F.count("k"), F.sum("v")).first()[:] == (250, sum(2 * k for k in range(100, 250)))
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) < 100


def test_long_texts_are_dealt_once(spark, tmp_path, monkeypatch):
    """the columns of ``wide`` reach the writing tasks by one exchange, and the target's rows by none."""
    from lodestone.operators import upsert as U
    store, plans = TableStore(spark, str(tmp_path), rows_per_bucket=20), []
    real = U.observed_write

    def watched(merged, write):
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return real(merged, write)

    monkeypatch.setattr(U, "observed_write", watched)
    want = {}
    for step, keys in enumerate((range(150), range(100, 200))):
        rows = spark.createDataFrame([(f"k{i}", f"v{step}.{i}.{j}", j) for i in keys for j in (0, 1)], "k string, v string, o int")
        wide = spark.createDataFrame([(f"k{i}", f"text {step}.{i}") for i in keys if i % 3] + [("other", "x")], "k string, text string")
        e = store.upsert_bucketed("t", rows, "k", "o", ["k", "text", "v"], wide=wide).first()
        before = len(want)
        want |= {f"k{i}": (f"text {step}.{i}" if i % 3 else None, f"v{step}.{i}.1") for i in keys}
        assert (e.filas_antes, e.filas_despues, e.filas_nuevas + e.filas_actualizadas) == (before, len(want), 2 * len(keys))
    assert store.current("t").schema.names == ["k", "text", "v"]
    assert {r.k: (r.text, r.v) for r in store.read("t").collect()} == want
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plans[1] and "lodestone_" not in "".join(
        p for p in plans[1].split("Exchange hashpartitioning")[1:] if "Bucketed: true" not in p)
    with pytest.raises(ValueError):
        store.upsert_bucketed("t", spark.createDataFrame([(None, "v", 1)], "k string, v string, o int"), "k", "o",
                              ["k", "text", "v"], wide=wide)


def test_files_are_as_many_as_the_tasks(spark, tmp_path):
    """a table whose rows take more tasks than it has store buckets is joined where it lies."""
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.lit(1).alias("o"))
    store.upsert_bucketed("t", rows, "k", "o", ["k", "v"])
    now, made = store.current("t"), []
    files = list((tmp_path / "t" / "v=000001").rglob("*.parquet"))
    tasks = store._tasks(2 * now.modulus, now.rows)
    assert now.buckets == 1 and tasks == 4 and len(files) == 4 and {p.files for p in now.parts.values()} == {4}
    store._target("t", now, list(now.parts), tasks, made)
    assert made
    spark.sql(f"DROP TABLE {made[0]}")
    store.upsert_bucketed("t", rows.where("k < 10").withColumn("v", F.lit(0)), "k", "o", ["k", "v"])
    assert store.read("t").agg(F.count("k"), F.sum("v")).first()[:] == (100_000, 3 * (99_999 * 50_000) - 135)
    assert [r.v for r in store.lookup("t", "k", 77).collect()] == [231]


def test_scratch_tables_go(spark, tmp_path):
    """Tables of a block are deleted when dropped and at its end, also after an error; settings come back."""
    import os

    from lodestone.session import SHUFFLE_CLEANUP, SPLIT, Scratch, _megabytes
    old = [spark.conf.get(c, None) for c in (SHUFFLE_CLEANUP, SPLIT)]
    with pytest.raises(RuntimeError), Scratch(spark) as scratch:
        a, b = scratch.keep(spark.range(10)), scratch.keep(spark.range(20))
        paths = [p for _, p in scratch._made]
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true" and _megabytes(spark.conf.get(SPLIT)) <= 32
        scratch.drop(a)
        assert not os.path.exists(paths[0]) and b.count() == 20
        with pytest.raises(Exception):
            scratch.keep(spark.range(10).selectExpr("raise_error('no')"))
        raise RuntimeError
    assert not any(map(os.path.exists, paths)) and [spark.conf.get(c, None) for c in (SHUFFLE_CLEANUP, SPLIT)] == old
    assert [_megabytes(x) for x in ("134217728b", "16m", "1g", "2048k", "1048576")] == [128, 16, 1024, 2, 1]
