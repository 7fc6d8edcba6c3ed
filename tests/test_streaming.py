"""Incremental landing: each availableNow run processes only files it has not seen."""

from pyspark.sql import functions as F

from lodestone.sources import bronze as B
from lodestone.streaming.incremental import ingest_new_bronze


def test_incremental_runs(spark, tmp_path):
    root, target, ckpt = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    rows = lambda lo, hi: spark.range(lo, hi).select(
        F.concat(F.lit("q"), F.col("id").cast("string")).alias("query"), F.lit(200).alias("status"),
        F.to_json(F.struct(F.col("id").alias("n"))).alias("data"))
    B.write_bronze(B.envelopes(rows(0, 30), "src"), root, "b1")
    assert ingest_new_bronze(spark, root, target, ckpt) == 30
    B.write_bronze(B.envelopes(rows(30, 45), "src"), root, "b2")
    assert ingest_new_bronze(spark, root, target, ckpt) == 15
    assert ingest_new_bronze(spark, root, target, ckpt) == 0
    landed = spark.read.parquet(target)
    assert landed.count() == 45
    assert {r.batch_id for r in landed.select("batch_id").distinct().collect()} == {"b1", "b2"}
    # object payloads come back as their JSON text
    one = landed.where("query = 'q7'").first()
    assert one.data.replace(" ", "") == '{"n":7}'


def test_ingested_at_is_utc(spark):
    import datetime as dt
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        env = B.envelopes(spark.range(1).select(F.lit("q").alias("query"), F.lit(200).alias("status"),
                                                F.lit("x").alias("data")), "src")
        stamp = env.first().ingested_at
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert stamp.endswith("Z")
    got = dt.datetime.strptime(stamp, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=dt.timezone.utc)
    assert abs((dt.datetime.now(dt.timezone.utc) - got).total_seconds()) < 600


def test_newest_fetch_is_kept_without_code_by_key(spark, tmp_path, monkeypatch):
    """Fetches out of order, one of them twice; keys are told apart by a join, no Python state."""
    from pyspark.sql.streaming.query import StreamingQuery

    from lodestone.operators import validate as VAL
    from lodestone.sources.store import TableStore
    from lodestone.streaming.incremental import upsert_new_bronze
    root, ckpt, store, plans = str(tmp_path / "land"), str(tmp_path / "ck"), TableStore(spark, str(tmp_path / "st")), []
    real = StreamingQuery.awaitTermination

    def watched(query, *a):
        done = real(query, *a)
        plans.append(query._jsq.explainInternal(False))
        return done

    monkeypatch.setattr(StreamingQuery, "awaitTermination", watched)

    def land(day, prefix, keys):
        body = F.to_json(F.struct(F.lit(1).alias("usageKey"), F.lit(f"{prefix} name").alias("scientificName"), F.lit("EXACT").alias("matchType")))
        rows = spark.createDataFrame([(k,) for k in keys], "query string").select("query", F.lit(200).alias("status"), body.alias("data"))
        B.write_bronze(B.envelopes(rows, "gbif_taxonomy").withColumn("ingested_at", F.lit(f"{day}T00:00:00Z")), root, f"{day}-{prefix}")
        e = upsert_new_bronze(spark, root, store, "taxonomy", ckpt, lambda df: VAL.validate_taxonomy(df, key="query"),
                              "query", ["query", "scientific_name"])
        return [(x["filas_nuevas"], x["filas_actualizadas"]) for x in e]

    assert land("2024-02-01", "new", "abc") == [(3, 0)]
    assert land("2024-01-01", "old", "abcd") == [(1, 0)]  # a, b and c are older than known
    assert land("2024-02-01", "same", "aa") == [(0, 2)]  # as new as what is known
    assert land("2024-01-15", "late", "abcd") == [(0, 1)]
    assert land("2024-01-01", "old again", "d") == [(0, 0)]
    assert sorted(map(tuple, store.read("taxonomy").collect())) == [
        ("a", "same name"), ("b", "new name"), ("c", "new name"), ("d", "late name")]
    assert plans and not any("InPandas" in p for p in plans)
