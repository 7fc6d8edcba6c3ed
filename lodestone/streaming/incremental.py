"""Incremental landing with Structured Streaming.

``readStream`` over the bronze folder (explicit schema, partition columns from
the ``source=/batch_id=`` paths) with ``trigger(availableNow=True)``: each run
processes only files not seen by earlier runs (the checkpoint keeps the file
log), then stops.  ``foreachBatch`` writes every micro-batch to its own
``epoch=N`` folder with overwrite, so a retried epoch replaces its own output
instead of appending twice (exactly-once into a plain Parquet sink).

``upsert_new_bronze`` keeps the time of every key's newest fetch in a bucketed table beside the query's
checkpoint, so files may land in any order: a fetch older than what its key already has changes
nothing, however late it comes (there is no watermark that would drop it unseen; the state is one
time a key).  A micro-batch is joined to the known times as a whole: no code runs key by key.  The
times are committed after the rows, so a repeated micro-batch meets the times it met before.  Everything an epoch rejects, records as well as lines that are no envelopes, is in the
quarantine table as that epoch's part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rules as R
from ..session import cut_lineage
from ..sources import bronze as B
from ..sources.bronze import CORRUPT, LANDED_SCHEMA, responses_of
from ..sources.store import TableStore


def landed_stream(spark: SparkSession, bronze_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelopes as they land."""
    reader = spark.readStream.schema(LANDED_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(bronze_root)


def ingest_new_bronze(spark: SparkSession, bronze_root: str, target: str, checkpoint: str,
                      transform: Callable[[DataFrame], DataFrame] = responses_of,
                      max_files_per_trigger: int | None = None) -> int:
    """Process new landed files once; returns the number of rows written by this run."""
    stream = landed_stream(spark, bronze_root, max_files_per_trigger)
    written = {"rows": 0}

    def sink(batch: DataFrame, epoch: int) -> None:
        out = transform(batch)
        out.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")
        # count from the files just written (metadata-only), not a second pass over the input
        written["rows"] += spark.read.parquet(f"{target}/epoch={epoch}").count()

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return written["rows"]


_ROW, _REJECT, _LINE = "row", "reject", "line"
NEWEST = "newest_fetch"  # table of (record_key, fetched), in a store under the checkpoint folder


def tagged_rows(checked: DataFrame, lines: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Streaming: (kind, record_key, fetched, reason, payload) of checked rows, of rejects and of
    lines that are no envelopes."""
    kept = list(dict.fromkeys([*columns, key]))
    reason = F.when(F.col(R.REASON).isNull() & F.col(key).isNull(), R.MISSING_KEY).otherwise(F.col(R.REASON))
    rows = checked.select(
        F.when(reason.isNull(), _ROW).otherwise(_REJECT).alias("kind"), F.col(key).cast("string").alias("record_key"),
        F.col(f"{order}.ingested_at").alias("fetched"), reason.alias("reason"),
        F.when(reason.isNull(), F.to_json(F.struct(*kept, order))).otherwise(
            F.to_json(F.struct(R.CONTEXT, "source"))).alias("payload"))
    other = lines.where(F.col(CORRUPT).isNotNull() | F.col("raw_responses").isNull()).select(
        F.lit(_LINE).alias("kind"), F.col("landed.file_path").alias("record_key"), F.lit(None).cast("string").alias("fetched"),
        F.lit(R.HTTP_ERROR).alias("reason"),
        F.to_json(F.struct("source", "batch_id", F.col(CORRUPT).alias("record"), F.col("landed.file_path").alias("file"))).alias("payload"))
    return rows.unionByName(other)


def newest_rows(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows that are not older than what is known of their key: ``known(record_key, fetched)``."""
    rows = rows.withColumn("fetched", F.coalesce("fetched", F.lit("")))
    if known is None:
        return rows
    old = known.select("record_key", F.col("fetched").alias("_known"))
    return rows.join(old, "record_key", "left").where(
        F.col("fetched") >= F.coalesce("_known", F.lit(""))).drop("_known")


def upsert_new_bronze(spark: SparkSession, bronze_root: str, store, table: str, checkpoint: str,
                      checked: Callable[[DataFrame], DataFrame], key: str, columns: Sequence[str],
                      order: str = "fetch", quarantine: str = "quarantine",
                      max_files_per_trigger: int | None = None) -> list[dict]:
    """Validate new landed files and upsert them by key: ``checked`` turns responses into rows
    with ``rejection_reason`` and context; valid ones that are not older than their key's newest
    fetch go to ``table`` of the store, rejects and broken lines to ``quarantine``.  Returns the
    evidence of each micro-batch.  A repeated micro-batch upserts the same keys again and adds
    none."""
    evidence: list[dict] = []
    times = TableStore(spark, f"{checkpoint.rstrip('/')}/newest")
    stream = B.with_place(landed_stream(spark, bronze_root, max_files_per_trigger))
    rows = checked(responses_of(stream))
    tagged = tagged_rows(rows, stream, key, columns, order)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    kept = list(dict.fromkeys([*columns, key]))
    row_type = T.StructType([T.StructField(c, kinds[c]) for c in (*kept, order)])
    reject_type = T.StructType([T.StructField(R.CONTEXT, T.MapType(T.StringType(), T.StringType())),
                                T.StructField("source", T.StringType())])
    line_type = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "batch_id", "record", "file")])

    def of(batch: DataFrame, kind: str, schema: T.StructType) -> DataFrame:
        return batch.where(F.col("kind") == kind).select("record_key", "reason", F.from_json("payload", schema).alias("p"))

    def sink(batch: DataFrame, epoch: int) -> None:
        batch = cut_lineage(batch)
        rejects = of(batch, _REJECT, reject_type).select(
            F.col("p.source").alias("source"), F.coalesce("record_key", F.lit("None")).alias("record_key"),
            F.col("reason").alias(R.REASON), F.col(f"p.{R.CONTEXT}").alias(R.CONTEXT))
        lines = of(batch, _LINE, line_type).select("p.*")
        lines = lines.select("source", "batch_id", F.col("record").alias(CORRUPT), F.lit(None).cast("string").alias("raw_responses"),
                             F.struct(F.col("file").alias("file_path")).alias("landed"))
        broken = B.corrupt_lines(lines).select(
            F.lit("bronze").alias("source"), R.line_key("record").alias("record_key"), F.lit(R.HTTP_ERROR).alias(R.REASON),
            R.non_null_map(("source", "source"), ("line", "record"), ("file", "file")).alias(R.CONTEXT))
        store.write_partition(quarantine, rejects.unionByName(broken), f"{table}-epoch-{epoch}")
        known = times.read(NEWEST) if times.exists(NEWEST) else None
        fresh = cut_lineage(newest_rows(batch.where(F.col("kind") == _ROW), known))
        rows = of(fresh, _ROW, row_type).select("p.*")
        evidence.extend(r.asDict() for r in store.upsert(table, rows, key, order, columns).collect())
        times.upsert_bucketed(NEWEST, fresh, "record_key", "fetched", ["record_key", "fetched"])
        times.vacuum(NEWEST)

    q = (tagged.writeStream.outputMode("append").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return evidence
