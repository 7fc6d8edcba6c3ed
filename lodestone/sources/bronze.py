"""Bronze landing: raw API responses kept unmodified in JSON envelopes.

Envelope (one JSON line per fetch)::

    {source, lote, ingested_at "yyyy-MM-ddTHH:mm:ssZ", species_queried: [..],
     raw_responses: [{query, response: {status, data}}]}

``data`` is landed as the response's text, byte for byte (key order and number forms included),
and is parsed downstream.  Files written by others, whose ``data`` is a JSON object, are read
the same way: the object's own text.  Landing is append-only and partitioned by ``source`` and
``batch_id``; files are compressed, their names generated by Spark, and never collide.  Lines that are no JSON are
kept in ``_corrupt_record``; lines that are JSON but no envelope are found by ``corrupt_lines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip
from ..session import cut_lineage

RESPONSE = T.StructType([T.StructField("status", T.IntegerType()),
                         T.StructField("data", T.StringType())])
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("lote", T.IntegerType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("species_queried", T.ArrayType(T.StringType())),
    T.StructField("raw_responses", T.ArrayType(T.StructType([
        T.StructField("query", T.StringType()), T.StructField("response", RESPONSE)]))),
])
CORRUPT = "_corrupt_record"
LINES_PER_FILE = 20_000  # of a landed file
# with what landing adds: the batch, and the text of lines that are no envelope
LANDED_SCHEMA = T.StructType(ENVELOPE_SCHEMA.fields + [
    T.StructField("batch_id", T.StringType()), T.StructField(CORRUPT, T.StringType())])


def envelopes(responses: DataFrame, source: str, lote: int = 1, query_col: str = "query",
              status_col: str = "status", data_col: str = "data",
              group_col: str | None = None, queried_col: str | None = None) -> DataFrame:
    """Build envelopes from response rows.  Rows sharing ``group_col`` (e.g. the two
    page responses of one title) go into one envelope; otherwise one per row.
    Groups are per fetch, so an envelope stays small whatever the batch size."""
    resp = F.struct(F.col(query_col).alias("query"),
                    F.struct(F.col(status_col).cast("int").alias("status"),
                             F.col(data_col).cast("string").alias("data")).alias("response"))
    queried = F.col(queried_col) if queried_col else F.col(query_col)
    # UTC wall clock whatever the session time zone is (the 'Z' suffix must be true)
    now_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    now = F.date_format(now_utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if group_col:
        base = responses.groupBy(group_col).agg(
            F.array_sort(F.collect_list(resp)).alias("_rs"), F.first(queried).alias("_q"))
        rs, q = F.col("_rs"), F.col("_q")
    else:
        base, rs, q = responses, F.array(resp), queried
    return base.select(F.lit(source).alias("source"), F.lit(lote).alias("lote"),
                       now.alias("ingested_at"), F.array(q.cast("string")).alias("species_queried"),
                       rs.alias("raw_responses"))


def write_bronze(env: DataFrame, root: str, batch_id: str) -> None:
    """Append envelopes under ``root/source=../batch_id=..`` as JSON lines, compressed.  A
    compressed file is read by one task, so a file holds ``LINES_PER_FILE`` lines at most."""
    (env.withColumn("batch_id", F.lit(batch_id))
     .write.mode("append").partitionBy("source", "batch_id")
     .option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).json(root))


def with_place(env: DataFrame) -> DataFrame:
    """Adds ``landed``: when and where an envelope landed, for the latest-fetch rule."""
    return env.withColumn("landed", F.struct("_metadata.file_modification_time", "_metadata.file_path",
                                             "_metadata.file_block_start"))


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Landed envelopes with an explicit schema (never inferred); corrupt lines too."""
    return with_place(spark.read.schema(LANDED_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).json(root))


def read_envelope_files(spark: SparkSession, root: str) -> DataFrame:
    """Envelopes in the layout ``root/{source}/lote_{n}.json``, one (multi-line) document a
    file; the batch is the file's lote."""
    env = (spark.read.schema(LANDED_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT)
           .option("multiLine", True).json(f"{root.rstrip('/')}/*/*.json"))
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return with_place(env.withColumn("batch_id", F.regexp_replace(name, r"\.json$", "")))


def corrupt_lines(env: DataFrame) -> DataFrame:
    """(source, batch_id, record, file): landed lines that are no JSON, and lines that are JSON but
    hold no list of responses, each as its whole text, for quarantine.  The parser keeps the
    text of the former only; the files of the latter, if there are any, are read again."""
    cols = ("source", "batch_id", "record", "file")
    file = F.col("landed.file_path").alias("file")
    broken = env.where(F.col(CORRUPT).isNotNull()).select("source", "batch_id", F.col(CORRUPT).alias("record"), file)
    odd = env.where(F.col(CORRUPT).isNull() & F.col("raw_responses").isNull()).select("source", "batch_id", file)
    files = [r["file"] for r in odd.select("file").distinct().collect()]  # names of files, not rows
    if not files:
        return broken.select(*cols)
    lines = env.sparkSession.read.text(files).select("value", F.col("_metadata.file_path").alias("file"))
    known = F.from_json("value", T.StructType([f for f in ENVELOPE_SCHEMA.fields if f.name == "raw_responses"])
                        .add(CORRUPT, T.StringType()), {"columnNameOfCorruptRecord": CORRUPT})
    other = lines.where(F.length(F.trim("value")) > 0).withColumn("_e", known).where(
        F.col(f"_e.{CORRUPT}").isNull() & F.col("_e.raw_responses").isNull())
    return broken.select(*cols).unionByName(
        other.join(odd.distinct(), "file").select("source", "batch_id", F.col("value").alias("record"), "file"))


def responses_of(env: DataFrame) -> DataFrame:
    """One row per raw response: source, batch, ingestion time, query, status, data, and
    ``fetch``, which orders fetches in time."""
    landed = F.col("landed") if "landed" in env.columns else F.lit(None).cast("string")
    return (env.select("source", "batch_id", "ingested_at", "species_queried", landed.alias("landed"),
                       F.posexplode("raw_responses").alias("_pos", "_r"))
            .select("source", "batch_id", "ingested_at",
                    F.get(F.col("species_queried"), 0).alias("queried"), F.col("_r.query").alias("query"),
                    F.col("_r.response.status").alias("status"), F.col("_r.response.data").alias("data"),
                    F.struct("ingested_at", "landed", F.col("_pos").alias("pos")).alias("fetch")))


def latest_fetch(resp: DataFrame, by=("source", "batch_id", "query")) -> DataFrame:
    """The latest response of every query: one struct per query, so a status never meets the
    body of another fetch.  What orders the fetches is dealt once, as part of the response."""
    order = ("fetch", "status", "data")
    rest = [c for c in resp.columns if c not in by]
    return resp.groupBy(*by).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_l")).select(
        *by, *[F.col(f"_l.{c}").alias(c) for c in rest])


def pair_page_responses(resp: DataFrame, by=("batch_id", "queried")) -> DataFrame:
    """Re-join the latest ``summary:{title}`` and ``extracts:{title}`` responses per title."""
    parts = F.split(F.col("query"), ":", 2)
    kinds = resp.select(*by, F.get(parts, 0).alias("_kind"), F.get(parts, 1).alias("title_q"),
                        F.struct("status", "data").alias("_v"), F.struct("fetch", "status", "data").alias("_f"))

    def latest(kind: str):
        mine = F.col("_kind") == kind
        return F.max_by(F.when(mine, F.col("_v")), F.when(mine, F.col("_f"))).alias(kind)

    return kinds.groupBy(*by, "title_q").agg(latest("summary"), latest("extracts")).select(
        *by, "title_q", F.col("summary.status").alias("summary_status"), F.col("summary.data").alias("summary_data"),
        F.col("extracts.status").alias("extracts_status"), F.col("extracts.data").alias("extracts_data"))


def batch_names(spark: SparkSession, *, path: str | None = None, text: str | None = None,
                names: list[str] | None = None) -> DataFrame:
    """Batch input as ``names(name)``: a text file (one name per line, stripped, blank
    lines dropped), a JSON array string or a comma-separated string, or a list."""
    if path is not None:
        df = spark.read.text(path).select(py_strip("value").alias("name"))
    elif text is not None:
        raw = py_strip(F.lit(text))
        arr = F.when(raw.startswith("["), F.from_json(raw, "array<string>")) \
            .otherwise(F.split(raw, ","))
        df = spark.range(1).select(F.explode(arr).alias("name")) \
            .select(py_strip("name").alias("name"))
    else:
        df = spark.createDataFrame([(n,) for n in (names or [])], "name string")
    return df.where(F.col("name").isNotNull() & (F.col("name") != ""))


def split_batches(names: DataFrame, order: str, n_batches: int) -> DataFrame:
    """Add ``batch_no`` (1..n): consecutive slices of the list in ``order`` of equal size
    (the last slice may be shorter), e.g. first / last half of a seed list; an empty list gives
    no rows.  Rows are numbered in two steps, ranges of the order first and then within each
    range, so no task sees the whole list."""
    total = names.count()
    size = -(-total // n_batches) or 1
    ranged = cut_lineage(names.repartitionByRange(order).sortWithinPartitions(order)
                         .withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    row = F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1
    return (ranged.withColumn("_i", row).join(before, "_p")
            .withColumn("batch_no", (F.floor((F.col("_before") + F.col("_i")) / size) + 1).cast("int"))
            .select(*names.columns, "batch_no"))
