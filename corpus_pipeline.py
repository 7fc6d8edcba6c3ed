"""Corpus pipeline: the stages that turn raw ``documents`` into packed training sequences.

Every stage takes all that the one before kept, reads it from a written table and returns the
columns of ``documents``; the last returns the packed pieces.  Every row is judged by its own
text, also where it has no doc_id or a repeated one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.decontam import decontaminated
from lodestone.llm.near_dedup import near_duplicates
from lodestone.llm.packing import packed_documents
from lodestone.llm.pii import sanitised
from lodestone.llm.toxicity import without_toxic
from lodestone.session import checkpoint_dir, cut_lineage
from lodestone.sources.tables import read_table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity chain rejects go.  Null and empty texts say nothing toxic and stay;
    an empty table gives no rows."""
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, the one with the smallest doc_id, and of its
    rows without a doc_id one more.  Rows without words are alone in their group; repeated rows
    are a group; an empty table gives no rows.  Rows are numbered in a written table, as they
    are read twice."""
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")))
    group = near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text")).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    first = (rows.select("row", F.col("doc.doc_id").alias("id")).join(group, "row")
             .groupBy("group", F.col("id").isNull()).agg(F.min(F.struct("id", "row")).alias("first")).select("first.row"))
    return rows.join(first, "row", "left_semi").select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows contaminated by the benchmark go.  Null and empty texts have no words and stay; an
    empty table gives no rows."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced; every document stays, null and
    empty texts as they are."""
    return sanitised(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences (null texts as empty ones)."""
    return packed_documents(docs)


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("pii", pii), ("packing", packing)]

#: The stages fit models, connect components and tokenise: not expressible; the stages are
#: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written to the shared
    checkpoint folder and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
