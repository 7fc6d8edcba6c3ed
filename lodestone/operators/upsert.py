"""Idempotent keyed upsert with before / after / new / updated evidence.

Semantics of ``INSERT ... ON CONFLICT (key) DO UPDATE`` applied record by
record in arrival order, expressed set-wise:

* the batch collapses to one row per key: update columns take the **last**
  record's values (one struct, so never a mixture of two records), insert-only
  columns the **first** record's - both are partial aggregates, so a hot key is
  reduced map-side before the shuffle;
* a key already in the target keeps its insert-only columns and takes the
  batch's update columns; a new key takes the collapsed batch row;
* evidence: ``new`` = batch keys absent from the target, ``updated`` = batch
  records minus ``new`` (a key repeated n times in one batch is 1 new + n-1
  updated), ``after`` = ``before`` + ``new``.

Physical strategy: one full outer join on the key, whatever the sizes; the
target is scanned once, and the evidence is counted by the same job that writes
the new version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Evidence columns (table, rows before, rows after, new rows, updated rows).
EVIDENCE_COLUMNS = ("tabla", "filas_antes", "filas_despues", "filas_nuevas", "filas_actualizadas")
EVIDENCE_SCHEMA = ("tabla string, filas_antes long, filas_despues long, filas_nuevas long, "
                   "filas_actualizadas long")


def collapse_batch(batch: DataFrame, key: str, order: str, update_cols: Sequence[str],
                   insert_only: Sequence[str] = ()) -> DataFrame:
    """One row per key: last record's update columns, first record's insert-only columns,
    and ``_n`` = number of records of that key in the batch."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if update_cols:
        aggs.append(F.max_by(F.struct(*update_cols), order).alias("_last"))
    if insert_only:
        aggs.append(F.min_by(F.struct(*insert_only), order).alias("_first"))
    return batch.groupBy(key).agg(*aggs).select(
        key, *[F.col(f"_last.{c}").alias(c) for c in update_cols],
        *[F.col(f"_first.{c}").alias(c) for c in insert_only], "_n")


@dataclass
class UpsertResult:
    table: DataFrame
    evidence: DataFrame


def merge_plan(target: DataFrame, batch: DataFrame, key: str, order: str, columns: Sequence[str],
               insert_only: Sequence[str] = (), derive=None) -> DataFrame:
    """The new version's rows (key and ``columns``) with ``_in_t`` (the key was in the target)
    and ``_n`` (batch records of the key).  ``derive`` adds key-only columns to the collapsed
    batch (e.g. an origin flag looked up by key) instead of joining every raw record.  Null
    keys are one key."""
    present = [c for c in columns if c != key and c in set(batch.columns)]
    b = collapse_batch(batch, key, order, [c for c in present if c not in insert_only],
                       [c for c in present if c in insert_only])
    return merge_collapsed(target, b if derive is None else derive(b), key, columns, insert_only, null_keys=True)


def merge_collapsed(target: DataFrame, b: DataFrame, key: str, columns: Sequence[str],
                    insert_only: Sequence[str] = (), null_keys: bool = False) -> DataFrame:
    """``merge_plan`` of a batch that is one row per key already (with ``_n``)."""
    t = target.select(key, *[c for c in columns if c != key]).withColumn("_in_t", F.lit(True))
    b = b.withColumn("_in_b", F.lit(True))
    kept = [F.when(F.col("_in_t"), t[c]).otherwise(b[c]).alias(c) if c in insert_only else
            F.when(F.col("_in_b"), b[c]).otherwise(t[c]).alias(c) for c in columns if c != key]
    same = t[key].eqNullSafe(b[key]) if null_keys else t[key] == b[key]
    return t.join(b, same, "full_outer").select(F.coalesce(t[key], b[key]).alias(key), *kept, "_in_t", "_n")


def new_rows(b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``merge_collapsed`` with a target that has none of the batch's keys."""
    return b.select(key, *[c for c in columns if c != key], F.lit(None).cast("boolean").alias("_in_t"), "_n")


def dealt_with(b: DataFrame, wide: DataFrame, key: str, tasks: int) -> DataFrame:
    """The rows of ``b`` (one a key) with the other columns of ``wide`` (one row a key at most),
    dealt by key to so many tasks.  Both go through one exchange and meet in an aggregation: a
    join would deal them anew to as many tasks as any shuffle has."""
    parts = {"_one": b, "_more": wide}
    kinds = {n: T.StructType([f for f in df.schema.fields if f.name != key]) for n, df in parts.items()}
    both = [df.select(key, *[(F.struct(*kinds[n].names) if n == own else F.lit(None).cast(kinds[n])).alias(n) for n in parts])
            for own, df in parts.items()]
    met = both[0].unionByName(both[1]).repartition(tasks, key).groupBy(key).agg(
        *[F.first(n, ignorenulls=True).alias(n) for n in parts])
    return met.where(F.col("_one").isNotNull()).select(key, "_one.*", "_more.*")


def observed_write(merged: DataFrame, write) -> tuple:
    """Write the rows of a merge plan with ``write(df)``; returns what that returns and
    (before, after, records), counted by the writing job itself."""
    seen = Observation()
    out = write(merged.observe(seen, F.count("_in_t").alias("before"), F.count(F.lit(1)).alias("after"),
                               F.coalesce(F.sum("_n"), F.lit(0)).alias("records")).drop("_in_t", "_n"))
    got = seen.get
    return out, (got["before"], got["after"], got["records"])


def evidence_row(spark, name: str, before: int, after: int, records: int) -> DataFrame:
    new = after - before
    return spark.createDataFrame([(name, before, after, new, records - new)], EVIDENCE_SCHEMA)


def upsert(target: DataFrame, batch: DataFrame, key: str, order: str, columns: Sequence[str],
           insert_only: Sequence[str] = (), name: str = "table", derive=None) -> UpsertResult:
    """Apply ``batch`` to ``target`` (both with ``key`` + ``columns``); ``order`` orders the
    batch records.  The new version is written once to the shared checkpoint folder and read
    back: later upserts do not replay the lineage, and a lost executor does not recompute
    earlier batches."""
    merged = merge_plan(target, batch, key, order, columns, insert_only, derive)
    table, counts = observed_write(merged, cut_lineage)
    return UpsertResult(table, evidence_row(target.sparkSession, name, *counts))


def evidence_of_steps(batches: Sequence[DataFrame], key: str, name: str = "table") -> DataFrame:
    """(step, evidence columns) of applying ``batches`` in turn to an empty table, from keys
    and counts alone: one aggregation, no version is written.  A key is new in the first step
    that brings it."""
    tagged = [b.select(key, F.lit(i).alias("_step")) for i, b in enumerate(batches, 1)]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    steps = range(1, len(batches) + 1)
    per_key = union.groupBy(key).agg(F.min("_step").alias("_first"),
                                     *[F.count_if(F.col("_step") == i).alias(f"_n{i}") for i in steps])
    sums = per_key.agg(*[F.count_if(F.col("_first") == i).alias(f"new{i}") for i in steps],
                       *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"n{i}") for i in steps])
    def after(i):
        return sum((F.col(f"new{j}") for j in range(1, i + 1)), F.lit(0))
    rows = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("tabla"), after(i - 1).alias("filas_antes"),
                     after(i).alias("filas_despues"), F.col(f"new{i}").alias("filas_nuevas"),
                     (F.col(f"n{i}") - F.col(f"new{i}")).alias("filas_actualizadas")) for i in steps]
    return sums.select(F.inline(F.array(*rows)))


def empty_like(df: DataFrame) -> DataFrame:
    """An empty table with the schema of ``df`` (first load into a new table)."""
    return df.sparkSession.createDataFrame([], df.schema)
