"""Data-quality invariants as queries (each one row: check, n_checked, n_failed, passed).
Every check is one aggregation over one scan of each input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _row(name: str, agg: DataFrame) -> DataFrame:
    return agg.select(F.lit(name).alias("check"), "n_checked", "n_failed",
                      (F.col("n_failed") == 0).alias("passed"))


def subset_check(name: str, child: DataFrame, parent: DataFrame, key: str,
                 parent_key: str | None = None) -> DataFrame:
    """Every key of ``child`` exists in ``parent`` (e.g. gold keys within the catalog).
    Distinct keys on both sides (partial aggregation), one left join, one count."""
    ck = child.select(F.col(key).alias("_k")).distinct()
    pk = parent.select(F.col(parent_key or key).alias("_k")).distinct() \
        .withColumn("_hit", F.lit(True))
    j = ck.join(pk, "_k", "left")
    return _row(name, j.agg(F.count(F.lit(1)).alias("n_checked"),
                            F.count_if(F.col("_hit").isNull()).alias("n_failed")))


def unique_check(name: str, df: DataFrame, key: str) -> DataFrame:
    """No key appears twice (a keyed table after upserts)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return _row(name, per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_checked"),
                                  F.count_if(F.col("_n") > 1).alias("n_failed")))


def run_checks(checks: list[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# --- determinism -------------------------------------------------------------------------

PRINT = ("n_rows", "low", "high")


def fingerprint(df: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """One row: a fingerprint of a table as a multiset of rows, whatever their order and
    partitions: their number and the sums of two 64-bit hashes of every row (columns by name,
    but those ``without``).  Sums, so fingerprints of parts add up to the whole's.  Nulls
    count: whether a column is null is hashed with its value; nested values as JSON."""
    names = sorted(c for c in df.columns if c not in set(without))
    nested = (T.ArrayType, T.MapType, T.StructType)
    values = [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if isinstance(df.schema[c].dataType, nested) else F.col(c)
              for c in names]
    nulls = F.concat(F.lit(""), *[F.col(c).isNull().cast("int").cast("string") for c in names])
    low, high = F.xxhash64(nulls, *values), F.xxhash64(*reversed(values), F.lit("high"), nulls)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast(
        "decimal(38,0)").alias(n) for h, n in ((low, "low"), (high, "high"))))


def merge_fingerprints(parts: Sequence[DataFrame]) -> DataFrame:
    """The fingerprint of the union of tables, from theirs."""
    return run_checks(list(parts)).agg(F.sum("n_rows").alias("n_rows"),
                                       *(F.sum(c).cast("decimal(38,0)").alias(c) for c in ("low", "high")))


def same_table(name: str, first: DataFrame, second: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """(table, n_first, n_second, same): whether two tables hold the same rows."""
    a, b = (fingerprint(df, without).select(F.struct(*PRINT).alias(c)) for df, c in ((first, "a"), (second, "b")))
    both = a.select(F.col("a"), F.lit(None).cast(a.schema["a"].dataType).alias("b")).unionByName(
        b.select(F.lit(None).cast(a.schema["a"].dataType).alias("a"), "b")).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return both.select(F.lit(name).alias("table"), F.col("a.n_rows").alias("n_first"), F.col("b.n_rows").alias("n_second"),
                       (F.col("a") == F.col("b")).alias("same"))
