"""Ordered first-match rule lists with quarantine.

A contract is an ordered list of ``(reason, failing_condition)``; the first
failing rule names the rejection reason.  The reason is computed once per row
in the same scan, and the valid and rejected sides are two filters (or one
partitioned write) over that single projection - no second pass, no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import non_null_map

REASON = "rejection_reason"
CONTEXT = "context"

# Rejection reasons.
PAGE_NOT_FOUND = "PAGE_NOT_FOUND"
AMBIGUOUS_RESOLUTION = "AMBIGUOUS_RESOLUTION"
EXTRACT_TOO_SHORT = "EXTRACT_TOO_SHORT"
DISAMBIGUATION_PAGE = "DISAMBIGUATION_PAGE"
HTTP_ERROR = "HTTP_ERROR"
MISSING_SECTIONS_TEXT = "MISSING_SECTIONS_TEXT"
MATCH_TYPE_NOT_EXACT = "MATCH_TYPE_NOT_EXACT"
NO_MATCH_RETURNED = "NO_MATCH_RETURNED"
MISSING_COORDINATES = "MISSING_COORDINATES"
COORDINATES_OUT_OF_RANGE = "COORDINATES_OUT_OF_RANGE"
MISSING_GBIF_ID = "MISSING_GBIF_ID"
INVALID_EVENT_DATE = "INVALID_EVENT_DATE"
MISSING_BASIS_OF_RECORD = "MISSING_BASIS_OF_RECORD"
#: A record that cannot be stored for want of its table's key.
MISSING_KEY = "MISSING_KEY"

Rule = tuple[str, Column]


def first_failing(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule whose condition holds (NULL conditions do not fire);
    NULL when every rule passes."""
    return F.coalesce(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(reason))
                        for reason, cond in rules], F.lit(None).cast("string"))


def context_for(reason: Column, contexts: Sequence[tuple[Column, Sequence[tuple[str, Column]]]]
                ) -> Column:
    """Per-reason detail map; ``contexts`` pairs a selector with (name, column) details.
    The first selector that holds wins; NULL detail values are dropped."""
    out = F.lit(None).cast("map<string,string>")
    for selector, pairs in reversed(list(contexts)):
        out = F.when(selector, non_null_map(*pairs)).otherwise(out)
    return F.when(reason.isNotNull(), out)


def with_rules(df: DataFrame, rules: Sequence[Rule], contexts=()) -> DataFrame:
    """Add ``rejection_reason`` (and ``context`` when given)."""
    out = df.withColumn(REASON, first_failing(rules))
    if contexts:
        out = out.withColumn(CONTEXT, context_for(F.col(REASON), contexts))
    return out


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())


def quarantine_rows(df: DataFrame, source: str, batch_id, record_key) -> DataFrame:
    """Quarantine table shape: one row per rejected record with its reason."""
    bid = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    rk = F.col(record_key) if isinstance(record_key, str) else record_key
    ctx = F.col(CONTEXT) if CONTEXT in df.columns else F.lit(None).cast("map<string,string>")
    return rejected(df).select(F.lit(source).alias("source"), bid.alias("batch_id"),
                               F.coalesce(rk.cast("string"), F.lit("None")).alias("record_key"),
                               F.col(REASON), ctx.alias(CONTEXT))


def line_key(line: str) -> Column:
    """Record key of a landed line: the line, or the beginning of a long one with its hash."""
    return F.when(F.length(line) <= 200, F.col(line)).otherwise(
        F.concat(F.substring(line, 1, 200), F.lit("#"), F.sha2(F.col(line).cast("binary"), 256)))


def reject_report(*quarantines: DataFrame) -> DataFrame:
    """Count of rejected records by source and reason, over quarantine tables."""
    u = quarantines[0]
    for q in quarantines[1:]:
        u = u.unionByName(q)
    return u.groupBy("source", REASON).agg(F.count(F.lit(1)).alias("n_rejected"))


def reject_report_checked(checked: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Same report straight from checked rows (before any quarantine write).

    A ``rejection_reason IS NOT NULL`` filter would be pushed below the projection
    that computes the reason and evaluate every rule twice (parsing each payload
    twice); instead all rows are aggregated (valid rows form the NULL group) and
    the NULL group is dropped with a predicate on an aggregate, which stays above
    the aggregation."""
    parts = [df.select(F.lit(src).alias("source"), F.col(REASON)) for src, df in checked]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.groupBy("source", REASON).agg(F.count(F.lit(1)).alias("n_rejected"),
                                           F.max(F.col(REASON).isNotNull()).alias("_rejected"))
    return agg.where(F.col("_rejected")).drop("_rejected")


def outcome_counts(source_rows: DataFrame, checked: DataFrame, source: str) -> DataFrame:
    """Reconciliation row per source: the rows of the source table against the valid and
    rejected ones of its checked frame (no silent loss)."""
    tagged = source_rows.select(F.lit(True).alias("_in"), F.lit(None).cast("string").alias(REASON)).unionByName(
        checked.select(F.lit(False).alias("_in"), F.col(REASON)))
    return tagged.agg(
        F.count_if(F.col("_in")).alias("n_input"),
        F.count_if(~F.col("_in") & F.col(REASON).isNull()).alias("n_valid"),
        F.count_if(F.col(REASON).isNotNull()).alias("n_rejected"),
    ).select(F.lit(source).alias("source"), "n_input", "n_valid", "n_rejected",
             (F.col("n_input") == F.col("n_valid") + F.col("n_rejected")).alias("balanced"))
