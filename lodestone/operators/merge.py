"""Pivot merge: a mandatory pivot row per key, augmented by optional sources.

The pivot decides which keys exist: every join is a left join from the pivot,
so augmentation never introduces a key, and a pivot without augmentation keeps
its row with defaults.  The taxonomy gate lives in the join condition (on the
augmenting side, before the join), never in a WHERE after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Taxonomy statuses, augmentation statuses, and the taxonomy fields a
# matched record carries (in this order).
MATCHED, UNMATCHED = "MATCHED", "UNMATCHED"
AUG_OK, AUG_EMPTY = "OK", "GBIF_AUGMENTATION_EMPTY"
TAXONOMY_FIELDS = ("kingdom", "phylum", "class_name", "rank")


def gated_left_join(pivot: DataFrame, aug: DataFrame, pivot_key: str, aug_key: str,
                    gate, fields=TAXONOMY_FIELDS, status_col: str = "taxonomy_status",
                    matched: str = MATCHED, unmatched: str = UNMATCHED) -> DataFrame:
    """Attach ``fields`` of ``aug`` only where ``gate`` holds; otherwise NULL fields and
    the ``unmatched`` status.  ``aug`` is keyed (one row per ``aug_key``)."""
    side = (aug.where(gate)
            .select(F.col(aug_key).alias("_aug_key"), F.lit(True).alias("_hit"),
                    *[F.col(f) for f in fields]))
    joined = pivot.join(side, pivot[pivot_key] == side["_aug_key"], "left")
    return (joined.withColumn(status_col, F.when(F.col("_hit"), F.lit(matched))
                              .otherwise(F.lit(unmatched)))
            .drop("_aug_key", "_hit"))


def summary_left_join(pivot: DataFrame, summary: DataFrame, key: str,
                      count_col: str = "n_occurrences_validas", list_col: str = "paises",
                      status_col: str = "augmentation_status") -> DataFrame:
    """Attach a per-key summary; a key without observations gets count 0, an empty
    list, NULL years / mode and the EMPTY status."""
    joined = pivot.join(summary, key, "left")
    return (joined
            .withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("int"))
            .withColumn(list_col, F.coalesce(F.col(list_col), F.array().cast("array<string>")))
            .withColumn(status_col, F.when(F.col(count_col) > 0, F.lit(AUG_OK))
                        .otherwise(F.lit(AUG_EMPTY))))


def pivot_merge(pivot: DataFrame, key: str, taxonomy: DataFrame | None, summary: DataFrame | None,
                *, taxonomy_key: str | None = None, pivot_taxonomy_key: str | None = None,
                gate_col: str = "match_type", gate_value: str = "EXACT",
                fields=TAXONOMY_FIELDS) -> DataFrame:
    """Merged record per pivot key: pivot columns, gated taxonomy fields + status,
    occurrence summary + augmentation status."""
    out = pivot
    if taxonomy is not None:
        out = gated_left_join(out, taxonomy, pivot_taxonomy_key or key, taxonomy_key or key,
                              F.col(gate_col) == F.lit(gate_value), fields)
    else:
        for f in fields:
            out = out.withColumn(f, F.lit(None).cast("string"))
        out = out.withColumn("taxonomy_status", F.lit(UNMATCHED))
    if summary is not None:
        out = summary_left_join(out, summary, key)
    return out


def unmatched_pivot(augmentation: DataFrame, pivot: DataFrame, aug_key: str,
                    pivot_key: str) -> DataFrame:
    """Keys that have augmentation but no pivot row (skipped and reported)."""
    return (augmentation.select(F.col(aug_key).alias(pivot_key)).distinct()
            .join(pivot.select(pivot_key), pivot_key, "left_anti"))
