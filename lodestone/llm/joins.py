"""Small join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20


def slot_filter(large: DataFrame, large_key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows of ``large`` whose key may be among ``wanted``'s: keys are hashed into ``SLOTS``
    slots and the slots in use broadcast, at most 2^20 longs however large ``wanted`` is.
    Spares the large side's shuffle for rows without a partner; an exact join follows."""
    slots = wanted.select(F.pmod(F.xxhash64(wanted_key), F.lit(SLOTS)).alias("_slot")).distinct()
    return (large.withColumn("_slot", F.pmod(F.xxhash64(large_key), F.lit(SLOTS)))
            .join(F.broadcast(slots), "_slot", "left_semi").drop("_slot"))
