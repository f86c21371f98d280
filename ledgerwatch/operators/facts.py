"""Append-only fact tables: insert the rows whose key is not in the target yet.

The target (all facts ever loaded) is the big side and is not shuffled as a
whole: a bitmap of the batch's key slots, of a fixed size whatever the rows,
is broadcast and filters the target's key column in the scan. Only keys that
share a slot with the batch go on to the exact semi join, and the batch is
then anti-joined against that small result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.bitmaps import slot_bitmap, with_slot_flag

KEY_SLOTS = 1 << 25   # a 4 MB bitmap; a batch of a million keys passes on 3% of the history's keys


def append_absent(target: DataFrame | None, batch: DataFrame, key: str, *,
                  dedupe_within_batch: bool = False, first_by: str | None = None,
                  slots: int = KEY_SLOTS) -> DataFrame:
    """Rows of ``batch`` to append: key absent from ``target``.

    As in the original, duplicates inside one batch are all appended and a
    null key is always appended. With ``dedupe_within_batch`` one row per key
    is kept, the one with the smallest ``first_by`` (pre-aggregated, skew-safe).
    """
    b = batch
    if dedupe_within_batch:
        others = [c for c in b.columns if c not in (key, first_by)]
        order = [first_by] if first_by else []
        pick = F.min(F.struct(*[F.col(c) for c in order + others])).alias("__pick")
        keyed = b.where(F.col(key).isNotNull()).groupBy(key).agg(pick)
        keyed = keyed.select(key, *[F.col(f"__pick.{c}").alias(c) for c in order + others])
        b = keyed.unionByName(b.where(F.col(key).isNull())).select(*batch.columns)
    if target is None:
        return b
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    keys = b.select(key).where(F.col(key).isNotNull()).distinct()
    bitmap = slot_bitmap(keys.select(slot.alias("__slot")), "__slot")
    near = with_slot_flag(target.select(key).withColumn("__slot", slot), "__slot", bitmap, "__near").where("__near")
    seen = near.select(key).join(keys, key, "left_semi")
    return b.join(seen, key, "left_anti")
