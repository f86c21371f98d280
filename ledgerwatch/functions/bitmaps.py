"""Bounded bitmaps of key slots: a map-side filter whose size does not depend on the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 15  # bits of one bitmap_construct_agg cell


def slot_bitmap(slots: DataFrame, slot: str) -> DataFrame:
    """Bitmap of the distinct values of a long column of slot numbers >= 0:
    (bm_bucket, bm_bits). Its size is bounded by the slot range, whatever the rows."""
    return (slots.select(F.shiftright(F.col(slot), 15).alias("bm_bucket"),
                         F.col(slot).bitwiseAND(F.lit(BITMAP_BITS - 1)).alias("__bit"))
            .groupBy("bm_bucket").agg(F.bitmap_construct_agg("__bit").alias("bm_bits")))


def with_slot_flag(df: DataFrame, slot: str, bitmap: DataFrame, out: str) -> DataFrame:
    """Flag rows whose slot is set in the (size-bounded, broadcast) bitmap."""
    bit = F.col(slot).bitwiseAND(F.lit(BITMAP_BITS - 1)).cast("int")
    byte = F.conv(F.hex(F.substring("bm_bits", F.shiftright(bit, 3) + F.lit(1), F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7))) == F.lit(1), F.lit(False))
    return (df.withColumn("bm_bucket", F.shiftright(F.col(slot), 15))
            .join(F.broadcast(bitmap), "bm_bucket", "left")
            .withColumn(out, flag).drop("bm_bucket", "bm_bits"))
