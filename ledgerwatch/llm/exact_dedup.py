"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

DataFrame operations only. Each step passes on only the rows whose key repeats:

1. byte lengths are counted; a row alone with its length is settled;
2. rows of repeated lengths are counted by (length, hash of the first bytes);
3. only rows of repeated (length, prefix hash) get a hash of the full text,
   and (length, full hash) forms the groups.

The counts are pre-aggregated before each shuffle. What steps 1 and 2 pass on
is handed to the next scan as a bitmap of a fixed number of slots (a broadcast
bounded whatever the rows); two keys sharing a slot only cost a needless full
hash, never a wrong result. Text is never shuffled.

Defined cases: null text counts as empty; rows with null ids take part, and a
group of only null ids has a null ``keep_id``; the kept row is the one with the
largest id, so rows repeated under that id are all kept; an empty table gives
an empty result; only the named columns are read, extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.bitmaps import slot_bitmap, with_slot_flag
from ledgerwatch.llm.spread import cut, join_stats

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_CHARS = 64
LENGTH_SLOTS = 1 << 20   # 128 KB bitmap
PREFIX_SLOTS = 1 << 25   # 4 MB bitmap


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` is the same, and faster, on pure ASCII)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, and the ``carry``
    columns (expressions over ``id`` and the null-free ``text``)."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("bytes", F.octet_length("text").cast("long"))

    length_slot = F.col("bytes") % F.lit(LENGTH_SLOTS)
    lengths = base.groupBy("bytes").count().where("count > 1").select(length_slot.alias("slot"))
    sized = with_slot_flag(base.withColumn("__slot", length_slot), "__slot", slot_bitmap(lengths, "slot"), "__len_again")

    prefix = ascii_lower(F.substring("text", 1, PREFIX_CHARS))
    sized = sized.withColumn("__ph", F.when(F.col("__len_again"), F.xxhash64(F.col("bytes"), prefix)))
    prefix_slot = F.pmod(F.col("__ph"), F.lit(PREFIX_SLOTS))
    prefixes = sized.where("__len_again").groupBy("bytes", "__ph").count().where("count > 1") \
        .select(prefix_slot.alias("slot"))
    survivors = with_slot_flag(sized.withColumn("__slot", F.coalesce(prefix_slot, F.lit(0))), "__slot",
                               slot_bitmap(prefixes, "slot"), "__ph_again")

    read_full = F.col("__len_again") & F.col("__ph_again")
    rows = cut(survivors.select(
        "id", "bytes", F.when(read_full, F.sha2(ascii_lower(F.col("text")), 256)).alias("full"),
        *[c.alias(n) for n, c in (carry or {}).items()]))

    n_rows = rows.count()
    read = rows.where(F.col("full").isNotNull())
    groups = read.groupBy("bytes", "full").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = join_stats(read, groups, ["bytes", "full"], "group_size", n_rows, F.xxhash64("id"))
    alone = rows.where(F.col("full").isNull()) \
        .withColumn("keep_id", F.col("id")).withColumn("group_size", F.lit(1).cast("long"))
    return grouped.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))) \
        .select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", *(carry or {}))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows whose id stays (rows with a null id are compared as any other value)."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("__kept_id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__kept_id")), "left_semi")
