"""Sharding by weighted rendezvous hashing of stable record keys.

Shard s of weight w scores a key with ``-w / ln(u)``, u uniform in (0, 1) from
a hash of (key, s); the highest score wins. Scores do not depend on the other
shards: a new shard only takes rows into itself, a removed one only gives its
own rows away, and each takes a share in proportion to its weight. Assigning is
a projection without a shuffle; only numbering rows within shards shuffles, and
it moves ids, sizes and checksums, not text.

Defined cases: a null id takes its key from the text, null text counts as
empty; equal ids share a shard; rows equal in id, size and checksum are counted
before the shuffle and numbered apart; an empty table gives an empty result;
only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.spread import cut, running_start

ROW_OVERHEAD = 16


def _score(key: Column, shard: Column, weight: Column) -> Column:
    unit = (F.shiftrightunsigned(F.xxhash64(key, shard.cast("long")), 11).cast("double") + F.lit(0.5)) / F.lit(2.0 ** 53)
    return -weight / F.log(unit)


def best_shard(key: Column, weights: list[float]) -> Column:
    """struct(score, shard) of the winner; on equal scores the lower shard. Zero weights take nothing."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative, one of them positive")
    live = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight"))
                     for i, w in enumerate(weights) if w > 0])
    win = F.array_max(F.transform(live, lambda s: F.struct(
        _score(key, s["shard"], s["weight"]).alias("score"), (-s["shard"]).alias("low"))))
    return F.struct(win["score"].alias("score"), (-win["low"]).alias("shard"))


def stable_key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"),
                      F.concat(F.lit("text:"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))


def assign_shards(docs: DataFrame, weights: list[float], new_weight: float | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard and, with ``new_weight``, the shard once one more shard is added."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), stable_key(id_col, text_col).alias("key"),
                       (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("win", best_shard(F.col("key"), weights))
    grown = F.lit(None).cast("int")
    if new_weight is not None:
        new = len(weights)
        grown = F.when(_score(F.col("key"), F.lit(new), F.lit(float(new_weight))) > F.col("win.score"), F.lit(new)) \
            .otherwise(F.col("win.shard"))
    return rows.select("id", "size", "text_crc32", F.col("win.shard").alias("shard"),
                       grown.cast("int").alias("grown_shard")).withColumnRenamed("id", id_col)


def number_slots(assigned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add ``slot``: 0, 1, 2... within each shard. Equal rows are counted first and
    given back as a run of slots, so repeated rows never meet in one window group."""
    cols = assigned.columns
    counted = cut(assigned.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
                  .withColumn("__h", F.shiftrightunsigned(F.xxhash64(id_col, "text_crc32"), 4)))
    start = running_start(counted, ["shard"], "__h", [id_col, "size", "text_crc32"], "__n", counted.count(), "__start")
    return start.select(*cols, F.explode(F.sequence(F.col("__start"), F.col("__start") + F.col("__n") - F.lit(1)))
                        .alias("slot"))


def shard_documents(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their shard, as a projection (no shuffle)."""
    return docs.withColumn("shard", best_shard(stable_key(id_col, text_col), weights)["shard"])
