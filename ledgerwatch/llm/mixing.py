"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

1. Words are counted per document and summed per source; targets fill up by
   weight and stop at ``max_epochs`` times the source's size.
2. Each source's documents form a permuted stream (order: a hash of the id),
   repeated if its target exceeds its size. The first ``target`` words of that
   stream are the mix: one document per source at most is cut, the last.
3. The stream is cut into blocks. The exact block quotas of all sources are
   split among the output shards by a binary tree: at each node the blocks of
   the left half are a multivariate hypergeometric draw from the node's quotas.
4. A keyed bijection permutes each source's block numbers; a shard takes a
   disjoint run of permuted blocks, and its pieces are shuffled locally by a
   hash order. What a row gives to the mix is the sum of its pieces that were
   dealt to a shard; the documents of the mix stand in the order of the shards
   and of their local shuffle.

The driver sees one row per source, never rows of documents. Equal rows
are one run, counted before any sum and given back as numbered rows. Stream
positions come from two-level running sums, over the ids of a source and over
the runs of an id, so neither a source nor an id (or no id) with a third of all
rows is one task.

Defined cases: null text has no words, null source is a source (last in
order), documents without words take 0 words; rows repeated under one id, or
without an id, are each mixed, equal ones as often in all as their run is taken;
an empty table gives an empty result; only named columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.llm.spread import cut, running_start

WORD = r"[^\x20\x09-\x0D]+"
MAX_BLOCKS = 1 << 28  # numpy's hypergeometric draws are exact below 1e9
RUN_ROWS = 1000       # rows of one run that are given back in one task
HOT_RUNS = 100        # what has more than this part of all rows is hot: there are at most so many


def hash60(*parts: Column) -> Column:
    """A uniform 60-bit order key from the first hex digits of an MD5."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fill_targets(sizes: list[int], weights: list[float], budget: float, max_epochs: float) -> list[float]:
    """Targets in proportion to weights, none above ``max_epochs * size``; the excess goes to the others by weight."""
    cap = [max_epochs * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: cap[i] / weights[i])
    target, left, weight = [0.0] * len(sizes), float(budget), float(sum(weights))
    for n, i in enumerate(order):
        if left * weights[i] <= cap[i] * weight:  # neither this nor any later source is above its cap
            for j in order[n:]:
                target[j] = left * weights[j] / weight
            break
        target[i] = float(cap[i])
        left, weight = left - cap[i], weight - weights[i]
    return target


def split_quotas(quotas: np.ndarray, n_shards: int, rng: np.random.Generator) -> np.ndarray:
    """Exact blocks of each source for each shard (shards x sources); shard totals differ by one at most."""
    total = int(quotas.sum())
    capacity = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    out = np.zeros((n_shards, len(quotas)), dtype=np.int64)
    todo = [(0, n_shards, quotas.astype(np.int64))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(have, sum(capacity[lo:mid]), method="marginals")
        todo += [(mid, hi, have - left), (lo, mid, left)]
    return out


def _coprime(n: int, key: int) -> int:
    a = key % n or 1
    while math.gcd(a, n) != 1:
        a = a % n + 1
    return a


def plan_mix(sizes: list[tuple[str | None, int]], weights: list[float], share: float, max_epochs: float,
             n_shards: int, block_words: int, seed: int) -> list[tuple]:
    """One row per source: size, target, integer target, block length, quota, permutation, shard bounds."""
    total = sum(n for _, n in sizes)
    targets = fill_targets([n for _, n in sizes], weights, share * total, max_epochs)
    least = math.ceil(max_epochs * total / MAX_BLOCKS) or 1
    block = max(least, block_words)
    words = [round(t) for t in targets]
    quota = np.array([-(-w // block) for w in words], dtype=np.int64)
    per_shard = split_quotas(quota, n_shards, np.random.default_rng(seed))
    rows = []
    for i, (source, n) in enumerate(sizes):
        q = int(quota[i])
        digest = hashlib.sha256(f"{seed}|{source}".encode()).digest()
        a, c = (_coprime(q, int.from_bytes(digest[:8], "big")), int.from_bytes(digest[8:16], "big") % q) if q else (1, 0)
        rows.append((source, n, float(targets[i]), words[i], block, q, a, c, np.cumsum(per_shard[:, i]).tolist()))
    return rows


PLAN = T.StructType([T.StructField("p_source", T.StringType())] + [
    T.StructField(n, t) for n, t in (("source_size", T.LongType()), ("target", T.DoubleType()), ("words", T.LongType()),
                                     ("block", T.LongType()), ("quota", T.LongType()), ("mul", T.LongType()),
                                     ("add", T.LongType()), ("bounds", T.ArrayType(T.LongType())))])


def _starts(runs: DataFrame, n_runs: int) -> DataFrame:
    """Add ``start``, the words before a run in its source's stream: by ``h``, the runs of one h by ``tie``."""
    many = runs.groupBy("source", "h").agg(F.count(F.lit(1)).alias("runs")) \
        .where(F.col("runs") > max(RUN_ROWS, n_runs // HOT_RUNS)).select("h").distinct().collect()
    ranges = None
    if many:  # ids of many rows, at most HOT_RUNS in all: a range ends before and after each, and they are cut by tie
        hot = F.array(*[F.lit(r["h"]).cast("long") for r in many])
        own = F.array_contains(hot, F.col("h"))
        zone = 2 * F.size(F.filter(hot, lambda x: x < F.col("h"))) + own.cast("int")
        ranges = lambda top: F.shiftleft(top, 24) + zone.cast("long") * (1 << 15) + F.when(
            own, F.shiftright("tie", 45)).otherwise(0)
    return running_start(runs, ["source"], "h", ["tie", "id", "crc", "size", "row"], "total", n_runs, "start", ranges) \
        .drop("total")


def _runs(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, row: Column | None) -> DataFrame:
    """Rows equal in id, source, words, checksum (and ``row``, if given) with their number ``n``."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
        (F.lit(0).cast("long") if row is None else row).alias("row"))
    return cut(rows.groupBy("id", "source", "size", "crc", "row").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("total", F.col("n") * F.col("size")).withColumn("h", hash60(F.lit(seed), F.col("id")))
               .withColumn("tie", hash60(F.lit(seed), F.col("crc"), F.col("size"), F.col("row"))))


def _streams(runs: DataFrame, weight_cycle: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
             max_epochs: float = 2.0, n_shards: int = 16, block_words: int = 2048, seed: int = 20) -> DataFrame:
    """One row for every row of the runs: their columns, ``start``, the source's plan columns, ``pieces``, ``taken``."""
    by_source = runs.groupBy("source").agg(F.sum("total").alias("words"), F.count(F.lit(1)).alias("runs"),
                                           F.max("n").alias("longest")).collect()
    sizes = sorted(((r["source"], int(r["words"])) for r in by_source), key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weights = [float(weight_cycle[i % len(weight_cycle)]) for i in range(len(sizes))]
    plan = plan_mix(sizes, weights, share, max_epochs, n_shards, block_words, seed) if sizes else []
    placed = _starts(runs, sum(r["runs"] for r in by_source))
    nth = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    if max((r["longest"] for r in by_source), default=0) > RUN_ROWS:  # a long run is dealt out in pieces
        placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {RUN_ROWS}"))))
        placed = placed.repartition("h", "tie", "part")
        nth = F.sequence(F.col("part") * RUN_ROWS, F.least(F.col("n"), (F.col("part") + 1) * RUN_ROWS) - 1)
    placed = placed.withColumn("nth", F.explode(nth)).withColumn("start", F.col("start") + F.col("nth") * F.col("size"))
    table = F.broadcast(runs.sparkSession.createDataFrame(plan, PLAN))
    streams = placed.join(table, F.col("source").eqNullSafe(F.col("p_source")), "left").drop("p_source")
    return streams.withColumn("pieces", _pieces(max_epochs)).withColumn("taken", _words(F.col("pieces")))


PIECE = "struct<epoch: int, word_from: bigint, word_to: bigint, block_no: bigint, shard: int>"


def _pieces(max_epochs: float) -> Column:
    """The drawn pieces of a row: its words word_from to word_to - 1 of an epoch, their block and its shard.
    Rows are cut where a block of the stream ends, so every shard gets its exact quota."""
    arrays = []
    for epoch in range(math.ceil(max_epochs)):
        at = F.col("start") + F.lit(epoch) * F.col("source_size")
        drawn = F.least(F.col("size"), F.col("words") - at)
        numbers = F.sequence(*[F.floor(x / F.col("block")).cast("long") for x in (at, at + drawn - 1)])

        def piece(number: Column) -> Column:  # called at once
            spot = F.pmod(number * F.col("mul") + F.col("add"), F.col("quota"))  # factors below 2**29: no overflow
            begin = number * F.col("block") - at
            return F.struct(F.lit(epoch).alias("epoch"), F.greatest(begin, F.lit(0)).alias("word_from"),
                            F.least(begin + F.col("block"), drawn).alias("word_to"), number.alias("block_no"),
                            F.size(F.filter("bounds", lambda b: b <= spot)).alias("shard"))

        arrays.append(F.when(drawn > 0, F.transform(numbers, piece)).otherwise(F.array().cast(f"array<{PIECE}>")))
    return F.filter(F.concat(*arrays), lambda p: p["shard"] < F.size("bounds"))  # dealt to a shard


def _words(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda n, p: n + p["word_to"] - p["word_from"])


def _local_order(seed: int, epoch: Column, number: Column) -> Column:
    return hash60(F.lit(seed + 1), F.col("id"), F.col("source"), F.col("start"), epoch, number)


def mix_streams(docs: DataFrame, seed: int = 20, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", **options) -> DataFrame:
    """Per row: id, source, size, source_size, target, ``start`` (its place in the source's permuted stream),
    the source's plan columns, its drawn ``pieces`` and ``taken``, the words of these."""
    return _streams(_runs(docs, seed, id_col, text_col, source_col, None), seed=seed, **options)


def draws(streams: DataFrame, seed: int = 20) -> DataFrame:
    """The drawn pieces, one a row: id, source, epoch, its words word_from to word_to - 1, block, shard and local
    shuffle order."""
    return streams.withColumn("piece", F.explode("pieces")).select(
        "id", "source", "piece.*",
        _local_order(seed, F.col("piece.epoch"), F.col("piece.block_no")).alias("local_order"))


def _copies(max_epochs: float) -> Column:
    """The first pieces of the epochs from which a row is taken: of its words, half or more are drawn. A row
    without words has one, in a shard by its hash."""
    mine = F.transform(F.sequence(F.lit(0), F.lit(math.ceil(max_epochs) - 1)),
                       lambda e: F.filter("pieces", lambda p: p["epoch"] == e))
    taken = F.filter(mine, lambda ps: (F.size(ps) > 0) & (2 * _words(ps) >= F.col("size")))
    none = F.lit(0).cast("long")
    lone = F.struct(F.lit(0).alias("epoch"), none.alias("word_from"), none.alias("word_to"), none.alias("block_no"),
                    F.pmod(F.col("h"), F.size("bounds")).cast("int").alias("shard"))
    return F.when(F.col("size") == 0, F.array(lone)).otherwise(F.transform(taken, lambda ps: F.get(ps, F.lit(0))))


def _row_key(docs: DataFrame) -> Column:
    """A hash of all columns, nulls told apart."""
    parts = []
    for f in docs.schema:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)
        parts += [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if nested else c, c.isNull()]
    return F.xxhash64(*parts)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = 20, max_epochs: float = 2.0, **options) -> DataFrame:
    """The documents, all columns, in the order of the shards and of their local shuffle, each as often as
    the mix takes it: once for every epoch from which half of its words or more are drawn, so the one cut
    document of a source is taken whole or not at all. A copy stands where its first drawn piece does.
    Documents without words have no part in any target and stay once. Of rows equal in all columns, one
    stands for its run."""
    runs = _runs(docs, seed, id_col, text_col, source_col, _row_key(docs))
    copied = _streams(runs, seed=seed, max_epochs=max_epochs, **options) \
        .withColumn("first", F.explode(_copies(max_epochs))) \
        .select(F.col("n").alias("__n"), F.col("row").alias("__row"), F.col("crc").alias("__crc"),
                F.col("first.shard").alias("__shard"),
                _local_order(seed, F.col("first.epoch"), F.col("first.block_no")).alias("__order"))
    keys = ["__row", "__crc"]
    marked = docs.withColumn("__row", _row_key(docs)) \
        .withColumn("__crc", F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    seen = runs.agg(F.sum("n").alias("rows"), F.max("n").alias("longest")).first()
    rows, longest = seen["rows"] or 0, seen["longest"] or 0
    limit = max(RUN_ROWS, rows // HOT_RUNS)
    place = ["__shard", "__order"]
    cols = [*docs.columns, *place]
    if longest <= limit:
        out = (marked if longest <= 1 else marked.dropDuplicates(keys)).join(copied, keys).select(*cols)
    else:
        hot = F.broadcast(runs.where(F.col("n") > limit).select(F.col("row").alias("__row"), F.col("crc").alias("__crc")))
        few = F.broadcast(marked.join(hot, keys, "left_semi").dropDuplicates(keys))
        rest = marked.join(hot, keys, "left_anti").dropDuplicates(keys)
        out = copied.where(F.col("__n") <= limit).join(rest, keys).select(*cols).unionByName(
            copied.where(F.col("__n") > limit).join(few, keys).select(*cols))
    return out.repartitionByRange(*place).sortWithinPartitions(*place).select(*docs.columns)


def write_mix(drawn: DataFrame, path: str) -> None:
    """Write each output shard as its own folder, shuffled locally by the hash order."""
    (drawn.repartition("shard", F.pmod("local_order", F.lit(16))).sortWithinPartitions("shard", "local_order")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
