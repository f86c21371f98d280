"""Helpers that keep hot groups spread: lineage cuts, two-level running sums,
joins with hot keys, and bounded Arrow batches."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


TEXT_ROWS = 1000  # whole texts in an Arrow batch


def text_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold at most ``TEXT_ROWS`` rows, also in jobs that run later:
    the default of 10,000 texts costs each task some hundred MB in the JVM and in Python."""
    old = int(spark.conf.get(BATCHES))
    if old <= 0 or old > TEXT_ROWS:
        spark.conf.set(BATCHES, str(TEXT_ROWS))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Bound the rows of an Arrow batch while jobs run whose rows hold whole texts or sets."""
    old = spark.conf.get(BATCHES)
    spark.conf.set(BATCHES, str(min(rows, int(old)) if int(old) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCHES, old)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names (a private one only where none is set, as in local tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="ledgerwatch-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder: lost executors cost no more than the steps since."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def running_start(df: DataFrame, groups: list[str], order: str, ties: list[str], weight: str,
                  n_rows: int, out: str, ranges: Callable[[Column], Column] | None = None) -> DataFrame:
    """Exclusive running sum of ``weight`` in each group, by ``order`` then ``ties``.

    ``order`` is a long holding a uniform 60-bit hash (0 <= order < 2**60). Its top bits cut a
    group into about sqrt(n_rows) ranges, so no task holds a whole group: one
    window runs inside (group, range), a second one over the range totals.
    ``ranges`` may cut these ranges finer, in the order of the rows.
    Group columns may be null. ``df`` should be cheap to read twice.
    """
    bits = min(30, max(0, math.ceil(math.log2(max(1, n_rows)) / 2)))
    top = F.shiftright(F.col(order), 60 - bits)
    sub = df.withColumn("__sub", ranges(top) if ranges else top)
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("\u0000null")) for g in groups]
    sub = sub.withColumn("__g", F.concat_ws("\u0001", *keys))
    inside = Window.partitionBy("__g", "__sub").orderBy(order, *ties) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("__g").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    base = (sub.groupBy("__g", "__sub").agg(F.sum(weight).alias("__w"))
            .withColumn("__base", F.coalesce(F.sum("__w").over(before), F.lit(0)))
            .select("__g", "__sub", "__base"))
    return (sub.withColumn("__in", F.sum(weight).over(inside) - F.col(weight))
            .join(base, ["__g", "__sub"])
            .withColumn(out, F.col("__base") + F.col("__in"))
            .drop("__g", "__sub", "__base", "__in"))


def join_stats(rows: DataFrame, stats: DataFrame, keys: list[str], count: str, n_rows: int,
               spread: Column, hot_groups: int = 10_000) -> DataFrame:
    """Left-join per-group ``stats`` (unique on ``keys``; ``count`` = rows of the group) to ``rows``.

    Groups of more than ``n_rows / hot_groups`` rows are hot; there are at most
    ``hot_groups`` of them, which bounds the broadcast. Rows of hot groups take
    their values from it and pass the shuffle join under a spread key without
    a match; all others are joined by key. Keys must not be null.
    """
    values = [c for c in stats.columns if c not in keys]
    limit = max(1, n_rows // hot_groups)
    hot = stats.where(F.col(count) > limit).select(*keys, *[F.col(c).alias(f"__hot_{c}") for c in values])
    cold = stats.where(F.col(count) <= limit).select(
        F.col(keys[0]).cast("string").alias("__k0"),
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys) if i], *values)
    # a first key that no group has, different for each row, deals hot rows out evenly
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "__first", F.when(F.col(f"__hot_{count}").isNull(), F.col(keys[0]).cast("string"))
        .otherwise(F.concat(F.lit("\u0000hot "), spread.cast("string"))))
    on = [marked["__first"] == cold["__k0"]] + [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys) if i]
    return marked.join(cold, on, "left").select(
        *rows.columns, *[F.coalesce(F.col(f"__hot_{c}"), F.col(c)).alias(c) for c in values])


def tree_sum(parts: DataFrame, column: str) -> np.ndarray | None:
    """Sum of the int64 arrays that tasks put out as binary cells of one length. They are merged by eight at a
    time, so the driver takes at most eight arrays, whatever the number of tasks."""
    arrays = parts.rdd.map(lambda r: np.frombuffer(r[column], dtype=np.int64))
    n = arrays.getNumPartitions()
    return arrays.treeReduce(np.add, depth=max(2, math.ceil(math.log(n, 8)))) if n else None
