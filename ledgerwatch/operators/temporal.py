"""Temporal operators: point-in-time (valid-at) joins against SCD2 history,
and time-bucketed look-back partitioning for per-card sliding windows.

Scale notes
-----------
* ``valid_at_join`` is an equi join on the business key with the validity
  range as a residual predicate, so Spark plans a hash/sort-merge join on the
  key (never a nested loop). Whether the dimension side is broadcast is left to
  Catalyst's size estimate and AQE's runtime statistics
  (``autoBroadcastJoinThreshold``), i.e. only behind a checked size. A hot key
  on the fact side is split by AQE's skew-join handling, which applies to the
  (left-outer) probe side.
* ``lookback_buckets`` turns "per card, look back N seconds" into windows over
  ``(card, time bucket)``. Each row is also copied, as context, into the next
  bucket when it lies within N seconds of that bucket's start, so every frame
  is complete inside its bucket. A card that holds a third of all rows is thus
  cut into many partitions; the copy overhead is ``N / bucket``.
* ``hot_groups`` finds the (card, bucket) groups that hold too many rows all the
  same, context included, however narrow the burst is. Callers reduce these to
  one summary per second before any window runs over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import LIVE, col


def checked_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows (on request; no registered query or
    pipeline step asks for it, Spark's own byte-based choice serves them).

    The check is a bounded job (``limit(max_rows + 1).count()``, which stops
    reading once the limit is passed); above the limit the join stays a
    shuffle join (and AQE may still broadcast from runtime statistics).
    """
    if not max_rows:
        return df
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def valid_at_join(facts: DataFrame, dim: DataFrame, *, fact_key: str | Column, dim_key: str,
                  at: str | Column, select: dict[str, str], live_only: bool = True,
                  how: str = "left", broadcast_rows: int | None = None) -> DataFrame:
    """Join each fact row to the dimension version valid at time ``at``.

    ``at between effective_from and effective_to`` (closed on both ends, as in
    the original model, so a version closed at midnight leaves the rest of its
    last day uncovered), optionally only non-deleted versions. ``select`` maps
    dimension columns to output names; a left join never drops a fact row.
    By default Catalyst decides the join strategy from its size estimate (the
    file size of a stored dimension) and AQE from runtime statistics; with
    ``broadcast_rows`` the dimension is broadcast after an explicit bounded
    row count instead (for derived dimensions whose size Catalyst cannot estimate).
    """
    live = f"deleted_flg = '{LIVE}'" if live_only else "true"
    d = dim.where(live).selectExpr(f"`{dim_key}` AS __vk", "effective_from AS __vf", "effective_to AS __vt",
                                   *[f"`{src}` AS `{dst}`" for src, dst in select.items()])
    if isinstance(fact_key, str) and isinstance(at, str):
        f = facts.selectExpr("*", f"`{fact_key}` AS __fk", f"`{at}` AS __at")
    else:
        f = facts.select("*", col(fact_key).alias("__fk"), col(at).alias("__at"))
    f = f.withColumn("__fk", salt_null_key(f, "__fk"))
    d = checked_broadcast(d, broadcast_rows)
    cond = F.expr("__fk = __vk AND __at BETWEEN __vf AND __vt")
    return f.join(d, cond, how).drop("__fk", "__at", "__vk", "__vf", "__vt")


NULL_KEY_PREFIX = "\u0000"   # never starts a real business key


def salt_null_key(df: DataFrame, key: str) -> Column:
    """A null string join key can never match; give each such row a distinct
    non-matching key so a mass of nulls (unknown cards, no client) spreads over
    all shuffle partitions instead of landing in one. Other types pass as is."""
    if dict(df.dtypes).get(key) != "string":
        return F.col(key)
    return F.expr(f"coalesce(`{key}`, concat('{NULL_KEY_PREFIX}', cast(xxhash64(*) as string)))")


BUCKET = "__bucket"
CONTEXT = "__ctx"
LONE = -(1 << 62)   # buckets of rows that see no other row start here, one bucket for each


def lookback_buckets(df: DataFrame, *, key: str, seconds: str, lookback: int, bucket: int,
                     valid: Column | None = None) -> DataFrame:
    """Assign ``(key, __bucket)`` window partitions with look-back context copies.

    A row lives in time bucket ``floor(t / bucket)`` and is copied (``__ctx``)
    into the next one if that starts at most ``lookback`` seconds after it, so
    every frame of ``lookback`` seconds is complete inside its bucket.
    Rows with ``valid`` false (null key or time) cannot see other rows: each
    gets a negative bucket of its own, so any mass of them, equal rows too,
    spreads evenly. Callers must mask their results.
    """
    if bucket < lookback:
        raise ValueError("bucket width must be at least the look-back")
    if valid is None:
        valid = F.col(key).isNotNull() & F.col(seconds).isNotNull()
    df = df.withColumns({"__v": valid, "__lone": F.monotonically_increasing_id()})
    b = f"floor({seconds} / {bucket})"
    groups = F.expr(
        f"CASE WHEN NOT __v THEN array(named_struct('{BUCKET}', {LONE} + __lone, '{CONTEXT}', false)) "
        f"WHEN {seconds} + {lookback} >= ({b} + 1) * {bucket} THEN "
        f"array(named_struct('{BUCKET}', {b}, '{CONTEXT}', false), named_struct('{BUCKET}', {b} + 1, '{CONTEXT}', true)) "
        f"ELSE array(named_struct('{BUCKET}', {b}, '{CONTEXT}', false)) END")
    return df.select("*", F.inline(groups)).drop("__v", "__lone")


def hot_groups(df: DataFrame, *, key: str, seconds: str, lookback: int, bucket: int, hot_rows: int) -> DataFrame:
    """The ``(key, __bucket)`` groups of ``lookback_buckets`` with more than ``hot_rows`` rows, copies counted.

    Exact counts (a partial aggregation, so a hot key is pre-aggregated
    map-side). Each entry stands for more than ``hot_rows`` of the at most
    ``2 * rows`` rows and copies: a proven bound for broadcasting the result.
    """
    known = df.where(F.col(key).isNotNull() & F.col(seconds).isNotNull()).select(key, seconds)
    dealt = lookback_buckets(known, key=key, seconds=seconds, lookback=lookback, bucket=bucket)
    return dealt.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("__n")) \
        .where(F.col("__n") > F.lit(hot_rows)).select(key, BUCKET)
