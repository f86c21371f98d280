"""Incremental-load control: watermarks, load gate, delta filter, batch stamps.

The load metadata is one row per target table (``table_name``,
``max_update_dt``). It is tiny by construction; a batch meets one value of it as
a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import DEFAULT_WATERMARK, col, parse_ddmmyyyy
from ledgerwatch.schemas import META


def empty_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], META)


def _default_wm() -> Column:
    return F.lit(DEFAULT_WATERMARK).cast("timestamp_ntz")


def watermark(meta: DataFrame, table: str) -> DataFrame:
    """B1: one row ``wm``: the table's max_update_dt, 1900-01-01 when missing."""
    return (meta.where(F.col("table_name") == table)
                .agg(F.coalesce(F.max("max_update_dt"), _default_wm()).alias("wm")))


def seed_watermarks(meta: DataFrame, tables: DataFrame | Iterable[str]) -> DataFrame:
    """B3: add a 1900-01-01 row for every target table without one."""
    if not isinstance(tables, DataFrame):
        spark = meta.sparkSession
        tables = spark.createDataFrame([(t,) for t in tables], "table_name string")
    missing = tables.select("table_name").distinct().join(meta.select("table_name"), "table_name",
                                                          "left_anti")
    return meta.unionByName(missing.select("table_name", _default_wm().alias("max_update_dt")))


def load_gate(batches: DataFrame, meta: DataFrame, tables: DataFrame | Iterable[str],
              batch_col: str = "batch_dt") -> DataFrame:
    """B2: (batch, table) pairs to run: watermark strictly before the batch date.

    ``batches`` holds one row per batch date, ``tables`` the target names.
    """
    if not isinstance(tables, DataFrame):
        spark = batches.sparkSession
        tables = spark.createDataFrame([(t,) for t in tables], "table_name string")
    wm = meta.groupBy("table_name").agg(F.max("max_update_dt").alias("wm"))
    pairs = batches.select(batch_col).distinct().crossJoin(F.broadcast(tables.select("table_name")))
    j = pairs.join(F.broadcast(wm), "table_name", "left")
    return (j.where(F.coalesce(F.col("wm"), _default_wm()) < F.col(batch_col).cast("timestamp_ntz"))
             .select(batch_col, "table_name"))


def delta_filter(df: DataFrame, meta: DataFrame, table: str, update_col: str = "update_dt") -> DataFrame:
    """B4: rows strictly newer than the table's watermark, a scalar subquery (read once, no join)."""
    return df.where(F.col(update_col).cast("timestamp_ntz") > watermark(meta, table).scalar())


def advance_watermark(meta: DataFrame, table: str, delta: DataFrame,
                      update_col: str = "update_dt") -> DataFrame:
    """B6: set max_update_dt to the delta's max update date, never backwards and
    never to null when the delta is empty (the original could write null)."""
    new = delta.agg(F.max(F.col(update_col).cast("timestamp_ntz")).alias("new"))
    old = watermark(meta, table)
    row = old.crossJoin(new).select(
        F.lit(table).alias("table_name"),
        F.greatest(F.col("wm"), F.coalesce(F.col("new"), F.col("wm"))).alias("max_update_dt"))
    return meta.where(F.col("table_name") != table).unionByName(row)


def stamp_batch_date(df: DataFrame, file_col: str | Column = "_metadata.file_name",
                     out: str = "update_dt") -> DataFrame:
    """B8: update_dt = the DDMMYYYY date in the file name, for every row; a name without a date is an error."""
    name = col(file_col)
    date = parse_ddmmyyyy(F.regexp_extract(name, r"_(\d{8})\.[^.]+$", 1))
    wrong = F.raise_error(F.concat(F.lit("no date in file name "), F.coalesce(name, F.lit("(none)"))))
    return df.withColumn(out, F.coalesce(date, wrong.cast("date")))
