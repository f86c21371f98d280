"""Transactions file source: ``;``-separated text with a header row and a
decimal comma, columns mapped by position (header names are ignored).

Everything is parsed with column expressions after a string-typed scan, so a
folder of many daily files is read in parallel splits; ids stay strings
(leading zeros kept) and amounts go straight to decimal(12,2), never through
a float.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.operators.incremental import stamp_batch_date
from ledgerwatch.schemas import TRANSACTIONS_FILE

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_decimal_comma(c: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """``1234,56`` -> 1234.56 as decimal; spaces (thousands groups) removed."""
    s = F.regexp_replace(F.regexp_replace(F.trim(F.col(c) if isinstance(c, str) else c), r"\s", ""), ",", ".")
    return s.cast(f"decimal({precision},{scale})")


def typed_transactions(raw: DataFrame, *keep: str) -> DataFrame:
    """The file's text columns as typed transaction columns."""
    return raw.select(
        "trans_id", F.to_timestamp_ntz(F.trim("trans_date"), F.lit(TIMESTAMP_FORMAT)).alias("trans_date"),
        "card_num", "oper_type", parse_decimal_comma("amt").alias("amt"), "oper_result", "terminal", *keep)


def read_transactions(spark: SparkSession, path: str, *, glob: str = "transactions_*.txt",
                      sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Typed transactions with ``update_dt`` = the file's DDMMYYYY date."""
    raw = (spark.read.option("pathGlobFilter", glob)
           .csv(path, sep=sep, header=True, schema=TRANSACTIONS_FILE, enforceSchema=True,
                encoding=encoding, mode="FAILFAST")
           .select("*", F.col("_metadata.file_name").alias("__file")))
    return stamp_batch_date(typed_transactions(raw, "__file"), "__file").drop("__file")
