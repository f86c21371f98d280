"""Dated-file batch discovery.

Input files are named ``<family>_<DDMMYYYY>.<ext>`` (``transactions_01032021.txt``,
``terminals_01032021.xlsx``, ``passport_blacklist_01032021.xlsx``). Listing uses
Spark's ``binaryFile`` source with only path/length selected, so no file
content is read; parsing is pure column expressions.

Decisions against the original: batch dates are sorted as dates (not as
DDMMYYYY text), and the batch list is the union of the dates of all families
with a per-family availability flag (the original indexed one family's list
with another's positions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import parse_ddmmyyyy

# File families and the name pattern of the landing folder.
FAMILIES = ("transactions", "terminals", "passport_blacklist")
NAME_PATTERN = r"^(transactions|terminals|passport_blacklist)_(\d{8})\.([A-Za-z0-9]+)$"


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Files directly in ``folder`` (path, file_name, length); content is not read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
          .load(folder).select("path", "length"))
    return df.withColumn("file_name", F.regexp_extract("path", r"([^/]+)$", 1))


def parse_file_names(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """family, batch_dt, file_name for names matching the pattern."""
    name = F.col(name_col)
    fam = F.regexp_extract(name, NAME_PATTERN, 1)
    day = parse_ddmmyyyy(F.regexp_extract(name, NAME_PATTERN, 2))
    return (files.select(fam.alias("family"), day.alias("batch_dt"), name.alias("file_name"))
                 .where((F.col("family") != "") & F.col("batch_dt").isNotNull()))


def undated_files(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """file_name of a family's files whose eight digits are no date; ``parse_file_names`` leaves them out."""
    name = F.col(name_col)
    day = parse_ddmmyyyy(F.regexp_extract(name, NAME_PATTERN, 2))
    return files.select(name.alias("file_name")).where(name.rlike(NAME_PATTERN) & day.isNull())


def discover_batches(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """One row per batch date, sorted by date, with a flag per family."""
    parsed = parse_file_names(files, name_col)
    return (parsed.groupBy("batch_dt")
                  .agg(*[F.max(F.col("family") == f).alias(f"has_{f}") for f in FAMILIES])
                  .select("batch_dt", *[F.coalesce(F.col(f"has_{f}"), F.lit(False)).alias(f"has_{f}")
                                        for f in FAMILIES])
                  .orderBy("batch_dt"))
