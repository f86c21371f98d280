"""Training rows: labelled documents outside the held-out fold, bounded in number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
SAMPLE = 20_000  # most labelled rows that any classifier here is fitted on


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0; rows with a null id count as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id", limit: int = SAMPLE) -> DataFrame:
    """(id, label) of at most ``limit`` labelled rows that are not held out, by hash order of the id.
    An id labelled more than once takes its largest label; null labels are left out."""
    rows = labels.where(~held_out(id_col) & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("train_id")).agg(F.max(label_col).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("train_id"), "train_id").limit(limit)
