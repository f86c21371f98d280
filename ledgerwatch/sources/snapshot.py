"""Source-table snapshots (cards, accounts, clients).

A snapshot is the full content of a source table at load time. In production
it comes from the operational database over JDBC, read in parallel ranges of
a numeric column; any DataFrame (e.g. a Parquet export) works the same way.
Columns are mapped by position onto the typed schema, like the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.schemas import ACCOUNTS_SRC, CARDS_SRC, CLIENTS_SRC

SOURCE_SCHEMAS = {"cards": CARDS_SRC, "accounts": ACCOUNTS_SRC, "clients": CLIENTS_SRC}


def typed_by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename columns by position to ``schema`` and cast to its types."""
    if len(df.columns) < len(schema.fields):
        raise ValueError(f"snapshot has {len(df.columns)} columns, {len(schema.fields)} expected")
    cols = [F.col(f"`{src}`").cast(f.dataType).alias(f.name) for src, f in zip(df.columns, schema.fields)]
    return df.select(*cols)


def read_jdbc_snapshot(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
                       partition_column: str | None = None, lower_bound: int | None = None,
                       upper_bound: int | None = None, num_partitions: int | None = None,
                       fetch_size: int = 10000) -> DataFrame:
    """Parallel JDBC scan of a whole table (``select *``)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return r.load()


def read_snapshot(source: DataFrame, family: str) -> DataFrame:
    """Typed snapshot rows of ``family`` from any DataFrame (JDBC, Parquet, ...)."""
    return typed_by_position(source, SOURCE_SCHEMAS[family])
