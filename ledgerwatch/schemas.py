"""Typed tables of the warehouse (sources, facts, SCD2 dimensions, report,
load metadata). Varchar limits of the original model are kept as field
metadata: :func:`within_limits` enforces them on warehouse writes, and
``CHAR``/``VARCHAR`` DDL for catalog tables is produced by :func:`ddl`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, TS, D = T.StringType(), T.TimestampNTZType(), T.DateType()
AMT = T.DecimalType(12, 2)


def _f(name, typ, limit=None):
    md = {"varchar": limit} if limit else {}
    return T.StructField(name, typ, True, md)


# ---- sources (columns by position) -------------------------------------
TRANSACTIONS_FILE = T.StructType([
    _f("trans_id", S, 11), _f("trans_date", S), _f("amt", S), _f("card_num", S, 20),
    _f("oper_type", S, 8), _f("oper_result", S, 8), _f("terminal", S, 6)])

CARDS_SRC = T.StructType([_f("card_num", S, 20), _f("account_num", S, 20),
                          _f("create_dt", TS), _f("update_dt", D)])
ACCOUNTS_SRC = T.StructType([_f("account_num", S, 20), _f("valid_to", D), _f("client", S, 10),
                             _f("create_dt", TS), _f("update_dt", D)])
CLIENTS_SRC = T.StructType([
    _f("client_id", S, 10), _f("last_name", S, 20), _f("first_name", S, 20), _f("patronymic", S, 20),
    _f("date_of_birth", D), _f("passport_num", S, 15), _f("passport_valid_to", D), _f("phone", S, 16),
    _f("create_dt", TS), _f("update_dt", D)])

# ---- facts ----------------------------------------------------------------
TRANSACTIONS = T.StructType([
    _f("trans_id", S, 11), _f("trans_date", TS), _f("card_num", S, 20), _f("oper_type", S, 8),
    _f("amt", AMT), _f("oper_result", S, 8), _f("terminal", S, 6)])

BLACKLIST = T.StructType([_f("passport_num", S, 15), _f("entry_dt", D)])

# ---- SCD2 dimensions: key, attributes -----------------------------------
DIMENSIONS = {
    "terminals": [_f("terminal_id", S, 6), _f("terminal_type", S, 3), _f("terminal_city", S, 50),
                  _f("terminal_address", S, 200)],
    "cards": CARDS_SRC.fields[:2],
    "accounts": ACCOUNTS_SRC.fields[:3],
    "clients": CLIENTS_SRC.fields[:8],
}


def dim_schema(name: str) -> T.StructType:
    """Key, attributes and version columns of a stored dimension."""
    return T.StructType([*DIMENSIONS[name], _f("effective_from", TS), _f("effective_to", TS), _f("deleted_flg", S, 1)])


def within_limits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows, failing on a text longer than its column's limit (as a VARCHAR table does)."""
    limits = {f.name: f.metadata["varchar"] for f in schema.fields if f.metadata.get("varchar")}
    return df.select(*[
        F.when(F.length(c) > limits[c], F.raise_error(F.concat(
            F.lit(f"value too long for {c} ({limits[c]} characters): "), F.col(c))).cast("string"))
        .otherwise(F.col(c)).alias(c) if c in limits else F.col(c) for c in df.columns])


# ---- report and load metadata ------------------------------------------
REPORT = T.StructType([
    _f("event_dt", TS), _f("passport", S, 15), _f("fio", S, 62), _f("phone", S, 16),
    _f("event_type", T.ShortType()), _f("report_dt", D)])

META = T.StructType([_f("table_name", S, 50), _f("max_update_dt", TS)])


def ddl(schema: T.StructType) -> str:
    """Column DDL with VARCHAR limits, e.g. for ``CREATE TABLE .. USING parquet``."""
    out = []
    for f in schema.fields:
        lim = f.metadata.get("varchar")
        typ = f"VARCHAR({lim})" if lim else f.dataType.simpleString()
        out.append(f"{f.name} {typ}")
    return ", ".join(out)


# ---- catalog tables with defaults (A12) ----------------------------------------
_OPEN_DEFAULT = "TIMESTAMP_NTZ '9999-12-31 00:00:00'"
def table_ddl(database: str) -> dict[str, str]:
    """``CREATE TABLE IF NOT EXISTS`` statements of the warehouse tables, with
    the original's VARCHAR limits (writes over the limit fail) and defaults
    (``effective_to = 9999-12-31``, ``deleted_flg = 'N'``)."""
    out = {
        "fact_transactions": f"{ddl(TRANSACTIONS)}, processed_dt TIMESTAMP, load_dt DATE",
        "fact_passport_blacklist": f"{ddl(BLACKLIST)}, processed_dt TIMESTAMP, load_dt DATE",
        "rep_fraud": f"{ddl(REPORT)}, processed_dt TIMESTAMP",
        "meta_loads": "schema_name VARCHAR(30), table_name VARCHAR(50), max_update_dt TIMESTAMP_NTZ, last_load_dt DATE, "
                      "processed_dt TIMESTAMP",
    }
    for name, fields in DIMENSIONS.items():
        out[f"dim_{name}_hist"] = (f"{ddl(T.StructType(fields))}, effective_from TIMESTAMP_NTZ, "
                                   f"effective_to TIMESTAMP_NTZ DEFAULT {_OPEN_DEFAULT}, "
                                   f"deleted_flg CHAR(1) DEFAULT 'N', processed_dt TIMESTAMP")
    return {t: f"CREATE TABLE IF NOT EXISTS {database}.{t} ({cols}) USING parquet" for t, cols in out.items()}


def create_tables(spark, database: str, location: str | None = None) -> list[str]:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    stmts = table_ddl(database)
    for s in stmts.values():
        spark.sql(s)
    return list(stmts)
