"""Reference-shaped inputs built from the driver's test tables.

Each builder has a Spark form (a DataFrame over the parquet tables) and an
SQL form (a DuckDB CTE body over the same tables, used by the oracle). The
mapping is the one in FIXTURES.md; both sides use the same fixed values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import LIVE, open_end

# Fixed values of the fixture mapping.
SUCCESS_TYPES = ("purchase", "click", "view")   # event types mapped to SUCCESS
TERMINAL_MOD = 100                              # terminal = event_id % 100
ACCOUNT_OFFSET = 100000                         # account_num = c_custkey + 100000
STATIC_FROM = dt.datetime(2000, 1, 1)           # start of the static dimension versions
BASE_DAY = dt.date(2024, 1, 1)                  # day 0 of the date offsets
BATCH_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3))


_READS: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's read-only table; one reader per session and path (saves
    the file listing and footer read when a plan uses a table many times)."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, name)
    df = _READS.get(key)
    if df is None:
        df = _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df


def _plus_days(n_col) -> F.Column:
    return F.date_add(F.lit(BASE_DAY), n_col.cast("int"))


def _version(deleted=None):
    return [F.lit(STATIC_FROM).cast("timestamp_ntz").alias("effective_from"),
            open_end().alias("effective_to"),
            (deleted if deleted is not None else F.lit(LIVE)).alias("deleted_flg")]


# ---- transactions ------------------------------------------------------------

def transactions(spark, sf_dir, card_mod: int | None = None,
                 success_types=SUCCESS_TYPES, days: tuple | None = None) -> DataFrame:
    """``days`` (first, last) bounds the event time in the scan itself, as a table stored by day would."""
    card = "user_id" if card_mod is None else f"user_id % {card_mod}"
    types = ", ".join(f"'{t}'" for t in success_types)
    events = table(spark, sf_dir, "events")
    if days is not None:
        kind = events.schema["ts"].dataType
        events = events.where((F.col("ts") >= F.lit(days[0]).cast(kind))
                              & (F.col("ts") < F.date_add(F.lit(days[1]), 1).cast(kind)))
    return events.selectExpr(
        "cast(event_id as string) as trans_id",
        "cast(date_trunc('second', ts) as timestamp_ntz) as trans_date",
        f"cast({card} as string) as card_num",
        "event_type as oper_type",
        "cast(value as decimal(12,2)) as amt",
        f"case when event_type in ({types}) then 'SUCCESS' else 'REJECT' end as oper_result",
        f"cast(event_id % {TERMINAL_MOD} as string) as terminal")


def transactions_sql(card_mod: int | None = None, success_types=SUCCESS_TYPES) -> str:
    card = "user_id" if card_mod is None else f"user_id % {card_mod}"
    types = ", ".join(f"'{t}'" for t in success_types)
    return f"""select cast(event_id as varchar) as trans_id,
        cast(date_trunc('second', ts) as timestamp) as trans_date,
        cast({card} as varchar) as card_num, event_type as oper_type,
        cast(value as decimal(12,2)) as amt,
        case when event_type in ({types}) then 'SUCCESS' else 'REJECT' end as oper_result,
        cast(event_id % {TERMINAL_MOD} as varchar) as terminal
      from events"""


# ---- static dimensions (one version per key) -------------------------------

_VERSION_EXPR = ["timestamp_ntz '2000-01-01 00:00:00' as effective_from",
                 "timestamp_ntz '9999-12-31 00:00:00' as effective_to"]


def terminals_static(spark, sf_dir) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).selectExpr(
        "cast(s_suppkey as string) as terminal_id",
        "case when s_suppkey % 3 = 0 then 'ATM' else 'POS' end as terminal_type",
        "n_name as terminal_city", "s_name as terminal_address", *_VERSION_EXPR, "'N' as deleted_flg")


STATIC_VERSION_SQL = ("timestamp '2000-01-01 00:00:00' as effective_from, "
                      "timestamp '9999-12-31 00:00:00' as effective_to")

TERMINALS_STATIC_SQL = f"""select cast(s_suppkey as varchar) as terminal_id,
        case when s_suppkey % 3 = 0 then 'ATM' else 'POS' end as terminal_type,
        n_name as terminal_city, s_name as terminal_address, {STATIC_VERSION_SQL}, 'N' as deleted_flg
      from supplier join nation on s_nationkey = n_nationkey"""


def cards_static(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0").selectExpr(
        "cast(c_custkey as string) as card_num",
        f"cast(c_custkey + {ACCOUNT_OFFSET} as string) as account_num", *_VERSION_EXPR, "'N' as deleted_flg")


CARDS_STATIC_SQL = f"""select cast(c_custkey as varchar) as card_num,
        cast(c_custkey + {ACCOUNT_OFFSET} as varchar) as account_num, {STATIC_VERSION_SQL}, 'N' as deleted_flg
      from customer where c_custkey % 13 <> 0"""


def accounts_static(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        f"cast(c_custkey + {ACCOUNT_OFFSET} as string) as account_num",
        "case when c_custkey % 5 = 0 then null "
        "else date_add(date '2024-01-01', cast(c_custkey % 45 as int)) end as valid_to",
        "cast(c_custkey as string) as client", *_VERSION_EXPR,
        "case when c_custkey % 17 = 0 then 'Y' else 'N' end as deleted_flg")


ACCOUNTS_STATIC_SQL = f"""select cast(c_custkey + {ACCOUNT_OFFSET} as varchar) as account_num,
        case when c_custkey % 5 = 0 then null
             else date '2024-01-01' + cast(c_custkey % 45 as integer) end as valid_to,
        cast(c_custkey as varchar) as client, {STATIC_VERSION_SQL},
        case when c_custkey % 17 = 0 then 'Y' else 'N' end as deleted_flg
      from customer"""


def clients_static(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as client_id", "c_mktsegment as last_name", "c_name as first_name",
        "case when c_custkey % 3 = 0 then null else 'X' end as patronymic",
        "date_add(date '1970-01-01', cast(c_custkey % 10000 as int)) as date_of_birth",
        "concat('P', cast(c_custkey as string)) as passport_num",
        "case when c_custkey % 4 = 0 then null "
        "else date_add(date '2024-01-01', cast(c_custkey % 40 as int)) end as passport_valid_to",
        "concat('+7', lpad(cast(c_custkey as string), 10, '0')) as phone", *_VERSION_EXPR, "'N' as deleted_flg")


CLIENTS_STATIC_SQL = f"""select cast(c_custkey as varchar) as client_id, c_mktsegment as last_name,
        c_name as first_name, case when c_custkey % 3 = 0 then null else 'X' end as patronymic,
        date '1970-01-01' + cast(c_custkey % 10000 as integer) as date_of_birth,
        'P' || cast(c_custkey as varchar) as passport_num,
        case when c_custkey % 4 = 0 then null
             else date '2024-01-01' + cast(c_custkey % 40 as integer) end as passport_valid_to,
        '+7' || lpad(cast(c_custkey as varchar), 10, '0') as phone, {STATIC_VERSION_SQL}, 'N' as deleted_flg
      from customer"""


def blacklist_static(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").selectExpr(
        "concat('P', cast(c_custkey as string)) as passport_num",
        "date_add(date '2024-01-01', cast(c_custkey % 30 as int)) as entry_dt")


BLACKLIST_STATIC_SQL = """select 'P' || cast(c_custkey as varchar) as passport_num,
        date '2024-01-01' + cast(c_custkey % 30 as integer) as entry_dt
      from customer where c_acctbal < 0"""


_STATIC = {"terminals": terminals_static, "cards": cards_static, "accounts": accounts_static,
           "clients": clients_static, "blacklist": blacklist_static}


class _LazyDims(dict):
    """Static dimensions, built on first use (a query builds only what it uses)."""

    def __init__(self, spark, sf_dir):
        super().__init__()
        self._args = (spark, sf_dir)

    def __missing__(self, name):
        df = self[name] = _STATIC[name](*self._args)
        return df


def static_dims(spark, sf_dir) -> dict[str, DataFrame]:
    return _LazyDims(spark, sf_dir)


STATIC_CTES = {"terminals": TERMINALS_STATIC_SQL, "cards": CARDS_STATIC_SQL,
               "accounts": ACCOUNTS_STATIC_SQL, "clients": CLIENTS_STATIC_SQL,
               "blacklist": BLACKLIST_STATIC_SQL}


# ---- dimension snapshots (one per batch day) ----------------------------------
# supplier, day 1: s_suppkey % 10 <> 0
#           day 2: % 7 <> 0; nationkey null if % 11 = 0, else + 1 if % 5 = 0
#           day 3: % 9 <> 0; nationkey + 1 if % 5 = 0

def _supplier_keep(k, day: int):
    return {1: k % 10 != 0, 2: k % 7 != 0, 3: k % 9 != 0}[day]


def _supplier_attr(k, nk, day: int):
    if day == 1:
        return nk
    if day == 2:
        return F.when(k % 11 == 0, F.lit(None).cast("int")).when(k % 5 == 0, nk + 1).otherwise(nk)
    return F.when(k % 5 == 0, nk + 1).otherwise(nk)


def supplier_snapshot(spark, sf_dir, day: int, keys_of: int | None = None) -> DataFrame:
    """Snapshot of batch ``day``; ``keys_of`` takes the key set of another day
    (attributes of one day over the keys of another)."""
    s = table(spark, sf_dir, "supplier")
    k, nk = F.col("s_suppkey"), F.col("s_nationkey")
    return s.where(_supplier_keep(k, keys_of or day)).select(
        k.alias("s_suppkey"), _supplier_attr(k, nk, day).alias("s_nationkey"),
        F.lit(BATCH_DAYS[(keys_of or day) - 1]).alias("update_dt"))


def supplier_snapshot_sql(day: int, keys_of: int | None = None) -> str:
    keep = {1: "s_suppkey % 10 <> 0", 2: "s_suppkey % 7 <> 0", 3: "s_suppkey % 9 <> 0"}[keys_of or day]
    attr = {1: "s_nationkey",
            2: ("case when s_suppkey % 11 = 0 then null when s_suppkey % 5 = 0 "
                "then s_nationkey + 1 else s_nationkey end"),
            3: "case when s_suppkey % 5 = 0 then s_nationkey + 1 else s_nationkey end"}[day]
    d = BATCH_DAYS[(keys_of or day) - 1].isoformat()
    return f"select s_suppkey, {attr} as s_nationkey, date '{d}' as update_dt from supplier where {keep}"


# Source snapshots of cards / accounts / clients / terminals for two batch days.
# Day 2 changes a fifth of the keys, drops every seventh, and gives some rows an
# old non-null update_dt (unchanged, so they fall out of the delta).

def _src_update_dt(k, day: int):
    """update_dt as the source holds it: null (-> batch date) or an old date."""
    if day == 1:
        return F.when(k % 2 == 0, F.lit(None).cast("date")).otherwise(F.lit(dt.date(2023, 12, 1)))
    return F.when(k % 5 == 0, F.lit(None).cast("date")).when(k % 3 == 0, F.lit(dt.date(2023, 12, 15))) \
        .otherwise(F.lit(None).cast("date"))


def _src_update_sql(day: int) -> str:
    if day == 1:
        return "case when c_custkey % 2 = 0 then null else date '2023-12-01' end"
    return ("case when c_custkey % 5 = 0 then null when c_custkey % 3 = 0 then date '2023-12-15' "
            "else null end")


def _src_keep(k, day: int):
    return (k % 10 != 1) if day == 1 else (k % 7 != 0)


def _src_keep_sql(day: int) -> str:
    return "c_custkey % 10 <> 1" if day == 1 else "c_custkey % 7 <> 0"


def _create_dt(k):
    return F.date_add(F.lit(dt.date(2023, 6, 1)), (k % 100).cast("int")).cast("timestamp_ntz")


CREATE_DT_SQL = "cast(date '2023-06-01' + cast(c_custkey % 100 as integer) as timestamp)"


def card_source(spark, sf_dir, day: int) -> DataFrame:
    k = F.col("c_custkey")
    card = F.when(k % 7 == 3, F.concat(F.lit(" "), k.cast("string"), F.lit(" "))).otherwise(k.cast("string"))
    acct = k + ACCOUNT_OFFSET + (F.when(k % 5 == 0, F.lit(ACCOUNT_OFFSET)).otherwise(0) if day == 2 else 0)
    return table(spark, sf_dir, "customer").where(_src_keep(k, day)).select(
        card.alias("card_num"), acct.cast("string").alias("account_num"),
        _create_dt(k).alias("create_dt"), _src_update_dt(k, day).alias("update_dt"))


def card_source_sql(day: int) -> str:
    acct = f"c_custkey + {ACCOUNT_OFFSET}" + (
        f" + case when c_custkey % 5 = 0 then {ACCOUNT_OFFSET} else 0 end" if day == 2 else "")
    return f"""select case when c_custkey % 7 = 3 then ' ' || cast(c_custkey as varchar) || ' '
                else cast(c_custkey as varchar) end as card_num,
            cast({acct} as varchar) as account_num, {CREATE_DT_SQL} as create_dt,
            {_src_update_sql(day)} as update_dt
          from customer where {_src_keep_sql(day)}"""


def account_source(spark, sf_dir, day: int) -> DataFrame:
    k = F.col("c_custkey")
    valid = F.when(k % 5 == 0, F.lit(None).cast("date")).otherwise(_plus_days(k % 45))
    if day == 2:
        valid = F.when(k % 4 == 0, _plus_days(k % 45 + 365)).otherwise(valid)
    return table(spark, sf_dir, "customer").where(_src_keep(k, day)).select(
        (k + ACCOUNT_OFFSET).cast("string").alias("account_num"), valid.alias("valid_to"),
        k.cast("string").alias("client"), _create_dt(k).alias("create_dt"),
        _src_update_dt(k, day).alias("update_dt"))


def account_source_sql(day: int) -> str:
    valid = "case when c_custkey % 5 = 0 then null else date '2024-01-01' + cast(c_custkey % 45 as integer) end"
    if day == 2:
        valid = (f"case when c_custkey % 4 = 0 then date '2024-01-01' + cast(c_custkey % 45 + 365 as integer) "
                 f"else {valid} end")
    return f"""select cast(c_custkey + {ACCOUNT_OFFSET} as varchar) as account_num, {valid} as valid_to,
            cast(c_custkey as varchar) as client, {CREATE_DT_SQL} as create_dt,
            {_src_update_sql(day)} as update_dt
          from customer where {_src_keep_sql(day)}"""


def client_source(spark, sf_dir, day: int) -> DataFrame:
    base = clients_static(spark, sf_dir).drop("effective_from", "effective_to", "deleted_flg")
    k = F.col("client_id").cast("bigint")
    phone = F.col("phone")
    patr = F.col("patronymic")
    if day == 2:
        phone = F.when(k % 6 == 0, F.concat(F.lit("+8"), F.substring("phone", 3, 10))).otherwise(phone)
        patr = F.when(k % 8 == 1, F.lit(None).cast("string")).otherwise(patr)
    return base.where(_src_keep(k, day)).select(
        "client_id", "last_name", "first_name", patr.alias("patronymic"), "date_of_birth", "passport_num",
        "passport_valid_to", phone.alias("phone"),
        F.date_add(F.lit(dt.date(2023, 6, 1)), (k % 100).cast("int")).cast("timestamp_ntz").alias("create_dt"),
        _src_update_dt(k, day).alias("update_dt"))


def client_source_sql(day: int) -> str:
    phone = "'+7' || lpad(cast(c_custkey as varchar), 10, '0')"
    patr = "case when c_custkey % 3 = 0 then null else 'X' end"
    if day == 2:
        phone = f"case when c_custkey % 6 = 0 then '+8' || substring({phone}, 3, 10) else {phone} end"
        patr = f"case when c_custkey % 8 = 1 then null else {patr} end"
    return f"""select cast(c_custkey as varchar) as client_id, c_mktsegment as last_name,
            c_name as first_name, {patr} as patronymic,
            date '1970-01-01' + cast(c_custkey % 10000 as integer) as date_of_birth,
            'P' || cast(c_custkey as varchar) as passport_num,
            case when c_custkey % 4 = 0 then null
                 else date '2024-01-01' + cast(c_custkey % 40 as integer) end as passport_valid_to,
            {phone} as phone, {CREATE_DT_SQL} as create_dt, {_src_update_sql(day)} as update_dt
          from customer where {_src_keep_sql(day)}"""


def terminal_source(spark, sf_dir, day: int) -> DataFrame:
    """Terminal file contents of a batch day (update_dt = the file's date)."""
    base = terminals_static(spark, sf_dir).drop("effective_from", "effective_to", "deleted_flg")
    k = F.col("terminal_id").cast("bigint")
    city = F.col("terminal_city")
    if day == 2:
        city = F.when(k % 4 == 0, F.concat(city, F.lit("-N"))).otherwise(city)
    return base.where(_src_keep(k, day)).select(
        "terminal_id", "terminal_type", city.alias("terminal_city"), "terminal_address",
        F.lit(BATCH_DAYS[day - 1]).alias("update_dt"))


def terminal_source_sql(day: int) -> str:
    city = "terminal_city"
    if day == 2:
        city = "case when cast(terminal_id as bigint) % 4 = 0 then terminal_city || '-N' else terminal_city end"
    keep = ("cast(terminal_id as bigint) % 10 <> 1" if day == 1 else "cast(terminal_id as bigint) % 7 <> 0")
    return f"""select terminal_id, terminal_type, {city} as terminal_city, terminal_address,
            date '{BATCH_DAYS[day - 1].isoformat()}' as update_dt
          from ({TERMINALS_STATIC_SQL}) where {keep}"""
