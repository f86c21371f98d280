"""Registered queries for incremental-load control, fact appends, batch
discovery and the single-day report, with their DuckDB oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators import facts, fraud as fr, incremental as inc, scd2
from ledgerwatch.plans import fixtures as fx
from ledgerwatch.plans import oracle as orc
from ledgerwatch.schemas import META, TRANSACTIONS_FILE
from ledgerwatch.sources import delimited, discovery

# The load-metadata state the queries start from, and the targets.
META0 = [("transactions", dt.datetime(2024, 1, 15)), ("terminals", dt.datetime(2024, 1, 10)),
         ("passport_blacklist", dt.datetime(2024, 2, 1)), ("cards", dt.datetime(2024, 1, 20))]
TARGETS = ["transactions", "terminals", "passport_blacklist", "cards", "accounts", "clients", "fraud_report"]
REPORT_DAY = dt.date(2024, 1, 15)

META0_SQL = ("select * from (values " + ", ".join(f"('{t}', timestamp '{w:%Y-%m-%d %H:%M:%S}')" for t, w in META0)
             + ") as m(table_name, max_update_dt)")
TARGETS_SQL = "select * from (values " + ", ".join(f"('{t}')" for t in TARGETS) + ") as t(table_name)"
TS1900 = "timestamp '1900-01-01 00:00:00'"


def meta0(spark) -> DataFrame:
    return spark.createDataFrame(META0, META)


# ---- stamped sources --------------------------------------------------------------

def tx_stamped(spark, sf) -> DataFrame:
    return fx.transactions(spark, sf).withColumn("update_dt", F.to_date("trans_date"))


TX_STAMPED_SQL = f"select *, cast(trans_date as date) as update_dt from ({fx.transactions_sql()})"


def blacklist_stamped(spark, sf) -> DataFrame:
    return fx.blacklist_static(spark, sf).withColumn("update_dt", F.col("entry_dt"))


BL_STAMPED_SQL = f"select *, entry_dt as update_dt from ({fx.BLACKLIST_STATIC_SQL})"


def _wm_sql(table: str) -> str:
    return f"(select coalesce(max(max_update_dt), {TS1900}) from meta where table_name = '{table}')"


# ---- B4 delta filter ----------------------------------------------------------------

def q_delta_filter(spark, sf):
    return inc.delta_filter(tx_stamped(spark, sf), meta0(spark), "transactions")


SQL_DELTA_FILTER = orc.with_ctes({"meta": META0_SQL, "txs": TX_STAMPED_SQL},
                                 f"select * from txs where cast(update_dt as timestamp) > {_wm_sql('transactions')}")


# ---- B6 watermark advance (one family with an empty delta) ---------------------------

def _advanced(spark, sf) -> DataFrame:
    m0 = meta0(spark)
    m = inc.advance_watermark(m0, "transactions", inc.delta_filter(tx_stamped(spark, sf), m0, "transactions"))
    m = inc.advance_watermark(m, "passport_blacklist",
                              inc.delta_filter(blacklist_stamped(spark, sf), m0, "passport_blacklist"))
    terms = fx.terminal_source(spark, sf, 2)
    return inc.advance_watermark(m, "terminals", inc.delta_filter(terms, m0, "terminals"))


def q_watermark_advance(spark, sf):
    return _advanced(spark, sf)


_ADV_CTES = {"meta": META0_SQL, "txs": TX_STAMPED_SQL, "bl": BL_STAMPED_SQL, "terms": fx.terminal_source_sql(2)}
_ADV_NEW = " union all ".join(
    f"select '{t}' as t, max(cast(update_dt as timestamp)) as nw from {rel} "
    f"where cast(update_dt as timestamp) > {_wm_sql(t)}"
    for t, rel in (("transactions", "txs"), ("passport_blacklist", "bl"), ("terminals", "terms")))
_ADV_BODY = ("select m.table_name, greatest(m.max_update_dt, coalesce(n.nw, m.max_update_dt)) as max_update_dt "
             "from meta m left join new n on m.table_name = n.t")
SQL_WATERMARK_ADVANCE = orc.with_ctes({**_ADV_CTES, "new": _ADV_NEW}, _ADV_BODY)


# ---- B3 seed ----------------------------------------------------------------------

def q_watermark_seed(spark, sf):
    return inc.seed_watermarks(_advanced(spark, sf), TARGETS)


SQL_WATERMARK_SEED = orc.with_ctes(
    {**_ADV_CTES, "new": _ADV_NEW, "adv": _ADV_BODY, "targets": TARGETS_SQL},
    f"""select * from adv union all
        select t.table_name, {TS1900} from targets t
        where not exists (select 1 from adv a where a.table_name = t.table_name)""")


# ---- A7 discovery and B2 gate --------------------------------------------------------

def landing_names(spark, sf) -> DataFrame:
    """File names of a landing folder, one family file per event day (derived
    from the events table), plus names that are not batch files."""
    d = F.col("d")
    stamp = F.date_format(d, "ddMMyyyy")
    day = F.dayofmonth(d)
    names = F.array(F.concat(F.lit("transactions_"), stamp, F.lit(".txt")),
                    F.when(day % 2 == 1, F.concat(F.lit("terminals_"), stamp, F.lit(".xlsx"))),
                    F.when(day % 5 == 0, F.concat(F.lit("passport_blacklist_"), stamp, F.lit(".xlsx"))),
                    F.when(day % 7 == 0, F.concat(F.lit("notes_"), stamp, F.lit(".txt"))))
    days = fx.table(spark, sf, "events").select(F.to_date("ts").alias("d")).distinct()
    return days.select(F.explode(names).alias("file_name")).where(F.col("file_name").isNotNull())


LANDING_SQL = """select file_name from (
      select 'transactions_' || strftime(d, '%d%m%Y') || '.txt' as file_name from days
      union all select 'terminals_' || strftime(d, '%d%m%Y') || '.xlsx' from days where day(d) % 2 = 1
      union all select 'passport_blacklist_' || strftime(d, '%d%m%Y') || '.xlsx' from days where day(d) % 5 = 0
      union all select 'notes_' || strftime(d, '%d%m%Y') || '.txt' from days where day(d) % 7 = 0)"""
_PAT = orc.BATCH_FILE
PARSED_SQL = f"""select regexp_extract(file_name, '{_PAT}', 1) as family,
        cast(strptime(regexp_extract(file_name, '{_PAT}', 2), '%d%m%Y') as date) as batch_dt
      from names where regexp_extract(file_name, '{_PAT}', 1) <> ''"""
_DISC_CTES = {"days": "select distinct cast(ts as date) as d from events", "names": LANDING_SQL,
              "parsed": PARSED_SQL}


def q_batch_discovery(spark, sf):
    return discovery.discover_batches(landing_names(spark, sf))


SQL_BATCH_DISCOVERY = orc.with_ctes(_DISC_CTES, "select batch_dt, " + ", ".join(
    f"coalesce(bool_or(family = '{f}'), false) as has_{f}" for f in orc.FAMILIES)
    + " from parsed group by batch_dt")


def q_load_gate(spark, sf):
    batches = discovery.discover_batches(landing_names(spark, sf))
    return inc.load_gate(batches, inc.seed_watermarks(meta0(spark), TARGETS), TARGETS)


SQL_LOAD_GATE = orc.with_ctes({**_DISC_CTES, "meta": META0_SQL, "targets": TARGETS_SQL}, f"""
      select b.batch_dt, t.table_name
      from (select distinct batch_dt from parsed) b cross join targets t
      left join (select table_name, max(max_update_dt) as wm from meta group by table_name) m
        on m.table_name = t.table_name
      where coalesce(m.wm, {TS1900}) < cast(b.batch_dt as timestamp)""")


# ---- B5 present keys, both scopes ------------------------------------------------------

def _card_batches(spark, sf):
    s1 = scd2.prepare_source("cards", fx.card_source(spark, sf, 1), fx.BATCH_DAYS[0])
    s2 = scd2.prepare_source("cards", fx.card_source(spark, sf, 2), fx.BATCH_DAYS[1])
    return s1, s2


def _present(scope):
    def q(spark, sf):
        s1, s2 = _card_batches(spark, sf)
        return scd2.present_keys(s2, "card_num", since=scd2.delta_watermark(s1), delete_scope=scope)
    return q


def _card_src_sql(day):
    return (f"select trim(card_num) as card_num, account_num, create_dt, "
            f"coalesce(update_dt, date '{fx.BATCH_DAYS[day - 1].isoformat()}') as update_dt "
            f"from ({fx.card_source_sql(day)})")


_PK_CTES = {"src1": _card_src_sql(1), "src2": _card_src_sql(2)}
SQL_PRESENT_DELTA = orc.with_ctes(_PK_CTES, "select card_num from src2 where update_dt > (select max(update_dt) from src1)")
SQL_PRESENT_SNAPSHOT = orc.with_ctes(_PK_CTES, "select card_num from src2")


# ---- H8 / H9 fact appends --------------------------------------------------------------

def q_append_absent_tx(spark, sf):
    """Target: ids with an id modulo 10 below 6; batch: those from 4 on, the sevens twice. Every row takes part."""
    tx = fx.transactions(spark, sf)
    part = F.col("trans_id").cast("bigint") % 10
    batch = tx.where(part >= 4).unionByName(tx.where(part == 7))
    return facts.append_absent(tx.where(part < 6), batch, "trans_id")


SQL_APPEND_TX = orc.with_ctes(
    {"tx": fx.transactions_sql(),
     "batch": ("select * from tx where cast(trans_id as bigint) % 10 >= 4 "
               "union all select * from tx where cast(trans_id as bigint) % 10 = 7")},
    "select * from batch where cast(trans_id as bigint) % 10 >= 6")


def blacklist_batch(spark, sf) -> DataFrame:
    """A blacklist file's rows: the passport of every customer, and a second, later entry for every other one."""
    k = F.col("c_custkey")
    day = F.date_add(F.lit(fx.BASE_DAY), (k % 30).cast("int"))
    c = fx.table(spark, sf, "customer").select(F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
                                               day.alias("entry_dt"), (k % 2 == 0).alias("again"))
    return c.drop("again").unionByName(
        c.where("again").select("passport_num", F.date_add("entry_dt", 3).alias("entry_dt")))


BL_BATCH_SQL = """select 'P' || cast(c_custkey as varchar) as passport_num,
        date '2024-01-01' + cast(c_custkey % 30 as integer) as entry_dt from customer
      union all
      select 'P' || cast(c_custkey as varchar), date '2024-01-01' + cast(c_custkey % 30 + 3 as integer)
        from customer where c_custkey % 2 = 0"""


def q_append_absent_blacklist(spark, sf):
    return facts.append_absent(fx.blacklist_static(spark, sf), blacklist_batch(spark, sf), "passport_num")


def q_append_absent_blacklist_dedup(spark, sf):
    return facts.append_absent(fx.blacklist_static(spark, sf), blacklist_batch(spark, sf), "passport_num",
                               dedupe_within_batch=True, first_by="entry_dt")


_BL_CTES = {"target": fx.BLACKLIST_STATIC_SQL, "batch": BL_BATCH_SQL}
SQL_APPEND_BL = orc.with_ctes(
    _BL_CTES, "select * from batch b where not exists (select 1 from target t where t.passport_num = b.passport_num)")
SQL_APPEND_BL_DEDUP = orc.with_ctes(
    _BL_CTES, """select passport_num, min(entry_dt) as entry_dt from batch b
      where not exists (select 1 from target t where t.passport_num = b.passport_num) group by passport_num""")


# ---- one report day (day slice + look-back across midnight) ----------------------------

def q_fraud_report_day(spark, sf):
    tx = fx.transactions(spark, sf, 10, days=(REPORT_DAY - dt.timedelta(days=1), REPORT_DAY))  # day and look-back
    d = fx.static_dims(spark, sf)
    return fr.build_report(tx, d["terminals"], d["cards"], d["accounts"], d["clients"], d["blacklist"],
                           report_from=REPORT_DAY, report_to=REPORT_DAY)


SQL_FRAUD_REPORT_DAY = (f"select * from ({orc.report_sql(card_mod=10)}) r "
                        f"where report_dt = date '{REPORT_DAY.isoformat()}'")


# ---- the gate per target, with the rows each due (target, batch) would stage -------------

def q_load_per_target(spark, sf):
    """Staged rows of every (target, batch date) that its own watermark lets through."""
    m0 = inc.seed_watermarks(meta0(spark), TARGETS)
    staged = [("transactions", tx_stamped(spark, sf)), ("passport_blacklist", blacklist_stamped(spark, sf)),
              ("terminals", fx.terminal_source(spark, sf, 2)), ("cards", fx.card_source(spark, sf, 2))]
    rows = None
    for name, df in staged:
        one = df.where(F.col("update_dt").isNotNull()).groupBy(F.col("update_dt").cast("date").alias("batch_dt")) \
            .agg(F.count(F.lit(1)).alias("staged_rows")).withColumn("table_name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    due = inc.load_gate(rows, m0, TARGETS)
    return rows.join(due, ["batch_dt", "table_name"], "left_semi").select("table_name", "batch_dt", "staged_rows")


SQL_LOAD_PER_TARGET = orc.with_ctes(
    {"meta": META0_SQL, "txs": TX_STAMPED_SQL, "bl": BL_STAMPED_SQL, "terms": fx.terminal_source_sql(2),
     "crd": fx.card_source_sql(2)},
    " union all ".join(
        f"""select '{t}' as table_name, cast(update_dt as date) as batch_dt, count(*) as staged_rows from {rel}
            where cast(cast(update_dt as date) as timestamp) > {_wm_sql(t)} group by cast(update_dt as date)"""
        for t, rel in (("transactions", "txs"), ("passport_blacklist", "bl"), ("terminals", "terms"), ("cards", "crd"))))


# ---- A1 / F1 / F13: the text form of the transactions, parsed by the reader's expressions ----

def q_tx_from_text(spark, sf):
    """Every transaction written as a line of the file format and parsed back."""
    tx = fx.transactions(spark, sf)
    text = {"trans_date": F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss"),
            "amt": F.translate(F.col("amt").cast("string"), ".", ",")}
    names = TRANSACTIONS_FILE.names
    line = F.concat_ws(";", *[F.coalesce(text.get(n, F.col(n)), F.lit("")) for n in names])
    cells = F.split(line, ";", -1)
    raw = tx.select(*[F.nullif(cells[i], F.lit("")).alias(n) for i, n in enumerate(names)])
    return delimited.typed_transactions(raw)


QUERIES = {
    "delta_filter": q_delta_filter,
    "watermark_advance": q_watermark_advance,
    "watermark_seed": q_watermark_seed,
    "batch_discovery": q_batch_discovery,
    "load_gate": q_load_gate,
    "present_keys_delta": _present("delta"),
    "present_keys_snapshot": _present("snapshot"),
    "append_absent_tx": q_append_absent_tx,
    "append_absent_blacklist": q_append_absent_blacklist,
    "append_absent_blacklist_dedup": q_append_absent_blacklist_dedup,
    "fraud_report_day": q_fraud_report_day,
    "load_per_target": q_load_per_target,
    "tx_from_text": q_tx_from_text,
}

SQL = {
    "delta_filter": SQL_DELTA_FILTER,
    "watermark_advance": SQL_WATERMARK_ADVANCE,
    "watermark_seed": SQL_WATERMARK_SEED,
    "batch_discovery": SQL_BATCH_DISCOVERY,
    "load_gate": SQL_LOAD_GATE,
    "present_keys_delta": SQL_PRESENT_DELTA,
    "present_keys_snapshot": SQL_PRESENT_SNAPSHOT,
    "append_absent_tx": SQL_APPEND_TX,
    "append_absent_blacklist": SQL_APPEND_BL,
    "append_absent_blacklist_dedup": SQL_APPEND_BL_DEDUP,
    "fraud_report_day": SQL_FRAUD_REPORT_DAY,
    "load_per_target": SQL_LOAD_PER_TARGET,
    "tx_from_text": fx.transactions_sql(),
}
