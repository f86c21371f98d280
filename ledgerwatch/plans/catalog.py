"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the driver's tables (through the fixture mapping) in full;
nothing is sampled or capped. Column names and types match the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.operators import fraud as fr
from ledgerwatch.operators import scd2
from ledgerwatch.operators.temporal import valid_at_join
from ledgerwatch.plans import fixtures as fx
from ledgerwatch.plans import load_queries
from ledgerwatch.plans import oracle as orc

Query = Callable[[SparkSession, str], DataFrame]

CARD_MOD_RULES34 = 10        # rules 3 and 4: card = user_id % 10 (too sparse per user)
RULE4_WIDE_WINDOW = 7200     # rule 4 variant with a wider look-back
PURCHASE_ONLY = ("purchase",)


# ---- fraud -------------------------------------------------------------------

def _candidates(spark, sf, *, card_mod=None, success=fx.SUCCESS_TYPES, **rule_kw) -> DataFrame:
    tx = fx.transactions(spark, sf, card_mod, success)
    dims = fx.static_dims(spark, sf)
    flagged = fr.flag_transactions(tx, dims["terminals"], **rule_kw)
    return fr.enrich_candidates(flagged, dims["cards"], dims["accounts"], dims["clients"])


def q_candidates(spark, sf):
    return _candidates(spark, sf, rules=()).drop("city_hop", "amount_guess")


def q_rule1(spark, sf):
    return fr.passport_rule(_candidates(spark, sf, rules=()), fx.blacklist_static(spark, sf))


def q_rule2(spark, sf):
    return fr.account_rule(_candidates(spark, sf, rules=()))


def q_rule3(spark, sf):
    return fr.city_hop_rule(_candidates(spark, sf, card_mod=CARD_MOD_RULES34, rules=(3,)))


def q_rule4(spark, sf):
    return fr.amount_guess_rule(_candidates(spark, sf, card_mod=CARD_MOD_RULES34, success=PURCHASE_ONLY,
                                            guess_window=RULE4_WIDE_WINDOW, rules=(4,)))


def q_rule4_native(spark, sf):
    return fr.amount_guess_rule(_candidates(spark, sf, card_mod=1, rules=(4,)))


def q_rule3_flagged(spark, sf):
    """Ids of successful transactions flagged by rule 3 (the bare flag pass)."""
    tx = fx.transactions(spark, sf, CARD_MOD_RULES34)
    flagged = fr.flag_transactions(tx, fx.terminals_static(spark, sf), rules=(3,))
    return flagged.where("city_hop").select("trans_id")


def q_rule4_flagged(spark, sf):
    """Ids of successful transactions flagged by rule 4, 7200 s, purchase only."""
    tx = fx.transactions(spark, sf, CARD_MOD_RULES34, PURCHASE_ONLY)
    flagged = fr.flag_transactions(tx, None, guess_window=RULE4_WIDE_WINDOW, rules=(4,))
    return flagged.where("amount_guess").select("trans_id")


# Bursts: the events of the ten cards folded into one minute (rule 3), and into half a day (both rules).
MINUTE, HALF_DAY = 60, 43200
BURST = {"hot_rows": 100}


def folded(tx: DataFrame, seconds: int) -> DataFrame:
    at = F.expr(f"timestampadd(SECOND, cast(unix_seconds(cast(trans_date AS timestamp)) % {seconds} AS int), "
                "timestamp_ntz'2024-03-01 11:59:30')")
    return tx.withColumn("trans_date", at)


def folded_sql(tx_sql: str, seconds: int) -> str:
    return (f"select * replace (timestamp '2024-03-01 11:59:30' + to_seconds(cast(epoch(trans_date) as bigint) % {seconds}) "
            f"as trans_date) from ({tx_sql})")


def q_rule3_burst_minute(spark, sf):
    """Rule 3, 2 s look-back, where all rows of a card lie inside one minute: every bucket is hot."""
    tx = folded(fx.transactions(spark, sf, 1000), MINUTE)
    flagged = fr.flag_transactions(tx, fx.terminals_static(spark, sf), rules=(3,), city_window=2, hot_rows=5)
    return flagged.where("city_hop").select("trans_id")


def q_rules34_burst_half_day(spark, sf):
    """Both rules where all rows of a card lie inside one bucket of half a day; hot and cold buckets mix."""
    tx = folded(fx.transactions(spark, sf, CARD_MOD_RULES34, PURCHASE_ONLY), HALF_DAY)
    flagged = fr.flag_transactions(tx, fx.terminals_static(spark, sf), city_window=600, guess_window=1200, **BURST)
    return flagged.where("city_hop OR amount_guess").select("trans_id", "city_hop", "amount_guess")


def q_report(spark, sf):
    tx = fx.transactions(spark, sf)
    d = fx.static_dims(spark, sf)
    return fr.build_report(tx, d["terminals"], d["cards"], d["accounts"], d["clients"], d["blacklist"])


def q_report_rules34(spark, sf):
    """Whole report with the rule 3/4 card mapping (all four rules fire)."""
    tx = fx.transactions(spark, sf, CARD_MOD_RULES34)
    d = fx.static_dims(spark, sf)
    return fr.build_report(tx, d["terminals"], d["cards"], d["accounts"], d["clients"], d["blacklist"])


def blacklist_with_repeats(spark, sf) -> DataFrame:
    """The static blacklist plus repeated entries: every third passport again
    with the same date, every fourth again five days later (Q12)."""
    bl = fx.blacklist_static(spark, sf)
    k = F.substring("passport_num", 2, 20).cast("bigint")
    again = bl.where(k % 3 == 0)
    later = bl.where(k % 4 == 0).select("passport_num", F.date_add("entry_dt", 5).alias("entry_dt"))
    return bl.unionByName(again).unionByName(later)


BLACKLIST_REPEATS_SQL = f"""select * from ({fx.BLACKLIST_STATIC_SQL})
      union all select * from ({fx.BLACKLIST_STATIC_SQL}) where cast(substring(passport_num, 2, 20) as bigint) % 3 = 0
      union all select passport_num, entry_dt + 5 from ({fx.BLACKLIST_STATIC_SQL})
        where cast(substring(passport_num, 2, 20) as bigint) % 4 = 0"""


def q_report_blacklist_repeats(spark, sf):
    tx = fx.transactions(spark, sf)
    d = fx.static_dims(spark, sf)
    return fr.build_report(tx, d["terminals"], d["cards"], d["accounts"], d["clients"],
                           blacklist_with_repeats(spark, sf))


def q_tx_typed(spark, sf):
    return fx.transactions(spark, sf)


def q_valid_at_cards(spark, sf):
    tx = fx.transactions(spark, sf)
    j = valid_at_join(tx, fx.cards_static(spark, sf), fact_key="card_num", dim_key="card_num",
                      at="trans_date", select={"account_num": "account_num"})
    return j.select("trans_id", "trans_date", "card_num", "account_num")


def q_valid_at_accounts(spark, sf):
    tx = fx.transactions(spark, sf)
    j = valid_at_join(tx, fx.cards_static(spark, sf), fact_key="card_num", dim_key="card_num",
                      at="trans_date", select={"account_num": "account_num"})
    j = valid_at_join(j, fx.accounts_static(spark, sf), fact_key="account_num", dim_key="account_num",
                      at="trans_date", select={"valid_to": "valid_to", "client": "client",
                                               "deleted_flg": "acc_deleted_flg"}, live_only=False)
    return j.select("trans_id", "account_num", "valid_to", "client", "acc_deleted_flg")


def q_valid_at_clients(spark, sf):
    tx = fx.transactions(spark, sf)
    c = fx.clients_static(spark, sf)
    j = valid_at_join(tx, c, fact_key="card_num", dim_key="client_id", at="trans_date",
                      select={"passport_num": "passport_num", "phone": "phone"})
    return j.select("trans_id", "card_num", "passport_num", "phone")


def _terminal_hist2(spark, sf) -> DataFrame:
    h1 = scd2.apply_preset("terminals", None, fx.terminal_source(spark, sf, 1), batch_dt=fx.BATCH_DAYS[0])
    return scd2.apply_preset("terminals", h1, fx.terminal_source(spark, sf, 2), batch_dt=fx.BATCH_DAYS[1],
                             since=fx.BATCH_DAYS[0])


def q_valid_at_terminals(spark, sf):
    """Point-in-time join against a two-batch SCD2 history (gap day included)."""
    tx = fx.transactions(spark, sf)
    j = valid_at_join(tx, _terminal_hist2(spark, sf), fact_key="terminal", dim_key="terminal_id",
                      at="trans_date", select={"terminal_city": "terminal_city",
                                               "effective_from": "version_from"})
    return j.select("trans_id", "trans_date", "terminal", "terminal_city", "version_from")


# ---- SCD2 --------------------------------------------------------------------

def _supplier_apply(hist, snap, day, since=None):
    return scd2.scd2_apply(hist, snap, key="s_suppkey", attrs=["s_nationkey"], batch_dt=fx.BATCH_DAYS[day - 1],
                           since=since)


def q_scd2_new(spark, sf):
    return _supplier_apply(None, fx.supplier_snapshot(spark, sf, 1), 1)


def q_scd2_changed(spark, sf):
    h1 = _supplier_apply(None, fx.supplier_snapshot(spark, sf, 1), 1)
    return _supplier_apply(h1, fx.supplier_snapshot(spark, sf, 2, keys_of=1), 2)


def q_scd2_deleted(spark, sf):
    h1 = _supplier_apply(None, fx.supplier_snapshot(spark, sf, 1), 1)
    return _supplier_apply(h1, fx.supplier_snapshot(spark, sf, 1, keys_of=2), 2)


def q_scd2_three_batches(spark, sf):
    h = None
    for day in (1, 2, 3):
        h = _supplier_apply(h, fx.supplier_snapshot(spark, sf, day), day)
    return h


def preset_history(spark, sf, name: str, source, **overrides) -> DataFrame:
    """Two batches of a dimension source through its SCD2 preset."""
    s1 = scd2.prepare_source(name, source(spark, sf, 1), fx.BATCH_DAYS[0])
    h1 = scd2.apply_preset(name, None, s1, batch_dt=fx.BATCH_DAYS[0], **overrides)
    s2 = scd2.prepare_source(name, source(spark, sf, 2), fx.BATCH_DAYS[1])
    since = scd2.delta_watermark(s1)
    return scd2.apply_preset(name, h1, s2, batch_dt=fx.BATCH_DAYS[1], since=since, **overrides)


def q_scd2_cards_snapshot_scope(spark, sf):
    """Cards preset with present keys from the whole snapshot (Q3 fixed): rows
    with an old update_dt are no longer tombstoned."""
    return preset_history(spark, sf, "cards", fx.card_source, delete_scope="snapshot")


def q_rule3_flagged_with_current(spark, sf):
    """Rule 3 counting the current operation's own city too (Q9 fixed)."""
    tx = fx.transactions(spark, sf, CARD_MOD_RULES34)
    flagged = fr.flag_transactions(tx, fx.terminals_static(spark, sf), rules=(3,), include_current=True)
    return flagged.where("city_hop").select("trans_id")


def _preset_two_batches(name: str, source) -> Query:
    def q(spark, sf):
        return preset_history(spark, sf, name, source)
    return q


SOURCES = {"terminals": fx.terminal_source, "cards": fx.card_source, "accounts": fx.account_source,
           "clients": fx.client_source}
SOURCES_SQL = {"terminals": fx.terminal_source_sql, "cards": fx.card_source_sql,
               "accounts": fx.account_source_sql, "clients": fx.client_source_sql}


def q_report_history(spark, sf):
    """Whole report over dimensions built by the SCD2 presets (several versions
    per key, the uncovered day after a close, tombstones)."""
    d = {n: preset_history(spark, sf, n, src) for n, src in SOURCES.items()}
    return fr.build_report(fx.transactions(spark, sf), d["terminals"], d["cards"], d["accounts"],
                           d["clients"], fx.blacklist_static(spark, sf))


def with_repeated_ids(tx: DataFrame) -> DataFrame:
    """Transactions plus repeats of ids: every seventh row once more as it is, every fifth one again 20 minutes
    later at another terminal for another amount, and every eleventh one again without an id."""
    k = F.col("trans_id").cast("bigint")
    later = tx.where(k % 5 == 0).withColumn("trans_date", F.col("trans_date") + F.expr("INTERVAL 20 MINUTES")) \
        .withColumn("terminal", ((F.col("terminal").cast("int") + 7) % fx.TERMINAL_MOD).cast("string")) \
        .withColumn("amt", (F.col("amt") / 2).cast("decimal(12,2)"))
    nameless = tx.where(k % 11 == 0).withColumn("trans_id", F.lit(None).cast("string"))
    return tx.unionByName(tx.where(k % 7 == 0)).unionByName(later).unionByName(nameless)


def repeated_ids_sql(tx_sql: str) -> str:
    k = "cast(trans_id as bigint)"
    return f"""select * from ({tx_sql})
      union all select * from ({tx_sql}) where {k} % 7 = 0
      union all select trans_id, trans_date + interval 20 minute, card_num, oper_type, cast(amt / 2 as decimal(12,2)),
          oper_result, cast((cast(terminal as integer) + 7) % {fx.TERMINAL_MOD} as varchar)
        from ({tx_sql}) where {k} % 5 = 0
      union all select null, trans_date, card_num, oper_type, amt, oper_result, terminal from ({tx_sql}) where {k} % 11 = 0"""


def q_report_repeated_ids(spark, sf):
    """Whole report where ids repeat: rules 3 and 4 judge an id by all its rows of a day together."""
    tx = with_repeated_ids(fx.transactions(spark, sf, CARD_MOD_RULES34))
    d = fx.static_dims(spark, sf)
    return fr.build_report(tx, d["terminals"], d["cards"], d["accounts"], d["clients"], d["blacklist"],
                           repeated_ids=True)


QUERIES: dict[str, Query] = {
    "tx_typed": q_tx_typed,
    "valid_at_cards": q_valid_at_cards,
    "valid_at_accounts": q_valid_at_accounts,
    "valid_at_clients": q_valid_at_clients,
    "valid_at_terminals": q_valid_at_terminals,
    "candidates": q_candidates,
    "rule1_passport": q_rule1,
    "rule2_account": q_rule2,
    "rule3_city_hop": q_rule3,
    "rule4_amount_guess": q_rule4,
    "rule4_amount_guess_native": q_rule4_native,
    "rule3_flagged": q_rule3_flagged,
    "rule4_flagged": q_rule4_flagged,
    "rule3_burst_minute": q_rule3_burst_minute,
    "rules34_burst_half_day": q_rules34_burst_half_day,
    "fraud_report": q_report,
    "fraud_report_rules34": q_report_rules34,
    "scd2_new": q_scd2_new,
    "scd2_changed": q_scd2_changed,
    "scd2_deleted": q_scd2_deleted,
    "scd2_three_batches": q_scd2_three_batches,
    "scd2_terminals": _preset_two_batches("terminals", fx.terminal_source),
    "scd2_cards": _preset_two_batches("cards", fx.card_source),
    "scd2_accounts": _preset_two_batches("accounts", fx.account_source),
    "scd2_clients": _preset_two_batches("clients", fx.client_source),
    "fraud_report_history": q_report_history,
    "scd2_cards_snapshot_scope": q_scd2_cards_snapshot_scope,
    "rule3_flagged_with_current": q_rule3_flagged_with_current,
    "fraud_report_blacklist_repeats": q_report_blacklist_repeats,
    "fraud_report_repeated_ids": q_report_repeated_ids,
}


# ---- oracle SQL ----------------------------------------------------------------

def _sql_fraud():
    cand_cols = ("select trans_id, event_dt, report_dt, passport, fio, phone, passport_valid_to, "
                 "acc_valid_to, acc_deleted_flg from cand")
    out = {
        "candidates": orc.fraud_query_sql(cand_cols),
        "rule1_passport": orc.fraud_query_sql(orc.rule_sql(1)),
        "rule2_account": orc.fraud_query_sql(orc.rule_sql(2)),
        "rule3_city_hop": orc.fraud_query_sql(orc.rule_sql(3), card_mod=CARD_MOD_RULES34),
        "rule4_amount_guess": orc.fraud_query_sql(orc.rule_sql(4, window=RULE4_WIDE_WINDOW),
                                                  card_mod=CARD_MOD_RULES34, success_types=PURCHASE_ONLY),
        "rule4_amount_guess_native": orc.fraud_query_sql(orc.rule_sql(4), card_mod=1),
        "rule3_flagged": orc.with_ctes(orc.fraud_ctes(card_mod=CARD_MOD_RULES34),
                                       orc.flagged_ids_sql(orc.rule3_days_sql())),
        "rule4_flagged": orc.with_ctes(orc.fraud_ctes(card_mod=CARD_MOD_RULES34, success_types=PURCHASE_ONLY),
                                       orc.flagged_ids_sql(orc.rule4_days_sql(RULE4_WIDE_WINDOW))),
        "fraud_report": orc.report_sql(),
        "fraud_report_rules34": orc.report_sql(card_mod=CARD_MOD_RULES34),
        "fraud_report_blacklist_repeats": orc.report_sql(blacklist_sql=BLACKLIST_REPEATS_SQL),
        "tx_typed": fx.transactions_sql(),
    }
    minute = orc.fraud_ctes(card_mod=1000)
    minute["tx"] = folded_sql(minute["tx"], MINUTE)
    out["rule3_burst_minute"] = orc.with_ctes(minute, orc.flagged_ids_sql(orc.rule3_days_sql(2)))
    half = orc.fraud_ctes(card_mod=CARD_MOD_RULES34, success_types=PURCHASE_ONLY)
    half["tx"] = folded_sql(half["tx"], HALF_DAY)
    half["hops"], half["guesses"] = orc.rule3_days_sql(600), orc.rule4_days_sql(1200)
    out["rules34_burst_half_day"] = orc.with_ctes(half, """select trans_id, h.trans_id is not null as city_hop,
        g.trans_id is not null as amount_guess
      from (select distinct trans_id from hops) h full join (select distinct trans_id from guesses) g using (trans_id)""")
    repeated = orc.fraud_ctes(card_mod=CARD_MOD_RULES34)
    repeated["tx"] = repeated_ids_sql(repeated["tx"])
    repeated["cand"] = orc.CANDIDATES_SQL
    out["fraud_report_repeated_ids"] = orc.with_ctes(repeated, "\nunion all\n".join(orc.rule_sql(n) for n in (1, 2, 3, 4)))
    ctes = orc.fraud_ctes()
    out["valid_at_cards"] = orc.with_ctes(ctes, """select t.trans_id, t.trans_date, t.card_num, cd.account_num
      from tx t left join cards cd on t.card_num = cd.card_num and cd.deleted_flg = 'N'
        and t.trans_date between cd.effective_from and cd.effective_to""")
    out["valid_at_accounts"] = orc.with_ctes(ctes, """select t.trans_id, cd.account_num, a.valid_to, a.client,
        a.deleted_flg as acc_deleted_flg
      from tx t left join cards cd on t.card_num = cd.card_num and cd.deleted_flg = 'N'
        and t.trans_date between cd.effective_from and cd.effective_to
      left join accounts a on cd.account_num = a.account_num
        and t.trans_date between a.effective_from and a.effective_to""")
    out["valid_at_clients"] = orc.with_ctes(ctes, """select t.trans_id, t.card_num, c.passport_num, c.phone
      from tx t left join clients c on t.card_num = c.client_id and c.deleted_flg = 'N'
        and t.trans_date between c.effective_from and c.effective_to""")
    return out


def _sql_scd2():
    key, attrs = "s_suppkey", ["s_nationkey"]
    d = [x.isoformat() for x in fx.BATCH_DAYS]

    def step(hist, snap, day):
        return orc.scd2_step_sql(hist, snap, key=key, attrs=attrs, batch_dt=d[day - 1])

    snaps = {f"snap{i}": fx.supplier_snapshot_sql(i) for i in (1, 2, 3)}
    snaps["snap2k1"] = fx.supplier_snapshot_sql(2, keys_of=1)
    snaps["snap1k2"] = fx.supplier_snapshot_sql(1, keys_of=2)
    h0 = orc.empty_hist_sql("snap1", key, attrs)
    base = dict(snaps)
    base["h1"] = "select * from " + step(h0, "snap1", 1)
    out = {"scd2_new": orc.with_ctes(base, "select * from h1")}
    out["scd2_changed"] = orc.with_ctes(base, "select * from " + step("h1", "snap2k1", 2))
    out["scd2_deleted"] = orc.with_ctes(base, "select * from " + step("h1", "snap1k2", 2))
    chain = dict(base)
    chain["h2"] = "select * from " + step("h1", "snap2", 2)
    chain["h3"] = "select * from " + step("h2", "snap3", 3)
    out["scd2_three_batches"] = orc.with_ctes(chain, "select * from h3")

    hist_ctes = {}
    for name, src in SOURCES_SQL.items():
        ctes = _sql_preset_ctes(name, src, d)
        out[f"scd2_{name}"] = orc.with_ctes(ctes, f"select * from {name}_h2")
        hist_ctes.update(ctes)
    rep = orc.fraud_ctes()
    for name in SOURCES_SQL:
        rep[name] = f"select * from {name}_h2"
    rep["cand"] = orc.CANDIDATES_SQL
    body = "\nunion all\n".join(orc.rule_sql(n) for n in (1, 2, 3, 4))
    out["fraud_report_history"] = orc.with_ctes({**hist_ctes, **rep}, body)
    out["scd2_cards_snapshot_scope"] = orc.with_ctes(
        _sql_preset_ctes("cards", fx.card_source_sql, d, delete_scope="snapshot"), "select * from cards_h2")
    out["rule3_flagged_with_current"] = orc.with_ctes(orc.fraud_ctes(card_mod=CARD_MOD_RULES34),
                                                      orc.flagged_ids_sql(orc.rule3_days_sql(include_current=True)))
    d_ = d
    ctes = orc.fraud_ctes()
    ctes["src1"] = fx.terminal_source_sql(1)
    ctes["src2"] = fx.terminal_source_sql(2)
    p = orc.PRESETS["terminals"]
    ctes["th1"] = "select * from " + orc.scd2_step_sql(
        orc.empty_hist_sql("src1", p["key"], p["attrs"]), "src1", key=p["key"], attrs=p["attrs"],
        batch_dt=d_[0], start_col=p["start_col"], delete_scope=p["delete_scope"],
        compare_start=p["compare_start"])
    ctes["th2"] = "select * from " + orc.scd2_step_sql(
        "th1", "src2", key=p["key"], attrs=p["attrs"], batch_dt=d_[1], start_col=p["start_col"],
        since=f"date '{d_[0]}'", delete_scope=p["delete_scope"], compare_start=p["compare_start"])
    out["valid_at_terminals"] = orc.with_ctes(ctes, """select t.trans_id, t.trans_date, t.terminal,
        h.terminal_city, h.effective_from as version_from
      from tx t left join th2 h on t.terminal = h.terminal_id and h.deleted_flg = 'N'
        and t.trans_date between h.effective_from and h.effective_to""")
    return out


def _sql_preset_ctes(name, src_sql, d, **overrides) -> dict[str, str]:
    """CTEs ``<name>_raw1.. <name>_h2``: two batches of a preset in SQL."""
    p = {**orc.PRESETS[name], **overrides}
    key, attrs = p["key"], p["attrs"]
    ctes = {}
    for day in (1, 2):
        ctes[f"{name}_raw{day}"] = src_sql(day)
        trim = f"trim({key}) as {key}" if p.get("trim_key") else key
        others = ", ".join(c for c in [*attrs, *([p["start_col"]] if p["start_col"] else [])])
        ctes[f"{name}_src{day}"] = (f"select {trim}, {others}, coalesce(update_dt, date '{d[day - 1]}') "
                                    f"as update_dt from {name}_raw{day}")
    kw = dict(key=key, attrs=attrs, start_col=p["start_col"], delete_scope=p["delete_scope"],
              compare_start=p["compare_start"])
    ctes[f"{name}_h1"] = "select * from " + orc.scd2_step_sql(
        orc.empty_hist_sql(f"{name}_src1", key, attrs), f"{name}_src1", batch_dt=d[0],
        since="date '1900-01-01'", **kw)
    # watermark after batch 1: max update_dt of its delta (all rows of batch 1)
    ctes[f"{name}_h2"] = "select * from " + orc.scd2_step_sql(
        f"{name}_h1", f"{name}_src2", batch_dt=d[1], since=f"(select max(update_dt) from {name}_src1)", **kw)
    return ctes


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(_sql_fraud())
    out.update(_sql_scd2())
    out.update(load_queries.SQL)
    return out


QUERIES.update(load_queries.QUERIES)
