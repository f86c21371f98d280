"""DuckDB oracle SQL for the registered queries.

The fraud rules are stated from their descriptions, apart from the Spark
operators: rule 3 as the least and greatest city of a look-back frame, rule 4
as conditions on the ordered list of the earlier operations. An id that occurs
more than once on a day is judged by the look-backs of all its rows together.
SCD2 is one SELECT per batch. Nothing is taken from the code under test.
"""

from __future__ import annotations

from ledgerwatch.plans import fixtures as fx

OPEN = "timestamp '9999-12-31 00:00:00'"


def with_ctes(ctes: dict[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n" + body


def fraud_ctes(card_mod=None, success_types=fx.SUCCESS_TYPES, terminals_sql=None,
               blacklist_sql=None) -> dict[str, str]:
    c = {"tx": fx.transactions_sql(card_mod, success_types)}
    c.update({"terminals": terminals_sql or fx.TERMINALS_STATIC_SQL, "cards": fx.CARDS_STATIC_SQL,
              "accounts": fx.ACCOUNTS_STATIC_SQL, "clients": fx.CLIENTS_STATIC_SQL,
              "blacklist": blacklist_sql or fx.BLACKLIST_STATIC_SQL})
    return c


def _at(alias: str, time: str) -> str:
    """The version of ``alias`` that holds at ``time`` (both ends included)."""
    return f"{time} >= {alias}.effective_from and {time} <= {alias}.effective_to"


CANDIDATES_SQL = f"""with paid as (select trans_id, card_num, trans_date as event_dt, cast(trans_date as date) as report_dt
                from tx where oper_result = 'SUCCESS'),
      carded as (select p.*, v.account_num from paid p
                 left join (select * from cards where deleted_flg = 'N') v
                   on v.card_num = p.card_num and {_at('v', 'p.event_dt')}),
      booked as (select c.*, v.client, v.valid_to as acc_valid_to, v.deleted_flg as acc_deleted_flg from carded c
                 left join accounts v on v.account_num = c.account_num and {_at('v', 'c.event_dt')})
      select b.trans_id, b.event_dt, b.report_dt, v.passport_num as passport,
        rtrim(coalesce(v.last_name, '') || ' ' || coalesce(v.first_name, '') || ' ' || coalesce(v.patronymic, '')) as fio,
        v.phone, v.passport_valid_to, b.acc_valid_to, b.acc_deleted_flg
      from booked b
      left join (select * from clients where deleted_flg = 'N') v
        on v.client_id = b.client and {_at('v', 'b.event_dt')}"""


def _event(n: int) -> str:
    return f"select event_dt, passport, fio, phone, cast({n} as smallint) as event_type, report_dt"


# every matching blacklist row counts; an expired passport counts once if no row matches
RULE1_SQL = f"""{_event(1)} from cand
        join blacklist on passport_num = passport and entry_dt <= report_dt
      union all
      {_event(1)} from cand
        where passport_valid_to < report_dt and not exists (
          select 1 from blacklist where passport_num = cand.passport and entry_dt <= cand.report_dt)"""

RULE2_SQL = f"{_event(2)} from cand where acc_deleted_flg = 'Y' or acc_valid_to < report_dt"

ATTEMPTS = 3


def rule3_days_sql(window: int = 3600, include_current: bool = False) -> str:
    """(trans_id, day) of successful operations whose look-back visits two cities."""
    least, most = ("least(first_city, city)", "greatest(last_city, city)") if include_current \
        else ("first_city", "last_city")
    return f"""select trans_id, day from (
        select trans_id, day, city, min(city) over near as first_city, max(city) over near as last_city
        from (select t.trans_id, t.card_num, cast(t.trans_date as date) as day,
                     cast(epoch(t.trans_date) as bigint) as sec, v.terminal_city as city
              from tx t left join (select * from terminals where deleted_flg = 'N') v
                on v.terminal_id = t.terminal and {_at('v', 't.trans_date')}
              where t.oper_result = 'SUCCESS' and t.card_num is not null)
        window near as (partition by card_num order by sec range between {window} preceding and 1 preceding))
      where trans_id is not null
      group by trans_id, day having min({least}) < max({most})"""


def rule4_days_sql(window: int = 1200) -> str:
    """(trans_id, day) of successful operations after at least three attempts: the latest three all failed,
    each above the paid amount and below the attempt before it."""
    return f"""select trans_id, day from (
        select trans_id, day, list_reverse_sort(flatten(list(tries))) as tries from (
          select trans_id, day, oper_result, [struct_pack(sec := e.sec, id := e.id, amt := e.amt, res := e.res,
                                                          own := amt) for e in coalesce(before, [])] as tries
          from (select trans_id, cast(trans_date as date) as day, amt, oper_result, list(
                  struct_pack(sec := cast(epoch(trans_date) as bigint), id := trans_id, amt := amt, res := oper_result))
                  over (partition by card_num order by cast(epoch(trans_date) as bigint)
                        range between {window} preceding and 1 preceding) as before
                from tx where card_num is not null))
        where oper_result = 'SUCCESS' and trans_id is not null
        group by trans_id, day)
      where len(tries) >= {ATTEMPTS} and len([j for j in range(1, {ATTEMPTS + 1}) if len([k for k in range(1, {ATTEMPTS + 1})
        if tries[k].own = tries[j].own and (tries[k].res = 'SUCCESS' or tries[k].amt <= tries[k].own
           or coalesce(tries[k + 1].amt, tries[k].amt + 1) <= tries[k].amt)]) = 0
        and len([k for k in range(1, {ATTEMPTS + 1}) if tries[k].own = tries[j].own and tries[k].amt > tries[k].own]) > 0]) > 0"""


def flagged_ids_sql(days_sql: str) -> str:
    return f"select distinct trans_id from ({days_sql})"


def rule_sql(n: int, **kw) -> str:
    if n == 1:
        return RULE1_SQL
    if n == 2:
        return RULE2_SQL
    days = rule3_days_sql(kw.get("window", 3600)) if n == 3 else rule4_days_sql(kw.get("window", 1200))
    return f"{_event(n)} from cand semi join ({days}) f on f.trans_id = cand.trans_id and f.day = cand.report_dt"


def fraud_query_sql(body: str, **ctes_kw) -> str:
    ctes = fraud_ctes(**ctes_kw)
    ctes["cand"] = CANDIDATES_SQL
    return with_ctes(ctes, body)


def report_sql(**ctes_kw) -> str:
    body = "\nunion all\n".join(rule_sql(n) for n in (1, 2, 3, 4))
    return fraud_query_sql(body, **ctes_kw)


# ---- SCD2 ------------------------------------------------------------------

def scd2_step_sql(hist: str, snap: str, *, key: str, attrs: list[str], batch_dt: str,
                  start_col: str | None = None, since: str | None = None,
                  delete_scope: str = "snapshot", compare_start: bool = False) -> str:
    """One batch as one SELECT.

    ``hist`` and ``snap`` are relation names; ``since`` an SQL expression of
    the watermark (None: every row is in the delta).
    """
    a_cols = ", ".join(attrs)
    h_attrs = ", ".join(f"h.{a}" for a in attrs)
    s_attrs = ", ".join(f"s.{a}" for a in attrs)
    differ = " or ".join(f"s.{a} is distinct from h.{a}" for a in attrs)
    if compare_start:
        differ += f" or cast(s.{start_col} as timestamp) is distinct from h.effective_from"
    delta = f"(select * from {snap} where update_dt > {since})" if since else f"(select * from {snap})"
    present = delta if delete_scope == "delta" else snap
    start = f"cast(s.{start_col} as timestamp)" if start_col else "cast(s.update_dt as timestamp)"
    live = f"h.effective_to = {OPEN} and h.deleted_flg = 'N'"
    bd = f"date '{batch_dt}'"
    return f"""(
      with stg as {delta},
      del_keys as (select h.{key} from {hist} h where {live} and h.{key} is not null
                   and not exists (select 1 from {present} p where p.{key} = h.{key})),
      chg as (select s.*, h.effective_from as old_from from stg s join {hist} h on s.{key} = h.{key}
              where {live} and ({differ}))
      select h.{key}, {h_attrs}, h.effective_from,
        case when c.{key} is not null then cast(c.update_dt - interval 1 day as timestamp)
             when d.{key} is not null then cast({bd} - interval 1 day as timestamp)
             else h.effective_to end as effective_to,
        h.deleted_flg
      from {hist} h
      left join chg c on h.{key} = c.{key} and {live}
      left join del_keys d on h.{key} = d.{key} and {live}
      union all
      select s.{key}, {s_attrs}, {start}, {OPEN}, 'N' from stg s
        where not exists (select 1 from {hist} h where h.{key} = s.{key})
      union all
      select s.{key}, {s_attrs}, cast(s.update_dt as timestamp), {OPEN}, 'N' from chg s
      union all
      select h.{key}, {h_attrs}, cast({bd} as timestamp), {OPEN}, 'Y' from {hist} h
        join del_keys d on h.{key} = d.{key} where {live}
    )"""


def empty_hist_sql(snap: str, key: str, attrs: list[str]) -> str:
    return (f"(select {key}, {', '.join(attrs)}, {OPEN} as effective_from, {OPEN} as effective_to, "
            f"'N' as deleted_flg from {snap} where false)")


# The dimension presets and file names, written out here so that a wrong preset or pattern cannot pass.
PRESETS = {
    "terminals": {"key": "terminal_id", "attrs": ["terminal_type", "terminal_city", "terminal_address"],
                  "start_col": None, "compare_start": False, "delete_scope": "delta"},
    "cards": {"key": "card_num", "attrs": ["account_num"], "start_col": "create_dt", "compare_start": True,
              "delete_scope": "delta", "trim_key": True},
    "accounts": {"key": "account_num", "attrs": ["valid_to", "client"], "start_col": "create_dt",
                 "compare_start": True, "delete_scope": "delta"},
    "clients": {"key": "client_id", "attrs": ["last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                                              "passport_valid_to", "phone"],
                "start_col": "create_dt", "compare_start": True, "delete_scope": "delta"},
}
FAMILIES = ["transactions", "terminals", "passport_blacklist"]
BATCH_FILE = r"^(transactions|terminals|passport_blacklist)_([0-9]{8})[.][A-Za-z0-9]+$"
