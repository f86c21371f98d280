"""Fraud rules and the daily fraud report.

Rules (event_type):
  1  passport blacklisted (entry on or before the report day) or expired
  2  account expired or deleted
  3  prior successful operations of the card within the last hour (1..3600 s
     back, the current one excluded) at terminals in more than one city
  4  amount guessing: at least three operations within 1..1200 s back, the
     latest three all unsuccessful with strictly falling amounts (the oldest
     of the three compared with the operation before it, when that one is in
     the look-back too), and all of them above the successful amount

Rules 3 and 4 in the original are self joins of the transaction table on the
card with a time-difference range, i.e. quadratic per card. Here both are one
window pass per (card, time bucket) with running frames only, O(n) per row
and exact:

* rule 3: for every row x, ``diff(x)`` is the time of the latest earlier row
  whose (non-null) city differs from x's. A frame [t-N, t-1] holds two cities
  iff ``max(diff(x))`` over rows with ``time <= t-1`` is ``>= t-N``.
* rule 4: the latest three rows before t are the latest row r with
  ``time <= t-1`` and its row predecessors; a running ``max(struct(time, id,
  lags...))`` picks r together with the lagged values the rule needs.

What a row sees depends on its card and second alone. A window group with too
many rows (a burst, however narrow) is therefore reduced to one summary per
second, and the same carries run over the summaries (``_second_pass``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import SUCCESS, epoch_seconds, full_name, true_or_false
from ledgerwatch.operators.temporal import BUCKET, CONTEXT, hot_groups, lookback_buckets, salt_null_key, valid_at_join

CITY_WINDOW = 3600      # rule 3 look-back, seconds
GUESS_WINDOW = 1200     # rule 4 look-back, seconds
GUESS_ATTEMPTS = 3      # rule 4 number of declined attempts
HOT_ROWS = 2_000_000    # rows of a (card, time bucket) window partition before it is reduced to a summary per second
DAY_BUCKET = 86400      # default time bucket of the rule 3/4 window partitions, seconds

REPORT_COLS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]


def _day_start(d) -> Column:
    return F.lit(d).cast("date").cast("timestamp_ntz")


def flag_transactions(tx: DataFrame, terminals: DataFrame | None = None, *,
                      city_window: int = CITY_WINDOW, guess_window: int = GUESS_WINDOW,
                      attempts: int = GUESS_ATTEMPTS, bucket: int | None = None,
                      hot_rows: int | None = HOT_ROWS, rules: tuple[int, ...] = (3, 4),
                      include_current: bool = False, repeated_ids: bool = False,
                      report_from: dt.date | str | None = None,
                      report_to: dt.date | str | None = None) -> DataFrame:
    """Successful transactions of the report days with rule 3/4 flags.

    Output: trans_id, trans_date, card_num, amt, report_dt, city_hop, amount_guess.
    ``terminals`` (SCD2 history) is needed for rule 3; without it city_hop is
    false. ``rules`` selects the flags to compute (``()`` skips the window
    pass). Window partitions are (card, time bucket); one that would hold more
    than ``hot_rows`` rows is reduced to a summary per second first, so that no
    window sees more than ``max(hot_rows, bucket + look-back)`` rows of a group
    (``None`` turns the counting pass off). ``include_current`` also counts the
    current operation's own city in rule 3 (the original leaves it out; off by
    default for parity). ``repeated_ids`` judges an id that several successful
    rows of a day share by the look-backs of all of them together (rows without
    earlier operations add nothing); leave it off where ids are unique. A row
    without an id is never flagged. ``report_from``/``report_to`` (inclusive days) bound
    the scan to the report days plus the look-back, so a fact table stored by
    time is pruned.
    """
    do3, do4 = 3 in rules and terminals is not None, 4 in rules
    if not (do3 or do4):
        return _candidates_only(tx, report_from, report_to)
    lookback = max(city_window if do3 else 0, guess_window if do4 else 0)
    # one-day buckets by default: a wide bucket keeps window groups few and the
    # context copies at 4%; hot ones are reduced per second (hot_rows)
    bucket = bucket or max(DAY_BUCKET, 6 * lookback)
    t = tx.select("trans_id", "trans_date", "card_num", "amt", "oper_result", "terminal")
    if report_from is not None:
        t = t.where(F.col("trans_date") >= _day_start(report_from) - F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(lookback)))
    if report_to is not None:
        t = t.where(F.col("trans_date") < _day_start(report_to) + F.expr("INTERVAL 1 DAY"))
    ok = true_or_false(F.col("oper_result") == SUCCESS)
    t = t.select("*", epoch_seconds("trans_date").alias("__sec"), ok.alias("__ok"))
    base = t
    if do3:
        # every transaction looks up its terminal; Spark broadcasts the history if its bytes allow it
        t = valid_at_join(t, terminals, fact_key="terminal", dim_key="terminal_id",
                          at="trans_date", select={"terminal_city": "__city_raw"})
        city = F.when(F.col("__ok"), F.col("__city_raw"))
    else:
        city = F.lit(None).cast("string")
    valid = F.col("card_num").isNotNull() & F.col("__sec").isNotNull()
    t = t.select(*[c for c in t.columns if c != "__city_raw"], city.alias("__city"), valid.alias("__valid"))
    t = lookback_buckets(t, key="card_num", seconds="__sec", lookback=lookback, bucket=bucket, valid=F.col("__valid"))
    near = do3 and (include_current or repeated_ids)
    kw = dict(do3=do3, attempts=attempts if do4 else 0, near=near)
    if hot_rows:
        # counted from the card/time columns only, before the terminal join; bounded (see hot_groups)
        hot = F.broadcast(hot_groups(base, key="card_num", seconds="__sec", lookback=lookback, bucket=bucket,
                                     hot_rows=hot_rows))
        group = ["card_num", BUCKET]
        seen = _row_pass(t.join(hot, group, "left_anti"), **kw).unionByName(
            _second_pass(t.join(hot, group, "left_semi"), **kw))
    else:
        seen = _row_pass(t, **kw)

    city_hop, guess = "false", "false"
    if do3:
        city_hop = f"coalesce(__hop_since >= __sec - {city_window}, false)"
        if near:
            seen = seen.withColumn("__seen_city", F.expr(f"CASE WHEN __near.s >= __sec - {city_window} THEN __near.lo END"))
        if include_current:
            # one earlier city in the frame, or none, is left where city_hop is false
            city_hop += " OR coalesce(__seen_city <> __city, false)"
    if do4:
        def inside(k):
            return f"(__last.s{k} IS NOT NULL AND __last.s{k} >= __sec - {guess_window})"
        bad = []
        for k in range(attempts):
            prev = f"coalesce(CASE WHEN {inside(k + 1)} THEN __last.a{k + 1} END, __last.a{k} + 1)"
            bad += [f"coalesce(__last.o{k} = '{SUCCESS}', false)", f"coalesce({prev} - __last.a{k} <= 0, false)"]
        least = ", ".join(f"__last.a{k}" for k in range(attempts))
        guess = f"coalesce({inside(attempts - 1)} AND NOT ({' OR '.join(bad)}) AND least({least}) > amt, false)"

    named = "__valid AND trans_id IS NOT NULL"
    out = seen.withColumns({"report_dt": F.to_date("trans_date"), "city_hop": F.expr(f"{named} AND ({city_hop})"),
                            "amount_guess": F.expr(f"{named} AND ({guess})")})
    if report_from is not None:
        out = out.where(F.col("report_dt") >= F.lit(report_from).cast("date"))
    cols = ["trans_id", "trans_date", "card_num", "amt", "report_dt"]
    if not repeated_ids:
        return out.select(*cols, "city_hop", "amount_guess")
    paid = base.where(F.col("__ok") & F.col("trans_date").isNotNull() & F.col("trans_id").isNotNull())
    shared = paid.groupBy("trans_id", F.to_date("trans_date").alias("report_dt")).agg(
        F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    merged = _shared_id_flags(out.where("__valid"), shared, do3, include_current,
                              attempts if do4 else 0, guess_window)
    return out.join(merged, ["trans_id", "report_dt"], "left").select(
        *cols, F.coalesce("__hop", "city_hop").alias("city_hop"), F.coalesce("__guess", "amount_guess").alias("amount_guess"))


CARRIED = ["trans_id", "trans_date", "card_num", "amt", "__sec", "__city", "__valid"]


def _paid() -> Column:
    """Candidates among the rows of the window groups: successful, with a time (a null time has no report day)."""
    return ~F.col(CONTEXT) & F.col("__ok") & F.col("trans_date").isNotNull()


def _row_pass(t: DataFrame, *, do3: bool, attempts: int, near: bool) -> DataFrame:
    """The candidates with what their card did before, one window group per (card, bucket).

    Adds, as asked for, ``__hop_since`` (time of the latest earlier change of
    city), ``__near`` (the latest earlier second with a known city, with its
    least and greatest city) and ``__last`` (the latest ``attempts + 1`` earlier
    operations). "Earlier" is by at least one second.
    """
    # One window spec, in SQL form: the expressions below are parsed once each
    # on the JVM. All share partitioning and order, so they run on one
    # exchange and one sort.
    part = f"PARTITION BY card_num, {BUCKET}"
    rows_order = f"{part} ORDER BY __sec, trans_id, amt, oper_result"
    prior = f"OVER ({rows_order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    upto = f"OVER ({rows_order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    lagw = f"OVER ({rows_order})"
    before = f"OVER ({part} ORDER BY __sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    step1, after = [], []
    if attempts:   # rule 4: each row with its row predecessors 1..attempts
        fields = ["'s0', __sec", "'id0', trans_id", "'a0', amt", "'o0', oper_result"]
        for k in range(1, attempts + 1):
            fields += [f"'s{k}', lag(__sec, {k}) {lagw}", f"'id{k}', lag(trans_id, {k}) {lagw}",
                       f"'a{k}', lag(amt, {k}) {lagw}", f"'o{k}', lag(oper_result, {k}) {lagw}"]
        step1.append(f"named_struct({', '.join(fields)}) AS __row")
        after.append(f"max(__row) {before} AS __last")
    if do3:   # rule 3: latest earlier row with a different city, carried forward
        step1 += [f"last(__city, true) {prior} AS __pcity",
                  f"last(CASE WHEN __city IS NOT NULL THEN __sec END, true) {prior} AS __psec"]
    t = t.selectExpr("*", *step1)
    if do3:
        t = t.selectExpr("*", "last(CASE WHEN __city IS NOT NULL AND __pcity IS NOT NULL AND __city <> __pcity "
                              f"THEN __psec END, true) {upto} AS __diff")
        after.append(f"max(__diff) {before} AS __hop_since")
    if near:
        after.append("max(CASE WHEN __city IS NOT NULL THEN named_struct('s', __sec, 'id', trans_id, "
                     f"'lo', __city, 'hi', __city) END) {before} AS __near")
    t = t.selectExpr("*", *after).where(_paid())
    if near:
        t = t.withColumn("__near", F.expr("named_struct('s', __near.s, 'lo', __near.lo, 'hi', __near.hi)"))
    return t.select(*CARRIED, *_carries(do3, attempts, near))


def _carries(do3: bool, attempts: int, near: bool) -> list[str]:
    return [*(["__hop_since"] if do3 else []), *(["__near"] if near else []), *(["__last"] if attempts else [])]


def _second_pass(t: DataFrame, *, do3: bool, attempts: int, near: bool) -> DataFrame:
    """As ``_row_pass``, for groups with any number of rows: all rows of one second see the same earlier
    operations, so a second is reduced to its least and greatest city and its latest ``attempts + 1``
    operations, the carry runs over these summaries, and the candidates take it by (card, bucket, second).

    Both reductions start before their shuffle (partial aggregate, window group
    limit), so a second that holds every row costs a few rows a task. A window
    group has at most ``bucket + look-back`` summaries. The last join buffers
    one summary a key; a second with very many candidates only streams, and AQE
    splits it.
    """
    key = ["card_num", BUCKET, "__sec"]
    if attempts:
        latest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in ("trans_id", "amt", "oper_result")])
        tops = t.select(*key, "trans_id", "amt", "oper_result", F.row_number().over(latest).alias("__rank")) \
            .where(F.col("__rank") <= attempts + 1)
        at = tops.groupBy(*key).agg(F.sort_array(F.collect_list(F.expr(
            "named_struct('rank', __rank, 's', __sec, 'id', trans_id, 'a', amt, 'o', oper_result)"))).alias("__ops"))
        if do3:
            cities = t.where("__city IS NOT NULL").groupBy(*key).agg(F.min("__city").alias("__lo"),
                                                                     F.max("__city").alias("__hi"))
            at = at.join(cities, key, "left")
    else:
        at = t.where("__ok").groupBy(*key).agg(F.min("__city").alias("__lo"), F.max("__city").alias("__hi"))
    order = f"PARTITION BY card_num, {BUCKET} ORDER BY __sec"
    prior = f"OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    if do3:
        at = at.selectExpr("*", "last(CASE WHEN __lo IS NOT NULL THEN named_struct('s', __sec, 'lo', __lo, 'hi', __hi) "
                                f"END, true) {prior} AS __near")
        at = at.selectExpr("*", "CASE WHEN __lo < __hi THEN __sec WHEN __lo <> __near.lo OR __lo <> __near.hi "
                                "THEN __near.s END AS __change")
        at = at.selectExpr("*", f"last(__change, true) {prior} AS __hop_since")
    if attempts:
        lists = ", ".join(f"lag(__ops, {k}) OVER ({order})" for k in range(1, attempts + 2))
        at = at.selectExpr("*", f"flatten(filter(array({lists}), x -> x IS NOT NULL)) AS __past")
        fields = ", ".join(f"'{name}{k}', get(__past, {k}).{name}" for k in range(attempts + 1)
                           for name in ("s", "id", "a", "o"))
        at = at.withColumn("__last", F.expr(f"CASE WHEN size(__past) > 0 THEN named_struct({fields}) END"))
    carries = _carries(do3, attempts, near)
    return t.where(_paid()).join(at.select(*key, *carries), key).select(*CARRIED, *carries)


def _shared_id_flags(seen: DataFrame, shared: DataFrame, do3: bool, include_current: bool, attempts: int,
                     guess_window: int) -> DataFrame:
    """(trans_id, report_dt, __hop, __guess) of the ids in ``shared``, from the look-back summaries of their rows.

    The look-backs of an id together visit two cities if one of them does, or
    if the cities last seen by two of them differ. Of the earlier operations
    only the latest ``attempts + 1`` of an id matter; each row offers its own
    latest, and the ranking drops the others before its shuffle, so an id
    repeated very often is no hot group. No row is joined with its look-back.
    Operations of one id and second, whose order the original leaves open, are
    taken by amount, then result, greatest first and nulls last.
    """
    key = ["trans_id", "report_dt"]
    own = seen.join(shared, key, "left_semi")
    out = shared.withColumns({"__hop": F.lit(False), "__guess": F.lit(False)})
    if do3:
        least, most = ("least(__seen_city, __city)", "greatest(__seen_city, __city)") if include_current \
            else ("__seen_city", "__seen_city")
        hops = own.groupBy(*key).agg(F.expr(f"bool_or(city_hop) OR coalesce(min({least}) < max({most}), false)").alias("__h"))
        out = out.join(hops, key, "left").withColumn("__hop", F.coalesce("__h", F.lit(False))).drop("__h")
    if attempts:
        tries = ", ".join(f"named_struct('sec', __last.s{k}, 'id', __last.id{k}, 'pamt', __last.a{k}, 'res', __last.o{k})"
                          for k in range(attempts + 1))
        tops = own.select(*key, "amt", "__sec", F.expr(f"inline(array({tries}))")) \
            .where(F.col("sec") >= F.col("__sec") - guess_window)
        latest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in ("sec", "id", "pamt", "res", "amt")])
        tops = tops.select(*key, "sec", "id", "pamt", "res", "amt", F.row_number().over(latest).alias("__rank")) \
            .where(F.col("__rank") <= attempts + 1)
        listed = tops.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("__rank", "pamt", "res", "amt"))).alias("xs"))
        bad = (f"coalesce(y.res = '{SUCCESS}', false) OR coalesce(coalesce(get(xs, y.__rank).pamt, y.pamt + 1) - y.pamt <= 0, "
               "false) OR coalesce(y.pamt <= x.amt, false)")
        good = listed.select(*key, F.expr(
            f"size(xs) >= {attempts} AND exists(slice(xs, 1, {attempts}), x -> "
            f"forall(slice(xs, 1, {attempts}), y -> coalesce(y.amt <> x.amt, true) OR NOT ({bad})) "
            f"AND exists(slice(xs, 1, {attempts}), y -> coalesce(y.amt = x.amt AND y.pamt > x.amt, false)))").alias("__g"))
        out = out.join(good, key, "left").withColumn("__guess", F.coalesce("__g", F.lit(False))).drop("__g")
    return out


def _candidates_only(tx: DataFrame, report_from, report_to) -> DataFrame:
    """Successful transactions of the report days without rule 3/4 flags
    (no window pass: rules 1 and 2 need only the candidates)."""
    t = tx.where(true_or_false(F.col("oper_result") == SUCCESS) & F.col("trans_date").isNotNull())
    if report_from is not None:
        t = t.where(F.col("trans_date") >= _day_start(report_from))
    if report_to is not None:
        t = t.where(F.col("trans_date") < _day_start(report_to) + F.expr("INTERVAL 1 DAY"))
    return t.select("trans_id", "trans_date", "card_num", "amt", F.to_date("trans_date").alias("report_dt"),
                    F.lit(False).alias("city_hop"), F.lit(False).alias("amount_guess"))


def enrich_candidates(flagged: DataFrame, cards: DataFrame, accounts: DataFrame,
                      clients: DataFrame) -> DataFrame:
    """Report candidates: each transaction with the card, account and client
    versions valid at its time (left joins, so no transaction is dropped)."""
    t = valid_at_join(flagged, cards, fact_key="card_num", dim_key="card_num", at="trans_date",
                      select={"account_num": "__acc"}, live_only=True)
    t = valid_at_join(t, accounts, fact_key="__acc", dim_key="account_num", at="trans_date",
                      select={"valid_to": "acc_valid_to", "client": "__client",
                              "deleted_flg": "acc_deleted_flg"}, live_only=False)
    t = valid_at_join(t, clients, fact_key="__client", dim_key="client_id", at="trans_date",
                      select={"last_name": "__ln", "first_name": "__fn", "patronymic": "__pn",
                              "passport_num": "passport", "passport_valid_to": "passport_valid_to",
                              "phone": "phone"}, live_only=True)
    return t.select(
        "trans_id", F.col("trans_date").alias("event_dt"), "report_dt", "passport",
        full_name("__ln", "__fn", "__pn").alias("fio"), "phone", "passport_valid_to",
        "acc_valid_to", "acc_deleted_flg",
        *[c for c in ("city_hop", "amount_guess") if c in flagged.columns])


def _report(df: DataFrame, event_type: Column | int) -> DataFrame:
    et = F.lit(event_type) if isinstance(event_type, int) else event_type
    return df.select("event_dt", "passport", "fio", "phone", et.cast("smallint").alias("event_type"),
                     "report_dt")


def passport_rule(cands: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Rule 1. One row per matching blacklist entry (duplicates multiply, as
    in the original), or one row for an expired passport without entry."""
    bl = blacklist.select(F.col("passport_num").alias("__bl"), F.col("entry_dt").alias("__entry"))
    c = cands.withColumn("__pk", salt_null_key(cands, "passport"))
    j = c.join(bl, (F.col("__pk") == F.col("__bl")) & (F.col("__entry") <= F.col("report_dt")), "left")
    expired = F.coalesce(F.col("passport_valid_to"), F.col("report_dt")) < F.col("report_dt")
    return _report(j.where(F.col("__bl").isNotNull() | expired), 1)


def account_rule(cands: DataFrame) -> DataFrame:
    """Rule 2: account past its validity (null = valid) or deleted."""
    expired = F.coalesce(F.col("acc_valid_to"), F.col("report_dt")) < F.col("report_dt")
    return _report(cands.where(expired | (F.col("acc_deleted_flg") == "Y")), 2)


def city_hop_rule(cands: DataFrame) -> DataFrame:
    return _report(cands.where(F.col("city_hop")), 3)


def amount_guess_rule(cands: DataFrame) -> DataFrame:
    return _report(cands.where(F.col("amount_guess")), 4)


def blacklist_entries(blacklist: DataFrame) -> DataFrame:
    """Blacklist pre-aggregated to distinct (passport, entry_dt) with their row
    count, and whether the entry date is the passport's first. Duplicates
    collapse map-side, so a passport has at most one row per entry date."""
    agg = blacklist.groupBy("passport_num", "entry_dt").agg(F.count(F.lit(1)).alias("__n"))
    first = F.min("entry_dt").over(Window.partitionBy("passport_num"))
    return agg.select(F.col("passport_num").alias("__bl"), F.col("entry_dt").alias("__entry"), "__n",
                      (F.col("entry_dt") == first).alias("__first"))


def fraud_report(cands: DataFrame, blacklist: DataFrame) -> DataFrame:
    """All four rules in one pass over the candidates.

    Rule 1 fires once per matching blacklist row (duplicates multiply, as in
    the original) or once for an expired passport without a match; rules 2-4
    fire at most once per candidate and are emitted with the candidate's first
    matching entry date (or its only row when nothing matches).
    """
    bl = blacklist_entries(blacklist)
    c = cands.withColumn("__pk", salt_null_key(cands, "passport"))
    j = c.join(bl, (F.col("__pk") == F.col("__bl")) & (F.col("__entry") <= F.col("report_dt")), "left")
    matched = F.col("__bl").isNotNull()
    expired = F.coalesce(F.col("passport_valid_to"), F.col("report_dt")) < F.col("report_dt")
    rule1 = F.when(matched, F.array_repeat(F.lit(1), F.col("__n").cast("int"))) \
        .when(expired, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    acc_bad = F.coalesce(F.col("acc_valid_to"), F.col("report_dt")) < F.col("report_dt")
    once = ~matched | F.col("__first")
    rest = F.array_compact(F.array(
        F.when(once & true_or_false(acc_bad | (F.col("acc_deleted_flg") == "Y")), F.lit(2)),
        F.when(once & F.col("city_hop"), F.lit(3)),
        F.when(once & F.col("amount_guess"), F.lit(4))))
    return _report(j.select("*", F.explode(F.concat(rule1, rest)).alias("__rule")), F.col("__rule"))


def build_report(tx: DataFrame, terminals: DataFrame, cards: DataFrame, accounts: DataFrame,
                 clients: DataFrame, blacklist: DataFrame, *, report_from=None, report_to=None,
                 **rule_params) -> DataFrame:
    flagged = flag_transactions(tx, terminals, report_from=report_from, report_to=report_to,
                                **rule_params)
    return fraud_report(enrich_candidates(flagged, cards, accounts, clients), blacklist)
