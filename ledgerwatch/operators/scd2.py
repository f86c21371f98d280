"""SCD2 dimension maintenance as one keyed pass.

The original applies six statements per batch (insert new keys, close
changed versions, open their successors, insert tombstones for missing keys,
close the deleted versions). Here the same result comes from one full outer
join of the history with the snapshot, in which only the *head* versions
(``effective_to = 9999-12-31``; exactly one per key, live or tombstone) can
match, followed by a per-row expansion:

    keep -> the head as is
    chg  -> head closed at update_dt - 1 day  +  new version from update_dt
    del  -> head closed at batch_dt - 1 day   +  tombstone from batch_dt ('Y')
    new  -> first version from the start column (create_dt or batch date)

The join key is (key, salt): salt 0 for head versions and snapshot rows with
a key, a row hash for closed versions and null keys, which never match and so
spread evenly instead of piling up on one key. Snapshot keys are unique
(checked in-plan, on the join's partitioning) and heads are unique per key, so
the matching part has no hot key either. The warehouse passes only the head
versions in (closed versions are stored append-only), so a batch shuffles
one row per key plus the snapshot.

Behaviour kept from the original on purpose (see README, decisions):
* a key deleted earlier that comes back is ignored (``revive_deleted=False``),
* with ``compare_start`` the start column is compared with effective_from, so
  a row whose start differs from its current version's start re-opens a version,
* ``delete_scope='delta'`` counts only keys of rows newer than the watermark as
  present (unchanged old rows are then tombstoned); ``'snapshot'`` uses the
  whole snapshot,
* closing at ``update_dt - close_offset_days`` (midnight) and closed ``between``
  leave the last day uncovered; a change on the version's own start day gives
  ``effective_to < effective_from``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import DELETED, LIVE, open_end, true_or_false

VERSION = ["effective_from", "effective_to", "deleted_flg"]


def empty_history(spark, snapshot: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    cols = [F.col(c) for c in [key, *attrs]]
    return snapshot.select(*cols, open_end().alias("effective_from"), open_end().alias("effective_to"),
                           F.lit(LIVE).alias("deleted_flg")).where(F.lit(False))


def delta_flag(update_col: str, since) -> Column:
    if since is None:
        return F.lit(True)
    s = since if isinstance(since, Column) else F.lit(since)
    return true_or_false(F.col(update_col) > s)


def present_keys(snapshot: DataFrame, key: str, *, since=None, update_col: str = "update_dt",
                 delete_scope: str = "snapshot") -> DataFrame:
    """Keys that count as present in a batch (for delete detection)."""
    s = snapshot
    if isinstance(since, DataFrame):
        since = since.select(since.columns[0]).scalar()
    if delete_scope == "delta":
        s = s.where(delta_flag(update_col, since))
    elif delete_scope != "snapshot":
        raise ValueError(delete_scope)
    return s.select(key)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


OPEN_SQL = "TIMESTAMP_NTZ '9999-12-31 00:00:00'"


def scd2_apply(hist: DataFrame | None, snapshot: DataFrame, *, key: str, attrs: list[str],
               batch_dt: dt.date | str, start_col: str | None = None, update_col: str = "update_dt",
               since=None, delete_scope: str = "snapshot", compare_start: bool = False,
               close_offset_days: int = 1, revive_deleted: bool = False,
               check_unique: bool = True, stamp_col: str | None = None) -> DataFrame:
    """Apply one batch (a full snapshot) to SCD2 history; returns the new history.

    ``snapshot`` holds key, attrs, ``update_col`` (date, already defaulted to
    the batch date) and ``start_col`` if given. Rows with
    ``update_col > since`` form the delta (all rows when ``since`` is None).
    New keys start at ``start_col`` (or at ``update_col`` when None); changed
    keys start a new version at ``update_col``.

    With ``stamp_col`` (e.g. ``processed_dt``) every inserted or closed
    version gets the current time there and untouched versions keep theirs.

    The per-row logic is one SQL expression (a ``CASE`` producing 0, 1 or 2
    version structs, expanded with ``inline``), so plan building stays cheap.
    """
    if delete_scope not in ("snapshot", "delta"):
        raise ValueError(delete_scope)
    out_cols = [key, *attrs, *VERSION]
    k, oc = _q(key), ", ".join(_q(c) for c in out_cols)
    batch = f"DATE '{dt.date.fromisoformat(str(batch_dt)).isoformat()}'"
    if hist is None:
        hist = empty_history(None, snapshot, key, attrs)
    if stamp_col:
        if stamp_col not in hist.columns:
            hist = hist.withColumn(stamp_col, F.lit(None).cast("timestamp"))
        out_cols = [*out_cols, stamp_col]
    # Join key (key, salt): salt 0 for head versions with a key; closed versions
    # and null keys, which can never match, get a row hash so they spread over
    # all partitions instead of piling up in one.
    head = f"coalesce(effective_to = {OPEN_SQL}, false)"
    h = hist.selectExpr(*[_q(c) for c in out_cols], f"{head} AS h__head",
                        f"CASE WHEN {head} AND {k} IS NOT NULL THEN 0L ELSE xxhash64({oc}) END AS h__salt")

    if isinstance(since, DataFrame):
        since = since.select(since.columns[0]).scalar()   # one-row aggregate: a scalar subquery
    start = _q(start_col or update_col)
    s = snapshot.select(F.col(key).alias("s__k"), *[F.col(a).alias(f"s__{a}") for a in attrs],
                        F.col(update_col).cast("date").cast("timestamp_ntz").alias("s__upd"),
                        F.expr(f"CAST({start} AS TIMESTAMP_NTZ)").alias("s__start"),
                        delta_flag(update_col, since).alias("s__delta"))
    s = s.selectExpr("*", "CASE WHEN s__k IS NOT NULL THEN 0L ELSE xxhash64(*) END AS s__salt")
    if check_unique:
        # partitioned like the join below, so the join reuses this shuffle
        s = s.withColumn("s__n", F.count(F.lit(1)).over(Window.partitionBy("s__k", "s__salt")))
        s = s.where(F.assert_true((F.col("s__n") <= 1) | F.col("s__k").isNull(),
                                  F.lit(f"duplicate {key} in snapshot")).isNull())

    j = h.join(s, F.expr(f"{k} = s__k AND h__salt = s__salt AND h__head"), "full_outer")

    matched = "(h__head AND s__delta IS NOT NULL)"
    live = f"(h__head AND {k} IS NOT NULL AND coalesce(deleted_flg = '{LIVE}', false))"
    present = matched if delete_scope == "snapshot" else f"({matched} AND s__delta)"
    pairs = [(_q(a), _q(f"s__{a}")) for a in attrs]
    if compare_start:
        pairs.append(("effective_from", "s__start"))
    changed = f"({matched} AND s__delta AND (" + " OR ".join(f"NOT ({x} <=> {y})" for x, y in pairs) + "))"

    def row(kx, ax, ef, et, flg, stamp="current_timestamp()"):
        fields = [f"'{key}', {kx}", *[f"'{a}', {e}" for a, e in zip(attrs, ax)],
                  f"'effective_from', {ef}", f"'effective_to', {et}", f"'deleted_flg', {flg}"]
        if stamp_col:
            fields.append(f"'{stamp_col}', {stamp}")
        return "named_struct(" + ", ".join(fields) + ")"

    ha = [_q(a) for a in attrs]
    sa = [_q(f"s__{a}") for a in attrs]
    keep = row(k, ha, "effective_from", "effective_to", "deleted_flg", _q(stamp_col or ""))
    closed_chg = row(k, ha, "effective_from",
                     f"CAST(date_sub(CAST(s__upd AS DATE), {close_offset_days}) AS TIMESTAMP_NTZ)", "deleted_flg")
    closed_del = row(k, ha, "effective_from",
                     f"CAST(date_sub({batch}, {close_offset_days}) AS TIMESTAMP_NTZ)", "deleted_flg")
    tomb = row(k, ha, f"CAST({batch} AS TIMESTAMP_NTZ)", OPEN_SQL, f"'{DELETED}'")
    succ = row("s__k", sa, "s__upd", OPEN_SQL, f"'{LIVE}'")
    first = row("s__k", sa, "s__start", OPEN_SQL, f"'{LIVE}'")
    revive = (f"WHEN h__head AND deleted_flg = '{DELETED}' AND {matched} AND s__delta "
              f"THEN array({closed_chg}, {succ}) ") if revive_deleted else ""
    rows = (f"CASE WHEN h__head IS NULL THEN (CASE WHEN s__delta THEN array({first}) "
            f"ELSE filter(array({keep}), x -> false) END) "
            f"WHEN {live} AND NOT {present} THEN array({closed_del}, {tomb}) "
            f"WHEN {live} AND {changed} THEN array({closed_chg}, {succ}) "
            f"{revive}ELSE array({keep}) END")
    return j.selectExpr(f"inline({rows})")


def version_stats(hist: DataFrame) -> DataFrame:
    """Counts of closed, live and tombstone versions (and inverted ones, Q20)."""
    head = true_or_false(F.col("effective_to") == open_end())
    return hist.agg(
        F.count(F.lit(1)).alias("versions"),
        F.sum(F.when(~head, 1).otherwise(0)).alias("closed"),
        F.sum(F.when(head & (F.col("deleted_flg") == LIVE), 1).otherwise(0)).alias("live"),
        F.sum(F.when(head & (F.col("deleted_flg") == DELETED), 1).otherwise(0)).alias("tombstones"),
        F.sum(F.when(F.col("effective_to") < F.col("effective_from"), 1).otherwise(0)).alias("inverted"))


# ---- the four dimensions of the warehouse ---------------------------------------
# Parity presets: terminals start new keys at the file date and compare only
# attributes; cards/accounts/clients start new keys at create_dt and also
# compare create_dt with effective_from. Present keys are the delta's keys.
PRESETS = {
    "terminals": dict(key="terminal_id", attrs=["terminal_type", "terminal_city", "terminal_address"],
                      start_col=None, compare_start=False, delete_scope="delta"),
    "cards": dict(key="card_num", attrs=["account_num"], start_col="create_dt", compare_start=True,
                  delete_scope="delta", trim_key=True),
    "accounts": dict(key="account_num", attrs=["valid_to", "client"], start_col="create_dt",
                     compare_start=True, delete_scope="delta"),
    "clients": dict(key="client_id", attrs=["last_name", "first_name", "patronymic", "date_of_birth",
                                            "passport_num", "passport_valid_to", "phone"],
                    start_col="create_dt", compare_start=True, delete_scope="delta"),
}


def prepare_source(name: str, source: DataFrame, batch_dt) -> DataFrame:
    """Typed snapshot rows of a batch: trimmed key where the original trims,
    and ``update_dt`` defaulted to the batch date (file sources carry it already)."""
    p = PRESETS[name]
    key = F.trim(F.col(p["key"])) if p.get("trim_key") else F.col(p["key"])
    cols = [key.alias(p["key"]), *[F.col(a) for a in p["attrs"]]]
    if p["start_col"]:
        cols.append(F.col(p["start_col"]).cast("timestamp_ntz").alias(p["start_col"]))
    upd = F.coalesce(F.col("update_dt").cast("date"), F.lit(batch_dt).cast("date")).alias("update_dt")
    return source.select(*cols, upd)


def delta_watermark(delta: DataFrame, update_col: str = "update_dt") -> DataFrame:
    """One-row watermark after loading ``delta``: its max update date."""
    return delta.agg(F.max(F.col(update_col).cast("timestamp_ntz")).alias("wm"))


def apply_preset(name: str, hist: DataFrame | None, snapshot: DataFrame, *, batch_dt, since=None,
                 **overrides) -> DataFrame:
    p = {k: v for k, v in PRESETS[name].items() if k != "trim_key"}
    p.update(overrides)
    return scd2_apply(hist, snapshot, batch_dt=batch_dt, since=since, **p)


def overlapping_versions(hist: DataFrame, key: str, live_only: bool = True) -> DataFrame:
    """Versions whose validity overlaps the previous version of the same key
    (by effective_from). A valid-at left join would match both, duplicating
    fact rows; ``scd2_apply`` never produces them, so this guards histories
    loaded from elsewhere. Versions per key are bounded by the number of
    batches, so the per-key window has no hot key. Inverted versions
    (``effective_to < effective_from``, Q20) cover no instant and are skipped.
    """
    h = hist.where(F.col("effective_to") >= F.col("effective_from")).where(F.col(key).isNotNull())
    if live_only:
        h = h.where(F.col("deleted_flg") == LIVE)
    w = Window.partitionBy(key).orderBy("effective_from", "effective_to")
    return (h.withColumn("__prev_to", F.lag("effective_to").over(w))
             .where(F.col("__prev_to") >= F.col("effective_from")).drop("__prev_to"))
