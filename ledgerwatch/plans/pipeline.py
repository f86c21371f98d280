"""Daily batch pipeline: dated files and source snapshots -> facts, SCD2
dimensions, fraud report, load metadata.

For each pending batch date (sorted as dates) and each target whose own
watermark and last load are before that date:

  transactions   CSV  -> delta filter -> append absent trans_id
  terminals      XLSX -> SCD2 (file date starts new keys)
  blacklist      XLSX -> delta filter -> append absent passport
  cards, accounts, clients   snapshot -> default update_dt -> SCD2 (parity presets)
  fraud report   the batch day, over the state after the loads above

Targets are gated one by one: a family that arrives after others of its date
were committed is loaded by the next run. A file older than its own target's
watermark is not loaded, as in the original; the result names it under
``late`` and it stays in the landing folder. So does a file that is delivered
again with other content: only the very file that a load took, by length and
checksum, is archived.

Each input is parsed or read once into a staging folder (the original's
``*_tmp`` tables), so a live source is read exactly once per batch; outputs
are written next, the metadata state last (commit point), and the processed
files are archived after the commit; files that a crash left behind are
archived by the next run. Errors propagate: a failed batch leaves the
committed state untouched and can be re-run.

The loop runs over batch *dates* (a handful of metadata rows on the driver);
all row work is Spark jobs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import DEFAULT_WATERMARK
from ledgerwatch.operators import facts, fraud, scd2
from ledgerwatch.plans.storage import Warehouse
from ledgerwatch.schemas import BLACKLIST, dim_schema
from ledgerwatch.sources import delimited, discovery, snapshot as snap, workbook

SNAPSHOT_TARGETS = ("cards", "accounts", "clients")
REPORT = "fraud_report"
TARGETS = ["transactions", "terminals", "passport_blacklist", *SNAPSHOT_TARGETS, REPORT]

SnapshotReader = Callable[[SparkSession, dt.date], DataFrame]


class EmptySnapshotError(RuntimeError):
    pass


def pending_batches(spark: SparkSession, landing: str) -> list[dict]:
    """Batch dates of the landing folder with per-family availability; a file whose name has an
    impossible date stops the run, as in the original, instead of being passed over."""
    files = discovery.list_files(spark, landing)
    undated = discovery.undated_files(files).orderBy("file_name").first()
    if undated is not None:
        raise ValueError(f"no date in the file name {undated['file_name']}")
    return [r.asDict() for r in discovery.discover_batches(files).collect()]


def _state(meta: DataFrame) -> dict[str, tuple]:
    return {r["table_name"]: (r["max_update_dt"], r["last_load_dt"]) for r in meta.collect()}


def _wm(state, table) -> dt.datetime:
    v = state.get(table, (None, None))[0]
    return v or dt.datetime.combine(DEFAULT_WATERMARK, dt.time())


def _advance(state, table, delta: DataFrame | None, batch: dt.date, to_batch: bool = False):
    """New watermark: the delta's max update date, never backwards, unchanged
    for an empty delta (one small aggregate over the staged batch)."""
    old = _wm(state, table)
    if to_batch:
        new = dt.datetime.combine(batch, dt.time())
    else:
        m = delta.agg(F.max(F.col("update_dt").cast("timestamp_ntz"))).first()[0] if delta is not None else None
        new = m or old
    state[table] = (max(old, new), batch)


FILES = {"transactions": ("transactions", "txt"), "passport_blacklist": ("passport_blacklist", "xlsx"),
         "terminals": ("terminals", "xlsx")}


def run_batch(spark: SparkSession, wh: Warehouse, landing: str, batch: dt.date, *,
              snapshots: dict[str, SnapshotReader] | None = None, delete_scope: str = "delta",
              allow_empty_snapshot: bool = False, archive: bool = True, parallel: bool = True,
              keep_heads: int | None = 2) -> dict:
    """Load what is due of one batch date; returns what ran.

    The six loads are independent (each reads and writes only its own
    target), so with ``parallel`` they are submitted as concurrent Spark jobs
    from driver threads; the report runs after all of them, the commit last.
    Any failure propagates before the commit. ``keep_heads`` is the number of
    head copies kept of each dimension (None: all).
    """
    snapshots = snapshots or {}
    landing = landing.rstrip("/")
    state = _state(wh.meta())
    for t in TARGETS:
        state.setdefault(t, (None, None))
    midnight = dt.datetime.combine(batch, dt.time())
    due = {t: _wm(state, t) < midnight and (state[t][1] is None or state[t][1] < batch) for t in TARGETS}
    taken_before = {r["target"]: (r["file_length"], r["file_checksum"])
                    for r in wh.loads().where(F.col("batch_dt") == F.lit(batch)).collect()}
    files = {t: f"{landing}/{prefix}_{batch:%d%m%Y}.{ext}" for t, (prefix, ext) in FILES.items()}
    files = {t: f for t, f in files.items() if wh.exists(f)}
    prints = {t: wh.fingerprint(f) for t, f in files.items() if due[t] or t in taken_before}
    done = {t for t in files if not due[t] and t in taken_before and prints[t] == taken_before[t]}
    late = sorted(f for t, f in files.items() if not due[t] and t not in done)
    if archive:   # files of a load that crashed between its commit and the archiving
        for t in done:
            wh.archive(files[t], f"{landing}/archive")
    load = wh.begin()
    as_of = max([d for _, d in state.values() if d] + [batch])

    def append(name, rows, key, columns=None, sort_by=None):
        delta = rows.where(F.col("update_dt").cast("timestamp_ntz") > F.lit(_wm(state, name)))
        new = facts.append_absent(wh.facts(name), delta.select(*columns) if columns else delta.drop("update_dt"), key)
        wh.write_facts(name, new, batch, load, sort_by=sort_by)
        return delta

    def load_transactions(p):
        tx = wh.stage("transactions", delimited.read_transactions(spark, p, glob="*"), load)
        return append("transactions", tx, "trans_id", sort_by="trans_date")

    def load_blacklist(p):
        bl = wh.stage("passport_blacklist", workbook.read_blacklist(spark, p, glob="*"), load)
        return append("passport_blacklist", bl, "passport_num", ["passport_num", "entry_dt"])

    def load_terminals(p):
        src = wh.stage("terminals", workbook.read_terminals(spark, p, glob="*"), load)
        return _load_dim(wh, state, "terminals", src, batch, as_of, delete_scope, allow_empty_snapshot, load)

    def load_snapshot(name):
        src = snap.read_snapshot(snapshots[name](spark, batch), name)
        src = wh.stage(name, scd2.prepare_source(name, src, batch), load)
        return _load_dim(wh, state, name, src, batch, as_of, delete_scope, allow_empty_snapshot, load)

    loaders = {"transactions": load_transactions, "passport_blacklist": load_blacklist, "terminals": load_terminals}
    tasks = {t: (loaders[t], f) for t, f in files.items() if due[t]}   # target -> (function, argument)
    for name in SNAPSHOT_TARGETS:
        if due[name] and snapshots.get(name) is not None:
            tasks[name] = (load_snapshot, name)

    if parallel and len(tasks) > 1:
        with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
            futures = {t: pool.submit(fn, arg) for t, (fn, arg) in tasks.items()}
            deltas = {t: f.result() for t, f in futures.items()}
    else:
        deltas = {t: fn(arg) for t, (fn, arg) in tasks.items()}
    ran = [t for t in TARGETS if t in tasks and deltas[t] is not None]
    for t in ran:
        _advance(state, t, deltas[t], batch)

    # fraud report of the batch day, over the state including this batch
    if due[REPORT] and wh.facts("transactions", upto=load) is not None:
        wh.write_report(build_day_report(wh, state, batch, load), load)
        _advance(state, REPORT, None, batch, to_batch=True)
        ran.append(REPORT)

    if ran:
        taken = [(t, batch, files[t].rsplit("/", 1)[1], *prints[t]) if t in files else (t, batch, None, None, None)
                 for t in ran if t != REPORT]
        wh.commit([(t, *v) for t, v in state.items()], taken, load)
        if archive:
            for t in ran:
                if t in files:
                    wh.archive(files[t], f"{landing}/archive")
        wh.housekeeping(load, keep_heads)
    return {"batch": batch, "ran": ran, "late": late, "quiet": [t for t in tasks if deltas[t] is None]}


def _load_dim(wh, state, name, src, batch, as_of, delete_scope, allow_empty, load) -> DataFrame | None:
    """SCD2 load of one dimension; returns its delta (for the watermark), or None when the
    dimension was left as it is: a snapshot without newer rows is a quiet day, not a deletion."""
    since = _wm(state, name)
    heads = wh.dim(name, state[name][1], as_of, heads_only=True, keep_stamp=True)
    delta = src.where(F.col("update_dt").cast("timestamp_ntz") > F.lit(since))
    if heads is not None and not allow_empty:
        if src.isEmpty():
            raise EmptySnapshotError(f"{name}: empty snapshot in batch {batch}; refusing to tombstone everything")
        if delete_scope == "delta" and delta.isEmpty():
            return None
    hist = scd2.apply_preset(name, heads, src, batch_dt=batch, since=F.lit(since), delete_scope=delete_scope,
                             stamp_col="processed_dt")
    wh.write_dim(name, hist, batch, load)
    return delta


def build_day_report(wh: Warehouse, state: dict, day: dt.date, load: int | None = None) -> DataFrame:
    """Report of one day; only the fact partitions of that day and the day before (the look-back) are read."""
    tx = wh.facts("transactions", upto=load, days=(day - dt.timedelta(days=1), day))
    last = max([d for _, d in state.values() if d] + [day])
    dims = {n: wh.dim(n, state[n][1], last, upto=load) for n in ("terminals", *SNAPSHOT_TARGETS)}
    for n, d in dims.items():
        if d is None:
            dims[n] = wh.spark.createDataFrame([], dim_schema(n))
    bl = wh.facts("passport_blacklist", upto=load)
    if bl is None:
        bl = wh.spark.createDataFrame([], BLACKLIST)
    return fraud.build_report(tx, dims["terminals"], dims["cards"], dims["accounts"], dims["clients"], bl,
                              report_from=day, report_to=day, repeated_ids=True)


def run_pending(spark: SparkSession, landing: str, warehouse: str, **kw) -> list[dict]:
    wh = Warehouse(spark, warehouse)
    return [run_batch(spark, wh, landing, b["batch_dt"], **kw) for b in pending_batches(spark, landing)]
