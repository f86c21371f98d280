"""SCD2: hand-made cases for the kept behaviours and guards, and equivalence of
the one-pass ``scd2_apply`` with the original's six statements (DuckDB) over
seeded random snapshot chains, both delete scopes, with and without
``compare_start``."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from ledgerwatch.operators import scd2
from ledgerwatch.plans import oracle as orc

D = [dt.date(2024, 1, d) for d in (1, 2, 3, 4, 5)]
SNAP = "k string, a string, b int, start timestamp_ntz, update_dt date"
OPEN = dt.datetime(9999, 12, 31)


def snap(spark, rows):
    return spark.createDataFrame(rows, SNAP)


def apply(hist, s, day, **kw):
    kw.setdefault("start_col", "start")
    return scd2.scd2_apply(hist, s, key="k", attrs=["a", "b"], batch_dt=D[day], **kw)


def _key(t):
    return tuple((v is None, "" if v is None else str(v)) for v in t)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def r(k, a, b, start_day=0, upd=None):
    return (k, a, b, dt.datetime.combine(D[start_day], dt.time(8)), upd)


def test_new_change_delete(spark):
    h1 = apply(None, snap(spark, [r("1", "x", 1, upd=D[0]), r("2", "y", 2, upd=D[0])]), 0)
    h2 = apply(h1, snap(spark, [r("1", "x", 5, upd=D[1])]), 1)
    got = rows_of(h2)
    start = dt.datetime.combine(D[0], dt.time(8))
    assert got == sorted([
        ("1", "x", 1, start, dt.datetime(2024, 1, 1), "N"),                # closed at update_dt - 1 day
        ("1", "x", 5, dt.datetime(2024, 1, 2), OPEN, "N"),                  # new version from update_dt
        ("2", "y", 2, start, dt.datetime(2024, 1, 1), "N"),                 # deleted: closed at batch - 1
        ("2", "y", 2, dt.datetime(2024, 1, 2), OPEN, "Y"),                  # tombstone
    ])


def test_returning_key_ignored_or_revived(spark):
    h1 = apply(None, snap(spark, [r("1", "x", 1, upd=D[0])]), 0)
    h2 = apply(h1, snap(spark, [r("9", "z", 9, upd=D[1])]), 1)
    back = snap(spark, [r("1", "x", 2, upd=D[2]), r("9", "z", 9, upd=D[2])])
    h3 = apply(h2, back, 2)
    assert rows_of(h3) == rows_of(h2)                       # Q4: the original ignores it
    h3r = apply(h2, back, 2, revive_deleted=True)
    live = [x for x in rows_of(h3r) if x[0] == "1" and x[4] == OPEN]
    assert live == [("1", "x", 2, dt.datetime(2024, 1, 3), OPEN, "N")]


def test_duplicate_key_fails(spark):
    s = snap(spark, [r("1", "x", 1, upd=D[0]), r("1", "y", 1, upd=D[0])])
    with pytest.raises(Exception) as e:
        apply(None, s, 0).collect()
    assert "duplicate" in str(e.value)


def test_change_on_start_day_inverts(spark):
    # new key starts 2024-01-02 (update_dt as start), changes the same day next batch run
    h1 = scd2.scd2_apply(None, snap(spark, [r("1", "x", 1, upd=D[1])]), key="k", attrs=["a", "b"],
                         batch_dt=D[1])
    h2 = scd2.scd2_apply(h1, snap(spark, [r("1", "x", 2, upd=D[1])]), key="k", attrs=["a", "b"],
                         batch_dt=D[1])
    st = scd2.version_stats(h2).first()
    assert st.inverted == 1                                 # effective_to < effective_from (Q20)


def test_null_key_always_inserted(spark):
    s = snap(spark, [r(None, "x", 1, upd=D[0]), r(None, "x", 1, upd=D[0])])
    h1 = apply(None, s, 0)
    h2 = apply(h1, s, 1)
    assert h2.where("k is null").count() == 4                 # inserted every batch, never matched


def test_delete_scope(spark):
    h1 = apply(None, snap(spark, [r("1", "x", 1, upd=D[0]), r("2", "y", 2, upd=D[0])]), 0)
    s2 = snap(spark, [r("1", "x", 1, upd=dt.date(2023, 12, 1)), r("2", "y", 3, upd=D[1])])
    since = dt.date(2024, 1, 1)
    parity = apply(h1, s2, 1, since=since, delete_scope="delta")
    fixed = apply(h1, s2, 1, since=since, delete_scope="snapshot")
    assert parity.where("k = '1' and deleted_flg = 'Y'").count() == 1   # Q3: old row counts as deleted
    assert fixed.where("deleted_flg = 'Y'").count() == 0


def test_present_keys_scopes(spark):
    s = snap(spark, [r("1", "x", 1, upd=dt.date(2023, 12, 1)), r("2", "y", 2, upd=D[1])])
    since = dt.date(2024, 1, 1)
    assert rows_of(scd2.present_keys(s, "k", since=since, delete_scope="delta")) == [("2",)]
    assert rows_of(scd2.present_keys(s, "k", since=since, delete_scope="snapshot")) == [("1",), ("2",)]


# ---- random chains against the six-statement SQL ----------------------------------

def random_snapshots(seed, batches=4, keys=40):
    rnd = random.Random(seed)
    attrs = {k: (rnd.choice("xyz"), rnd.randrange(3)) for k in range(keys)}
    out = []
    for b in range(batches):
        rows = []
        for k in range(keys):
            if rnd.random() < 0.2:
                continue                                    # missing this batch (deleted / returns)
            a, n = attrs[k]
            if rnd.random() < 0.25:
                a = rnd.choice(["x", "y", "z", None])
            if rnd.random() < 0.25:
                n = rnd.choice([0, 1, 2, None])
            attrs[k] = (a, n)
            start = dt.datetime(2023, 6, 1) + dt.timedelta(days=rnd.choice([k % 5, k % 5, 7]))
            upd = rnd.choice([D[b], D[b], D[b], dt.date(2023, 12, 1)])
            rows.append((str(k), a, n, start, upd))
        out.append(rows)
    return out


def duck_chain(snaps, since_mode, **kw):
    con = duckdb.connect()
    for i, rows in enumerate(snaps):
        pdf = pd.DataFrame(rows, columns=["k", "a", "b", "start", "update_dt"])
        pdf["b"] = pdf["b"].astype("Int64")
        con.register(f"p{i}", pdf)
        con.sql(f"create view s{i} as select k, a, cast(b as integer) as b, cast(start as timestamp) as start, "
                f"cast(update_dt as date) as update_dt from p{i}")
    ctes = {"h0": "select * from " + orc.empty_hist_sql("s0", "k", ["a", "b"])}
    for i in range(len(snaps)):
        since = None if i == 0 or not since_mode else f"date '{D[i - 1].isoformat()}'"
        ctes[f"h{i + 1}"] = "select * from " + orc.scd2_step_sql(
            f"h{i}", f"s{i}", key="k", attrs=["a", "b"], batch_dt=D[i].isoformat(), start_col="start",
            since=since, **kw)
    sql = orc.with_ctes(ctes, f"select * from h{len(snaps)}")
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in con.sql(sql).fetchall()), key=_key)


@pytest.mark.parametrize("seed,scope,cmp,since_mode", [
    (1, "snapshot", False, False), (2, "delta", True, True), (3, "snapshot", True, True),
    (4, "delta", False, True)])
def test_scd2_matches_six_statements(spark, seed, scope, cmp, since_mode):
    snaps = random_snapshots(seed)
    h = None
    for i, rows in enumerate(snaps):
        since = None if i == 0 or not since_mode else D[i - 1]
        h = apply(h, snap(spark, rows), i, since=since, delete_scope=scope, compare_start=cmp)
    got = rows_of(h)
    exp = duck_chain(snaps, since_mode, delete_scope=scope, compare_start=cmp)
    assert got == exp


def test_stamp_kept_on_untouched_versions(spark):
    h1 = apply(None, snap(spark, [r("1", "x", 1, upd=D[0]), r("2", "y", 2, upd=D[0])]), 0,
               stamp_col="processed_dt")
    h1 = spark.createDataFrame(h1.collect(), h1.schema)         # as stored after batch 1
    first = {x.k: x.processed_dt for x in h1.collect()}
    h2 = apply(h1, snap(spark, [r("1", "x", 1, upd=D[1]), r("2", "y", 3, upd=D[1])]), 1,
               stamp_col="processed_dt").collect()
    unchanged = [x for x in h2 if x.k == "1"]
    assert len(unchanged) == 1 and unchanged[0].processed_dt == first["1"]
    changed = [x for x in h2 if x.k == "2"]
    assert len(changed) == 2 and all(x.processed_dt > first["2"] for x in changed)


def test_overlapping_versions(spark):
    h1 = apply(None, snap(spark, [r("1", "x", 1, upd=D[0]), r("2", "y", 2, upd=D[0])]), 0)
    h2 = apply(h1, snap(spark, [r("1", "x", 5, upd=D[1]), r("2", "y", 2, upd=D[1])]), 1)
    assert scd2.overlapping_versions(h2, "k").count() == 0          # scd2_apply output never overlaps
    bad = h2.unionByName(spark.createDataFrame(
        [("2", "z", 9, dt.datetime(2024, 1, 1), OPEN, "N")], h2.schema))
    assert [x.k for x in scd2.overlapping_versions(bad, "k").collect()] == ["2"]
