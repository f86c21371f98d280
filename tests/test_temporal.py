"""Point-in-time joins at version boundaries, and the column helpers
(FIXTURES.md §3: boundary at 00:00:00 and in the gap day, null patronymic and
all-null name, padded card number, malformed file dates)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerwatch.functions import columns as C
from ledgerwatch.operators import scd2
from ledgerwatch.operators.temporal import hot_groups, lookback_buckets, valid_at_join

DIM = "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
OPEN = dt.datetime(9999, 12, 31)


def test_valid_at_boundaries_and_gap_day(spark):
    # version 1 closed at 2024-01-01 00:00:00 (update on 01-02), version 2 from 01-02 00:00:00
    dim = spark.createDataFrame([
        ("A", "v1", dt.datetime(2023, 6, 1), dt.datetime(2024, 1, 1), "N"),
        ("A", "v2", dt.datetime(2024, 1, 2), OPEN, "N"),
        ("B", "b1", dt.datetime(2023, 6, 1), dt.datetime(2024, 1, 1), "N"),
        ("B", "b-del", dt.datetime(2024, 1, 2), OPEN, "Y"),
    ], DIM)
    facts = spark.createDataFrame([
        ("t1", "A", dt.datetime(2024, 1, 1, 0, 0, 0)),     # the closing instant: still version 1
        ("t2", "A", dt.datetime(2024, 1, 1, 12, 0, 0)),    # gap day: no version
        ("t3", "A", dt.datetime(2024, 1, 2, 0, 0, 0)),     # the opening instant: version 2
        ("t4", "B", dt.datetime(2024, 1, 5)),              # deleted: no live version
        ("t5", None, dt.datetime(2024, 1, 5)),             # null key: kept, no match
    ], "id string, k string, at timestamp_ntz")
    got = {r.id: r.v for r in valid_at_join(facts, dim, fact_key="k", dim_key="k", at="at",
                                            select={"v": "v"}).collect()}
    assert got == {"t1": "v1", "t2": None, "t3": "v2", "t4": None, "t5": None}
    any_flag = {r.id: r.v for r in valid_at_join(facts, dim, fact_key="k", dim_key="k", at="at",
                                                 select={"v": "v"}, live_only=False).collect()}
    assert any_flag["t4"] == "b-del"                         # accounts join: tombstones match


def test_checked_broadcast_same_rows(spark):
    dim = spark.createDataFrame([("A", "v", dt.datetime(2000, 1, 1), OPEN, "N")], DIM)
    facts = spark.createDataFrame([("t", "A", dt.datetime(2024, 1, 1))], "id string, k string, at timestamp_ntz")
    for rows in (None, 0, 10):
        j = valid_at_join(facts, dim, fact_key="k", dim_key="k", at="at", select={"v": "v"}, broadcast_rows=rows)
        assert [tuple(r) for r in j.collect()] == [("t", "A", dt.datetime(2024, 1, 1), "v")]


def test_full_name_and_concat(spark):
    df = spark.createDataFrame([("Ivanov", "Ivan", "Ivanovich"), ("Ivanov", "Ivan", None), (None, "Ivan", None),
                                (None, None, None)], "l string, f string, p string")
    got = [r.fio for r in df.select(C.full_name("l", "f", "p").alias("fio")).collect()]
    assert got == ["Ivanov Ivan Ivanovich", "Ivanov Ivan", " Ivan", ""]


def test_padded_card_is_trimmed(spark):
    src = spark.createDataFrame([(" 42 ", "A", dt.datetime(2023, 6, 1), None)],
                                "card_num string, account_num string, create_dt timestamp_ntz, update_dt date")
    s = scd2.prepare_source("cards", src, dt.date(2024, 1, 1)).collect()[0]
    assert (s.card_num, s.update_dt) == ("42", dt.date(2024, 1, 1))   # trim + default update date


def test_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(1970, 1, 2, 0, 0, 1), "01032021", "31022021", "x")],
                               "t timestamp_ntz, a string, b string, c string")
    r = df.select(C.epoch_seconds("t").alias("e"), C.parse_ddmmyyyy("a").alias("a"),
                  C.parse_ddmmyyyy("b").alias("b"), C.parse_ddmmyyyy("c").alias("c"),
                  C.days_before(F.lit(dt.date(2024, 3, 1)), 1).alias("d")).first()
    assert (r.e, r.a, r.b, r.c) == (86401, dt.date(2021, 3, 1), None, None)
    assert r.d == dt.datetime(2024, 2, 29)


def test_lookback_context_copies(spark):
    # width 100 s, look-back 30 s: rows in the last 30 s of a bucket are copied to the next
    df = spark.createDataFrame([("c", 10), ("c", 75), ("c", 99), ("c", 100), (None, 5), (None, 5)], "k string, s long")
    out = lookback_buckets(df, key="k", seconds="s", lookback=30, bucket=100)
    got = sorted((r["s"], r["__bucket"], r["__ctx"]) for r in out.where("k is not null").collect())
    assert got == [(10, 0, False), (75, 0, False), (75, 1, True), (99, 0, False), (99, 1, True), (100, 1, False)]
    nulls = [r["__bucket"] for r in out.where("k is null").collect()]
    assert len(set(nulls)) == 2 and max(nulls) < 0          # invalid rows, equal ones too: a bucket each


def test_hot_groups_count_the_copies(spark):
    # width 100 s, look-back 30 s; bucket 1 holds one row of its own and two copies
    rows = [("c", 10), ("c", 75), ("c", 99), ("c", 100), ("d", 5), (None, 5), ("d", None)]
    df = spark.createDataFrame(rows, "k string, s long")
    def hot(n):
        return {(r["k"], r["__bucket"]) for r in hot_groups(df, key="k", seconds="s", lookback=30, bucket=100, hot_rows=n).collect()}
    assert hot(2) == {("c", 0), ("c", 1)}
    assert hot(3) == set()
    assert hot(0) == {("c", 0), ("c", 1), ("d", 0)}
