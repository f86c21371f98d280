"""File and snapshot sources, batch discovery, incremental control."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwatch.operators import facts, incremental as inc
from ledgerwatch.schemas import META
from ledgerwatch.sources import delimited, discovery, snapshot, workbook
from xlsx_writer import excel_serial, write_xlsx


def test_transactions_csv(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "transactions_01032021.txt"), "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        f.write("00012;2021-03-01 00:00:01;1234,56;1234 5678 ;PAYMENT;SUCCESS;P001\n")
        f.write("13;2021-03-01 23:59:59;-7,00;4444;WITHDRAW;REJECT;A002\n")
    with open(os.path.join(tmp_dir, "transactions_28022021.txt"), "w") as f:
        f.write("a;b;c;d;e;f;g\n9;2021-02-28 10:00:00;1 000,5;1;P;SUCCESS;T\n")
    with open(os.path.join(tmp_dir, "terminals_01032021.xlsx"), "w") as f:
        f.write("not a csv")
    rows = {r.trans_id: r for r in delimited.read_transactions(spark, tmp_dir).collect()}
    assert set(rows) == {"00012", "13", "9"}                    # leading zeros kept
    assert rows["00012"].amt == Decimal("1234.56")
    assert rows["13"].amt == Decimal("-7.00")
    assert rows["9"].amt == Decimal("1000.50")
    assert rows["00012"].trans_date == dt.datetime(2021, 3, 1, 0, 0, 1)
    assert rows["00012"].card_num == "1234 5678 "              # trimmed later, by the cards load
    assert rows["00012"].update_dt == dt.date(2021, 3, 1)        # from the file name
    assert rows["9"].update_dt == dt.date(2021, 2, 28)


def test_workbooks(spark, tmp_dir):
    write_xlsx(os.path.join(tmp_dir, "terminals_01032021.xlsx"),
               {"other": [["x"]], "terminals": [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                                                ["P001", "POS", "Moscow", "Lenina 1"],
                                                ["A002", "ATM", "Kazan", None]]})
    write_xlsx(os.path.join(tmp_dir, "terminals_02032021.xlsx"),
               {"terminals": [["id", "t", "c", "a"], ["P001", "POS", "Tver", "Lenina 1"]]}, inline=True)
    write_xlsx(os.path.join(tmp_dir, "passport_blacklist_01032021.xlsx"),
               {"blacklist": [["date", "passport"], [excel_serial(dt.date(2021, 2, 20)), "1234 567890"],
                              ["2021-02-21", "9999 000111"]]})
    t = sorted(tuple(r) for r in workbook.read_terminals(spark, tmp_dir).collect())
    assert t == [("A002", "ATM", "Kazan", None, dt.date(2021, 3, 1)),
                 ("P001", "POS", "Moscow", "Lenina 1", dt.date(2021, 3, 1)),
                 ("P001", "POS", "Tver", "Lenina 1", dt.date(2021, 3, 2))]
    b = sorted(tuple(r) for r in workbook.read_blacklist(spark, tmp_dir).collect())
    assert b == [("1234 567890", dt.date(2021, 2, 20), dt.date(2021, 3, 1)),
                 ("9999 000111", dt.date(2021, 2, 21), dt.date(2021, 3, 1))]


def test_discovery_sorts_dates_and_unions_families(spark, tmp_dir):
    for n in ["transactions_01032021.txt", "transactions_28022021.txt", "terminals_02032021.xlsx",
              "passport_blacklist_28022021.xlsx", "readme.txt", "transactions_31022021.txt"]:
        open(os.path.join(tmp_dir, n), "w").write("x")
    got = [tuple(r) for r in discovery.discover_batches(discovery.list_files(spark, tmp_dir)).collect()]
    assert got == [(dt.date(2021, 2, 28), True, False, True),     # 28.02 before 01.03 (as dates)
                   (dt.date(2021, 3, 1), True, False, False),
                   (dt.date(2021, 3, 2), False, True, False)]     # a date only terminals have


def test_snapshot_by_position(spark):
    src = spark.createDataFrame([(" 42 ", "A1", "2021-01-01 10:00:00", None)], "x string, y string, z string, w string")
    s = snapshot.read_snapshot(src, "cards").collect()[0]
    assert (s.card_num, s.account_num, s.create_dt, s.update_dt) == (" 42 ", "A1", dt.datetime(2021, 1, 1, 10), None)


def test_watermarks(spark):
    meta = spark.createDataFrame([("t1", dt.datetime(2024, 1, 5))], META)
    seeded = inc.seed_watermarks(meta, ["t1", "t2"])
    assert sorted(tuple(r) for r in seeded.collect()) == [("t1", dt.datetime(2024, 1, 5)),
                                                           ("t2", dt.datetime(1900, 1, 1))]
    rows = spark.createDataFrame([(dt.date(2024, 1, 4),), (dt.date(2024, 1, 7),)], "update_dt date")
    delta = inc.delta_filter(rows, meta, "t1")
    assert [r.update_dt for r in delta.collect()] == [dt.date(2024, 1, 7)]
    adv = {r.table_name: r.max_update_dt for r in inc.advance_watermark(meta, "t1", delta).collect()}
    assert adv == {"t1": dt.datetime(2024, 1, 7)}
    empty = rows.where(F.lit(False))
    adv = {r.table_name: r.max_update_dt for r in inc.advance_watermark(meta, "t1", empty).collect()}
    assert adv == {"t1": dt.datetime(2024, 1, 5)}               # Q5: an empty delta keeps the mark
    batches = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 6),)], "batch_dt date")
    gate = sorted(tuple(r) for r in inc.load_gate(batches, meta, ["t1", "t2"]).collect())
    assert gate == [(dt.date(2024, 1, 5), "t2"), (dt.date(2024, 1, 6), "t1"), (dt.date(2024, 1, 6), "t2")]


def test_append_absent(spark):
    target = spark.createDataFrame([("1", 1), ("2", 2)], "id string, v int")
    batch = spark.createDataFrame([("2", 9), ("3", 3), ("3", 4), (None, 5)], "id string, v int")
    got = sorted((tuple(r) for r in facts.append_absent(target, batch, "id").collect()), key=str)
    assert got == sorted([("3", 3), ("3", 4), (None, 5)], key=str)   # in-batch duplicates and null kept
    dd = facts.append_absent(target, batch, "id", dedupe_within_batch=True, first_by="v")
    assert sorted((tuple(r) for r in dd.collect()), key=str) == sorted([("3", 3), (None, 5)], key=str)


def test_catalog_tables_with_defaults(spark, tmp_dir):
    from ledgerwatch.schemas import create_tables
    names = create_tables(spark, "lw_ddl_test", os.path.join(tmp_dir, "db"))
    assert "dim_cards_hist" in names and "rep_fraud" in names
    spark.sql("INSERT INTO lw_ddl_test.dim_cards_hist (card_num, account_num, effective_from) "
              "VALUES ('1', 'A', TIMESTAMP_NTZ '2024-01-01 00:00:00')")
    r = spark.sql("SELECT effective_to, deleted_flg FROM lw_ddl_test.dim_cards_hist").first()
    assert (r.effective_to, r.deleted_flg) == (dt.datetime(9999, 12, 31), "N")
    try:
        spark.sql("INSERT INTO lw_ddl_test.dim_cards_hist (card_num) VALUES ('123456789012345678901')")
        raise AssertionError("over-length value accepted")
    except Exception as e:
        assert "EXCEED_LIMIT_LENGTH" in str(e)
