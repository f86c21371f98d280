"""End to end: three dated batches (CSV + XLSX files, source snapshots) in a
temp landing folder -> facts, SCD2 dimensions, daily report, metadata,
archive; a re-run changes nothing. Plus the availableNow streaming ingest."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerwatch.operators import fraud, scd2
from ledgerwatch.plans import fixtures as fx
from ledgerwatch.plans import pipeline
from ledgerwatch.plans.storage import Warehouse
from ledgerwatch.streaming import ingest
from xlsx_writer import excel_serial, write_xlsx

DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
SOURCES = {"cards": fx.card_source, "accounts": fx.account_source, "clients": fx.client_source}


def _day_no(d):
    return 1 if d == DAYS[0] else 2


def write_landing(spark, landing):
    tx = fx.transactions(spark, SF_SMALL).toPandas()
    tx["day"] = tx["trans_date"].dt.date
    counts = {}
    for d in DAYS:
        part = tx[tx["day"] == d]
        counts[d] = len(part)
        with open(os.path.join(landing, f"transactions_{d:%d%m%Y}.txt"), "w") as f:
            f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
            for r in part.itertuples():
                amt = f"{r.amt:.2f}".replace(".", ",")
                f.write(f"{r.trans_id};{r.trans_date:%Y-%m-%d %H:%M:%S};{amt};{r.card_num};"
                        f"{r.oper_type};{r.oper_result};{r.terminal}\n")
        terms = fx.terminal_source(spark, SF_SMALL, _day_no(d)).toPandas()
        write_xlsx(os.path.join(landing, f"terminals_{d:%d%m%Y}.xlsx"),
                   {"terminals": [["terminal_id", "terminal_type", "terminal_city", "terminal_address"]]
                    + terms[["terminal_id", "terminal_type", "terminal_city", "terminal_address"]].values.tolist()})
        bl = fx.blacklist_static(spark, SF_SMALL).where(F.col("entry_dt") <= F.lit(d)).toPandas()
        write_xlsx(os.path.join(landing, f"passport_blacklist_{d:%d%m%Y}.xlsx"),
                   {"blacklist": [["date", "passport"]]
                    + [[excel_serial(e), p] for p, e in zip(bl["passport_num"], bl["entry_dt"])]})
    return counts


def readers():
    return {n: (lambda src: (lambda spark, batch: src(spark, SF_SMALL, _day_no(batch))))(s)
            for n, s in SOURCES.items()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(v) for v in t))


def test_end_to_end(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "dwh")
    os.makedirs(landing)
    counts = write_landing(spark, landing)
    out = pipeline.run_pending(spark, landing, root, snapshots=readers(), keep_heads=None)
    assert [o["batch"] for o in out] == DAYS
    assert all(len(o["ran"]) == 7 for o in out), out
    wh = Warehouse(spark, root)
    assert wh.committed() == DAYS[-1]
    assert wh.facts("transactions", DAYS[-1]).count() == sum(counts.values())
    # the blacklist files repeat earlier entries; each passport is stored once
    bl = wh.facts("passport_blacklist", DAYS[-1])
    assert bl.count() == bl.select("passport_num").distinct().count()
    # archived with the .backup suffix
    assert sorted(os.listdir(landing)) == ["archive"]
    assert len([n for n in os.listdir(os.path.join(landing, "archive")) if n.endswith(".backup")]) == 9

    # dimensions equal a direct chain of scd2 applications
    state = {r.table_name: r for r in wh.meta().collect()}
    for name, src in SOURCES.items():
        h, since = None, dt.datetime(1900, 1, 1)
        for d in DAYS:
            s = scd2.prepare_source(name, src(spark, SF_SMALL, _day_no(d)), d)
            h = scd2.apply_preset(name, h, s, batch_dt=d, since=F.lit(since))
            m = s.where(F.col("update_dt").cast("timestamp_ntz") > F.lit(since)).agg(
                F.max(F.col("update_dt").cast("timestamp_ntz"))).first()[0]
            since = max(since, m or since)
        assert rows(wh.dim(name, state[name].last_load_dt, DAYS[-1])) == rows(h), name
        assert state[name].max_update_dt == since

    # the report of each day equals the report computed from the stored state of that day
    rep = wh.report()
    assert rep.count() > 0
    tx = wh.facts("transactions", DAYS[-1])
    for d in DAYS:
        dims = {n: wh.dim(n, d, d) for n in ("terminals", *SOURCES)}
        exp = fraud.build_report(tx, dims["terminals"], dims["cards"], dims["accounts"], dims["clients"],
                                 wh.facts("passport_blacklist", d), report_from=d, report_to=d)
        got = rep.where(F.col("report_dt") == F.lit(d)).select(*fraud.REPORT_COLS)
        assert rows(got) == rows(exp), d

    # re-run: nothing pending, nothing changes
    before = rows(rep)
    assert pipeline.run_pending(spark, landing, root, snapshots=readers()) == []
    assert pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=readers())["ran"] == []
    assert rows(wh.report()) == before


def test_empty_snapshot_guard(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "dwh")
    os.makedirs(landing)
    open(os.path.join(landing, "transactions_01012024.txt"), "w").write("a;b;c;d;e;f;g\n")
    open(os.path.join(landing, "transactions_02012024.txt"), "w").write("a;b;c;d;e;f;g\n")
    good = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, 1)}
    wh = Warehouse(spark, root)
    pipeline.run_batch(spark, wh, landing, DAYS[0], snapshots=good)
    empty = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, 1).where(F.lit(False))}
    try:
        pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=empty)
        raise AssertionError("expected EmptySnapshotError")
    except pipeline.EmptySnapshotError:
        pass
    assert wh.committed() == DAYS[0]                   # the failed batch left no commit


def test_streaming_ingest_available_now(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    archive, target, ckpt = (os.path.join(tmp_dir, x) for x in ("archive", "facts", "ckpt"))

    def put(day, ids):
        with open(os.path.join(landing, f"transactions_{day:%d%m%Y}.txt"), "w") as f:
            f.write("id;date;amt;card;type;result;term\n")
            for i in ids:
                f.write(f"{i};{day} 10:00:0{i % 10};1,5{i % 10};c{i % 3};P;SUCCESS;T1\n")

    put(DAYS[0], [1, 2, 3])
    put(DAYS[1], [3, 4])                               # trans_id 3 again: not appended twice
    stream = ingest.transactions_stream(spark, landing, archive, max_files=1)
    ingest.ingest_available(stream, ingest.append_transactions(target), ckpt)
    assert sorted(r.trans_id for r in spark.read.parquet(target).collect()) == ["1", "2", "3", "4"]
    put(DAYS[2], [5])
    stream = ingest.transactions_stream(spark, landing, archive, max_files=1)
    ingest.ingest_available(stream, ingest.append_transactions(target), ckpt)
    facts = spark.read.parquet(target)
    assert sorted(r.trans_id for r in facts.collect()) == ["1", "2", "3", "4", "5"]
    assert {r.load_dt for r in facts.collect()} == set(DAYS)
    archived = [n for _, _, fs in os.walk(archive) for n in fs]
    assert "transactions_01012024.txt" in archived     # archiving lags one micro-batch


def test_family_missing_on_a_date(spark, tmp_dir):
    # day 2 has a transactions file only: terminals and blacklist keep their
    # day-1 state, and the day-2 report still runs over it
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "dwh")
    os.makedirs(landing)
    write_landing(spark, landing)
    for d in DAYS[1:]:
        os.remove(os.path.join(landing, f"terminals_{d:%d%m%Y}.xlsx"))
        os.remove(os.path.join(landing, f"passport_blacklist_{d:%d%m%Y}.xlsx"))
    os.remove(os.path.join(landing, f"transactions_{DAYS[2]:%d%m%Y}.txt"))
    out = pipeline.run_pending(spark, landing, root, snapshots=readers(), archive=False)
    assert [o["batch"] for o in out] == DAYS[:2]
    assert len(out[0]["ran"]) == 7
    assert set(out[1]["ran"]) == {"transactions", "cards", "accounts", "clients", "fraud_report"}
    wh = Warehouse(spark, root)
    state = {r.table_name: r for r in wh.meta().collect()}
    assert state["terminals"].last_load_dt == DAYS[0]
    assert state["fraud_report"].max_update_dt == dt.datetime(2024, 1, 2)   # Q23: moves to the day
    # the day-2 report equals a recomputation over the stored state, with the
    # terminal history still the one loaded on day 1
    d = DAYS[1]
    dims = {n: wh.dim(n, state[n].last_load_dt, d) for n in ("terminals", *SOURCES)}
    exp = fraud.build_report(wh.facts("transactions", d), dims["terminals"], dims["cards"], dims["accounts"],
                             dims["clients"], wh.facts("passport_blacklist", d), report_from=d, report_to=d)
    got = wh.report().where(F.col("report_dt") == F.lit(d)).select(*fraud.REPORT_COLS)
    assert rows(got) == rows(exp)


def test_crash_before_commit_then_rerun(spark, tmp_dir):
    # batch 2 dies after writing its outputs but before the metadata commit;
    # running it again must give the same warehouse as an uninterrupted run
    def fresh(name):
        landing, root = os.path.join(tmp_dir, name, "landing"), os.path.join(tmp_dir, name, "dwh")
        os.makedirs(landing)
        write_landing(spark, landing)
        os.remove(os.path.join(landing, f"transactions_{DAYS[2]:%d%m%Y}.txt"))
        for fam in ("terminals", "passport_blacklist"):
            os.remove(os.path.join(landing, f"{fam}_{DAYS[2]:%d%m%Y}.xlsx"))
        return landing, Warehouse(spark, root)

    landing, wh = fresh("crash")
    pipeline.run_batch(spark, wh, landing, DAYS[0], snapshots=readers())
    real_commit = wh.commit
    def boom(state, taken, load):
        raise RuntimeError("executor lost before commit")
    wh.commit = boom
    try:
        pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=readers())
        raise AssertionError("expected the simulated crash")
    except RuntimeError:
        pass
    wh.commit = real_commit
    assert wh.committed() == DAYS[0]                       # readers still see batch 1 only
    pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=readers())

    landing2, clean = fresh("clean")
    pipeline.run_pending(spark, landing2, clean.root, snapshots=readers())
    assert wh.committed() == clean.committed() == DAYS[1]
    assert rows(wh.report()) == rows(clean.report())
    assert rows(wh.facts("transactions", DAYS[1])) == rows(clean.facts("transactions", DAYS[1]))
    state = {r.table_name: r for r in wh.meta().collect()}
    for name in ("terminals", *SOURCES):
        assert rows(wh.dim(name, state[name].last_load_dt, DAYS[1])) == \
            rows(clean.dim(name, state[name].last_load_dt, DAYS[1])), name


# ---- nothing is lost: late families, crashes, changed sources, foreign sessions ----

def _landing(spark, tmp_dir, name="x"):
    landing, root = os.path.join(tmp_dir, name, "landing"), os.path.join(tmp_dir, name, "dwh")
    os.makedirs(landing)
    return landing, Warehouse(spark, root)


def _put_tx(landing, day, ids, amt="1,50"):
    with open(os.path.join(landing, f"transactions_{day:%d%m%Y}.txt"), "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        f.writelines(f"{i};{day} 10:00:00;{amt};c1;P;SUCCESS;T1\n" for i in ids)


def _ids(wh):
    df = wh.facts("transactions")
    return sorted(r.trans_id for r in df.collect()) if df is not None else []


def test_family_arriving_after_others_of_its_date(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    cards = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, 1)}
    assert pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=cards)["ran"] == ["cards"]
    _put_tx(landing, DAYS[0], ["a"])       # an earlier date, and the committed date, of another family
    _put_tx(landing, DAYS[1], ["b"])
    out = pipeline.run_pending(spark, landing, wh.root, snapshots=cards)
    assert ["transactions" in o["ran"] for o in out] == [True, True] and not any("cards" in o["ran"] for o in out)
    assert _ids(wh) == ["a", "b"] and sorted(os.listdir(landing)) == ["archive"]


def test_file_older_than_its_own_target_is_reported(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    _put_tx(landing, DAYS[1], ["b"])
    pipeline.run_batch(spark, wh, landing, DAYS[1])
    _put_tx(landing, DAYS[0], ["a"])
    out = pipeline.run_batch(spark, wh, landing, DAYS[0])
    assert out["ran"] == [] and [os.path.basename(f) for f in out["late"]] == ["transactions_01012024.txt"]
    assert os.path.exists(out["late"][0]) and _ids(wh) == ["b"]


def test_half_written_commit_does_not_count(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    cards = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, _day_no(b))}
    pipeline.run_batch(spark, wh, landing, DAYS[0], snapshots=cards)
    before = rows(wh.dim("cards", DAYS[0], DAYS[0]))
    os.makedirs(os.path.join(wh.root, "meta", "load_id=2", "_temporary"))   # died inside the meta write
    os.makedirs(os.path.join(wh.root, "dims", "cards", "load_id=2", f"load_dt={DAYS[1]}", "part=heads"))
    assert wh.committed_id() == 1 and wh.committed() == DAYS[0]
    assert rows(wh.dim("cards", DAYS[0], DAYS[0])) == before
    assert "cards" in pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=cards)["ran"]
    assert wh.committed_id() == 2 and len(rows(wh.dim("cards", DAYS[1], DAYS[1]))) >= len(before)


def test_source_that_changed_before_the_rerun(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    _put_tx(landing, DAYS[0], ["a", "gone"])
    real = wh.commit
    wh.commit = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        pipeline.run_batch(spark, wh, landing, DAYS[0])
        raise AssertionError("expected the simulated crash")
    except RuntimeError:
        pass
    wh.commit = real
    assert _ids(wh) == []
    _put_tx(landing, DAYS[0], [])
    pipeline.run_batch(spark, wh, landing, DAYS[0])
    assert _ids(wh) == []                  # no row of the failed attempt is left


def test_session_in_static_overwrite_mode(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for d, i in zip(DAYS, "abc"):
            _put_tx(landing, d, [i])
            pipeline.run_batch(spark, wh, landing, d)
        stream_in, target = os.path.join(tmp_dir, "s_in"), os.path.join(tmp_dir, "s_facts")
        os.makedirs(stream_in)
        for d, i in zip(DAYS, "xyz"):
            _put_tx(stream_in, d, [i])
        s = ingest.transactions_stream(spark, stream_in, max_files=1)
        ingest.ingest_available(s, ingest.append_transactions(target), os.path.join(tmp_dir, "s_ckpt"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert _ids(wh) == ["a", "b", "c"]
    assert sorted(r.trans_id for r in spark.read.parquet(target).collect()) == ["x", "y", "z"]


def test_crash_between_commit_and_archiving(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    _put_tx(landing, DAYS[0], ["a"])
    real = wh.archive
    wh.archive = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        pipeline.run_batch(spark, wh, landing, DAYS[0])
        raise AssertionError("expected the simulated crash")
    except RuntimeError:
        pass
    wh.archive = real
    assert wh.committed() == DAYS[0] and _ids(wh) == ["a"]
    assert pipeline.run_batch(spark, wh, landing, DAYS[0])["ran"] == []
    assert os.listdir(os.path.join(landing, "archive")) == ["transactions_01012024.txt.backup"] and _ids(wh) == ["a"]


def test_quiet_day_leaves_a_dimension_as_it_is(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    cards = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, 1)}
    pipeline.run_batch(spark, wh, landing, DAYS[0], snapshots=cards)
    before = rows(wh.dim("cards", DAYS[0], DAYS[0]))
    old_rows = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, 1)
                .withColumn("update_dt", F.lit(dt.date(2000, 1, 1)))}
    _put_tx(landing, DAYS[1], ["a"])
    out = pipeline.run_batch(spark, wh, landing, DAYS[1], snapshots=old_rows)
    assert "transactions" in out["ran"] and out["quiet"] == ["cards"] and wh.committed() == DAYS[1]
    assert rows(wh.dim("cards", DAYS[0], DAYS[1])) == before


def test_staging_and_old_heads_go_after_the_commit(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    cards = {"cards": lambda spark, b: fx.card_source(spark, SF_SMALL, _day_no(b))}
    for d in DAYS[:2]:
        pipeline.run_batch(spark, wh, landing, d, snapshots=cards, keep_heads=1)
    assert wh._load_ids(wh.path("staging")) == []
    heads = [p for p, _, _ in os.walk(os.path.join(wh.root, "dims", "cards")) if p.endswith("part=heads")]
    assert len(heads) == 1 and "load_id=2" in heads[0]


def test_meta_columns_and_length_limits(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    _put_tx(landing, DAYS[0], ["a"])
    pipeline.run_batch(spark, wh, landing, DAYS[0])
    r = wh.meta().where("table_name = 'transactions'").first()
    assert r.schema_name == "ledgerwatch" and r.processed_dt is not None and r.last_load_dt == DAYS[0]
    _put_tx(landing, DAYS[1], ["x" * 12])
    try:
        pipeline.run_batch(spark, wh, landing, DAYS[1])
        raise AssertionError("expected a length error")
    except AssertionError:
        raise
    except Exception as e:
        assert "value too long for trans_id" in str(e)
    assert wh.committed() == DAYS[0]


def test_report_reads_the_partitions_of_two_days_only(spark, tmp_dir):
    landing, wh = _landing(spark, tmp_dir)
    for d in DAYS:
        _put_tx(landing, d, [f"t{d.day}"])
        pipeline.run_batch(spark, wh, landing, d)
    plan = pipeline.build_day_report(wh, pipeline._state(wh.meta()), DAYS[2])._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan.split("PartitionFilters")[1][:200]


def test_stream_keeps_files_of_one_date(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    target = os.path.join(tmp_dir, "facts")
    for part, i in (("a", "1"), ("b", "2")):
        with open(os.path.join(landing, f"transactions_{part}_01012024.txt"), "w") as f:
            f.write(f"h;h;h;h;h;h;h\n{i};2024-01-01 10:00:00;1,5;c;P;SUCCESS;T1\n")
    for ckpt in ("c1", "c2"):              # two micro-batches; then a second run replays both
        s = ingest.transactions_stream(spark, landing, max_files=1)
        ingest.ingest_available(s, ingest.append_transactions(target), os.path.join(tmp_dir, ckpt))
        assert sorted(r.trans_id for r in spark.read.parquet(target).collect()) == ["1", "2"]


def test_names_and_cells_without_a_date_are_errors(spark):
    from ledgerwatch.operators.incremental import stamp_batch_date
    from ledgerwatch.sources.workbook import cell_date
    df = spark.createDataFrame([("01.03.2021", "x.txt")], "c string, f string")
    for bad in (df.select(cell_date("c")), stamp_batch_date(df, "f")):
        try:
            bad.collect()
            raise AssertionError("expected an error")
        except AssertionError:
            raise
        except Exception as e:
            assert "not a date" in str(e) or "no date in file name" in str(e)


def test_a_file_delivered_again_is_kept_unless_it_is_the_same(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "dwh")
    os.makedirs(landing)
    path = os.path.join(landing, "transactions_01012024.txt")

    def put(ids):
        with open(path, "w") as f:
            f.write("id;date;amt;card;type;result;term\n")
            f.writelines(f"{i};2024-01-01 10:00:00;1,50;c1;P;SUCCESS;T1\n" for i in ids)

    put([1, 2])
    assert "transactions" in pipeline.run_pending(spark, landing, root)[0]["ran"]
    assert not os.path.exists(path)
    put([1, 2, 3, 4])                                  # other content: reported and left alone, each time
    for _ in range(2):
        out = pipeline.run_pending(spark, landing, root)[0]
        assert out["ran"] == [] and [p.rsplit("/", 1)[1] for p in out["late"]] == ["transactions_01012024.txt"]
        assert len(open(path).readlines()) == 5
    put([2, 9])                                        # other content of the same length
    assert pipeline.run_pending(spark, landing, root)[0]["late"] and os.path.exists(path)
    put([1, 2])                                        # the very file that was loaded
    out = pipeline.run_pending(spark, landing, root)[0]
    assert out["late"] == [] and out["ran"] == [] and not os.path.exists(path)
    assert sorted(r.trans_id for r in Warehouse(spark, root).facts("transactions").collect()) == ["1", "2"]


def test_a_name_with_an_impossible_date_stops_the_run(spark, tmp_dir):
    for name in ("transactions_01032021.txt", "transactions_99999999.txt", "notes_99999999.txt"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("x")
    try:
        pipeline.pending_batches(spark, tmp_dir)
        raise AssertionError("expected ValueError")
    except ValueError as e:
        assert "transactions_99999999.txt" in str(e)
    os.rename(os.path.join(tmp_dir, "transactions_99999999.txt"), os.path.join(tmp_dir, "other.txt"))
    assert [b["batch_dt"] for b in pipeline.pending_batches(spark, tmp_dir)] == [dt.date(2021, 3, 1)]
