"""Warehouse layout on shared storage (Parquet, no table format needed).

    <root>/facts/<name>/load_id=<n>/load_dt=<B>/[event_day=<D>/]  append-only facts
    <root>/dims/<name>/load_id=<n>/load_dt=<B>/part=closed/       versions closed by load n (never rewritten)
    <root>/dims/<name>/load_id=<n>/load_dt=<B>/part=heads/        head version of every key after load n
    <root>/report/load_id=<n>/report_dt=<D>/                      fraud report of day D
    <root>/loads/load_id=<n>/                                     what load n took: target, batch date, file
    <root>/meta/load_id=<n>/                                      whole load-metadata state after load n
    <root>/staging/load_id=<n>/<name>/                            the parsed input, read once from the source

A load is one run of one batch date, numbered from 1. Write protocol: an
attempt first clears everything under its own number, writes each output into
its own ``load_id`` folder, and writes the meta state last. A load counts as
committed only when its meta folder holds ``_SUCCESS``; readers see loads up to
the last committed one. A crashed attempt, also one that died inside the meta
write, is simply run again under the same number. No write depends on session
settings, and none touches another load's folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.columns import open_end, true_or_false
from ledgerwatch.schemas import BLACKLIST, REPORT, TRANSACTIONS, dim_schema, within_limits

META_STATE = T.StructType([T.StructField("schema_name", T.StringType(), True, {"varchar": 30}),
                           T.StructField("table_name", T.StringType(), True, {"varchar": 50}),
                           T.StructField("max_update_dt", T.TimestampNTZType()),
                           T.StructField("last_load_dt", T.DateType()),
                           T.StructField("processed_dt", T.TimestampType())])
LOADS = T.StructType([T.StructField("target", T.StringType()), T.StructField("batch_dt", T.DateType()),
                      T.StructField("file", T.StringType()), T.StructField("file_length", T.LongType()),
                      T.StructField("file_checksum", T.StringType())])
FACTS = {"transactions": TRANSACTIONS, "passport_blacklist": BLACKLIST}
EVENT_DAY = {"transactions": "trans_date"}   # facts stored by the day of this time
SCHEMA_NAME = "ledgerwatch"


def _with(schema: T.StructType, **more: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in more.items()]])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ---- paths and listing (driver-side metadata only) ----
    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _fs(self, path: str):
        return self._Path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        """Whether a path exists, on the file system that the path itself names."""
        return self._fs(path).exists(self._Path(path))

    def _names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(self._Path(path)) if s.isDirectory())

    def _load_ids(self, path: str) -> list[int]:
        return sorted(int(n.split("=", 1)[1]) for n in self._names(path) if n.startswith("load_id="))

    def _delete(self, path: str):
        if self.exists(path) and not self._fs(path).delete(self._Path(path), True):
            raise OSError(f"cannot delete {path}")

    # ---- loads ----
    def committed_id(self) -> int:
        """Number of the last committed load, 0 before any."""
        done = [n for n in self._load_ids(self.path("meta")) if self.exists(self.path("meta", f"load_id={n}", "_SUCCESS"))]
        return max(done, default=0)

    def committed(self) -> dt.date | None:
        """Latest batch date that any target has committed."""
        return self.meta().agg(F.max("last_load_dt")).first()[0]

    def begin(self) -> int:
        """Number of the next load, whatever an earlier attempt wrote under it cleared."""
        n = self.committed_id() + 1
        tops = [self.path("report"), self.path("loads"), self.path("meta"), self.path("staging")]
        tops += [self.path(kind, name) for kind in ("facts", "dims") for name in self._names(self.path(kind))]
        for top in tops:
            for stale in self._load_ids(top):
                if stale >= n:
                    self._delete(f"{top}/load_id={stale}")
        return n

    def housekeeping(self, load: int, keep_heads: int | None):
        """After a commit: staged inputs go, and all but the last ``keep_heads`` head copies of each dimension."""
        self._delete(self.path("staging", f"load_id={load}"))
        if keep_heads is None:
            return
        for name in self._names(self.path("dims")):
            top = self.path("dims", name)
            held = [f"{top}/load_id={n}/{d}/part=heads" for n in self._load_ids(top) if n <= load
                    for d in self._names(f"{top}/load_id={n}")]
            for old in [p for p in held if self.exists(p)][:-max(keep_heads, 1)]:
                self._delete(old)

    # ---- reads (of committed loads, or up to the given one) ----
    def _read(self, path: str, schema: T.StructType, upto: int | None) -> DataFrame | None:
        upto = self.committed_id() if upto is None else upto
        if not any(n <= upto for n in self._load_ids(path)):
            return None
        df = self.spark.read.schema(_with(schema, load_id=T.LongType())).parquet(path)
        return df.where(F.col("load_id") <= F.lit(upto)).drop("load_id")

    def meta(self) -> DataFrame:
        n = self.committed_id()
        if not n:
            return self.spark.createDataFrame([], META_STATE)
        return self.spark.read.schema(META_STATE).parquet(self.path("meta", f"load_id={n}"))

    def fingerprint(self, path: str) -> tuple[int, str]:
        """Length and checksum of a file: the sum of its line hashes, taken in tasks as the file may be large."""
        size = self._fs(path).getFileStatus(self._Path(path)).getLen()
        total = self.spark.read.text(path).agg(F.sum(F.xxhash64("value").cast("decimal(38,0)"))).first()[0]
        return size, str(total)

    def loads(self) -> DataFrame:
        """Target, batch date and file (name, length, checksum) of everything that committed loads took."""
        df = self._read(self.path("loads"), LOADS, None)
        return self.spark.createDataFrame([], LOADS) if df is None else df

    def facts(self, name: str, as_of: dt.date | None = None, upto: int | None = None,
              days: tuple[dt.date, dt.date] | None = None) -> DataFrame | None:
        """Stored facts, of batches up to ``as_of``; ``days`` bounds the event-day partitions that are read."""
        more = {"processed_dt": T.TimestampType(), "load_dt": T.DateType()}
        if name in EVENT_DAY:
            more["event_day"] = T.DateType()
        df = self._read(self.path("facts", name), _with(FACTS[name], **more), upto)
        if df is None:
            return None
        if as_of is not None:
            df = df.where(F.col("load_dt") <= F.lit(as_of))
        if days is not None and name in EVENT_DAY:
            df = df.where(F.col("event_day").between(F.lit(days[0]), F.lit(days[1])))
        return df.select(*FACTS[name].names)

    def dim(self, name: str, heads_at: dt.date | None, as_of: dt.date, heads_only: bool = False,
            keep_stamp: bool = False, upto: int | None = None) -> DataFrame | None:
        """History as of batch ``as_of``: closed versions up to it plus the
        heads written by batch ``heads_at`` (the dimension's last load)."""
        if heads_at is None:
            return None
        schema = _with(dim_schema(name), processed_dt=T.TimestampType(), load_dt=T.DateType(), part=T.StringType())
        df = self._read(self.path("dims", name), schema, upto)
        if df is None:
            return None
        heads = (F.col("part") == "heads") & (F.col("load_dt") == F.lit(heads_at))
        cond = heads if heads_only else (heads | ((F.col("part") == "closed") & (F.col("load_dt") <= F.lit(as_of))))
        return df.where(cond).select(*dim_schema(name).names, *(["processed_dt"] if keep_stamp else []))

    def report(self) -> DataFrame:
        """The stored report (empty, with its schema, before any row is written)."""
        df = self._read(self.path("report"), _with(REPORT, processed_dt=T.TimestampType()), None)
        return self.spark.createDataFrame([], REPORT) if df is None else df.select(*REPORT.names)

    # ---- writes, each into the load's own folder ----
    @staticmethod
    def _write(rows: DataFrame, path: str, *parts: str):
        w = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy(*parts) if parts else w).parquet(path)

    def stage(self, name: str, rows: DataFrame, load: int) -> DataFrame:
        """Write a batch's parsed input once (CSV parse, workbook decode, JDBC
        read) and return it read back from Parquet: later steps scan the staged
        copy, the lineage is cut, and a live source is read exactly once, so
        all steps see the same snapshot."""
        path = self.path("staging", f"load_id={load}", name)
        self._write(rows, path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def write_facts(self, name: str, rows: DataFrame, batch: dt.date, load: int, sort_by: str | None = None):
        out = within_limits(rows.select(*FACTS[name].names), FACTS[name]) \
            .withColumns({"processed_dt": F.current_timestamp(), "load_dt": F.lit(batch)})
        parts = ["load_dt"]
        if name in EVENT_DAY:
            out, parts = out.withColumn("event_day", F.to_date(EVENT_DAY[name])), [*parts, "event_day"]
            out = out.repartition(F.col("event_day"), F.pmod(F.xxhash64(*FACTS[name].names), F.lit(16)))
        if sort_by:
            out = out.sortWithinPartitions(*parts[1:], sort_by)
        self._write(out, self.path("facts", name, f"load_id={load}"), *parts)

    def write_dim(self, name: str, hist: DataFrame, batch: dt.date, load: int):
        head = true_or_false(F.col("effective_to") == open_end())
        out = within_limits(hist, dim_schema(name)).withColumn("part", F.when(head, "heads").otherwise("closed")) \
            .withColumn("load_dt", F.lit(batch))
        self._write(out, self.path("dims", name, f"load_id={load}"), "load_dt", "part")

    def write_report(self, report: DataFrame, load: int):
        out = within_limits(report, REPORT).withColumn("processed_dt", F.current_timestamp())
        self._write(out, self.path("report", f"load_id={load}"), "report_dt")

    def commit(self, state: list[tuple], taken: list[tuple], load: int):
        """``state``: (table, max_update_dt, last_load_dt) of every target; ``taken``: rows of ``loads``."""
        self._write(self.spark.createDataFrame(taken, LOADS).coalesce(1), self.path("loads", f"load_id={load}"))
        meta = self.spark.createDataFrame([(SCHEMA_NAME, *s) for s in state], T.StructType(META_STATE.fields[:4])) \
            .withColumn("processed_dt", F.current_timestamp())
        self._write(within_limits(meta, META_STATE).coalesce(1), self.path("meta", f"load_id={load}"))

    # ---- file archiving ----
    def archive(self, src: str, archive_dir: str, suffix: str = ".backup"):
        """Move a processed file to ``archive_dir/<name><suffix>``; when that
        already exists, delete the source (as the original does)."""
        s, d = self._Path(src), self._Path(archive_dir)
        fs = self._fs(src)
        if not fs.exists(d) and not fs.mkdirs(d):
            raise OSError(f"cannot create {archive_dir}")
        target = self._Path(d, s.getName() + suffix)
        if not (fs.delete(s, False) if fs.exists(target) else fs.rename(s, target)):
            raise OSError(f"cannot archive {src}")
