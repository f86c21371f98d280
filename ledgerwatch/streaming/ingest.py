"""Process each new dated file exactly once, then archive it.

This is Structured Streaming's file source run as a bounded job
(``trigger(availableNow=True)``): the checkpoint remembers which files were
taken, ``foreachBatch`` applies the batch with the same operators as the
daily pipeline, and ``cleanSource='archive'`` moves processed files to the
archive folder. (Spark archives a file one micro-batch after processing it,
and keeps the original name rather than adding a ``.backup`` suffix.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import facts
from ledgerwatch.operators.incremental import stamp_batch_date
from ledgerwatch.schemas import TRANSACTIONS_FILE
from ledgerwatch.sources.delimited import typed_transactions


def transactions_stream(spark: SparkSession, landing: str, archive_dir: str | None = None,
                        glob: str = "transactions_*.txt", max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(TRANSACTIONS_FILE).option("sep", ";").option("header", True)
         .option("pathGlobFilter", glob))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.csv(landing).select("*", F.col("_metadata.file_name").alias("__file"))
    return stamp_batch_date(typed_transactions(raw, "__file"), "__file").withColumnRenamed("__file", "src_file")


def append_transactions(target_path: str):
    """foreachBatch handler: append the micro-batch's absent trans_ids to the fact table.

    Rows are stored by source file (``src_file``), so files of one date, in one
    micro-batch or in several, never replace each other; a replayed file
    replaces exactly its own rows, and is checked against all other files'.
    The overwrite mode is set on the write itself.
    """
    def handle(batch: DataFrame, epoch_id: int):
        spark = batch.sparkSession
        names = [f for f in batch.schema.fields if f.name not in ("update_dt", "src_file")]
        schema = T.StructType([*names, T.StructField("load_dt", T.DateType()), T.StructField("src_file", T.StringType())])
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target_path)
        target = None
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            own = batch.select("src_file").distinct()
            target = spark.read.schema(schema).parquet(target_path).join(own, "src_file", "left_anti")
        new = facts.append_absent(target, batch, "trans_id")
        (new.withColumnRenamed("update_dt", "load_dt").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("src_file").parquet(target_path))
    return handle


def ingest_available(stream: DataFrame, handler, checkpoint: str):
    """Run the stream over everything available now, then stop."""
    q = (stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
