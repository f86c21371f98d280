"""Token counts of documents in flat, unindexed token files, by a separator scan.

A token file is a run of little-endian uint16 ids in which every document ends
with the end-of-document id; nothing tells where. Files are read in blocks of
``BLOCK_TOKENS`` by byte range, each block on its own: numpy finds the
separators, and the block reports the lengths between them, the first and the
last possibly parts of documents that cross its edges. A running maximum over
the blocks' last separators (a prefix scan over one small row per block) then
completes the first length of every block, also across blocks without any
separator, and a running count numbers the documents.

Files lie in the shared folder and are reached through Arrow's file systems
(local, HDFS, object stores); paths are URIs.

Defined cases: an empty file has no documents; ids after the last separator
are a document without an end (``ended`` false); null and empty texts are
written as documents of no tokens; repeated rows are documents of their own;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.spread import cut, shared_folder, text_batches
from ledgerwatch.llm.text import blocks
from ledgerwatch.llm.tokens import END, VOCABULARY, encoder, with_ends

BLOCK_TOKENS = 1 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _writer(folder: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, base = _open(folder)
        name = f"part-{context.partitionId():06d}.bin"
        draft = f"{base}/.{name}.{context.attemptNumber()}.{context.taskAttemptId()}"
        bpe, n = encoder(path), 0
        with fs.open_output_stream(draft) as out:
            for batch in batches:
                for lo, hi, data, offsets in blocks(batch.column(1)):
                    ids, _ = with_ends(*bpe.encode(data, offsets))
                    out.write(ids.astype("<u2").tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), pa.array([f"{folder}/{name}"] * (hi - lo), pa.string()),
                         pa.array(np.arange(n, n + hi - lo)), pa.array(np.full(hi - lo, 2 * len(ids) / (hi - lo)))],
                        names=["id", "file", "document", "bytes"])
                    n += hi - lo
        fs.move(draft, f"{base}/{name}")  # only whole files get the name; a repeated task writes the same bytes
    return run


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Write one flat file per partition into ``folder``; returns the key (id, file, document number)."""
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    text_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return cut(source.mapInArrow(_writer(folder, vocabulary), f"id {kind}, file string, document long, bytes double")
               .select("id", "file", "document"))


def list_files(folder: str) -> list[tuple[str, int]]:
    """(URI, bytes) of the token files of a folder."""
    fs, base = _open(folder)
    found = fs.get_file_info(pafs.FileSelector(base))
    return sorted((f"{folder}/{f.base_name}", f.size) for f in found if f.is_file and f.base_name.endswith(".bin"))


def separator_scan(ids: np.ndarray, end: int) -> tuple[np.ndarray, int]:
    """(lengths up to each separator, ids after the last one) of one block."""
    ends = np.flatnonzero(ids == end)
    return np.diff(ends, prepend=-1) - 1, len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids)


def _scanner(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = _open(file)
                start = block * BLOCK_TOKENS
                with fs.open_input_file(path) as f:
                    raw = f.read_at(min(2 * BLOCK_TOKENS, size - 2 * start), 2 * start)
                lengths, rest = separator_scan(np.frombuffer(raw, dtype="<u2"), end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int64()), pa.array([len(lengths)], pa.int64()),
                     pa.array([len(raw) // 2 + start - rest if len(lengths) else None], pa.int64()),
                     pa.array([len(raw) // 2 + start], pa.int64()), pa.array([lengths.tolist()], pa.list_(pa.int64()))],
                    names=["file", "block", "n", "after_last", "block_end", "lengths"])
    return run


def count_tokens(files: DataFrame, end: int = END) -> DataFrame:
    """(file, document, n_tokens, ended) of every document of ``files(file, bytes)``."""
    places = files.where("bytes > 1").select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 2) / (2 * BLOCK_TOKENS))))
        .alias("block"), F.col("bytes").alias("size"))
    scanned = cut(places.repartition("file", "block").mapInArrow(
        _scanner(end), "file string, block long, n long, after_last long, block_end long, lengths array<long>"))
    past = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = scanned.select(
        "file", "block", "n", "after_last", "block_end",
        F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"),
        F.coalesce(F.max("after_last").over(past), F.lit(0)).alias("open_from"))
    start = F.col("block") * BLOCK_TOKENS
    docs = scanned.select("file", "block", F.posexplode("lengths").alias("at", "length")) \
        .join(stitched.select("file", "block", "before", "open_from"), ["file", "block"]) \
        .select("file", (F.col("before") + F.col("at")).alias("document"),
                (F.col("length") + F.when(F.col("at") == 0, start - F.col("open_from")).otherwise(0)).alias("n_tokens"),
                F.lit(True).alias("ended"))
    rest = scanned.groupBy("file").agg(F.sum("n").alias("document"), F.max("block_end").alias("size"),
                                       F.coalesce(F.max("after_last"), F.lit(0)).alias("open_from")) \
        .where("size > open_from").select("file", "document", (F.col("size") - F.col("open_from")).alias("n_tokens"),
                                          F.lit(False).alias("ended"))
    return docs.unionByName(rest)


def count_document_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """Token counts of the documents from flat files written for them and scanned without the key.
    The files are deleted once the scan's result is checkpointed."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    key = write_token_files(docs, folder, vocabulary, id_col, text_col)
    counts = cut(count_tokens(spark.createDataFrame(list_files(folder), "file string, bytes long")))
    fs, base = _open(folder)
    fs.delete_dir(base)
    return key.join(counts, ["file", "document"]).select(F.col("id").alias(id_col), "file", "document", "n_tokens")
