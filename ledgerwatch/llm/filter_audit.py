"""Filter interaction audit: what every filter of a chain removes, in every order, from one pass over the texts.

Whether a document fails a filter does not depend on the filters before it, so
a part of the corpus is described by counts of documents per set of failed
filters (a mask of one bit per filter). Spark makes these counts in one scan;
texts are never shuffled.

The audit then walks the subsets of active filters of a part in Gray-code order:
each step toggles one filter, adds one to (or takes one from) the counter of
active failures of every mask cell that holds it, and keeps the running
survivors, which change only where a counter leaves or reaches zero. The
survivors of all subsets (32 for five filters) are stored; every figure of every
order is a difference of two stored states.

A copy fails the duplicate filter if a smaller id has the identical text
anywhere in the table. Copies have equal masks otherwise, so they are counted
per (digest, part, label) first; ids are compared on these few counts, and a
text that fills a third of the table is no hot group.

Defined cases: null text counts as empty; a null part is the empty string; a
row with a null id is no copy of anything, and nothing is a copy of it; rows
repeated under one id with one text are no copies of each other; labels that
repeat for an id count as 1 if any is 1, null and missing labels as 0; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"


def text_filters(words: Column, text: Column) -> dict[str, Column]:
    """Failure conditions by letter, from the words and the null-free text."""
    count = F.size(words)
    return {
        "A": count < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * count,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_cells(docs: DataFrame, labels: DataFrame, filters: Callable[[Column, Column], dict[str, Column]] = text_filters,
               id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail exactly the filters of the mask. Bit i is
    the i-th letter of ``filters``; the last bit is the duplicate filter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text")).withColumn("words", F.array_remove(F.split("text", WORD_GAP), ""))
    conditions = list(filters(F.col("words"), F.col("text")).values())
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)), F.lit(0))
    copy = F.lit(1 << len(conditions))
    rows = read.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")) \
        .groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    # a null id matches no label: a key of its own deals such rows out
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("\u0000"), F.hex("digest"))))
    marked = labels.groupBy(F.col(id_col).cast("string").alias("label_key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).where("good or toxic")
    rows = rows.join(marked, F.col("key") == F.col("label_key"), "left").select(
        "id", "part", "mask", "digest", "n", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # per text: rows, rows of its least id in this group, rows without an id
    texts = rows.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(F.lit(0))).alias("n_null"))
    # one digest has at most four rows a part here
    texts = texts.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    stays = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(F.lit(0))
    split = F.explode(F.array(F.struct(F.col("mask").alias("mask"), stays.alias("n")),
                              F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - stays).alias("n"))))
    return texts.select("part", "good", "toxic", split.alias("cell")).groupBy("part", "cell.mask").agg(
        F.sum("cell.n").alias("n"), F.sum(F.when(F.col("good"), F.col("cell.n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("cell.n")).otherwise(F.lit(0))).alias("toxic"))


def gray_walk(counts: np.ndarray, n_filters: int) -> np.ndarray:
    """Survivors of every subset of active filters: ``counts[mask]`` rows of figures to ``states[subset]``.

    Subsets are visited in Gray-code order; ``active[mask]`` counts the active
    filters that the documents of a cell fail.
    """
    masks = np.arange(1 << n_filters)
    active = np.zeros(1 << n_filters, dtype=np.int64)
    now = counts.sum(axis=0)
    states = np.zeros_like(counts)
    states[0] = now
    subset = 0
    for step in range(1, 1 << n_filters):
        bit = (step & -step).bit_length() - 1
        subset ^= 1 << bit
        hit = (masks >> bit) & 1 == 1
        if subset >> bit & 1:
            now = now - counts[hit & (active == 0)].sum(axis=0)
            active[hit] += 1
        else:
            active[hit] -= 1
            now = now + counts[hit & (active == 0)].sum(axis=0)
        states[subset] = now
    return states


FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def order_table(counts: np.ndarray, letters: str) -> list[tuple]:
    """(order, step, *FIGURES) of every order of the filters; ``counts[mask]`` holds (n, good, toxic)."""
    k = len(letters)
    states, every = gray_walk(counts, k), (1 << k) - 1
    fails = [states[0, 0] - states[1 << i, 0] for i in range(k)]
    alone = [states[every ^ (1 << i), 0] - states[every, 0] for i in range(k)]
    rows, total = [], [0] * k
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            lost = states[before] - states[before | 1 << i]
            before |= 1 << i
            total[i] += int(lost[0])
            rows.append((order, step, i, states[before, 0], lost[0], fails[i] - lost[0], alone[i], lost[1], lost[2]))
    return [("".join(letters[j] for j in order), step, *map(int, rest), total[i]) for order, step, i, *rest in rows]


def _auditor(letters: str):
    kinds = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                       *[(f, pa.int64()) for f in FIGURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.zeros((1 << len(letters), 3), dtype=np.int64)
                for c in cells:
                    counts[c["mask"]] = c["n"], c["good"], c["toxic"]
                rows = [(part, *r) for r in order_table(counts, letters)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
    return run


def audit_filters(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE", **options) -> DataFrame:
    """One row per part, order of the filters and step, with ``FIGURES``."""
    cells = mask_cells(docs, labels, **options)
    # at most 2 ** len(letters) cells of a part come together
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return parts.mapInArrow(_auditor(letters), "part string, filter_order string, step int, "
                            + ", ".join(f"{f} long" for f in FIGURES))
