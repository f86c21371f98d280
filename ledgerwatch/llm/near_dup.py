"""Near-duplicate components by fast similarity sketching, banding and exact verification.

Sketch (after Dahlgaard, Knudsen and Thorup): a sketch has t bins. In round i
every shingle falls into a hashed bin with value (i, hash), a bin keeps its
least value, and a document stops once all its bins are filled. Rounds t to
2t - 1 use bin i - t for all shingles, so every bin is filled in the end.
Large documents need one or two rounds, O(size + t log t) in all instead of
O(size * t), and the share of equal bins is concentrated around the similarity.

1. Documents of one shingle set form a class; everything below is per class.
2. Bands of sketch bins are bucket keys. With 30 bands of 4 bins a pair of
   similarity 0.85 shares no band with probability 3e-10 (0.80: 1.4e-7).
3. Every bucket member is verified against the bucket's hub (one pair per
   member), and verified links are contracted to components.
4. Buckets still holding several components are finished exactly: small ones
   pair by pair, large ones in chunks whose pairs of chunks are compared inside
   a task with numpy and put out only links that join components.

Links are confirmed on full shingle sets: ``100 * |A & B| >= percent * |A | B|``.
No bucket is capped and no pair within a component is put out needlessly.

Defined cases: null and word-free texts have no shingles and stay alone; fewer
words than a shingle form one shingle; rows with a null id get a null
``component_id`` and stay; rows of one id with different texts are documents of
their own, each kept or dropped by its own text; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.bitmaps import slot_bitmap, with_slot_flag
from ledgerwatch.llm.components import connected_components
from ledgerwatch.llm.spread import arrow_batches, cut, join_stats, text_batches
from ledgerwatch.llm.text import as_binary, blocks, mix, words_of

ID_SLOTS = 1 << 25         # 4 MB bitmap
SMALL_BUCKET = 12          # pair by pair up to here, in chunks beyond: exact both ways
CHUNK_ROWS = 512
CHUNK_SHINGLES = 500_000
SET_ROWS = 128             # pairs of whole sets in an Arrow batch
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes of each row: (flat values, row offsets)."""
    words = words_of(data, offsets)
    row, h = words.shingles(k)
    first = np.searchsorted(row, np.arange(words.n_rows + 1))
    for i in np.flatnonzero(np.diff(first) > 1):
        h[first[i]:first[i + 1]].sort()
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    counts = np.bincount(row[keep], minlength=words.n_rows)
    return h[keep], np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def sketch(h: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """(rows, t) sketch of sets given as flat values and offsets; empty sets stay unfilled."""
    n = len(first) - 1
    out = np.full((n, t), _EMPTY, dtype=np.uint64)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(n), np.diff(first))
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * t):
        if not len(h):
            break
        m = mix(h, i + 1)
        spot = (m >> np.uint64(32)) % np.uint64(t) if i < t else np.full(len(h), i - t, dtype=np.uint64)
        np.minimum.at(flat, row * t + spot.astype(np.int64), (m & low) | np.uint64(i << 32))
        open_rows = np.unique(row) if i else np.flatnonzero(np.diff(first) > 0)
        full = np.zeros(n, dtype=bool)
        full[open_rows] = (out[open_rows] != _EMPTY).all(axis=1)
        if full.any():
            stay = ~full[row]
            h, row = h[stay], row[stay]
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketches.reshape(len(sketches), bands, rows)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64), 7), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for j in range(rows):
            key = mix(key * np.uint64(3) + parts[:, :, j], j + 1)
    return key.view(np.int64)


def set_names(h: np.ndarray, first: np.ndarray) -> pa.Array:
    """16-byte names of the sets: two independent sums of mixed members, and the size mixed in."""
    sums = []
    for seed in (101, 202):
        c = np.zeros(len(h) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(h, seed), out=c[1:])
            sums.append(mix(c[first[1:]] - c[first[:-1]] + np.diff(first).astype(np.uint64), seed))
    return as_binary(np.stack(sums, axis=1).reshape(-1), np.arange(len(first)) * 2)


def _sketcher(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in blocks(batch.column(1)):
                h, first = distinct_shingles(data, offsets, k)
                keys = band_keys(sketch(h, first, bands * rows), bands, rows)
                size = np.diff(first)
                off = np.concatenate(([0], np.cumsum(np.where(size > 0, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(size), set_names(h, first),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(keys[size > 0].reshape(-1)))],
                    names=["id", "n", "node", "keys"])
    return run


def _setter(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                h, first = distinct_shingles(data, offsets, k)
                yield pa.RecordBatch.from_arrays([set_names(h, first), as_binary(h, first)], names=["node", "members"])
    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column(2), batch.column(3)
            good = [_linked(np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64),
                            percent) for x, y in zip(xs, ys, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, type=pa.bool_()))
    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs, over the members that occur in two sets or more."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, where, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    keep = count[where] > 1
    column, owner = number[where][keep], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        out += part @ part.T
    return out


def _chunk_linker(percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_pylist()
        sets = [np.frombuffer(m, dtype=np.uint64) for m in table.column("members").to_pylist()]
        label = np.unique(np.array([x.hex() for x in table.column("label").to_pylist()]), return_inverse=True)[1]
        size = np.array([len(s) for s in sets])
        both = _common(sets)
        union = size[:, None] + size[None, :] - both
        hit = np.triu(100 * both.astype(np.float64) >= percent * union, 1) & (label[:, None] != label[None, :])
        root = list(range(int(label.max()) + 1 if len(label) else 0))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        a, b = [], []
        for i, j in np.argwhere(hit):
            p, q = find(label[i]), find(label[j])
            if p != q:
                root[p] = q
                a.append(nodes[i])
                b.append(nodes[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = pairs.join(sets.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b")
    two = one.join(sets.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a")
    return two.select("a", "b", "ma", "mb").mapInArrow(_verifier(percent), "a binary, b binary")


def _decided(docs: DataFrame, shingle: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n, node (name of its set), component_id, kept."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    sketched = cut(source.mapInArrow(_sketcher(shingle, bands, rows),
                                     f"id {kind}, n long, node binary, keys array<long>"))
    classes = cut(sketched.where("n > 0 and id is not null").groupBy("node", "n")
                  .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")))

    # buckets of two classes or more; the hub is the class of least name
    buckets = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = cut(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("s"), F.min("node").alias("hub"),
                                            F.sum("n").alias("weight")).where("s > 1"))
    members = cut(buckets.join(shared, "key"))
    wanted = members.select("node").distinct().join(classes, "node").select("least")
    slot = F.pmod(F.xxhash64("id"), F.lit(ID_SLOTS))
    bitmap = slot_bitmap(wanted.select(F.pmod(F.xxhash64("least"), F.lit(ID_SLOTS)).alias("slot")), "slot")
    sets = cut(with_slot_flag(source.where("id is not null").withColumn("slot", slot), "slot", bitmap, "wanted")
               .where("wanted").select("text").mapInArrow(_setter(shingle), "node binary, members binary")
               .join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))

    sized = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    hubs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"), F.col("n").alias("nb")) \
        .distinct().join(classes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").where(sized)
    with arrow_batches(docs.sparkSession, SET_ROWS):
        edges = cut(_verify(hubs.select("a", "b"), sets, percent))

    # buckets that still hold several components
    found = connected_components(edges)
    labelled = members.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = cut(labelled)
    open_keys = labelled.groupBy("key").agg((F.min("label") != F.max("label")).alias("open")).where("open") \
        .select("key").join(shared.where("s > 2").select("key"), "key", "left_semi")
    rest = cut(labelled.join(cut(open_keys), "key", "left_semi"))

    item = F.struct("node", "n", "label")
    lists = rest.where((F.col("s") <= SMALL_BUCKET) & (F.col("node") != F.col("hub"))) \
        .groupBy("key").agg(F.sort_array(F.collect_list(item)).alias("xs"))
    pairs = lists.select(F.explode(F.flatten(F.transform("xs", lambda x, i: F.transform(
        F.filter("xs", lambda y: (y["node"] > x["node"]) & (y["label"] != x["label"])
                 & (x["n"] * 100 >= y["n"] * percent) & (y["n"] * 100 >= x["n"] * percent)),
        lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))).alias("p")).select("p.a", "p.b").distinct()
    more = _verify(pairs, sets, percent)

    m = F.greatest(F.ceil(F.col("s") / CHUNK_ROWS), F.ceil(F.col("weight") / CHUNK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node", "key"), F.col("m")).cast("int")
    chunks = rest.where(F.col("s") > SMALL_BUCKET).withColumn("m", m).withColumn("own", own) \
        .select("key", "node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("other")) \
        .select("key", "node", "label", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"))
    blockwise = chunks.join(sets, "node").groupBy("key", "c1", "c2") \
        .applyInArrow(_chunk_linker(percent), "a binary, b binary")
    with arrow_batches(docs.sparkSession, SET_ROWS):
        late = cut(more.unionByName(blockwise).distinct())
    if not late.isEmpty():
        found = connected_components(edges.unionByName(late))

    linked = found.join(classes, "node")
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = classes.join(cut(linked.join(least, "label").select("node", "component_id")), "node", "left") \
        .select("node", "copies", F.coalesce("component_id", "least").alias("component_id"))
    done = join_stats(sketched.select("id", "n", "node"), of_class, ["node"], "copies", sketched.count(),
                      F.xxhash64("id"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return done.select("id", "n", "node", component.alias("component_id"),
                       F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 30, rows: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable over links), kept."""
    done = _decided(docs, shingle, percent, bands, rows, id_col, text_col)
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def _namer(k: int, text_at: int):
    """The rows as they come, each with the name of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(text_at)):
                names = set_names(*distinct_shingles(data, offsets, k))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, names], names=[*batch.schema.names, "__node"])
    return run


def kept_documents(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 30, rows: int = 4,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the rows that a smaller id of their component stands for.

    Rows of one id fall together unless their texts differ; the few ids with rows of both fates are told apart by set."""
    fates = cut(_decided(docs, shingle, percent, bands, rows, id_col, text_col).select(
        F.col("id").alias("__gone"), F.col("node").alias("__set"), "kept"))
    gone = fates.where("not kept").select("__gone").distinct()
    stay = docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    both = cut(fates.groupBy("__gone").agg(F.min("kept").alias("all"), F.max("kept").alias("any")).where("any and not all").select("__gone"))
    if both.isEmpty():
        return stay
    spared = cut(fates.where("kept").join(both, "__gone", "left_semi").select("__gone", "__set").distinct())
    mixed = docs.join(both, F.col(id_col) == F.col("__gone"), "left_semi").withColumn("__text", F.col(text_col).cast("string"))
    schema = T.StructType([*mixed.schema.fields, T.StructField("__node", T.BinaryType())])
    named = mixed.mapInArrow(_namer(shingle, len(docs.columns)), schema)
    told = named.join(spared, (F.col(id_col) == F.col("__gone")) & (F.col("__node") == F.col("__set")), "left_semi")
    return stay.unionByName(told.select(*docs.columns))
