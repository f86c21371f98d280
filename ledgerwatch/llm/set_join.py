"""Exact n-gram Jaccard join by PartEnum signatures.

Sets of similarity ``percent`` or more differ in at most
``(100 - percent) / (100 + percent) * (|x| + |y|)`` members. Sizes are cut into
bands; a set takes part in the band of its size and, if a larger partner can be
there, in the next one, so partners always meet in a band with one bound k on
their difference. In a band the feature domain is hashed into n1 first-level
partitions of n2 parts each, with n1 * (k2 + 1) > k: some first-level partition
holds at most k2 differences, hence some n2 - k2 of its parts agree entirely. The
signatures of a set are all subsets of n2 - k2 parts of all first-level partitions,
each hashed with the members in it: linked sets share a signature for certain.

A set's own bound is below k, so it needs only the first partitions that its
bound asks for. ``spare`` more of them make up for empty subsets, which many
unrelated sets would share: a set with no more than ``spare`` partitions that have
an empty subset leaves empty signatures out, any other one repeats the scheme with
another seed, and only in the last one gives out empty signatures too.

1. Documents of one set form a class; everything below is per class.
2. First links: the signatures of the first few partitions, every class against
   the class it shares most of them with; links are contracted to components.
3. All signatures, with components for classes: only signatures that span two
   components are open. Their members of different components are compared: short
   lists pair by pair, longer ones in pairs of blocks, which put out no more pairs
   than would join all components that look alike; these links are contracted too.
4. Blocks that still hold members that look alike, but are of different components,
   are finished on the full sets of these members and put out confirmed links, again
   no more than join components. So the rows of a signature grow with its members,
   not with their pairs.

Sets look alike by their sketches, parities of the members in hashed bins: sketches
differ in at most as many bins as the sets do in members. All links are confirmed
on the full sets: ``100 * |A & B| >= percent * |A | B|``.

No signature is capped. Texts are not shuffled.

Defined cases: null and word-free texts have no shingles and stay alone; fewer
words than a shingle form one shingle; rows with a null id get a null
``component_id`` and link nothing; rows of one id with different texts are
documents of their own; an empty table gives an empty result; only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.bitmaps import slot_bitmap, with_slot_flag
from ledgerwatch.llm.components import connected_components
from ledgerwatch.llm.near_dup import CHUNK_SHINGLES, _chunk_linker, distinct_shingles, set_names
from ledgerwatch.llm.spread import arrow_batches, cut, join_stats, text_batches
from ledgerwatch.llm.text import as_binary, blocks, mix

PARTS = 2              # n2, second-level partitions
DIRTY = 1              # k2, of which so many may differ
SEEDS = 4
RARELY = 1.3           # standard deviations: one set in ten has more sparse partitions than are spare
COARSE = 4             # first-level partitions of the first links
ID_SLOTS = 1 << 25     # 4 MB bitmap
KEY_SLOTS = 1 << 27    # 16 MB bitmap
LIST_ROWS = 16         # members of a signature compared as a list; in pairs of blocks beyond
BLOCK_ROWS = 512
SET_ROWS = 128         # pairs of whole sets in an Arrow batch


class Bands:
    """Size bands of a similarity bound with their partition counts."""

    def __init__(self, percent: int, parts: int = PARTS, dirty: int = DIRTY, largest: int = 1 << 31):
        self.percent, self.parts, self.dirty = percent, parts, dirty
        self.subsets = list(combinations(range(parts), parts - dirty))
        lows, low = [], 1
        while low <= largest:
            lows.append(low)
            low = max(low, low * 10_000 // (percent * percent)) + 1
        self.low = np.array(lows + [low], dtype=np.int64)
        self.high = np.array(lows[1:] + [low], dtype=np.int64) - 1
        self.high = np.append(self.high, self.high[-1])
        self.bound = (100 - percent) * 2 * self.high // (100 + percent)
        need = -(-(self.bound + 1) // (dirty + 1))
        self.spare = np.array([self._spare(int(n), -(-int(lo) * percent // 100)) for n, lo in zip(need, self.low)], dtype=np.int64)
        self.first_level = need + self.spare

    def _spare(self, need: int, size: int) -> int:
        """Least number of spare partitions (of a grid of numbers) for which sets of the least size rarely have more sparse ones."""
        spare = np.unique(np.concatenate(([0], np.geomspace(1, 2 + need // 4, 200).astype(np.int64))))
        n1 = need + spare
        mean = n1 * np.minimum(1.0, len(self.subsets) * np.exp(-size * (self.parts - self.dirty) / (n1 * self.parts)))
        late = (spare + 0.5 - mean) / np.sqrt(np.maximum(mean, 1e-9))
        enough = late >= RARELY
        return int(spare[np.argmax(enough) if enough.any() else np.argmax(late)])

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1

    def needed(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        """First-level partitions that a set of this size gives out in a band."""
        partner = np.minimum(self.high[band], 100 * size // self.percent)
        bound = (100 - self.percent) * (size + partner) // (100 + self.percent)
        return np.minimum(-(-(bound + 1) // (self.dirty + 1)) + self.spare[band], self.first_level[band])


@lru_cache(maxsize=4)
def bands_of(percent: int) -> Bands:
    return Bands(percent)


def _round(h, first, rows, band, take, bands: Bands, seed: int, empties: bool):
    """Signatures of ``rows`` in their ``band`` under one seed: (position in rows, key, sparse partitions of each)."""
    size = np.diff(first)[rows]
    base = np.concatenate(([0], np.cumsum(take * bands.parts)))
    element = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - first[rows], size)
    at, values = np.repeat(np.arange(len(rows)), size), h[element]
    spot = mix(values, 1000 + seed)
    level1 = ((spot >> np.uint64(20)) % bands.first_level[band].astype(np.uint64)[at]).astype(np.int64)
    inside = level1 < take[at]
    level2 = (spot[inside] & np.uint64(0xFFFFF)) % np.uint64(bands.parts)
    cell = base[at[inside]] + level1[inside] * bands.parts + level2.astype(np.int64)
    sums, counts = np.zeros(base[-1], dtype=np.uint64), np.bincount(cell, minlength=base[-1]).reshape(-1, bands.parts)
    np.add.at(sums, cell, mix(values[inside], 77))
    sums = sums.reshape(-1, bands.parts)
    owner = np.repeat(np.arange(len(rows)), take)
    number = (np.arange(len(owner)) - np.repeat(np.cumsum(take) - take, take)).astype(np.uint64)
    keys, full = [], []
    with np.errstate(over="ignore"):
        name = mix(number + (band[owner].astype(np.uint64) << np.uint64(48)), 5 + seed)
        for i, chosen in enumerate(bands.subsets):
            members = sums[:, list(chosen)].sum(axis=1, dtype=np.uint64)
            keys.append(mix(members + name * np.uint64(3), 11 + i))
            full.append(counts[:, list(chosen)].sum(axis=1) > 0)
    keys, full = np.stack(keys, axis=1), np.stack(full, axis=1)
    sparse = np.bincount(owner[~full.all(axis=1)], minlength=len(rows))
    give = full | (empties & (sparse > bands.spare[band])[owner][:, None])
    return np.repeat(owner, len(bands.subsets))[give.reshape(-1)], keys.reshape(-1)[give.reshape(-1)], sparse


def signatures(h: np.ndarray, first: np.ndarray, bands: Bands, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every set's signatures, by row; ``most`` keeps the first partitions of the first seed only."""
    size = np.diff(first)
    own = bands.of(size)
    rows_out, keys_out = [], []
    for step in (0, 1):
        band = own + step
        rows = np.flatnonzero((size > 0) & (bands.bound[band] > 0)
                              & ((step == 0) | (100 * size >= bands.percent * bands.low[band])))
        for seed in range(1 if most else SEEDS):
            if not len(rows):
                break
            take = bands.needed(size[rows], band[rows])
            take = np.minimum(take, most) if most else take
            at, key, sparse = _round(h, first, rows, band[rows], take, bands, seed, not most and seed == SEEDS - 1)
            rows_out.append(rows[at])
            keys_out.append(key)
            rows = rows[sparse > bands.spare[band[rows]]]
    if not rows_out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    row, key = np.concatenate(rows_out), np.concatenate(keys_out)
    order = np.argsort(row, kind="stable")
    return row[order], key[order].view(np.int64)


def sketches(h: np.ndarray, first: np.ndarray) -> pa.Array:
    """One bit string per set: parities of its members by hashed bin, with a power of two of bins, two to four a member."""
    size = np.diff(first)
    bins = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(size, 1) * 2)).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(bins)))
    row = np.repeat(np.arange(len(size)), size)
    cell = base[row] + (mix(h, 303) & (bins[row] - 1).astype(np.uint64)).astype(np.int64)
    return as_binary(np.packbits((np.bincount(cell, minlength=base[-1]) & 1).astype(np.uint8)), base // 8)


def _folded(bits: np.ndarray, length: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, length), axis=0)


def _allowed(n_a, n_b, percent: int):
    return (100 - percent) * (n_a + n_b) // (100 + percent)


def _list(row: np.ndarray, key: np.ndarray, n_rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n_rows + 1)).astype(np.int32)), pa.array(key))


def _sketcher(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                h, first = distinct_shingles(data, offsets, k)
                row, key = signatures(h, first, bands_of(percent), COARSE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), set_names(h, first), sketches(h, first),
                     _list(row, key, hi - lo)], names=["id", "n", "node", "bits", "keys"])
    return run


def _signer(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(0)):
                h, first = distinct_shingles(data, offsets, k)
                row, key = signatures(h, first, bands_of(percent))
                yield pa.RecordBatch.from_arrays([set_names(h, first), _list(row, key, hi - lo)], names=["node", "keys"])
    return run


def _setter(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                h, first = distinct_shingles(data, offsets, k)
                yield pa.RecordBatch.from_arrays([set_names(h, first), as_binary(h, first)], names=["node", "members"])
    return run


def _sifter(percent: int):
    """Pairs (a, b, na, nb, ha, hb) whose sketches differ by no more than linked sets may."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            allowed = _allowed(batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                length = min(len(x), len(y))
                good[i] = np.bitwise_count(_folded(x, length) ^ _folded(y, length)).sum(dtype=np.int64) <= allowed[i]
            yield batch.select([0, 1]).filter(pa.array(good))
    return run


def _alike(table: pa.Table, root: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a pair of blocks with the later ones of another root that look like it, nearest first.
    ``root`` may change in between."""
    own, size = np.array(table.column("own").to_pylist()), np.array(table.column("n").to_pylist(), dtype=np.int64)
    raw = [np.frombuffer(x, dtype=np.uint64) for x in table.column("bits").to_pylist()]
    length = min(len(x) for x in raw)
    grid = np.stack([_folded(x, length) for x in raw])
    inner = len(set(own.tolist())) == 1
    for i in range(len(raw) - 1):
        later = np.flatnonzero((root[i + 1:] != root[i]) & (inner | (own[i + 1:] != own[i]))) + i + 1
        far = np.bitwise_count(grid[later] ^ grid[i]).sum(axis=1, dtype=np.int64)
        near = far <= _allowed(size[i], size[later], percent)
        if near.any():
            yield i, later[near][np.argsort(far[near], kind="stable")]


def _labels(table: pa.Table) -> np.ndarray:
    return np.unique(np.array([x.hex() for x in table.column("label").to_pylist()]), return_inverse=True)[1]


def _block_joiner(percent: int):
    """Pairs of members of a pair of blocks that look alike, as many as join the components that they are of."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")  # other signatures with these members then put out the same pairs
        nodes, root = table.column("node").to_pylist(), _labels(table)
        a, b = [], []
        for i, near in _alike(table, root, percent):
            new, at = np.unique(root[near], return_index=True)
            a += [nodes[i]] * len(at)
            b += [nodes[j] for j in near[at]]
            root[np.isin(root, new)] = root[i]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return run


def _block_sifter(percent: int):
    """The members of a pair of blocks that look like one of another component."""
    def run(table: pa.Table) -> pa.Table:
        wanted = np.zeros(table.num_rows, dtype=bool)
        for i, near in _alike(table, _labels(table), percent):
            wanted[i] = wanted[near] = True
        return table.select(["key", "c1", "c2", "node", "label"]).filter(pa.array(wanted))
    return run


def _confirmer(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(good))
    return run


def _sets(nodes: DataFrame, classes: DataFrame, source: DataFrame, shingle: int) -> DataFrame:
    """(node, members) of the classes named by ``nodes``, whose names are distinct."""
    slot = F.pmod(F.xxhash64("id"), F.lit(ID_SLOTS))
    wanted = nodes.join(classes.select("node", "least"), "node").select(F.pmod(F.xxhash64("least"), F.lit(ID_SLOTS)).alias("slot"))
    sets = with_slot_flag(source.where("id is not null").withColumn("slot", slot), "slot", slot_bitmap(wanted, "slot"), "wanted") \
        .where("wanted").select("text").mapInArrow(_setter(shingle), "node binary, members binary")
    return sets.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, classes: DataFrame, source: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The links among candidate pairs (a, b): sifted by sketches, then confirmed on full sets."""
    spark = pairs.sparkSession
    side = classes.select("node", "n", "bits")
    wide = pairs.join(side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ha")), "a") \
        .join(side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("hb")), "b") \
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    likely = cut(wide.select("a", "b", "na", "nb", "ha", "hb").mapInArrow(_sifter(percent), "a binary, b binary"))
    nodes = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    sets = _sets(nodes, classes, source, shingle)
    full = likely.join(sets.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b") \
        .join(sets.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a")
    with arrow_batches(spark, SET_ROWS):
        return cut(full.select("a", "b", "ma", "mb").mapInArrow(_confirmer(percent), "a binary, b binary"))


def _first_pairs(classes: DataFrame) -> DataFrame:
    """Every class with the class, of those that are least under a coarse signature, with which it shares most."""
    coarse = classes.select("node", F.explode("keys").alias("key"))
    shared = coarse.groupBy("key").agg(F.count(F.lit(1)).alias("s"), F.min("node").alias("hub")).where("s > 1")
    met = coarse.join(shared, "key").where("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("times"))
    return met.groupBy("node").agg(F.max_by("hub", F.struct("times", "hub")).alias("a")).select("a", F.col("node").alias("b"))


def _spanning(members: DataFrame) -> DataFrame:
    """The keys whose members are of two components or more."""
    return members.select("key", F.xxhash64("label").alias("mark")).groupBy("key") \
        .agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo <> hi").select("key")


def _open_members(signed: DataFrame) -> DataFrame:
    """(key, node, n, label, s, weight) of the signatures that span components, with their members and the sum of sizes;
    ``signed``: node, n, label, keys."""
    spot = F.pmod(F.col("key"), F.lit(KEY_SLOTS))
    every = signed.select("node", "n", "label", F.explode("keys").alias("key"))
    open_keys = cut(_spanning(every))
    bitmap = slot_bitmap(open_keys.select(spot.alias("slot")), "slot")
    members = cut(with_slot_flag(every.withColumn("slot", spot), "slot", bitmap, "wanted").where("wanted")
                  .select("key", "node", "n", "label").join(open_keys, "key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("s"), F.sum("n").alias("weight"))
    return cut(members.join(sizes, "key"))


def _dealt(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of long signatures, once for each pair of blocks (c1, c2) that they take part in."""
    m = F.greatest(F.ceil(F.col("s") / BLOCK_ROWS), F.ceil(F.col("weight") / CHUNK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("m")).cast("int")
    return members.where(F.col("s") > LIST_ROWS).withColumn("m", m).withColumn("own", own) \
        .join(classes.select("node", "bits"), "node") \
        .select("key", "node", "n", "label", "bits", "own", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("other")) \
        .select("key", "node", "n", "label", "bits", "own", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"))


def _open_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components: all of short lists, of longer ones those that join what looks alike."""
    item = F.struct("node", "n", "label")
    lists = members.where(F.col("s") <= LIST_ROWS).groupBy("key").agg(F.sort_array(F.collect_list(item)).alias("xs"))
    few = lists.select(F.explode(F.flatten(F.transform("xs", lambda x: F.transform(
        F.filter("xs", lambda y: (y["node"] > x["node"]) & (y["label"] != x["label"])
                 & (x["n"] * 100 >= y["n"] * percent) & (y["n"] * 100 >= x["n"] * percent)),
        lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))).alias("p")).select("p.a", "p.b")
    many = _dealt(members, classes).groupBy("key", "c1", "c2").applyInArrow(_block_joiner(percent), "a binary, b binary")
    return few.unionByName(many).distinct()


def _block_links(members: DataFrame, found: DataFrame, classes: DataFrame, source: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The links that long signatures still lack, as many as join components; ``found`` holds the labels by now."""
    named = cut(members.where(F.col("s") > LIST_ROWS).drop("label").join(found, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    dealt = _dealt(named.join(_spanning(named), "key", "left_semi"), classes)
    alike = cut(dealt.groupBy("key", "c1", "c2").applyInArrow(
        _block_sifter(percent), "key long, c1 int, c2 int, node binary, label binary"))
    sets = _sets(alike.select("node").distinct(), classes, source, shingle)
    return cut(alike.join(sets, "node").groupBy("key", "c1", "c2").applyInArrow(_chunk_linker(percent), "a binary, b binary").distinct())


def join_sets(docs: DataFrame, shingle: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable over links)."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    sketched = cut(source.mapInArrow(_sketcher(shingle, percent),
                                     f"id {kind}, n long, node binary, bits binary, keys array<long>"))
    classes = cut(sketched.where("n > 0 and id is not null").groupBy("node", "n")
                  .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"),
                       F.first("bits").alias("bits"), F.first("keys").alias("keys")))

    links = _confirmed(_first_pairs(classes), classes, source, shingle, percent)
    found = connected_components(links)

    labelled = classes.join(found, "node", "left").select("node", "n", F.coalesce("label", "node").alias("label"))
    signed = cut(source.where("id is not null").select("text").mapInArrow(_signer(shingle, percent), "node binary, keys array<long>")
                 .groupBy("node").agg(F.first("keys").alias("keys")).join(labelled, "node"))
    members = _open_members(signed)
    late = _confirmed(_open_pairs(members, classes, percent), classes, source, shingle, percent)
    if not late.isEmpty():
        links = links.unionByName(late)
        found = connected_components(links)
    last = _block_links(members, found, classes, source, shingle, percent)
    if not last.isEmpty():
        found = connected_components(links.unionByName(last))

    linked = found.join(classes, "node")
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = classes.join(cut(linked.join(least, "label").select("node", "component_id")), "node", "left") \
        .select("node", "copies", F.coalesce("component_id", "least").alias("component_id"))
    done = join_stats(sketched.select("id", "n", "node"), of_class, ["node"], "copies", sketched.count(), F.xxhash64("id"))
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                       F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
