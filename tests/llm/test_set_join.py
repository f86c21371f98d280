"""PartEnum set join: the signature guarantee, brute force on a hard fixture, and edge cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import set_join
from ledgerwatch.session import ship_package

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def _flat(sets):
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return np.concatenate([np.sort(s) for s in sets]).astype(np.uint64), first


@pytest.mark.parametrize("percent", [70, 85, 95])
def test_linked_sets_share_a_signature(percent):
    """Pairs that differ by just as much as a link allows, of all sizes and in both directions of size."""
    rng = np.random.default_rng(percent)
    sets, pairs = [], []
    for size in [1, 2, 3, 5, 8, 13, 14, 20, 40, 41, 77, 150, 300, 700, 2000] * 12:
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        worst = (100 - percent) * size // 100
        drop = int(rng.integers(0, worst + 1))
        # after dropping d of n members, a more may come in while 100 (n - d) >= percent (n + a)
        more = max(0, 100 * (size - drop) // percent - size)
        other = np.concatenate([base[drop:], rng.integers(0, 1 << 63, more, dtype=np.uint64)])
        if 100 * (size - drop) >= percent * (size + more) and len(other) and (drop or more):
            pairs.append((len(sets), len(sets) + 1))
            sets += [base, other]
    assert len(pairs) > 60
    h, first = _flat(sets)
    bands = set_join.Bands(percent)
    row, key = set_join.signatures(h, first, bands)
    assert (np.diff(row) >= 0).all()
    of = [set(key[row == i].tolist()) for i in range(len(sets))]
    assert all(of[a] & of[b] for a, b in pairs)


def test_sparse_sets_fall_back_to_the_next_seed():
    """Small sets have empty subsets in most partitions; all seeds and the empty signatures still find every link."""
    rng = np.random.default_rng(4)
    bands = set_join.Bands(85)
    sets = []
    for size in range(7, 60):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for drop in range((15 * size) // 100 + 1):
            sets += [base, base[drop:]]
    h, first = _flat(sets)
    row, key = set_join.signatures(h, first, bands)
    of = [set(key[row == i].tolist()) for i in range(len(sets))]
    assert all(len(sets[i]) == len(sets[i + 1]) or of[i] & of[i + 1] for i in range(0, len(sets), 2))


def _brute(rows, k=4, percent=85):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append(frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (x, _) in enumerate(rows):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return sorted((x, len(sets[i]), least[find(i)] if x is not None else None) for i, (x, _) in enumerate(rows) if x is not None) \
        + [(None, len(sets[i]), None) for i, (x, _) in enumerate(rows) if x is None]


def _rows():
    rng = random.Random(9)
    vocabulary = [f"wort{i}" for i in range(4000)]
    rows = []
    for group in range(14):
        size = rng.choice([6, 12, 30, 45, 80, 200, 500])
        base = [rng.choice(vocabulary) for _ in range(size)]
        rows.append(base)
        for _ in range(7):  # edits of all strengths around the bound
            words = list(base)
            for _ in range(rng.randrange(0, max(2, size // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            cut = rng.randrange(0, size // 6 + 1)
            rows.append(words[cut:] if rng.random() < 0.6 else words + [rng.choice(vocabulary) for _ in range(cut)])
    boiler = [f"fuss{i}" for i in range(60)]  # a passage that many texts share without being linked
    rows += [[rng.choice(vocabulary) for _ in range(60)] + boiler for _ in range(40)]
    # a chain: neighbours are linked, the ends are not
    long = [f"k{i}" for i in range(400)]
    rows += [long[12 * i:12 * i + 220] for i in range(12)]
    rows += [rows[0]] * 30  # exact copies
    rng.shuffle(rows)
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize("list_rows, block_rows", [(16, 512), (2, 3)])
def test_set_join_matches_brute_force(spark, monkeypatch, list_rows, block_rows):
    monkeypatch.setattr(set_join, "LIST_ROWS", list_rows)
    monkeypatch.setattr(set_join, "BLOCK_ROWS", block_rows)
    rows = _rows()
    got = set_join.join_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows)


def test_links_are_found_without_the_first_pairs(spark, monkeypatch):
    """The complete signatures alone find every link."""
    monkeypatch.setattr(set_join, "_first_pairs", lambda classes: classes.select(
        classes["node"].alias("a"), classes["node"].alias("b")).where("false"))
    rows = _rows()
    got = set_join.join_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows)


def test_pairs_of_a_group_grow_with_its_members(spark, monkeypatch):
    """All texts of a group are linked; the rows compared are no multiple of all their pairs."""
    counts, confirmed = [], set_join._confirmed

    def counting(pairs, *rest):
        counts.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(set_join, "_confirmed", counting)
    monkeypatch.setattr(set_join, "_first_pairs", lambda classes: classes.select(
        classes["node"].alias("a"), classes["node"].alias("b")).where("false"))
    rng, size = random.Random(5), 120
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(size):
        words = list(base)
        words[rng.randrange(200)] = f"neu{i}"
        rows.append((i, " ".join(words)))
    got = set_join.join_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component_id"] for r in got.collect()} == {0}
    assert 0 < sum(counts) < size * (size - 1) / 2 / 3


@pytest.mark.parametrize("block_rows", [512, 5])
def test_blocks_of_full_sets_alone_find_every_link(spark, monkeypatch, block_rows):
    """The finish on full sets needs none of the pairs before it."""
    monkeypatch.setattr(set_join, "LIST_ROWS", 1)
    monkeypatch.setattr(set_join, "BLOCK_ROWS", block_rows)
    none = lambda df, *_: df.select(df["node"].alias("a"), df["node"].alias("b")).where("false")
    monkeypatch.setattr(set_join, "_first_pairs", none)
    monkeypatch.setattr(set_join, "_open_pairs", none)
    rows = _rows()
    got = set_join.join_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows)


def test_sketches_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(8)
    for size in (1, 7, 60, 900):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        other = np.concatenate([base[size // 9:], rng.integers(0, 1 << 63, size // 5, dtype=np.uint64)])
        bits = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in set_join.sketches(*_flat([base, other]))]
        length = min(len(x) for x in bits)
        far = int(np.bitwise_count(set_join._folded(bits[0], length) ^ set_join._folded(bits[1], length)).sum())
        exact = len(np.setxor1d(base, other))
        assert exact / 2 <= far <= exact


def test_set_join_edges(spark):
    base = " ".join(f"wort{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "eins ZWEI"), (5, "Eins zwei"), (6, "eins  zwei\n"), (7, "Éins zwei"),
            (8, "éins zwei"), (9, base), (10, base + " ende"), (10, "other text of one id here"), (10, "other text of one id here"),
            (11, "long " * 60_000), (12, "long " * 9), (13, base.replace("wort1 ", "x ")), (None, base), (None, None),
            (14, "a\x1cb c"), (15, "a\x1cb C")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "n", "node", "keys", "label", "members", "copies", "least", "histogram", "slot", "key", "wanted", "component_id"):
        docs = docs.withColumn(name, F.lit(name))
    got = [tuple(r) for r in set_join.join_sets(docs).collect()]
    want = _brute(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert set_join.join_sets(docs.where("false")).count() == 0
    texts = docs.select(F.concat(F.lit("d"), "doc_id").alias("name"), F.col("text").alias("body"))
    named = set_join.join_sets(texts, id_col="name", text_col="body")
    assert named.columns == ["name", "n_shingles", "component_id"]
    assert {r["name"]: r["component_id"] for r in named.collect()}["d5"] == "d4"
