"""Operators against brute force, round trips and held-out accuracy; edge cases of every operator."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import (chat, decontaminate, exact_dedup, mixing, near_dup, packing, quality, queries, sharding,
                             token_files, tokens, toxicity)
from ledgerwatch.llm.components import connected_components
from ledgerwatch.llm.spread import running_start
from ledgerwatch.llm.text import blocks, words_of
from ledgerwatch.session import ship_package

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = " ".join(f"wort{i}" for i in range(60))
ROWS = [(1, "Alpha beta GAMMA é", "a"), (2, "alpha beta gamma é", "a"), (3, "alpha beta gamma É", None), (4, None, "b"),
        (5, "", "b"), (6, " \t\n ", "b"), (7, BASE, "a"), (8, BASE + " ende", "a"), (9, "eins zwei", "c"),
        (10, "eins zwei", "c"), (11, "long " * 30000, "a"), (None, BASE, "a"), (None, None, None), (12, "x", "a"),
        (12, "x", "a")]


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns named like the operators' own."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    for name in ("id", "score", "kept", "size", "shard", "label", "n", "node", "keys", "start", "h", "slot", "bytes",
                 "full", "win", "key", "taken", "count", "features", "turn"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="module")
def empty(edge):
    return edge.where("false")


def collect(df):
    return [tuple(r) for r in df.collect()]


# ---- helpers -----------------------------------------------------------------

def test_words_match_the_regex():
    texts = [t or "" for _, t, _ in ROWS] + ["a\x0bb\x0cc\x1cd", "ä ö ü"]
    for lo, _, data, offsets in blocks(pa.array(texts), limit=64):
        words = words_of(data, offsets)
        for i in range(words.n_rows):
            span = slice(words.first[i], words.first[i + 1])
            found = [words.data[a:b].tobytes().decode() for a, b in zip(words.start[span], words.end[span])]
            assert found == WORD.findall(texts[lo + i].translate(LOWER))


def test_word_hash_depends_on_the_word_alone():
    words = words_of(*[x for x in next(blocks(pa.array(["b aa b", "aa", "ab ba"])))[2:]])
    b1, aa1, b2, aa2, ab, ba = words.hash.tolist()
    assert b1 == b2 and aa1 == aa2 and len({b1, aa1, ab, ba}) == 4


def test_running_start(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), F.lit(2).cast("long").alias("w"),
                                 F.shiftrightunsigned(F.xxhash64("id"), 4).alias("h"))
    got = collect(running_start(df, ["g"], "h", ["id"], "w", 500, "at").select("g", "at"))
    for g in range(3):
        mine = sorted(a for k, a in got if k == g)
        assert mine == list(range(0, 2 * len(mine), 2))


def test_components_of_chains_and_stars(spark):
    name = lambda i: hashlib.md5(str(i).encode()).digest()
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    df = spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in edges], "a binary, b binary")
    got = {bytes(n): bytes(x) for n, x in collect(connected_components(df))}
    assert len({got[name(i)] for i in range(41)}) == 1 and len({got[name(i)] for i in range(100, 130)}) == 1
    assert got[name(0)] != got[name(100)] and name(200) not in got
    assert connected_components(df.where("false")).count() == 0


# ---- op1 ---------------------------------------------------------------------

def test_fingerprints_choose_layouts(spark):
    assert chat.layout_of(["turn", "role", "text", "extra", "id"]).name == "turn_rows"
    one = spark.createDataFrame([(1, [("human", "a"), ("gpt", None)])],
                                "conv_id long, conversations array<struct<`from`: string, value: string>>")
    assert collect(chat.canonical_turns(one)) == [(1, 0, "user", "a"), (1, 1, "assistant", "")]
    two = spark.createDataFrame([(1, "do", "with", "out"), (2, "do", None, "out")],
                                "conv_id long, instruction string, input string, output string")
    assert sorted(collect(chat.canonical_turns(two))) == [
        (1, 0, "user", "do\n\nwith"), (1, 1, "assistant", "out"), (2, 0, "user", "do"), (2, 1, "assistant", "out")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, nothing string"))


def test_json_records_are_mapped_one_by_one(spark):
    raw = ['{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": null}]}',
           '{"prompt": "p", "completion": "c", "more": 3}', '{"strange": 1}', "no json", None]
    df = spark.createDataFrame(list(enumerate(raw)), "conv_id long, js string")
    got = collections.defaultdict(list)
    for r in chat.canonical_turns_json(df, "conv_id", "js").collect():
        got[r["conv_id"]].append((r["layout"], r["role"], r["text"]))
    assert got[0] == [("messages", "user", "a"), ("messages", "assistant", "")]
    assert got[1] == [("prompt_completion", "user", "p"), ("prompt_completion", "assistant", "c")]
    assert got[2][0][:2] == ("unknown", "unknown") and got[3] == [("unknown", "unknown", "no json")] and len(got[4]) == 1


def test_json_rows_keep_their_own_turn(spark):
    raw = ['{"turn": 2, "role": "assistant", "text": "a"}', '{"turn": 1, "role": "user", "text": "z"}',
           '{"turn": "3", "role": "user", "text": "b"}', '{"turn": "x", "role": "user", "text": "c"}']
    df = spark.createDataFrame([(1, r) for r in raw], "conv_id long, js string")
    turns = chat.canonical_turns_json(df, "conv_id", "js")
    assert {r["text"]: r["turn"] for r in turns.collect()} == {"a": 2, "z": 1, "b": 3, "c": None}
    got = chat.read_back(chat.format_turns(turns)).first()
    assert got["turns_sha256"] == hashlib.sha256(b"user\nc\nuser\nz\nassistant\na\nuser\nb\n").hexdigest()


@pytest.mark.parametrize("text", ["", "\\### Assistant: </turn> ok", "\\", "a\\", "</turn>\n", "### User:\n", "é<#\\\\#"])
def test_turns_round_trip(spark, text):
    df = spark.createDataFrame([(1, 0, "assistant", text), (1, 1, "we:ird\n#role", text), (1, 2, None, None)],
                               "conv_id long, turn long, role string, text string")
    rows = chat.format_turns(chat.canonical_turns(df)).orderBy("turn").collect()
    assert [chat.parse_segment(r["formatted"]) for r in rows] == [("assistant", text), ("we:ird\n#role", text), ("", "")]
    body = rows[0]["formatted"][rows[0]["loss_from"]:rows[0]["loss_to"]]
    assert not re.search(r"(?<!\\)(?:\\\\)*[#<]", body) and rows[1]["loss_from"] is None


def test_read_back_of_nulls_ties_and_long_texts(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 5, "assistant", "x<" * 50000),
            (1, 5, "assistant", "x<" * 50000), (None, 0, "assistant", None), (3, 1, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("size", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(chat.canonical_turns(df))).collect()}
    said = "system\ns\nuser\na\nuser\nb\n" + ("assistant\n" + "x<" * 50000 + "\n") * 2
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[1]["n_turns"] == 5
    assert got[1]["loss_chars"] == 200000 and got[None]["loss_chars"] == 0 and got[3]["loss_chars"] == 0
    assert got[3]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert chat.read_back(chat.format_turns(chat.canonical_turns(df.where("false")))).count() == 0


# ---- op2, op3 ----------------------------------------------------------------

@pytest.mark.parametrize("query, label, least", [("op2_quality", "quality", 0.97), ("op3_toxicity", "toxic", 0.9)])
def test_classifiers_on_the_held_out_fold(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.QUERIES[query](spark, sf).collect()}
    assert len(got) == 1000
    labels = [(r["doc_id"], r[label]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= (0.3 if label == "quality" else 0.5))
    test = [(i, y) for i, y in labels if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == y for i, y in test) / len(test) >= least


@pytest.mark.parametrize("score, label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifier_edges(spark, edge, empty, score, label):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 1), (9, 0), (12, None), (None, 1), (1, 1)], f"doc_id long, {label} int")
    got = collect(score(edge, labels).select("doc_id", "held_out", "score"))
    assert sorted(map(str, (g[0] for g in got))) == sorted(map(str, (r[0] for r in ROWS)))
    assert all(0 <= s <= 1 for _, _, s in got) and all(h for i, h, _ in got if i is None)
    assert len({s for i, _, s in got if i in (4, 5, 6)}) == 1
    assert score(empty, labels).count() == 0
    constant = {s for _, _, s in collect(score(edge, labels.where("false")).select("doc_id", "held_out", "score"))}
    assert len(constant) == 1


def test_scores_depend_on_the_text_alone(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    other = docs.select(F.col("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("source"))
    for score in (quality.score_quality, toxicity.score_toxicity):
        assert sorted(collect(score(docs, labels))) == sorted(collect(score(other, labels)))


# ---- op4 ---------------------------------------------------------------------

def test_shards_move_only_into_the_new_one(spark):
    got = queries.q_shards(spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    per = collections.defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40) and r["law"] == "key"
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 16
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        per[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    assert 5 < sum(r["grown_shard"] == 40 for r in got) < 60
    grown = sharding.assign_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), [1.0] * 41)
    assert {r["doc_id"]: r["shard"] for r in grown.collect()} == {r["doc_id"]: r["grown_shard"] for r in got}


def test_shard_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    n = collections.Counter(r["shard"] for r in sharding.assign_shards(docs, [3.0, 1.0, 0.0]).collect())
    assert set(n) == {0, 1} and abs(n[0] / 4000 - 0.75) < 0.04
    with pytest.raises(ValueError):
        sharding.best_shard(F.lit("k"), [0.0])


def test_shard_edges(spark, edge, empty):
    got = sharding.number_slots(sharding.assign_shards(edge, [1.0] * 3, 1.0)).collect()
    assert len(got) == len(ROWS)
    for s in range(3):
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))
    assert sorted(r["size"] for r in got if r["doc_id"] in (4, 5)) == [16, 16]
    assert sharding.number_slots(sharding.assign_shards(empty, [1.0])).count() == 0
    assert sharding.shard_documents(edge, [1.0] * 3).columns == edge.columns


# ---- op5, op6 ----------------------------------------------------------------

def _plain(text):
    return tokens.encoder(tokens.VOCABULARY).bpe.encode_ordinary(text or "")


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "x  y", "a  b", "é à b", "tab\t x \n\n y", "'s don't 12 34", ""])
def test_pieces_encode_like_the_whole_text(text):
    _, _, data, offsets = next(blocks(pa.array([text, text + " " + text])))
    ids, first = tokens.encoder(tokens.VOCABULARY).encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [_plain(text), _plain(text + " " + text)]


def test_best_fit_fills_the_fullest_bin():
    lengths = np.array([5, 7, 3, 3, 2, 10, 1])
    bins = packing.best_fit(lengths, 10)
    load = np.bincount(bins, weights=lengths)
    assert (load <= 10).all() and load.sum() == 31 and len(load) == 4
    rng = np.random.default_rng(1)
    many = rng.integers(1, 101, 3000)
    brute, room = 0, []
    for n in sorted(many, reverse=True):
        fit = [i for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= n
        else:
            room.append(100 - n)
            brute += 1
    assert packing.best_fit(many, 100).max() + 1 == brute


def test_packing_is_lossless(spark, edge, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df, key in ((docs, lambda r: r["doc_id"]), (edge.where("doc_id is not null").dropDuplicates(["doc_id"]), None)):
        expected = {r["doc_id"]: _plain(r["text"]) + [tokens.END] for r in df.collect()}
        parts = collections.defaultdict(dict)
        for r in packing.pack_documents(df, row_tokens=256).collect():
            ids = np.frombuffer(r["ids"], dtype="<u2")
            assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] and (ids[r["n_tokens"]:] == tokens.END).all()
            assert r["position_resets"] == r["cu_seqlens"][:-1]
            for d, o, a, b in zip(r["doc_ids"], r["token_offsets"], r["cu_seqlens"][:-1], r["cu_seqlens"][1:]):
                parts[d][o] = ids[a:b].tolist()
        assert {d: [t for o in sorted(p) for t in p[o]] for d, p in parts.items()} == expected
    assert packing.pack_documents(empty).count() == 0
    segments = packing.pack_documents(edge).select(F.explode("doc_ids").alias("d")).collect()
    assert sum(r["d"] == 12 for r in segments) == 2


def test_token_counts(spark, edge, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in token_files.count_document_tokens(docs).collect()}
    assert got == {r["doc_id"]: len(_plain(r["text"])) for r in docs.collect()}
    rows = token_files.count_document_tokens(edge).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(_plain(t)) for _, t, _ in ROWS)
    assert token_files.count_document_tokens(empty).count() == 0


def test_separators_across_blocks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 4)
    streams = {"a": [9, 0, 1, 2, 3, 4, 5, 6, 7, 8, 1, 9, 9, 3, 9, 2, 2], "b": [1, 1, 1, 1, 9, 9], "c": [5], "d": [],
               "e": [9], "f": [1, 2, 3, 9]}
    files, expected = [], {}
    for name, ids in streams.items():
        path = f"{tmp_dir}/{name}.bin"
        np.array(ids, dtype="<u2").tofile(path)
        files.append((path, 2 * len(ids)))
        runs = "".join(chr(65 + i) for i in ids).split(chr(65 + 9))
        expected[path] = [len(r) for r in runs[:-1]] + ([len(runs[-1])] if runs[-1] else [])
    monkeypatch.setattr(token_files, "_scanner", _scanner_of_four)
    got = collections.defaultdict(list)
    for r in token_files.count_tokens(spark.createDataFrame(files, "file string, bytes long"), end=9) \
            .orderBy("file", "document").collect():
        got[r["file"]].append(r["n_tokens"])
    assert dict(got) == {k: v for k, v in expected.items() if v}


def _scanner_of_four(end):
    def run(batches):
        token_files.BLOCK_TOKENS = 4  # in the worker
        yield from _real_scanner(end)(batches)
    return run


_real_scanner = token_files._scanner


# ---- op7 ---------------------------------------------------------------------

def _brute_leaks(docs, items, k=5, least=0.8):
    grams = lambda w: collections.Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else \
        collections.Counter([tuple(w)] if w else [])
    out = {}
    for d, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        for i, item in items:
            v = WORD.findall((item or "").translate(LOWER))
            if not v or (len(v) < k and len(w) != len(v)):
                continue
            own = grams(v)
            for a in range(len(w) - len(v) + 1):
                c = grams(w[a:a + len(v)])
                both = sum((c & own).values())
                s = both / (sum(c.values()) + sum(own.values()) - both)
                if s >= least and s > out.get((d, i), (0,))[0]:
                    out[d, i] = (s, a)
    return out


def test_leaks_match_brute_force(spark, edge, empty):
    item = " ".join(f"frage{i}" for i in range(30))
    changed = item.replace("frage29", "anders")
    docs = [(1, f"vorher {item} nachher"), (2, item.upper()), (3, f"x {changed}"), (4, item.replace("frage9", "q")),
            (5, f"{item} {item}"), (6, None), (7, ""), (8, "eins zwei drei"), (9, "x eins zwei drei"), (10, " ".join(item.split()[:20])),
            (10, item), (11, "mitte " * 5000 + item + " ende" * 5000), (12, "la " * 40)]
    items = [(1, item), (2, None), (3, ""), (4, "eins zwei DREI"), (5, "la " * 10), (6, item)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(3))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["word_from"]) for r in decontaminate.find_leaks(d, b).collect()}
    assert got == _brute_leaks(docs, items)
    kept = decontaminate.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in docs if i not in {k[0] for k in got} or
                                                                 (i == 10 and t != item))
    assert decontaminate.find_leaks(d, b.where("false")).count() == 0
    assert decontaminate.find_leaks(empty, b).count() == 0 and decontaminate.find_leaks(edge, b).count() == 0


def _brute_any_length(docs, items, k=5, least=0.8):
    """The best window of the item's length, or of any length where none of the item's length reaches it."""
    out = {x: s for x, (s, _) in _brute_leaks(docs, items, k, least).items()}
    for d, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        for i, item in items:
            v = WORD.findall((item or "").translate(LOWER))
            if len(v) < k or (d, i) in out:
                continue
            own = collections.Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
            n = own.total()
            for size in range(k, len(w) + 1):
                for a in range(len(w) - size + 1):
                    c = collections.Counter(tuple(w[a + j:a + j + k]) for j in range(size - k + 1))
                    both = (c & own).total()
                    s = both / (c.total() + n - both)
                    if s >= least:
                        out[d, i] = max(s, out.get((d, i), 0))
    return out


def test_leaks_of_other_lengths_match_brute_force(spark):
    word = lambda n, c: [f"{c}{i}" for i in range(n)]
    a, b, c, e = word(20, "a"), word(48, "b"), word(45, "c"), word(59, "e")
    loop = ["la", "le"] * 10 + word(10, "f")
    cut = {f"a{n}": a[:-n] for n in (1, 2, 3, 4)} | {"front": a[3:], "b8": b[:-8], "b9": b[:-9], "b10": b[:-10]}
    middle = {"out": c[:22] + c[23:], "in": c[:22] + ["neu"] + c[22:], "three": e[:28] + ["x", "y", "z"] + e[28:],
              "ends": ["neu"] + a[1:-1] + ["neu"], "loop": loop[:-2], "loops": loop[4:], "la": ["la", "le"] * 30}
    docs = list((cut | middle).items()) + [(f"{n} inside", ["vor"] * 9 + w + ["nach"] * 9) for n, w in (cut | middle).items()]
    docs = [(n, " ".join(w)) for n, w in docs]
    items = [(i, " ".join(w)) for i, w in enumerate((a, b, c, e, loop, ["x"] + a[:12]))]
    expected = _brute_any_length(docs, items)
    assert {("a3", 0), ("b8", 1), ("out", 2), ("in", 2), ("three", 3), ("three inside", 3)} <= set(expected)
    assert ("a4", 0) not in expected
    d = spark.createDataFrame(docs, "doc_id string, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find_leaks(d, i).collect()
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows} == expected and len(rows) == len(expected)
    text = dict(docs)
    for r in rows:  # the words named are the window that reaches it
        window = " ".join(text[r["doc_id"]].split()[r["word_from"]:r["word_to"]])
        assert _brute_any_length([(0, window)], items)[0, r["item_id"]] >= r["similarity"]
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(d, i).collect()}
    assert kept == {n for n, _ in docs} - {n for n, _ in expected}


def test_no_fingerprint_within_the_radius_is_missed():
    texts = [" ".join(f"{c}{i}" for i in range(20)).encode() for c in "abc"]
    index = decontaminate.ItemIndex(texts, 5, 0.8)
    rng = np.random.default_rng(2)
    for flips in (0, 1, 20, 62, 63, 64, 90):
        bits = np.unpackbits(index.prints[1].view(np.uint8))
        bits[rng.permutation(256)[:flips]] ^= 1
        w, i, dist = index.lookup(np.array([20]), np.packbits(bits).view(np.uint16)[None, :])
        assert ((1 in i.tolist()) == (flips <= 63)) and (flips > 63 or dist[i.tolist().index(1)] == flips)


# ---- op8 ---------------------------------------------------------------------

def test_targets_and_taken_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix_streams(docs).collect()
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in docs.collect()}
    taken, size, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert r["size"] == sizes[r["id"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert all(taken[s] == round(target[s]) and target[s] <= 2 * size[s] for s in target)
    assert math.isclose(sum(target.values()), 1.5 * sum(sizes.values()))
    open_ratio = {round(target[s] / (3, 1, 2)[i % 3], 6) for i, s in enumerate(sorted(target)) if target[s] < 2 * size[s]}
    assert len(open_ratio) == 1
    streams = mixing.mix_streams(docs, n_shards=5, block_words=256)
    words, per_doc, blocks_of = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for r in mixing.draws(streams).collect():
        assert 0 <= r["word_from"] < r["word_to"] <= sizes[r["id"]]
        words[r["source"], r["shard"]] += r["word_to"] - r["word_from"]
        per_doc[r["id"]] += r["word_to"] - r["word_from"]
        blocks_of[r["source"], r["block_no"]].add(r["shard"])
    assert {i: n for i, n in per_doc.items()} == {r["id"]: r["taken"] for r in got if r["taken"]}
    assert all(len(s) == 1 for s in blocks_of.values())
    quota = collections.Counter((s, x) for (s, _), (x,) in blocks_of.items())
    assert all(0 <= 256 * n - words[k] < 256 for k, n in quota.items())
    per_shard = [sum(n for (_, x), n in quota.items() if x == k) for k in range(5)]
    assert max(per_shard) - min(per_shard) <= 1
    assert sorted(collect(mixing.mix_streams(docs).select("id", "taken"))) == sorted((r["id"], r["taken"]) for r in got)


def test_excess_is_reshared():
    assert mixing.fill_targets([10, 1000, 1000], [3, 1, 2], 1500, 2) == [20, pytest.approx(1480 / 3), pytest.approx(2960 / 3)]
    assert mixing.fill_targets([0, 0], [3, 1], 0, 2) == [0, 0]


def test_quotas_are_exact():
    quotas = np.array([1000, 10, 0, 333])
    out = mixing.split_quotas(quotas, 7, np.random.default_rng(1))
    assert (out.sum(axis=0) == quotas).all() and np.ptp(out.sum(axis=1)) <= 1 and (out >= 0).all()


def test_mix_edges(spark, edge, empty):
    got = collect(mixing.mix_streams(edge).select("id", "size", "source_size", "taken"))
    assert len(got) == len(ROWS) and all(t <= 2 * s for _, s, _, t in got)
    assert all(s == 0 and t == 0 for i, s, _, t in got if i in (4, 5, 6))
    assert mixing.mix_streams(empty).count() == 0
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns and max(collections.Counter(r["doc_id"] for r in mixed.collect() if r["doc_id"] != 12
                                                                     and r["doc_id"]).values()) <= 2


def test_runs_of_equal_rows_are_cut_exactly(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_ROWS", 100)  # so that the runs are dealt out in pieces and are hot
    same, none = ("eins zwei drei vier fuenf", "a"), ("sechs sieben", "b")
    rows = [(7, *same, None)] * 1000 + [(None, *none, "x")] * 300 + [(None, *none, None)] * 200 + [(None, None, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n string")
    a, b = docs.where("source = 'a'"), docs.where("source = 'b'")
    for share in (0.4, 0.6, 1.3):
        assert mixing.mixed_documents(a, share=share).count() == 1000 * share
        mixed = collections.Counter(tuple(r) for r in mixing.mixed_documents(b, share=share).collect())
        assert sum(mixed.values()) == 500 * share + 1 and set(mixed) <= {r for r in rows if r[2] == "b"}
        lone, x = mixed[None, *none, None], mixed[None, *none, "x"]  # a run is taken whole before the next begins
        assert (lone, x) in {(min(200, left) + base * 200, max(0, left - 200) + base * 300) for base, left in
                             [divmod(round(500 * share), 500)]} | {(max(0, left - 300) + base * 200, min(300, left) +
                             base * 300) for base, left in [divmod(round(500 * share), 500)]}
    taken = sorted(r["taken"] for r in mixing.mix_streams(a, share=0.4).collect())
    assert taken == [0] * 600 + [5] * 400
    many = spark.range(1000).selectExpr("cast(if(id < 600, null, id div 10) as long) as doc_id", "concat('w', id, ' v') as text",
                                        "'a' as source")  # 600 texts without an id: cut into ranges
    rows = sorted((r["start"], r["size"], r["h"]) for r in mixing.mix_streams(many).collect())
    assert [s for s, _, _ in rows] == list(range(0, 2000, 2)) and [h for *_, h in rows] == sorted(h for *_, h in rows)


def test_the_mix_is_what_the_shards_were_dealt(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = collections.defaultdict(list)
    for r in mixing.draws(mixing.mix_streams(docs)).collect():
        pieces[r["id"], r["epoch"]].append(r)
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    order = []
    for (i, _), ps in pieces.items():
        if 2 * sum(p["word_to"] - p["word_from"] for p in ps) >= size[i]:
            first = min(ps, key=lambda p: p["word_from"])
            order.append((first["shard"], first["local_order"], i))
    assert [r["doc_id"] for r in mixing.mixed_documents(docs).collect() if size[r["doc_id"]]] == \
        [i for *_, i in sorted(order)]
    whole = {r["doc_id"]: r["taken"] for r in queries.q_mix(spark, SF).collect()}
    split = mixing.split_quotas

    def without_the_last(*a):  # the blocks of the last shard are dealt to nobody
        return split(*a)[:-1]
    monkeypatch.setattr(mixing, "split_quotas", without_the_last)
    fewer = {r["doc_id"]: r["taken"] for r in queries.q_mix(spark, SF).collect()}
    lost = sum(whole.values()) - sum(fewer.values())
    assert all(fewer[i] <= n for i, n in whole.items()) and 0 < lost < sum(whole.values()) / 8


# ---- op9, op10 ---------------------------------------------------------------

def test_exact_groups(spark, edge, empty):
    got = collections.defaultdict(list)
    for r in exact_dedup.exact_groups(edge).collect():
        got[r["doc_id"]].append((r["keep_id"], r["group_size"], r["kept"]))
    assert got[1] == [(2, 2, False)] and got[2] == [(2, 2, True)] and got[3] == [(3, 1, True)]
    assert got[4] == [(5, 3, False)] and got[5] == [(5, 3, True)] and got[6] == [(6, 1, True)]
    assert got[7] == [(7, 2, True)] and sorted(got[None], key=str) == [(5, 3, False), (7, 2, False)]
    assert got[12] == [(12, 2, True)] * 2 and got[9] == [(10, 2, False)]
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.kept_rows(edge).columns == edge.columns


def _brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base)), (1, None), (2, ""), (3, "a b"), (4, "A b"), (5, "a")]
    for i in range(6, 220):  # a large group of near copies at all distances, and exact copies of some
        words = list(base)
        for j in rng.integers(0, 120, int(rng.integers(0, 9))):
            words[j] = f"x{i}_{j}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, rows[10 + i][1]) for i in range(5)] + [(400 + i, " ".join(f"u{i}_{j}" for j in range(30))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    for small, chunk in ((12, 512), (2, 16)):  # the second pair drives the chunked path
        near_dup.SMALL_BUCKET, near_dup.CHUNK_ROWS = small, chunk
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
               near_dup.near_duplicates(docs, shingle=3, percent=85).collect()}
        assert got == _brute_components(rows, 3, 85)
    near_dup.SMALL_BUCKET, near_dup.CHUNK_ROWS = 12, 512


def test_near_duplicate_edges(spark, edge, empty):
    got = collections.defaultdict(list)
    for r in near_dup.near_duplicates(edge, shingle=3, percent=85).collect():
        got[r["doc_id"]].append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[4] == [(0, 4, True)] and got[6] == [(0, 6, True)] and got[2] == [(2, 1, False)]
    assert got[8] == [(59, 7, False)] and got[10] == [(1, 9, False)] and got[12] == [(1, 12, True)] * 2
    assert sorted(got[None]) == [(0, None, True), (58, None, True)] and got[11] == [(1, 11, True)]
    assert near_dup.near_duplicates(empty).count() == 0
    kept = near_dup.kept_documents(edge, shingle=3, percent=85)
    assert kept.columns == edge.columns and kept.count() == len(ROWS) - 3  # 2, 8 and 10 go


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(0)
    whole = rng.integers(0, 1 << 63, 1500).astype(np.uint64)
    sets = [np.sort(whole[:1000]), np.sort(whole[250:1250]), np.sort(whole[:1]), np.sort(whole[:7])]
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    s = near_dup.sketch(np.concatenate(sets), first, 512)
    assert (s != near_dup._EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.08


# ---- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns == [*docs.columns, "shard"] and out.count() > 100
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = out.collect()
    assert all(texts[r["doc_id"]] == r["text"] for r in rows)
    assert max(collections.Counter(r["doc_id"] for r in rows).values()) <= 2
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    few = [(i, t) for i, t in texts.items() if i in {r["doc_id"] for r in rows} and len(t) < 3000]
    assert not _brute_leaks(few, items)


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
