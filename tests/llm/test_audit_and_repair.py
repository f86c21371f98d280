"""Filter audit and conversation repair: brute force, random cases, and edge cases."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import conversation_repair as repairing
from ledgerwatch.llm import filter_audit
from ledgerwatch.session import ship_package

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def collect(df):
    return [tuple(r) for r in df.collect()]


# ---- filter audit ------------------------------------------------------------

def test_gray_walk_states_are_the_survivors_of_each_subset():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5):
        counts = rng.integers(0, 9, (1 << k, 3))
        states = filter_audit.gray_walk(counts, k)
        for subset in range(1 << k):
            assert (states[subset] == sum(counts[m] for m in range(1 << k) if not m & subset)).all()


def _masks(rows):
    """Failed letters of each (id, text, part), from the descriptions."""
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * sum("A" <= x <= "Z" for x in t) > 10 * len(t), "D": bool(set(t) & set("#$%&*|")),
                 "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)}
        out.append({x for x, bad in fails.items() if bad})
    return out


def _brute_audit(rows, good, toxic):
    masks = _masks(rows)
    out, shapley = {}, {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, m) for (i, _, p), m in zip(rows, masks) if (p or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, m) for i, m in left if x in m]
                left = [(i, m) for i, m in left if x not in m]
                fails = [m for _, m in mine if x in m]
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(m == {x} for m in fails),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_matches_brute_force_on_edge_rows(spark):
    long, varied = "ab " * 120, " ".join(f"w{i}" for i in range(150))
    rows = [(1, None, "en"), (2, "", "en"), (3, long, "de"), (4, long, None), (4, long, None), (None, long, ""), (None, "", "en"),
            (5, varied, "en"), (6, varied, "de"), (7, varied + " #", "de"), (8, "SHOUT " * 200, "fr"), (9, "SHOUT " * 200, "fr"),
            (9, "other", "fr"), (10, "é" * 50, "en"), (11, varied.upper(), "en"), (12, "Ab\x1ccd \x0b|", "de"),
            (13, "word " * 100_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("id", "part", "mask", "n", "words", "digest", "good", "toxic", "key", "least", "first"):
        docs = docs.withColumn(name, F.lit(name))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (3, 1, None), (9, None, 1), (None, 1, 1), (11, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = collect(filter_audit.audit_filters(docs, labels))
    assert len(got) == len(set(got)) and set(got) == _brute_audit(rows, {1, 3, 11}, {1, 9, 11})
    assert filter_audit.audit_filters(docs.where("false"), labels).count() == 0
    assert filter_audit.audit_filters(docs, labels.where("false")).count() == len(got)


def test_audit_of_other_filters(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "bb", "x"), (3, "bb", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = collect(filter_audit.audit_filters(docs, labels, "LE", filters=lambda words, text: {"L": F.length(text) < 2}))
    assert sorted(got) == [("x", "EL", 1, 2, 1, 0, 1, 0, 0, 2), ("x", "EL", 2, 1, 1, 0, 1, 0, 0, 2),
                           ("x", "LE", 1, 2, 1, 0, 1, 0, 0, 2), ("x", "LE", 2, 1, 1, 0, 1, 0, 0, 2)]


# ---- conversation repair -----------------------------------------------------

STEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
TURN = {0: 2, 1: 2, 2: 3, 3: 2}


def _cheapest(rows):
    """(cost, audit, repaired turns) by a shortest-path search; rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit, out
        if (i, q) in seen:
            continue
        seen.add((i, q))
        to = TURN[q]
        new = {2: "user", 3: "assistant"}[to]
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*out, new + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to, (*out, f"{new}:{text}")))
                if (role[:1], q) in STEP:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, STEP[role[:1], q], (*out, f"{role}:{text}")))


def _brute_repair(rows, damaged=True):
    out = {}
    for key in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == key):
            role, text = " " if role is None else role, " " if text is None else text
            name = f"{' ' if key is None else key}:{' ' if turn is None else turn}"
            fate = zlib.crc32(name.encode()) % 20 if damaged else 9
            if fate == 1:
                text = ""
            if fate == 2:
                text = re.sub("[.!?]", "", text)
            if fate == 4:
                role = "user"
            mine += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, rated = set(), []
        for _, role, text in mine:
            found = WORD.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1][-1] not in ".!?" else ""
            seen.add((role, text))
            rated.append((role, text, fault))
        turns = {r[0] for r in mine if r[0] is not None}
        cost, audit, left = _cheapest(rated)
        out[key] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(sum(f == x for _, _, f in rated) for x in ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rated, rated[1:])), cost, audit,
                    hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def test_block_tables_match_a_shortest_path_search():
    random.seed(5)
    kinds = {1: ("u", "blank"), **{2 + i: (x, "") for i, x in enumerate("sua?")}, **{6 + i: (x, "truncated") for i, x in enumerate("sua?")}}
    for n in [0, 1, 2, 3, *(random.randrange(0, 25) for _ in range(1500))]:
        symbols = bytes(random.choice([1, 2, 3, 3, 3, 4, 4, 4, 5, 6, 7, 7, 8, 8, 9]) for _ in range(n))
        want = _cheapest([(kinds[s][0], "x", kinds[s][1]) for s in symbols])
        assert repairing.repair(symbols) == want[:2], list(symbols)


def _random_rows(n_conversations, seed):
    rng = random.Random(seed)
    texts = ["Hi.", "Hi.", "Ho!", "cut off", "ok? \n", " \t", "", None, "a.b", "é.", "x\x1c", "done.\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "agent", "User"]
    return [(c if c else None, rng.choice([t, t, t, None, 3 * t]), rng.choice(roles), rng.choice(texts))
            for c in range(n_conversations) for t in range(rng.randrange(1, 12))]


@pytest.mark.parametrize("damaged", [True, False])
def test_repair_matches_brute_force(spark, damaged):
    rows = _random_rows(150, 11) + [(900, t, r, x) for t, r, x in [(1, "user", "a."), (1, "user", "a."), (5, "user", "a."), (None, "user", "a.")]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("id", "gone", "fate", "digest", "stats", "audit", "copy", "fault", "seen"):
        df = df.withColumn(name, F.lit(name))
    ready = repairing.damage(df) if damaged else repairing.intact(df)
    got = {r[0]: tuple(r[1:]) for r in repairing.repair_conversations(ready).collect()}
    assert got == _brute_repair(rows, damaged)


def test_conversations_that_damage_empties_stay(spark):
    gone = [(c, 0) for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    df = spark.createDataFrame([(c, t, "user", "hi.") for c, t in gone], "conv_id long, turn long, role string, text string")
    got = collect(repairing.repair_conversations(repairing.damage(df)))
    assert sorted(got) == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, _ in gone]
    assert repairing.repair_conversations(repairing.damage(df.where("false"))).count() == 0


def test_long_conversation_and_text_ids(spark):
    n = 30_000
    rows = [("long", i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(n)] + [("one", 0, "user", "x" * 200_000 + "!")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {r["id"]: r for r in repairing.repair_conversations(repairing.intact(df)).collect()}
    assert got["long"]["audit"] == "K" * n and got["long"]["cost"] == 0
    assert got["long"]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows[:n]).encode()).hexdigest()
    assert (got["one"]["cost"], got["one"]["audit"]) == (2, "D")
