"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Rows
may be kept (0), given the role user or assistant (1), deleted (2; blank rows and
repeats must be) or preceded by an inserted empty turn (5); a truncated row that
is not deleted costs 5 more. The legal prefixes have four states (start, after
system, after user, after assistant), so the cost of what is left to do, by
state, is a vector of four numbers.

Four-Russians tables: a row is one of nine symbols. Cost vectors less their
least entry take few values; for every block of three symbols and every such
vector the table holds the vector before the block and the cost to add. A
conversation is processed by looking up its blocks from the last to the first,
keeping the vector behind each block; then the blocks are expanded, and the edit
of least letter (D, I, K, R) whose cost meets the vector is taken at every step.
Each state and letter has one successor, so this gives the least audit string of
all cheapest ones, ties included.

Rows are shuffled by conversation twice: narrow rows without texts, from which
the audits come, then the texts together with the audits, which are hashed as a
stream. Neither pass holds a conversation's rows: memory grows by one byte a row,
as the audit itself does. Repeats are found by a window on the first shuffle.

Defined cases: null roles and texts are one space; rows of a turn are in order of
role, then of the text's SHA-256 (null turns come first); a null id is a
conversation of its own; an unknown or empty role can only be replaced or
deleted; a conversation without rows after damage gives zeros, an empty audit and
the hash of the empty string; an empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.spread import text_batches

INFINITE = 10 ** 6
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = (USER, USER, ASSISTANT, USER)  # the state after an inserted or replaced turn
RENAMED = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK = 3
# symbols: 0 fills the last block, 1 must be deleted, 2-5 are sound rows of s, u, a and others, 6-9 truncated ones
PAD, DOOMED, SOUND, CUT = 0, 1, 2, 6
INITIALS = "sua"
N_SYMBOLS = 10
END_COST = (0, 2 * INSERT, INSERT, 0)
BLANK, REPEAT, SHORT = 1, 2, 3
GAP = r"\x20\x09-\x0D"


def _ways(symbol: int, state: int, after: tuple[int, ...]) -> dict[str, tuple[int, int]]:
    """Edits of a row by letter: (cost of the rest, next state), given the costs by state after it."""
    ways = {"D": (DELETE + after[state], state)}
    if symbol != DOOMED:
        extra = TRUNCATED if symbol >= CUT else 0
        initial = (INITIALS + "?")[(symbol - SOUND) % 4]
        if (state, initial) in NEXT:
            to = NEXT[state, initial]
            ways["K"] = (extra + after[to], to)
        to = WANTED[state]
        ways["R"] = (REROLE + extra + after[to], to)
    return ways


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs by state before a row, any turns inserted in front of it."""
    if symbol == PAD:
        return after
    row = [min(cost for cost, _ in _ways(symbol, q, after).values()) for q in range(4)]
    twice = [WANTED[WANTED[q]] for q in range(4)]
    return tuple(min(row[q], INSERT + row[WANTED[q]], 2 * INSERT + row[twice[q]]) for q in range(4))


class Tables:
    """Normalised vectors, their transitions by symbol and by block, and expansions made so far."""

    def __init__(self):
        self.vectors, number, steps = [END_COST], {END_COST: 0}, []
        for v in self.vectors:  # grows while new vectors are reached
            row = []
            for symbol in range(N_SYMBOLS):
                costs = _before(symbol, v)
                least = min(costs)
                norm = tuple(c - least for c in costs)
                if norm not in number:
                    number[norm] = len(self.vectors)
                    self.vectors.append(norm)
                row.append((number[norm], least))
            steps.append(row)
        table = np.array(steps, dtype=np.int32).transpose(2, 1, 0)
        self.step, self.gain = table[0], table[1]
        behind, gained = self.step, self.gain
        for _ in range(BLOCK - 1):  # [first symbol, ..., last symbol, vector behind the block]
            behind, gained = self.step[:, behind], self.gain[:, behind] + gained
        shape = (N_SYMBOLS ** BLOCK, len(self.vectors))
        self.block_step, self.block_gain = behind.reshape(shape).tolist(), gained.reshape(shape).tolist()
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    def expand(self, block: int, behind: int, state: int) -> tuple[str, int]:
        """(letters, state) of a block entered in ``state``, with vector ``behind`` after it."""
        key = (block, behind, state)
        if key not in self.expanded:
            symbols = [block // N_SYMBOLS ** (BLOCK - 1 - i) % N_SYMBOLS for i in range(BLOCK)]
            after = [behind]
            for s in reversed(symbols):
                after.append(int(self.step[s, after[-1]]))
            letters = []
            for s, v, mine in zip(symbols, after[-2::-1], after[:0:-1], strict=True):
                while s != PAD:
                    costs = [c + int(self.gain[s, v]) for c in self.vectors[mine]]
                    ways = _ways(s, state, self.vectors[v]) | {"I": (INSERT + costs[WANTED[state]], WANTED[state])}
                    letter = min(x for x, (cost, _) in ways.items() if cost == costs[state])
                    letters.append(letter)
                    state = ways[letter][1]
                    if letter != "I":
                        break
            self.expanded[key] = "".join(letters), state
        return self.expanded[key]


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def repair(symbols: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation given as one symbol a row."""
    t = tables()
    padded = symbols + bytes(-len(symbols) % BLOCK)
    codes = np.frombuffer(padded, dtype=np.uint8).reshape(-1, BLOCK) @ (N_SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
    behind = np.zeros(len(codes) + 1, dtype=np.int32)
    total, v = 0, 0
    for i in range(len(codes) - 1, -1, -1):
        total += t.block_gain[codes[i]][v]
        v = t.block_step[codes[i]][v]
        behind[i] = v
    cost = total + t.vectors[v][START]
    letters, state = [], START
    for i, code in enumerate(codes):
        piece, state = t.expand(int(code), int(behind[i + 1]), state)
        letters.append(piece)
    letters.append("I" * (END_COST[state] // INSERT))
    return cost, "".join(letters)


def damage(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turn, role, text, gone): rows damaged by the CRC of their id and turn. Dropped rows stay, marked ``gone``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(F.col(id_col).alias("id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                                text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    return rows.select(
        "id", "turn", F.when(fate == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (fate == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy")).drop("copy")


def intact(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The rows of ``damage`` without any damage."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(F.col(id_col).alias("id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                                text.alias("text"), F.lit(False).alias("gone"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Conversation:
    def __init__(self, key):
        self.key, self.symbols, self.faults = key, bytearray(), [0, 0, 0, 0]
        self.least = self.last_turn = self.initial = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.least = turn if self.least is None else self.least
            self.last_turn = turn
            self.turns += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        kind = INITIALS.find(initial) if initial else 3
        kind = 3 if kind < 0 else kind
        self.symbols.append(DOOMED if fault in (BLANK, REPEAT) else (CUT if fault == SHORT else SOUND) + kind)

    def result(self) -> tuple:
        cost, audit = repair(bytes(self.symbols))
        gaps = 0 if self.least is None else self.last_turn - self.least + 1 - self.turns
        return (self.key, gaps, *self.faults[1:], self.illegal, cost, audit)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _auditor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation to one row a conversation: figures and audit."""
    now, done, kinds = None, [], None
    names = ["id", *STATS, "audit"]
    for batch in batches:
        kinds = [batch.schema.field(0).type, *[pa.int64()] * len(STATS), pa.string()]
        for key, turn, initial, fault, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(key)
            if not gone:
                now.add(turn, initial, fault)
        if done:
            yield _batch(done, names, kinds)
            done = []
    if now is not None:
        yield _batch([now.result()], names, kinds)


class _Hash:
    """The repaired turns of one conversation, hashed as its rows come."""

    def __init__(self, key, stats: list, audit: str):
        self.key, self.stats, self.audit = key, stats, audit
        self.at, self.state, self.empty, self.sha = 0, START, True, hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.sha.update((("" if self.empty else "\n") + role + ":" + text).encode())
        self.empty = False

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = WANTED[self.state]
            self._write(RENAMED[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return
        self.state = NEXT[self.state, role[0]] if letter == "K" else WANTED[self.state]
        self._write(role if letter == "K" else RENAMED[self.state], text)

    def result(self) -> tuple:
        self._inserted()
        return (self.key, *self.stats, self.audit, self.sha.hexdigest())


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit row, then its rows in order, to its result with the hash."""
    now, done, kinds = None, [], None
    names = ["id", *STATS, "audit", "repaired_sha256"]
    for batch in batches:
        kinds = [batch.schema.field(0).type, *[pa.int64()] * len(STATS), pa.string(), pa.string()]
        for key, stats, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if stats is not None:
                if now is not None:
                    done.append(now.result())
                now = _Hash(key, stats, text)
            else:
                now.row(role, text)
        if done:
            yield _batch(done, names, kinds)
            done = []
    if now is not None:
        yield _batch([now.result()], names, kinds)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per id of ``rows`` (the columns of ``damage``): id, STATS, audit, repaired_sha256."""
    text_batches(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    figures = ", ".join(f"{s} long" for s in STATS)
    narrow = rows.select(
        "id", "turn", "role", _digest(F.col("text")).alias("digest"), "gone",
        F.when(~F.col("text").rlike(f"[^{GAP}]"), F.lit(BLANK))
        .when(~F.col("text").rlike(rf"[.!?][{GAP}]*\z"), F.lit(SHORT)).otherwise(F.lit(0)).alias("fault"))
    seen = Window.partitionBy("id", "role", "digest", "gone").orderBy(F.asc_nulls_first("turn"))
    narrow = narrow.repartition("id").withColumn("seen", F.row_number().over(seen))
    fault = F.when((F.col("fault") != BLANK) & (F.col("seen") > 1), F.lit(REPEAT)).otherwise(F.col("fault"))
    audits = narrow.sortWithinPartitions("id", F.asc_nulls_first("turn"), "role", "digest", "seen") \
        .select("id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "gone") \
        .mapInArrow(_auditor, f"id {kind}, {figures}, audit string")

    heads = audits.select("id", F.array(*STATS).alias("stats"), F.lit(None).cast("long").alias("turn"),
                          F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"))
    body = rows.where(~F.col("gone")).select("id", F.lit(None).cast("array<long>").alias("stats"), "turn", "role", "text",
                                             _digest(F.col("text")).alias("digest"))
    return heads.unionByName(body).repartition("id") \
        .sortWithinPartitions("id", F.col("stats").isNull(), F.asc_nulls_first("turn"), "role", "digest") \
        .select("id", "stats", "role", "text").mapInArrow(
            _hasher, f"id {kind}, {figures}, audit string, repaired_sha256 string")
