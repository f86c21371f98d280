"""Chat formatting by schema fingerprints.

A layout is the set of nested field paths of a record (``messages[].role``).
Its hash selects a declarative mapping from ``LAYOUTS`` that turns records into
canonical rows (id, turn, role, text). Typed tables are fingerprinted once by
their schema and mapped by column expressions; JSON strings record by record.

Turns are written as ``### Assistant:\\n<text>\\n</turn>\\n``. Every backslash,
``#`` and ``<`` inside a text is escaped by a backslash, so no text can contain
a control string, and removing the escapes restores it exactly. A loss span
(code points of the segment) covers each assistant text.

Conversations stay cut into one segment per turn: formatting is a projection,
and reading back streams a sorted partition with incremental digests, so the
length of a conversation never has to fit in memory.

Defined cases: null role or text is empty; turns are in order of turn, then
role, then text (null turns first); rows repeated in a conversation are turns
of their own; a null id is a conversation of its own; fields that no layout
names are ignored; a JSON record that is one turn keeps its own turn (null if
that is no number), other records number theirs; a JSON record of unknown layout becomes one turn of role
``unknown`` that holds the record; a typed table of unknown layout is an error;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHOWN = {"user": "User", "assistant": "Assistant", "system": "System"}
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """``each``: (array, role field, text field) of a list of turns; ``turns``: (role, fields joined by
    an empty line) of fixed turns, left out where all fields are empty; ``row``: one row is one turn."""

    name: str
    each: tuple[str, str, str] | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    row: tuple[str, str, str] | None = None
    rename: bool = False  # the layout's own role names stand for canonical ones

    @property
    def paths(self) -> list[str]:
        if self.row:
            return sorted(self.row)
        if self.each:
            array, role, text = self.each
            return sorted([array, f"{array}[]", f"{array}[].{role}", f"{array}[].{text}"])
        return sorted({f for _, fields in self.turns for f in fields})


LAYOUTS = [
    Layout("turn_rows", row=("turn", "role", "text")),
    Layout("messages", each=("messages", "role", "content")),
    Layout("from_value", each=("conversations", "from", "value"), rename=True),
    Layout("instruction_input", turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("instruction", turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("prompt_completion", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("system_prompt_response", turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_response", turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", turns=(("user", ("question",)), ("assistant", ("answer",)))),
]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint(x.paths): x for x in LAYOUTS}
KNOWN_PATHS = {p for x in LAYOUTS for p in x.paths}


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        out = []
        for f in kind.fields:
            path = f"{at}.{f.name}" if at else f.name
            out += [path, *schema_paths(f.dataType, path)]
        return out
    if isinstance(kind, T.ArrayType):
        return [f"{at}[]", *schema_paths(kind.elementType, f"{at}[]")]
    return []


def value_paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a parsed JSON value; null fields count as absent."""
    if isinstance(value, dict):
        out = set()
        for k, v in value.items():
            if v is not None:
                path = f"{at}.{k}" if at else k
                out |= {path} | value_paths(v, path)
        return out
    if isinstance(value, list):
        out = {f"{at}[]"}
        for v in value:
            out |= value_paths(v, f"{at}[]")
        return out
    return set()


def layout_of(paths: list[str]) -> Layout | None:
    """The layout with this fingerprint, fields that no layout knows left out; failing that (fields of
    several layouts at once), the rows-by-turn layout if its fields are there, else the largest layout all
    of whose fields are there."""
    known = [p for p in set(paths) if p in KNOWN_PATHS]
    exact = BY_FINGERPRINT.get(fingerprint(known))
    if exact:
        return exact
    fit = [x for x in LAYOUTS if set(x.paths) <= set(known)]
    return max(fit, key=lambda x: (bool(x.row), len(x.paths), x.name)) if fit else None


def _role(role: Column, rename: bool) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    for name, canonical in ROLE_NAMES.items() if rename else ():
        role = F.when(role == name, canonical).otherwise(role)
    return role


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turn, role, text) rows of a typed table in any known layout."""
    paths = schema_paths(T.StructType([f for f in df.schema.fields if f.name != id_col]))
    layout = layout_of(paths)
    if layout is None:
        raise ValueError(f"no layout for the fields {sorted(set(paths))}")
    key = F.col(id_col).alias(id_col)
    if layout.row:
        turn, role, text = layout.row
        rows = df.select(key, F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    elif layout.each:
        array, role, text = layout.each
        rows = df.select(key, F.posexplode(F.col(array)).alias("turn", "m")) \
            .select(id_col, F.col("turn").cast("long").alias("turn"), F.col("m")[role].alias("role"), F.col("m")[text].alias("text"))
    else:
        made = [F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                         F.concat_ws("\n\n", *[F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields]).alias("text"))
                for i, (role, fields) in enumerate(layout.turns)]
        rows = df.select(key, F.explode(F.array(*made)).alias("m")).select(id_col, "m.*").where("text <> ''")
    return rows.select(id_col, "turn", _role(F.col("role"), layout.rename).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def record_turns(value: object) -> tuple[str, list[tuple[str, str]]]:
    """(layout name, [(role, text)]) of one parsed JSON record."""
    layout = layout_of(sorted(value_paths(value))) if isinstance(value, dict) else None

    def text(x: object) -> str:
        return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)

    if layout is None:
        return "unknown", [("unknown", text(value))]
    if layout.each:
        array, role, body = layout.each
        names = ROLE_NAMES if layout.rename else {}
        return layout.name, [(names.get(text(m.get(role)), text(m.get(role))), text(m.get(body))) for m in value[array]]
    if layout.row:
        return layout.name, [(text(value.get("role")), text(value.get("text")))]
    made = [(role, "\n\n".join(text(value.get(f)) for f in fields if text(value.get(f)))) for role, fields in layout.turns]
    return layout.name, [m for m in made if m[1]]


def own_turn(value: object) -> int | None:
    """The turn that a record of the rows-by-turn layout names, as a 64-bit number (null: not one)."""
    try:
        turn = int(value)
    except (TypeError, ValueError, OverflowError):
        return None
    return turn if -(1 << 63) <= turn < 1 << 63 else None


def _json_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, turn, layouts, roles, texts = [], [], [], [], []
        for i, raw in enumerate(batch.column(1).to_pylist()):
            try:
                value = json.loads(raw) if raw is not None else None
            except ValueError:
                value = raw
            name, turns = record_turns(value)
            for n, (role, text) in enumerate(turns):
                at.append(i), turn.append(own_turn(value["turn"]) if name == "turn_rows" else n), layouts.append(name), roles.append(role), texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(turn, pa.int64()),
                                          pa.array(layouts, pa.string()), pa.array(roles, pa.string()),
                                          pa.array(texts, pa.string())], names=["id", "turn", "layout", "role", "text"])


def canonical_turns_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, turn, layout, role, text) rows of JSON records, each mapped by its own fingerprint."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(json_col).cast("string").alias("json")) \
        .mapInArrow(_json_reader, f"id {kind}, turn long, layout string, role string, text string") \
        .withColumnRenamed("id", id_col)


def format_turns(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One formatted segment per turn, with the loss span in code points of the segment (null: no loss)."""
    role = F.col("role")
    shown = F.concat(F.lit("="), F.regexp_replace(role, r"([\\#<:])", r"\\$1"))
    for name, display in SHOWN.items():
        shown = F.when(role == name, display).otherwise(shown)
    head = F.concat(F.lit("### "), shown, F.lit(":\n"))
    body = F.regexp_replace("text", r"([\\#<])", r"\\$1")
    learned = role == "assistant"
    return turns.select(
        id_col, "turn", F.col("role").alias("sort_role"), F.col("text").alias("sort_text"),
        F.concat(head, body, F.lit("\n</turn>\n")).alias("formatted"),
        F.when(learned, F.length(head)).alias("loss_from"),
        F.when(learned, F.length(head) + F.length(body)).alias("loss_to"))


_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*):\n", re.DOTALL)
_TAIL = "\n</turn>\n"


def parse_segment(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    head = _HEAD.match(formatted)
    if head is None or not formatted.endswith(_TAIL):
        raise ValueError("not a formatted turn")
    shown = head[1]
    role = _ESCAPE.sub(r"\1", shown[1:]) if shown.startswith("=") else {v: k for k, v in SHOWN.items()}[shown]
    return role, _ESCAPE.sub(r"\1", formatted[head.end():len(formatted) - len(_TAIL)])


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str, a: int | None, b: int | None) -> None:
        role, text = parse_segment(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n += 1
        self.chars += len(formatted)
        if a is not None:
            learned = _ESCAPE.sub(r"\1", formatted[a:b])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation of a partition sorted by it: what reading the segments back gives."""
    now, state, done = None, None, []

    def out() -> pa.RecordBatch:
        cols = list(zip(*[(k, d.n, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars) for k, d in done],
                        strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        for key, formatted, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if state is None or key != now:
                if state is not None:
                    done.append((now, state))
                now, state = key, _Digest()
            state.add(formatted, a, b)
        if done:
            yield out()
            done.clear()
    if state is not None:
        done.append((now, state))
        yield out()


def read_back(segments: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation (long ids): counts and digests of the turns and the loss text parsed from its segments."""
    order = [id_col, "turn", "sort_role", "sort_text"]
    return segments.repartition(F.col(id_col)).sortWithinPartitions(*order) \
        .select(F.col(id_col).cast("long").alias("id"), "formatted", "loss_from", "loss_to") \
        .mapInArrow(_digester, "id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                               "formatted_chars long").withColumnRenamed("id", id_col)
