"""Column-expression helpers. All of them are plain Catalyst expressions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse model.
OPEN_END = dt.datetime(9999, 12, 31)          # effective_to of a current version
DEFAULT_WATERMARK = dt.date(1900, 1, 1)       # watermark of a table never loaded
SUCCESS = "SUCCESS"                           # the only meaningful oper_result
LIVE, DELETED = "N", "Y"                      # deleted_flg values

_EPOCH = dt.datetime(1970, 1, 1)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a wall-clock timestamp (time-zone free)."""
    return F.timestamp_diff("SECOND", F.lit(_EPOCH).cast("timestamp_ntz"), col(ts).cast("timestamp_ntz"))


def days_before(d: str | Column, days: int = 1) -> Column:
    """``d - interval 'n day'`` as a timestamp at midnight (PostgreSQL date - interval)."""
    return F.date_sub(col(d).cast("date"), days).cast("timestamp_ntz")


def parse_ddmmyyyy(s: str | Column) -> Column:
    """File-name batch date ``DDMMYYYY`` to a date; null when malformed."""
    return F.try_to_timestamp(col(s), F.lit("ddMMyyyy")).cast("date")


def differs(a: str | Column, b: str | Column) -> Column:
    """Null-safe inequality: ``a <> b or (a is null) <> (b is null)``."""
    return ~col(a).eqNullSafe(col(b))


def pg_concat(*parts: str | Column) -> Column:
    """PostgreSQL ``concat``: null arguments are skipped, never null."""
    return F.concat(*[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])


def full_name(last: str | Column, first: str | Column, middle: str | Column) -> Column:
    """``rtrim(concat(last, ' ', first, ' ', middle))``; all-null gives ''."""
    return F.rtrim(pg_concat(last, F.lit(" "), first, F.lit(" "), middle))


def true_or_false(c: Column) -> Column:
    """Collapse SQL three-valued logic: null counts as false."""
    return F.coalesce(c, F.lit(False))
