"""XLSX workbook source (terminals and passport-blacklist files).

Parquet-style readers do not exist for ``.xlsx``; a workbook is a zip of XML
parts. Spark lists the workbooks with the ``binaryFile`` source and decodes
each one inside an executor task with ``mapInPandas`` (standard ``zipfile`` +
``xml.etree``): many daily workbooks decode in parallel, and nothing passes
through the driver. Cells come out as text by column position; typing (dates
as Excel serial numbers or ISO text) is done afterwards with Spark
expressions.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.operators.incremental import stamp_batch_date

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_EXCEL_EPOCH = "1899-12-30"   # day 0 of Excel serial dates (1900 system)


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _cell(c, shared: list[str]) -> str | None:
    kind, v = c.get("t"), c.find("m:v", _NS)
    if kind == "inlineStr":
        inline = c.find("m:is", _NS)
        return _text(inline) if inline is not None else None
    if v is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    return ("TRUE" if v.text == "1" else "FALSE") if kind == "b" else v.text


def _elements(part, tag: str):
    """The elements of a tag of an XML part, one at a time: each is dropped once used."""
    for _, node in ET.iterparse(part):
        if node.tag == f"{{{_NS['m']}}}{tag}":
            yield node
            node.clear()


def read_sheet(data: bytes, sheet: str | None) -> Iterator[list[str | None]]:
    """Rows of one sheet as lists of cell text (None for empty cells), streamed."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as part:
                shared = [_text(si) for si in _elements(part, "si")]
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
        sheets = wb.findall("m:sheets/m:sheet", _NS)
        chosen = next((s for s in sheets if sheet is None or s.get("name") == sheet), None)
        if chosen is None:
            raise ValueError(f"sheet {sheet!r} not found")
        target = targets[chosen.get(f"{{{_NS['r']}}}id")].lstrip("/")
        with z.open(target if target.startswith("xl/") else f"xl/{target}") as part:
            for row in _elements(part, "row"):
                cells = {_col_index(c.get("r")) if c.get("r") else pos: _cell(c, shared)
                         for pos, c in enumerate(row.findall("m:c", _NS))}
                yield [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]


DECODED_ROWS = 10_000   # rows of a sheet held at once


def _decoder(sheet: str | None, ncols: int, header: bool):
    names = ["path", "row_idx", *[f"c{i}" for i in range(ncols)]]

    def decode(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                out = []
                for i, r in enumerate(islice(read_sheet(bytes(content), sheet), 1 if header else 0, None)):
                    vals = (r + [None] * ncols)[:ncols]
                    if any(v is not None for v in vals):
                        out.append([path, i, *vals])
                    if len(out) == DECODED_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = []
                yield pd.DataFrame(out, columns=names)
    return decode


def read_workbooks(spark: SparkSession, path: str, *, glob: str, sheet: str | None, ncols: int,
                   header: bool = True) -> DataFrame:
    """Raw cells (c0..c{n-1} as strings), one row per sheet row, plus ``file_name``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    schema = "path string, row_idx int, " + ", ".join(f"c{i} string" for i in range(ncols))
    cells = files.mapInPandas(_decoder(sheet, ncols, header), schema)
    return cells.withColumn("file_name", F.regexp_extract("path", r"([^/]+)$", 1))


def cell_date(c: str | Column) -> Column:
    """A date cell: Excel serial number, or ISO ``yyyy-MM-dd[ HH:mm:ss]`` text; empty is null, anything else an error."""
    x = F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit(""))
    serial = x.try_cast("double")
    from_serial = F.date_add(F.lit(_EXCEL_EPOCH).cast("date"), F.floor(serial).cast("int"))
    return F.when(serial.isNotNull(), from_serial).otherwise(F.coalesce(
        F.try_to_date(F.substring(x, 1, 10), "yyyy-MM-dd"),
        F.when(x.isNotNull(), F.raise_error(F.concat(F.lit("not a date: "), x)).cast("date"))))


def read_terminals(spark: SparkSession, path: str, *, glob: str = "terminals_*.xlsx",
                   sheet: str = "terminals") -> DataFrame:
    raw = read_workbooks(spark, path, glob=glob, sheet=sheet, ncols=4)
    df = raw.select(F.col("c0").alias("terminal_id"), F.col("c1").alias("terminal_type"),
                    F.col("c2").alias("terminal_city"), F.col("c3").alias("terminal_address"), "file_name")
    return stamp_batch_date(df, "file_name").drop("file_name")


def read_blacklist(spark: SparkSession, path: str, *, glob: str = "passport_blacklist_*.xlsx",
                   sheet: str = "blacklist") -> DataFrame:
    raw = read_workbooks(spark, path, glob=glob, sheet=sheet, ncols=2)
    df = raw.select(F.col("c1").alias("passport_num"), cell_date("c0").alias("entry_dt"), "file_name")
    return stamp_batch_date(df, "file_name").drop("file_name")
