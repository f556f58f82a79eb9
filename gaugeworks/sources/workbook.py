"""Workbooks as long tables, parsed from their XML parts by executors.

``cells`` hold what a sheet shows, ``merges`` its merged ranges and ``formulas`` the
formula of each cell that has one; rows and columns count from 0.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.errors import ReadError
from gaugeworks.functions.scalars import column_index, column_letters

PART = "part string, sheet string, sheet_no int, row int, col int, row2 int, col2 int, kind string, s string"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: built-in number formats that show dates or times (fixed values)
_DATES = {*range(14, 23), *range(45, 48)}


@dataclass(frozen=True)
class Workbook:
    cells: DataFrame
    merges: DataFrame
    formulas: DataFrame
    sheets: tuple[str, ...]
    #: what has been worked out before
    known: dict = field(default_factory=dict, compare=False, repr=False)

    def sheet(self, name: str) -> Workbook:
        pick = lambda df: df.filter(F.col("sheet") == name)
        return self.once(("sheet", name), lambda: Workbook(pick(self.cells), pick(self.merges), pick(self.formulas), (name,)))

    def release(self) -> None:
        """Give back what is kept of the sheets' rows."""
        for found in self.known.values():
            if isinstance(found, Workbook):
                found.release()
            elif isinstance(found, DataFrame):
                found.unpersist()

    def bounds(self) -> tuple[int, int]:
        """Rows and columns in use: values, merges and formulas all count."""
        return self.once("bounds", self._bounds)

    def once(self, what, work: Callable):
        """A fact of this sheet, worked out when first asked for."""
        if what not in self.known:
            self.known[what] = work()
        return self.known[what]

    def _bounds(self) -> tuple[int, int]:
        spots = self.cells.select("row", "col").union(self.merges.select("row2", "col2")).union(self.formulas.select("row", "col"))
        r = spots.agg(F.max("row"), F.max("col")).first()
        return (r[0] + 1, r[1] + 1) if r[0] is not None else (0, 0)


def _address(ref: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"\$?([A-Z]+)\$?([0-9]+)", ref).groups()
    return int(digits) - 1, column_index(letters)


def _number(text: str) -> str:
    x = float(text)
    return str(int(x)) if x == int(x) and abs(x) < 1 << 53 else repr(x)


_CELL = re.compile(r"'[^']*'!?|\"[^\"]*\"|(?<![A-Za-z0-9_.$])(\$?)([A-Z]{1,3})(\$?)([0-9]+)(?![A-Za-z0-9_(.])")
_COLUMNS = re.compile(r"(?<![A-Za-z0-9_.$])(\$?)([A-Z]{1,3}):(\$?)([A-Z]{1,3})(?![A-Za-z0-9_(])")


def shifted(formula: str, rows: int, columns: int) -> str:
    """A formula as it reads some rows and columns further on; marked references stay."""
    letters = lambda mark, c: mark + (c if mark else column_letters(max(0, column_index(c) + columns)))

    def cell(m: re.Match) -> str:
        if m[2] is None:  # quoted text or a sheet's name
            return m[0]
        return letters(m[1], m[2]) + m[3] + (m[4] if m[3] else str(max(1, int(m[4]) + rows)))

    moved = _COLUMNS.sub(lambda m: f"{letters(m[1], m[2])}:{letters(m[3], m[4])}", formula) if columns else formula
    return _CELL.sub(cell, moved)


def parse_workbook(content: bytes) -> Iterator[tuple]:
    """Rows of PART from a workbook's bytes."""
    z = zipfile.ZipFile(io.BytesIO(content))
    names = set(z.namelist())
    xml = lambda name: ET.fromstring(z.read(name))
    whole = lambda node: "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))
    shared = [whole(si) for si in xml("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in names else []
    dated: set[int] = set()
    if "xl/styles.xml" in names:
        styles = xml("xl/styles.xml")
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.findall("m:numFmts/m:numFmt", _NS)}
        for i, xf in enumerate(styles.findall("m:cellXfs/m:xf", _NS)):
            fmt = int(xf.get("numFmtId", 0))
            if fmt in _DATES or re.search(r"[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(fmt, "")), re.I):
                dated.add(i)
    targets = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
    book = xml("xl/workbook.xml")
    for no, sheet in enumerate(book.findall("m:sheets/m:sheet", _NS)):
        target = targets[sheet.get(_REL)]
        root = xml(target.lstrip("/") if target.startswith("/") else f"xl/{target}")
        title = sheet.get("name")
        yield "sheet", title, no, None, None, None, None, None, None
        for ref in root.findall("m:mergeCells/m:mergeCell", _NS):
            a, _, b = ref.get("ref").partition(":")
            (r1, c1), (r2, c2) = _address(a), _address(b or a)
            yield "merge", title, no, r1, c1, r2, c2, None, None
        row_no = -1
        common: dict[str, tuple[str, int, int]] = {}  # formulas that several cells share, with the place of the first
        for row in root.findall("m:sheetData/m:row", _NS):
            row_no = int(row.get("r", row_no + 2)) - 1
            col_no = -1
            for c in row.findall("m:c", _NS):
                col_no = _address(c.get("r"))[1] if c.get("r") else col_no + 1
                f, v, kind = c.find("m:f", _NS), c.find("m:v", _NS), c.get("t", "n")
                if f is not None:
                    said = f.text or ""
                    if f.get("t") == "shared":
                        if said:
                            common[f.get("si")] = said, row_no, col_no
                        elif f.get("si") in common:
                            first, r0, c0 = common[f.get("si")]
                            said = shifted(first, row_no - r0, col_no - c0)
                    yield "formula", title, no, row_no, col_no, None, None, None, "=" + said
                text = whole(c.find("m:is", _NS)) if kind == "inlineStr" else None if v is None else v.text
                if text is None or text == "":
                    continue
                if kind == "s":
                    text, kind = shared[int(text)], "str"
                elif kind == "b":
                    text = "True" if text == "1" else "False"
                elif kind == "n" and int(c.get("s", 0)) in dated:
                    text, kind = (datetime(1899, 12, 30) + timedelta(days=float(text))).isoformat(sep=" "), "t"
                elif kind == "n":
                    text = _number(text)
                if text != "":
                    yield "cell", title, no, row_no, col_no, None, None, "str" if kind in ("inlineStr", "e") else kind, text


def read_workbook(spark: SparkSession, path: str) -> Workbook:
    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                rows = []
                for row in parse_workbook(bytes(content)):
                    rows.append(row)
                    if len(rows) == 50_000:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(parts, PART).cache()
    try:
        sheets = tuple(r["sheet"] for r in raw.filter("part = 'sheet'").orderBy("sheet_no").select("sheet").collect())
    except Exception as e:
        if "PythonException" in type(e).__name__:
            raise ReadError("The workbook can't be opened", path=path) from e
        raise
    if not sheets:
        raise ReadError("The workbook has no sheets", path=path)
    pick = lambda part, *cols: raw.filter(F.col("part") == part).select("sheet", *cols)
    return Workbook(pick("cell", "row", "col", "kind", "s"), pick("merge", "row", "col", "row2", "col2"), pick("formula", "row", "col", F.col("s").alias("formula")), sheets)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["part", "sheet", "sheet_no", "row", "col", "row2", "col2", "kind", "s"])
    return df.astype({c: "Int32" for c in ("row", "col", "row2", "col2")})
