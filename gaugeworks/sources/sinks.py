"""Sinks and digests."""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path
from typing import BinaryIO
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from gaugeworks.errors import NotEvaluable
from gaugeworks.functions.scalars import column_letters


def guarded(c: Column) -> Column:
    """Text that a spreadsheet would run as a formula, marked as text."""
    return F.when(F.substring(c, 1, 1).isin("=", "+", "-", "@"), F.concat(F.lit("'"), c)).otherwise(c)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet as it is; CSV with text guarded against formulas."""
    if fmt == "csv":
        df = df.select(*(guarded(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`").cast("string").alias(f.name) for f in df.schema.fields))
        df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode(mode).format(fmt).save(path)


def put_file(path: str | Path, write: Callable[[BinaryIO], None]) -> None:
    """A file that is there whole or not at all; a path with a scheme is written through Hadoop's file systems."""
    if "://" not in str(path):
        path = Path(path)
        path.parent.mkdir(parents=True, exist_ok=True)
        fd, temp = tempfile.mkstemp(dir=path.parent)
        with os.fdopen(fd, "wb") as f:
            write(f)
        os.replace(temp, path)
        return
    context = SparkSession.active().sparkContext
    to = context._jvm.org.apache.hadoop.fs.Path(str(path))
    temp = context._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = to.getFileSystem(context._jsc.hadoopConfiguration())
    with tempfile.TemporaryFile() as f:
        write(f)
        f.seek(0)
        out = fs.create(temp, True)
        for piece in iter(lambda: f.read(1 << 20), b""):
            out.write(piece)
        out.close()
    fs.delete(to, False)
    if not fs.rename(temp, to):
        raise OSError(f"{temp} can't be renamed to {path}")


def atomic_json(path: str | Path, payload: object) -> None:
    put_file(path, lambda f: f.write(json.dumps(payload, ensure_ascii=False, indent=2, default=str).encode()))


def write_failure(folder: str | Path, error) -> None:
    atomic_json(f"{folder}/failure.json", error.to_dict())


def clear_failure(spark: SparkSession, folder: str | Path) -> None:
    """Remove what :func:`write_failure` has left in a folder; nothing else."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/failure.json")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


#: rows of a sheet (fixed value), and characters that a sheet's text can't hold
SHEET_ROWS = 1 << 20
_UNFIT = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def write_workbook(df: DataFrame, path: str | Path, title: str = "Sheet1") -> int:
    """One sheet, for results that fit in one; rows stream through the driver to the file. Text stays text."""
    write, rows = workbook_writer(df, title)
    put_file(path, write)
    return rows[0]


def workbook_writer(df: DataFrame, title: str = "Sheet1") -> tuple[Callable[[BinaryIO], None], list[int]]:
    """What writes the sheet to a file, and where it tells the number of rows."""
    def cell(ref: str, v: object) -> str:
        if v is None or v != v:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
            return f'<c r="{ref}"><v>{float(v) if hasattr(v, "as_tuple") else v!r}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(_UNFIT.sub("", str(v)))}</t></is></c>'

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(title)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }
    rows = [0]

    def write(f: BinaryIO) -> None:
        with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in parts.items():
                z.writestr(name, text)
            with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
                sheet.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
                for n, row in enumerate(itertools.chain([tuple(df.columns)], map(tuple, df.toLocalIterator())), 1):
                    if n > SHEET_ROWS:
                        raise NotEvaluable("The table doesn't fit in a sheet", rows=SHEET_ROWS)
                    sheet.write((f'<row r="{n}">' + "".join(cell(f"{column_letters(i)}{n}", v) for i, v in enumerate(row)) + "</row>").encode())
                    rows[0] = n - 1
                sheet.write(b"</sheetData></worksheet>")

    return write, rows


def sha256_json(payload: object) -> str:
    """Of sorted keys, without spaces, letters as they are."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


#: children of a node of a digest tree
FAN_OUT = 64


def _leaf(c: Column) -> Column:
    """A value with its length, so that no two rows of values look alike; null is no text."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.octet_length(text), F.lit(":"), text))


def _fold(df: DataFrame, node: str, columns: list[str], fan_out: int) -> DataFrame:
    """Nodes one level up: the digest of fan_out children at most, in their order, for all columns in one shuffle."""
    kids = F.array_sort(F.collect_list(F.struct(node, *(F.col(f"`{c}`") for c in columns))))
    up = df.groupBy(F.expr(f"`{node}` div {fan_out}").alias("_up")).agg(kids.alias("_kids"))
    joined = lambda c: F.array_join(F.col("_kids").getField(c), "\x1f")
    return up.select(F.col("_up").alias(node), *(F.sha2(joined(c), 256).alias(c) for c in columns))


def digest_levels(df: DataFrame, order: str, columns: list[str] | None = None, fan_out: int = FAN_OUT, depth: int | None = None) -> list[DataFrame]:
    """Digest trees of all columns over the numbers of ``order``, unique and from 0: level k has (node, a digest a column) over fan_out^(k+1) rows each.

    No task holds more than fan_out values of a column; a level has fan_out times fewer
    rows than the one below. ``depth`` levels at least, so that trees of unequal tables meet.
    """
    columns = columns or [c for c in df.columns if c != order]
    top = df.agg(F.coalesce(F.max(order), F.lit(0))).first()[0]
    level = df.select(F.col(order).cast("long").alias("_node"), *(_leaf(F.col(f"`{c}`")).alias(c) for c in columns))
    levels = []
    while not levels or top > 0 or len(levels) < (depth or 0):
        level = _fold(level, "_node", columns, fan_out)
        levels.append(level)
        top //= fan_out
    return levels


def frame_digest(df: DataFrame, order: str, columns: list[str] | None = None, fan_out: int = FAN_OUT, depth: int | None = None) -> DataFrame:
    """(column_name, digest): the root of each column's digest tree over a unique whole number from 0."""
    columns = columns or [c for c in df.columns if c != order]
    root = digest_levels(df, order, columns, fan_out, depth)[-1]
    return root.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("digest")) for c in columns))).alias("x")).select("x.*")


def frame_difference(left: DataFrame, right: DataFrame, order: str, columns: list[str] | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """(column_name, first_row, last_row): the lowest blocks in which two tables differ, a column at a time.

    Both trees are walked down from the root; below the root only children of nodes that
    differ are compared, and a level's nodes are read once for all columns.
    """
    columns = columns or [c for c in left.columns if c != order]
    deep = lambda df: len(digest_levels(df, order, columns, fan_out))
    depth = max(deep(left), deep(right))
    trees = [digest_levels(df, order, columns, fan_out, depth) for df in (left, right)]
    open_ = None
    for a, b in reversed(list(zip(*trees))):
        other = b.select(F.col("_node").alias("_other"), *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)))
        met = a.join(other, F.col("_node") == F.col("_other"), "full").withColumn("_at", F.coalesce("_node", "_other"))
        differ = F.filter(F.array(*(F.when(~F.col(f"`{c}`").eqNullSafe(F.col(f"_{i}")), F.lit(c)) for i, c in enumerate(columns))), lambda x: x.isNotNull())
        found = met.select("_at", F.explode(differ).alias("column_name"))
        if open_ is not None:
            above = open_.select("column_name", F.col("_at").alias("_above"))
            found = found.withColumn("_above", F.expr(f"_at div {fan_out}")).join(above, ["column_name", "_above"]).drop("_above")
        open_ = found
    return open_.select("column_name", (F.col("_at") * fan_out).alias("first_row"), ((F.col("_at") + 1) * fan_out - 1).alias("last_row"))


def table_digest(df: DataFrame) -> dict[str, object]:
    """Rows of a table and two sums over them that don't depend on their order; one aggregate."""
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    sums = (F.coalesce(F.bit_xor(F.xxhash64(text, F.lit(i))), F.lit(0)).alias(f"x{i}") for i in range(2))
    r = df.agg(F.count("*").alias("rows"), *sums).first()
    return {"columns": df.columns, "rows": r["rows"], "sums": [r["x0"], r["x1"]]}
