"""Documents as numbered paragraph spans, and markup as text."""

from __future__ import annotations

import html
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeworks.errors import ReadError

SPANS = "document_id string, pos int, span_id string, text string"


def strip_markup(c: Column) -> Column:
    """Paragraph ends as line breaks, table cells as tabs, no tags; entities stay."""
    text = F.regexp_replace(c, "</w:p>", "\n")
    text = F.regexp_replace(text, "</w:tc>", "\t")
    return F.regexp_replace(text, "<[^>]*>", "")


def tidy(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


def unescaped(c: Column) -> Column:
    def run(cells: pd.Series) -> pd.Series:
        return cells.map(html.unescape, na_action="ignore")

    return F.pandas_udf(run, "string")(c)


def markup_to_text(c: Column) -> Column:
    return tidy(unescaped(strip_markup(c)))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(document_id, pos, span_id, text) of the non-blank lines, numbered from one."""
    lines = docs.select(F.col(id_col).cast("string").alias("document_id"), F.posexplode(F.split(F.col(text_col), r"\R|[\x1C-\x1E]")).alias("_line", "_raw"))
    lines = lines.withColumn("text", F.regexp_replace("_raw", r"(?U)^\s+|\s+$", "")).filter("text <> ''")
    pos = F.row_number().over(Window.partitionBy("document_id").orderBy("_line"))
    return lines.withColumn("pos", pos).select("document_id", "pos", F.format_string("%s:p%04d", "document_id", "pos").alias("span_id"), "text")


def read_documents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Spans of numbered documents (path, document_id, kind)."""
    listed = files.select("path", "document_id", "kind").collect()  # three at most
    raw = spark.read.format("binaryFile").load([r["path"] for r in listed]).select("path", "content")
    named = raw.join(F.broadcast(files.select("path", "document_id", "kind")), "path")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for kind, content in zip(b["kind"], b["content"]):
                content = bytes(content)
                if kind == "document_docx":
                    texts.append(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml").decode("utf-8", "replace"))
                else:
                    texts.append(content.decode("utf-8-sig"))
            yield pd.DataFrame({"document_id": b["document_id"], "kind": b["kind"], "raw": texts})

    try:
        texts = named.mapInPandas(unpack, "document_id string, kind string, raw string")
        whole = F.when(F.col("kind") == "document_docx", markup_to_text(F.col("raw"))).otherwise(tidy(F.col("raw")))
        spans = paragraphs(texts.select("document_id", whole.alias("text")), "document_id", "text")
        seen = {r["document_id"] for r in spans.select("document_id").distinct().collect()}
    except Exception as e:
        if "PythonException" in type(e).__name__:
            raise ReadError("A document can't be read", reason=str(e).strip().splitlines()[-1]) from e
        raise
    empty = [r["path"] for r in listed if r["document_id"] not in seen]
    if empty:
        raise ReadError("A document holds no text", paths=empty)
    return spans
