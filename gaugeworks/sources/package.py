"""A package: one workbook and three documents, found, classified and counted."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugeworks.errors import PackageError

INSTRUCTION, IGNORED = "assessor_instruction.txt", ("distrib.txt",)
FILES = "path string, name string, kind string, size long, sha256 string"


def classify(name: str, content: bytes) -> str:
    """By suffix for plain text, else by what a zip holds."""
    if name.lower().endswith(".txt"):
        return "document_txt"
    if content[:2] != b"PK":
        return "other"
    try:
        names = zipfile.ZipFile(io.BytesIO(content)).namelist()
    except zipfile.BadZipFile:
        return "other"
    for prefix, kind in (("xl/", "basket_xlsx"), ("word/", "document_docx")):
        if any(n.startswith(prefix) for n in names):
            return kind
    return "other"


def scan_package(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder (not below it), without hidden and lock files, in the order of their paths."""
    raw = spark.read.format("binaryFile").load(path)
    raw = raw.withColumn("name", F.element_at(F.split("path", "/"), -1))
    raw = raw.filter(~F.col("name").startswith(".") & ~F.col("name").startswith("~$"))

    def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["kind"] = [classify(n, bytes(c)) for n, c in zip(b["name"], b["content"])]
            yield b[["path", "name", "kind", "size", "sha256"]]

    rows = raw.select("path", "name", "content", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    return rows.mapInPandas(kinds, FILES).orderBy("path")


def admitted(files: DataFrame) -> DataFrame:
    """Workbooks, all docx, and a txt only under its agreed name."""
    txt = (F.col("kind") == "document_txt") & (F.lower("name") == INSTRUCTION)
    return files.filter(F.col("kind").isin("basket_xlsx", "document_docx") | txt)


def check_package(files: DataFrame) -> None:
    """One workbook, three documents, at most one text file, and no stray one."""
    ok = admitted(files)
    docs = F.count_if(F.col("kind").isin("document_docx", "document_txt"))
    n = ok.agg(F.count_if(F.col("kind") == "basket_xlsx").alias("books"), docs.alias("docs"), F.count_if(F.col("kind") == "document_txt").alias("txt")).first()
    stray = [r["name"] for r in files.filter((F.col("kind") == "document_txt") & ~F.lower("name").isin(INSTRUCTION, *IGNORED)).select("name").collect()]
    if n["books"] != 1:
        raise PackageError("A package has exactly one workbook", found=n["books"])
    if n["docs"] != 3 or n["txt"] > 1 or stray:
        raise PackageError("A package has exactly three documents, one of them text at most", found=n["docs"], text=n["txt"], stray=stray)


def numbered_documents(files: DataFrame) -> DataFrame:
    """Documents as doc-1.. by file name."""
    docs = admitted(files).filter("kind <> 'basket_xlsx'")
    return docs.withColumn("document_id", F.concat(F.lit("doc-"), F.row_number().over(Window.orderBy("name"))))


def basket_id(name: str) -> str:
    found = re.search(r"(?i)ci[0-9]+", name)
    return found[0].upper() if found else name


def package_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "-", name).strip("-._") or "basket"


#: what each input port takes, and the name it is kept under
PORTS = {
    "validation_report": (("docx",), "validation_report.docx"),
    "test_set": (("xlsx",), "test_set.xlsx"),
    "development_report": (("docx",), "development_report.docx"),
    "assessor_instruction": (("docx", "txt"), INSTRUCTION),
}


def resolve_port(port: str, paths: list[str]) -> tuple[str, str]:
    """The one artifact of an allowed kind below a port, and its canonical name."""
    kinds, kept = PORTS[port]
    seen = [p for p in paths if not any(x.startswith(".") for x in PurePosixPath(p).parts) and p.rsplit(".", 1)[-1].lower() in kinds]
    if len(seen) != 1:
        raise PackageError("A port takes exactly one artifact", port=port, kinds=list(kinds), found=seen)
    suffix = seen[0].rsplit(".", 1)[-1].lower()
    return seen[0], kept.rsplit(".", 1)[0] + "." + suffix


def port_files(spark: SparkSession, folder: str) -> list[str]:
    """Files at any depth below a port's folder, relative to it; the driver lists names only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    top = fs.makeQualified(root).toString().rstrip("/")
    found, out = fs.listFiles(root, True), []
    while found.hasNext():
        out.append(found.next().getPath().toString().removeprefix(top + "/"))
    return sorted(out)


def prepare_package(spark: SparkSession, ports: dict[str, str], out: str, name: str) -> str:
    """Copy the one artifact of each port under its agreed name into a package folder; returns the folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = f"{out.rstrip('/')}/{package_name(name)}"
    for port, source in ports.items():
        found, kept = resolve_port(port, port_files(spark, source))
        a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{source.rstrip('/')}/{found}", f"{folder}/{kept}"))
        jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)
    return folder


#: what a settings file may say (fixed keys)
SETTINGS = ("model", "sheet")


def read_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """Operator settings from a small JSON object; unknown keys are refused."""
    said = json.loads(spark.read.text(path, wholetext=True).first()[0])
    unknown = sorted(set(said) - set(SETTINGS))
    if unknown:
        raise PackageError("Unknown settings", settings=unknown)
    return {k: str(v) for k, v in said.items() if v not in (None, "")}
