"""Column profiles and document evidence; bounded by construction, one pass for all columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from gaugeworks.functions import scalars as S

from .validate import MARKER

SAMPLES, CELL_CAP, UNIQUES = 3, 200, 30
INTRO_SPANS, INTRO_CHARS = 40, 6000


def long_cells(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """(column_name, row, value) of non-blank cells, white space collapsed."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), S.collapse(F.col(f"`{c}`")).alias("value")) for c in columns)))
    return df.select(F.col(order).alias("row"), cells.alias("c")).select("c.column_name", "row", "c.value").filter("value <> ''")


def value_counts(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """(column_name, value, n, first_row) of each distinct value."""
    return long_cells(df, columns, order).groupBy("column_name", "value").agg(F.count("*").alias("n"), F.min("row").alias("first_row"))


def _tally(frames):
    """One partition: totals of each key, counts of at most UNIQUES values, and the first rows.

    A key with more values is marked and its counts go, so that what is kept and sent is bounded.
    """
    totals = counts = heads = None
    many: set = set()
    for f in frames:
        t = f.groupby("key", sort=False).agg(n=("row", "size"), numbers=("is_number", "sum"), row=("row", "min"))
        totals = t if totals is None else pd.concat([totals, t]).groupby(level=0, sort=False).agg({"n": "sum", "numbers": "sum", "row": "min"})
        c = f[~f["key"].isin(many)].groupby(["key", "value"], sort=False)["row"].agg(["size", "min"])
        counts = c if counts is None else pd.concat([counts, c]).groupby(level=[0, 1], sort=False).agg({"size": "sum", "min": "min"})
        sizes = counts.groupby(level=0).size()
        many |= set(sizes.index[sizes > UNIQUES])
        counts = counts[~counts.index.get_level_values(0).isin(many)]
        h = f[["key", "row", "value"]]
        heads = (h if heads is None else pd.concat([heads, h])).sort_values(["row", "value"]).groupby("key").head(SAMPLES)
    if totals is None:
        return
    whole = totals.reset_index().assign(kind=_TOTAL, value="", many=lambda t: t["key"].isin(many))
    values = counts.reset_index().rename(columns={"size": "n", "min": "row"}).assign(kind=_VALUE, numbers=0, many=False)
    out = pd.concat([whole, values, heads.assign(kind=_HEAD, n=1, numbers=0, many=False)])
    yield out[["key", "kind", "value", "row", "n", "numbers", "many"]]


_TOTAL, _VALUE, _HEAD = range(3)


def evidence(cells: DataFrame) -> DataFrame:
    """Per key of (key, row, value): non_null, numeric, the first values, and frequencies where at most UNIQUES values occur.

    One pass over the cells.  A task sends at most UNIQUES + SAMPLES + 1 rows a key, however many
    values there are; a row's number is not null
    and occurs once a key.
    """
    kind = {f.name: f.dataType.simpleString() for f in cells.schema}
    parts = cells.select("key", "row", "value", S.is_numeric(F.col("value")).alias("is_number")).mapInPandas(
        _tally, f"key {kind['key']}, kind int, value string, row {kind['row']}, n long, numbers long, many boolean")
    place = F.when(F.col("kind") == _HEAD, F.col("row")).alias("place")
    merged = parts.groupBy("key", "kind", "value", place).agg(F.min("row").alias("row"), *(F.sum(c).alias(c) for c in ("n", "numbers")), F.max("many").alias("many"))
    order = Window.partitionBy("key", "kind").orderBy(F.when(F.col("kind") == _VALUE, -F.col("n")), "row", "value")
    ranked = merged.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= UNIQUES + 1)
    of = lambda k: F.col("kind") == k
    listed = lambda k, most, *c: F.array_sort(F.collect_list(F.when(of(k) & (F.col("r") <= most), F.struct("r", *c))))
    told = ranked.groupBy("key").agg(
        F.max(F.when(of(_TOTAL), F.col("n"))).alias("non_null"), F.max(F.when(of(_TOTAL), F.col("numbers"))).alias("numeric"), F.max("many").alias("many"),
        listed(_VALUE, UNIQUES + 1, "value", "n").alias("top"), listed(_HEAD, SAMPLES, "value").alias("head"))
    few = ~F.col("many") & (F.size("top") <= UNIQUES)
    return told.select(
        "key", "non_null", "numeric", F.transform("head", lambda x: S.cap(x["value"], CELL_CAP)).alias("samples"),
        F.when(few, F.transform("top", lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))).alias("values"))


def profile_columns(df: DataFrame, columns: list[str], order: str, distinct: bool = True) -> DataFrame:
    """Per column: non-null and numeric counts, first value, and frequencies of a few values.

    ``distinct`` adds the exact number of values, for which all of them are shuffled.
    """
    cells = long_cells(df, columns, order)
    told = evidence(cells.withColumnRenamed("column_name", "key")).withColumnRenamed("key", "column_name")
    shown = ["column_name", "non_null", "numeric", F.col("samples")[0].alias("first_value"), "samples", "values"]
    if not distinct:
        return told.select(*shown)
    exact = cells.groupBy("column_name").agg(F.count_distinct("value").alias("distinct_values"))
    return told.join(exact, "column_name").select(*shown[:3], "distinct_values", *shown[3:])


def samples(df: DataFrame, columns: list[str], order: str, n: int = SAMPLES) -> dict[str, list[str]]:
    """The first n non-blank values of each column, capped."""
    out = {}
    for c in columns:
        rows = df.select(S.collapse(F.col(f"`{c}`")).alias("v"), order).filter("v <> ''").orderBy(order).limit(n).select(S.cap(F.col("v"), CELL_CAP).alias("v")).collect()
        out[c] = [r["v"] for r in rows]
    return out


def sheet_columns(cells: DataFrame, header: int) -> DataFrame:
    """Per column of a sheet with values below the header (0-based): counts, first samples, and frequencies of a few values."""
    below = cells.filter(F.col("row") > header).select(F.col("col").alias("key"), "row", S.collapse(F.col("s")).alias("value")).filter("value <> ''")
    return evidence(below).withColumnRenamed("key", "col")


def dialogue_hints(df: DataFrame, column: str):
    """Distinct speaker marks of a text column in their order, where there are two at least."""
    marks = F.array_distinct(F.regexp_extract_all(F.col(column), F.lit(MARKER), F.lit(1)))
    return df.withColumn("marks", marks).filter(F.size("marks") >= 2)


def header_candidate(cells: DataFrame) -> int:
    """The first row (0-based) of two non-empty cells, else 0."""
    r = cells.filter(S.collapse(F.col("s")) != "").groupBy("row").agg(F.count("*").alias("n")).filter("n >= 2").agg(F.min("row")).first()
    return r[0] or 0


def document_intro(spans: DataFrame) -> DataFrame:
    """(document_id, intro): the first spans joined, cut at a number of characters."""
    head = spans.filter(F.col("pos") <= INTRO_SPANS)
    joined = head.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("t"))
    return joined.select("document_id", F.substring("t", 1, INTRO_CHARS).alias("intro"))
