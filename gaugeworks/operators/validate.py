"""Checks of the canonical table; each is a small violation table or one aggregate."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType

from gaugeworks.functions import scalars as S
from gaugeworks.plans.layout import CANONICAL

from .grouping import ROW, first_rows

REQUIRED = ("query_id", "input_query", "output_answer")
_METRIC_NAME = re.compile(r"\S+_metric|main_metric")


def violations(canon: DataFrame) -> list[dict[str, object]]:
    """All violations of the canonical table, as (check, column, count, rows): the first 20 source rows of each."""
    missing = [c for c in REQUIRED if c not in canon.columns]
    if missing:
        return [{"check": "missing_column", "column": c, "count": 1, "rows": []} for c in missing]
    names, tests = [], []
    for c in ("query_id", "input_query"):
        bad = S.blank(F.col(c), canon.schema[c].dataType)
        names.append(("blank", c))
        tests.append(bad)
    for f in canon.schema.fields:
        if f.name in CANONICAL or not _METRIC_NAME.fullmatch(f.name):
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            bad = F.isnan(c) | (F.abs(c) == float("inf"))
        else:
            bad = F.lit(not isinstance(f.dataType, NumericType) or isinstance(f.dataType, BooleanType)) & c.isNotNull()
        names.append(("metric_not_finite", f.name))
        tests.append(bad)
    r = canon.agg(*(F.count_if(t).alias(f"a{i}") for i, t in enumerate(tests))).first()
    found = [{"check": k, "column": c, "count": r[i], "rows": first_rows(canon, tests[i], 20)["rows"]} for i, (k, c) in enumerate(names) if r[i]]
    return found + _duplicates(canon) + _turns(canon)


def duplicate_ids(canon: DataFrame) -> DataFrame:
    """(session_id, query_id, n, first_row) of ids that repeat; sessions part ids where rows are grouped."""
    keys = ["session_id", "query_id"] if "reference_group_id" in canon.columns else ["query_id"]
    return canon.filter("query_id is not null").groupBy(*keys).agg(F.count("*").alias("n"), F.min(ROW).alias("first_row")).filter("n > 1")


def _duplicates(canon: DataFrame) -> list[dict[str, object]]:
    found = duplicate_ids(canon)
    n = found.count()
    rows = [r[0] for r in found.select("first_row").orderBy("first_row").limit(20).collect()] if n else []
    return [{"check": "duplicate_id", "column": "query_id", "count": n, "rows": rows}] if n else []


def turn_faults(canon: DataFrame) -> DataFrame:
    """Groups with a bad turn index: (reference_group_id, bad, repeated, first)."""
    t = F.col("turn_index").try_cast("long")
    per = canon.groupBy("reference_group_id").agg(
        F.count_if(t.isNull() | (t < 1)).alias("bad"), (F.count(t) - F.count_distinct(t)).alias("repeated"), F.min(t).alias("first"))
    return per.filter("bad > 0 or repeated > 0 or first is null or first <> 1 or reference_group_id is null")


def _turns(canon: DataFrame) -> list[dict[str, object]]:
    has = [c in canon.columns for c in ("reference_group_id", "turn_index")]
    if not any(has):
        return []
    if not all(has):
        return [{"check": "group_without_turn", "column": "turn_index", "count": 1, "rows": []}]
    n = turn_faults(canon).count()
    return [{"check": "turn_index", "column": "turn_index", "count": n, "rows": []}] if n else []


def blank_answers(canon: DataFrame, raw: list[str]) -> dict[str, object]:
    """How many answers are blank, and the raw columns that are filled on all of those rows."""
    gap = S.blank(F.col("output_answer"))
    full = [F.bool_and(~S.blank(F.col(f"`{c}`"), canon.schema[c].dataType)).alias(f"c{i}") for i, c in enumerate(raw)]
    r = canon.filter(gap).agg(F.count("*").alias("n"), *full).first()
    return {"count": r["n"], "fallbacks": [c for i, c in enumerate(raw) if r[f"c{i}"]]}


MARKER = r"([A-ZА-ЯЁ][A-ZА-ЯЁ_]{1,15}):"  # fixed pattern of an upper-case speaker mark


def dialogue_columns(df: DataFrame, columns: list[str], samples: int = 3) -> list[dict[str, object]]:
    """Columns whose first samples all alternate between the same two speaker marks."""
    out = []
    for c in columns:
        col = F.col(f"`{c}`").cast("string")
        marks = df.filter(~S.blank(col)).orderBy(ROW).limit(samples).select(F.regexp_extract_all(col, F.lit(MARKER), F.lit(1)).alias("m")).collect()
        pairs = {tuple(r["m"][:2]) for r in marks}
        if len(pairs) != 1 or not marks:
            continue
        (pair,) = pairs
        even = all(len(r["m"]) >= 2 and len(r["m"]) % 2 == 0 and all(m == pair[i % 2] for i, m in enumerate(r["m"])) for r in marks)
        if even and pair[0] != pair[1]:
            out.append({"column": c, "question_marker": pair[0], "answer_marker": pair[1]})
    return out


def repeated_in_groups(df: DataFrame, key: str, cell: str) -> bool:
    """Is the same cell repeated over a contiguous run of rows of one key?"""
    per = df.filter(~S.blank(F.col(f"`{key}`"))).groupBy(F.col(f"`{key}`").alias("k")).agg(
        F.count("*").alias("n"), (F.max(ROW) - F.min(ROW) + 1).alias("span"), F.count_distinct(F.col(f"`{cell}`")).alias("d"))
    return not per.filter("n > 1 and span = n and d = 1").isEmpty()
