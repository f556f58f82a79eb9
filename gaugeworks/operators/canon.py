"""Canonical rows: identity, session, weight, text roles, then every raw column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from gaugeworks.errors import LayoutError
from gaugeworks.functions import scalars as S
from gaugeworks.plans.layout import LayoutPlan, raw_names

from .grouping import ROW, first_rows, group_by_column, group_by_merges, unroll_cell, with_turn_index
from .ordering import number_rows

_EXACT = float(1 << 53)


def text_role(df: DataFrame, name: str) -> Column:
    """The text as stored, or null if it is white space."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    return F.when(~S.blank(c, kind), _render(c, kind))


def scalar_role(df: DataFrame, name: str) -> Column:
    return text_role(df, name)


def _render(c: Column, kind) -> Column:
    """Numbers without a needless fraction."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when((c == F.floor(c)) & (F.abs(c) < _EXACT), F.floor(c).cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def rendered_id(df: DataFrame, name: str) -> Column:
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    return S.strip(_render(c, kind)) if isinstance(kind, StringType) else _render(c, kind)


def id_flags(df: DataFrame, name: str, scope: str | None = None) -> dict[str, object]:
    """Is a column fit as an id: nothing blank, nothing beyond exact integers, unique in its scope?"""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    vast = (F.abs(c.cast("double")) >= _EXACT) if isinstance(kind, (DoubleType, FloatType)) else F.lit(False)
    keys = [rendered_id(df, name).alias("k")] + ([F.col(f"`{scope}`").alias("s")] if scope else [])
    groups = df.select(*keys, S.blank(c, kind).alias("blank"), vast.alias("vast")).groupBy(*(["k", "s"] if scope else ["k"]))
    per = groups.agg(F.count("*").alias("n"), F.bool_or("blank").alias("blank"), F.bool_or("vast").alias("vast"))
    r = per.agg(F.bool_or("blank"), F.bool_or("vast"), F.max("n")).first()
    out = {"blank": bool(r[0]), "vast": bool(r[1]), "unique": (r[2] or 0) <= 1}
    return out | {"renders": not out["blank"] and not out["vast"], "usable": not out["blank"] and not out["vast"] and out["unique"]}


def weight_violations(df: DataFrame, name: str) -> DataFrame:
    """Rows whose weight is no whole number from one on."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    value = F.lit(None).cast(S.NUMBER) if kind.typeName() == "boolean" else S.parse_number(c, kind)
    bad = value.isNull() | (value < 1) | (value != F.floor(value))
    return df.filter(F.coalesce(bad, F.lit(True))).select(ROW, c.cast("string").alias("weight"))


def build_canon(df: DataFrame, plan: LayoutPlan, merges: DataFrame | None = None) -> tuple[DataFrame, dict[str, object]]:
    """The canonical table of a region with ``source_row_id``, and an account of what was chosen."""
    raw = [c for c in df.columns if c != ROW]
    account: dict[str, object] = {"grouping": plan.grouping}
    grouped, order = df, (ROW,)
    if plan.grouping == "column":
        grouped = group_by_column(df, plan.group_column)
    elif plan.grouping == "merged_rows":
        grouped = group_by_merges(df, merges, dict(enumerate(raw)))
    elif plan.grouping == "blob_row":
        c = plan.cell
        grouped, order = unroll_cell(df, c.column, c.question_marker, c.answer_marker, c.container), (ROW, "blob_turn")
    in_groups = plan.grouping != "none"
    if plan.weight:
        bad = first_rows(weight_violations(grouped, plan.weight), F.lit(True))
        if bad["n"]:
            raise LayoutError("Weights must be whole numbers from one on", invalid_count=bad["n"], rows=bad["rows"])
        kind = grouped.schema[plan.weight].dataType
        count = S.parse_number(F.col(f"`{plan.weight}`"), kind).cast("long")
    else:
        count = F.lit(1).cast("long")

    named = number_rows(grouped, ROW, "_n") if plan.grouping != "blob_row" else grouped.withColumn("_n", F.lit(None).cast("long"))
    if plan.session_id:
        if not id_flags(named, plan.session_id)["renders"]:
            raise LayoutError("The session column holds blanks or inexact numbers", column=plan.session_id)
        session, account["session_id"] = rendered_id(named, plan.session_id), "column"
    elif in_groups:
        session, account["session_id"] = F.col("group_index").cast("string"), "group"
    else:
        session, account["session_id"] = F.col("_n").cast("string"), "row"
    named = named.withColumn("_session", session)
    if plan.grouping == "blob_row":
        query, account["query_id"] = F.col("query_id_override"), "cell"
    elif plan.query_id and id_flags(named, plan.query_id, "_session" if plan.session_id or in_groups else None)["usable"]:
        query, account["query_id"] = rendered_id(named, plan.query_id), "column"
    else:
        query, account["query_id"] = F.concat(F.lit("row-"), F.col("_n")), "made"
    if in_groups:
        named = with_turn_index(named, "group_index", order)

    from_cell = plan.grouping == "blob_row"
    blank_to_null = lambda c: F.when(~S.blank(c), c)
    question = blank_to_null(F.col("blob_question")) if from_cell else text_role(named, plan.input_query)
    answers = [blank_to_null(F.col("blob_answer"))] if from_cell else [text_role(named, c) for c in plan.output_answer]
    cols = [
        F.col(ROW), query.alias("query_id"), F.col("_session").alias("session_id"), count.alias("input_query_count"),
        question.alias("input_query"), (F.coalesce(*answers) if answers else F.lit(None).cast("string")).alias("output_answer"),
    ]
    cols += [scalar_role(named, c).alias(n) for n, c in (("scenario", plan.scenario), ("assessor_id", plan.assessor_id)) if c]
    cols += [text_role(named, c).alias("reference_answer" if i == 1 else f"reference_answer_{i}") for i, c in enumerate(plan.reference_answers, 1)]
    if in_groups:
        cols += [F.col("group_index").cast("string").alias("reference_group_id"), F.col("turn_index")]
    names = raw_names(raw)
    cols += [F.col(f"`{c}`").alias(names[c]) for c in raw]
    return named.select(*cols), account


def drop_blank_questions(canon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a question, and the source rows of those without."""
    empty = S.blank(F.col("input_query"))
    return canon.filter(~empty), canon.filter(empty).select(ROW)
