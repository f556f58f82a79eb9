"""Evidence in documents, and columns whose plain means explain a published figure."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.errors import NotEvaluable
from gaugeworks.functions import scalars as S
from gaugeworks.plans.contracts import MetricPlan

from .metric import Evaluation, reported_quantum

#: words that name a reducer (fixed patterns)
MACRO, WEIGHTED = r"(?iU)\bmacro\b|\bмакро\w*", r"(?iU)\bweighted\b|\bвзвеш\w*"
_MACRO, _WEIGHTED = (re.compile(p.replace("(?iU)", "(?i)")) for p in (MACRO, WEIGHTED))


def reducer_flags(text: Column) -> tuple[Column, Column]:
    return text.rlike(MACRO), text.rlike(WEIGHTED)


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)\w+"), F.lit(0)))


def reducer_spans(spans: DataFrame, most: int = 12) -> DataFrame:
    """Spans that name a reducer and the spans behind them, in order."""
    w = Window.partitionBy("document_id").orderBy("pos")
    macro, weighted = reducer_flags(F.col("text"))
    flagged = spans.withColumn("_f", macro | weighted).withColumn("_p", F.coalesce(F.lag("_f").over(w), F.lit(False)))
    ranked = flagged.filter("_f or _p").withColumn("_n", F.row_number().over(w))
    return ranked.filter(F.col("_n") <= most).drop("_f", "_p", "_n")


def reported_candidates(spans: DataFrame, reducer: str, scale: str) -> DataFrame:
    """Short labels of one reducer whose next span holds exactly one number."""
    w = Window.partitionBy("document_id").orderBy("pos")
    macro, weighted = reducer_flags(F.col("text"))
    only = (macro & ~weighted) if reducer == "mean" else (weighted & ~macro)
    nxt = spans.withColumn("raw", F.lead("text").over(w)).withColumn("value_pos", F.lead("pos").over(w))
    found = nxt.filter(only & (word_count(F.col("text")) <= 3) & F.col("raw").isNotNull()).withColumn("_n", S.numbers(F.col("raw"))).filter(F.size("_n") == 1)
    one = F.col("_n")[0]
    value = F.when(one["percent"], (one["value"] / F.lit(Decimal(100)).cast("decimal(3,0)")).cast(S.NUMBER)).otherwise(one["value"]) if scale == "ratio" else one["value"]
    return found.select("document_id", F.col("pos").alias("label_pos"), "value_pos", "raw", value.alias("value"))


def variants_of(text: str) -> set[str]:
    return {v for v, p in (("mean", _MACRO), ("frequency_weighted_mean", _WEIGHTED)) if p.search(text)}


def identity_candidates(df: DataFrame, columns: list[str], weight: str | None = None, group: str | None = None, order: str = "source_row_id") -> DataFrame:
    """For each column the means it could stand for: plain, weighted, and both over first values of groups.

    Text is read leniently: what isn't a plain number is no value.  All columns' sums are taken in
    one row a task, without a row a cell; first values of a group are one row a group.
    """
    number = lambda c: F.nullif(F.col(f"`{c}`").try_cast("double"), F.lit(float("nan")))
    values = {f"x{i}": number(c) for i, c in enumerate(columns)} | {"w": number(weight) if weight else F.lit(1.0)}
    rows = df.select(F.col(order).alias("o"), (F.col(group) if group else F.lit(None).cast("string")).alias("g"), *(v.alias(k) for k, v in values.items()))

    def means(t: DataFrame, unit: str) -> DataFrame:
        forms = []
        for i, c in enumerate(columns):
            x, w = F.col(f"x{i}"), F.col("w")
            both = x.isNotNull() & w.isNotNull()
            weights = F.sum(F.when(both, w))
            found = {"mean": F.avg(x)} | ({"frequency_weighted_mean": F.when(weights > 0, F.sum(F.when(both, x * w)) / weights)} if weight else {})
            forms += [F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"), F.lit(unit).alias("assessment_mode"), F.lit(k).alias("reducer"), v.alias("value")) for k, v in found.items()]
        return t.agg(F.array(*forms).alias("f")).select(F.inline("f"))

    out = means(rows, "qa")
    if group:
        firsts = rows.groupBy("g").agg(*(F.min_by(k, F.when(F.col(k).isNotNull(), F.col("o"))).alias(k) for k in values))
        out = out.union(means(firsts, "dialogue"))
    return out.filter("value is not null")


def matching_plans(candidates: DataFrame, target: Decimal, tolerance: Decimal, most: int = 12) -> DataFrame:
    """Candidates within the tolerance, in column order; a report of at most ``most``."""
    gap = F.abs(F.col("value") - float(target))
    return candidates.filter(gap <= float(tolerance)).orderBy("i", "assessment_mode", "reducer").limit(most)


def gate(result: Evaluation, candidates: DataFrame) -> None:
    """On a mismatch, refuse a plan that another column's plain mean explains."""
    plan: MetricPlan = result.plan
    if result.reconciliation != "mismatch":
        return
    unit = Decimal(100) if plan.scale == "percent" else Decimal(1)
    found = matching_plans(candidates, plan.reported_value / unit, reported_quantum(plan) / unit).collect()
    if found:
        raise NotEvaluable(
            "The recomputed figure misses the published one, and plain means of other columns explain it",
            reported_value=str(plan.reported_value), recomputed_value=float(result.recomputed), difference=str(result.difference),
            published_quantum=str(reported_quantum(plan)),
            matching_identity_plans=[{"method": "identity", "column": r["column_name"], "assessment_mode": r["assessment_mode"], "reducer": r["reducer"], "recomputed": r["value"]} for r in found],
        )
