"""The query catalogue: every operator over whole tables, with equivalent SQL.

Each entry is (query, SQL); SQL is None where it can't express the operator.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.functions import scalars as S
from gaugeworks.operators import grouping, profile, publish, reconcile, validate
from gaugeworks.operators.canon import build_canon, weight_violations
from gaugeworks.operators.metric import VIOLATIONS, evaluate, metric_table as guarded_table, units, with_scores
from gaugeworks.plans.contracts import MetricPlan, Source
from gaugeworks.plans.layout import LayoutPlan
from gaugeworks.sources import documents as docs_source
from gaugeworks.sources.sinks import frame_digest

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, tuple[Query, str | None]] = {}


def register(sql: str | None, name: str | None = None):
    def add(f: Query) -> Query:
        CATALOGUE[name or f.__name__] = (f, sql)
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def metric_table(df: DataFrame, plan: MetricPlan, by: list[str] | None = None) -> DataFrame:
    """The table without its violation counts: a value that is there had none."""
    return guarded_table(df, plan, by).drop(*VIOLATIONS)


def _plan(method: str, *sources: Source, **more) -> MetricPlan:
    return MetricPlan("km", method, sources, **more)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with labels where there are any, and three criteria."""
    df = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return df.withColumns({"clean": 1 - F.col("toxic"), "long": (F.col("n_chars") >= 1000).cast("int")})


_LABELLED = "(SELECT d.*, quality, toxic, 1 - toxic AS clean, (n_chars >= 1000)::INT AS long FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _mean_sql(score: str, source: str, weight: str = "1") -> str:
    return f"""
SELECT count(*) AS total_units, count(s) AS scored_units, count(*) - count(s) AS excluded_units,
       coalesce(sum(CASE WHEN s IS NOT NULL THEN w END), 0)::BIGINT AS weight_sum, round(sum(s * w)::DOUBLE / sum(CASE WHEN s IS NOT NULL THEN w END), 9) AS value
FROM (SELECT {score} AS s, {weight} AS w FROM {source})"""


# ---- metrics


@register(_mean_sql("quality::DOUBLE", "labels"))
def km_identity_mean(spark, sf):
    return metric_table(table(spark, sf, "labels"), _plan("identity", Source("quality")))


@register(_mean_sql("coalesce(quality, 0)::DOUBLE", _LABELLED))
def km_identity_zero_policy(spark, sf):
    return metric_table(_labelled(spark, sf), _plan("identity", Source("quality"), missing_policy="zero"))


@register(_mean_sql("quality::DOUBLE", _LABELLED))
def km_identity_exclude_unit(spark, sf):
    return metric_table(_labelled(spark, sf), _plan("identity", Source("quality"), missing_policy="exclude_unit"))


@register(_mean_sql("(1 - toxic)::DOUBLE", "labels"))
def km_identity_inverted(spark, sf):
    return metric_table(table(spark, sf, "labels"), _plan("identity", Source("toxic", inverted=True)))


_PRIORITIES = {"1-URGENT": "1", "2-HIGH": "0.75", "3-MEDIUM": "0.5", "4-NOT SPECIFIED": "0.25", "5-LOW": "0"}


@register(_mean_sql("CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _PRIORITIES.items()) + " END::DOUBLE", "orders"))
def km_value_map(spark, sf):
    mapped = tuple((f"  {k.lower()} ", Decimal(v)) for k, v in _PRIORITIES.items())
    return metric_table(table(spark, sf, "orders"), _plan("identity", Source("o_orderpriority", normalization="value_map", value_map=mapped)))


@register(_mean_sql("(event_id % 1001)::DOUBLE / 1000", "events"))
def km_percent_parse(spark, sf):
    n = F.col("event_id") % 1001
    text = F.concat(F.lit(" "), F.floor(n / 10).cast("string"), F.lit(","), (n % 10).cast("string"), F.lit(" %"))
    return metric_table(table(spark, sf, "events").withColumn("share", text), _plan("identity", Source("share")))


_BOTH = "(SELECT l_linestatus, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


@register(_mean_sql("(l_linestatus = o_orderstatus)::INT::DOUBLE", _BOTH))
def km_accuracy_label(spark, sf):
    both = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    both = both.select(F.concat(F.lit("  "), F.lower("l_linestatus")).alias("p"), F.concat("o_orderstatus", F.lit("\t")).alias("t"))
    return metric_table(both, _plan("accuracy", Source("p", "prediction", "label"), Source("t", "target", "label")))


_CRITERIA = tuple(Source(c, "criterion") for c in ("quality", "clean", "long"))


def _criteria(method: str, policy: str) -> Query:
    return lambda spark, sf: metric_table(_labelled(spark, sf), _plan(method, *_CRITERIA, missing_policy=policy))


_SUM, _N = "(coalesce(quality, 0) + coalesce(clean, 0) + coalesce(long, 0))", "((quality IS NOT NULL)::INT + (clean IS NOT NULL)::INT + (long IS NOT NULL)::INT)"
for _policy, _score in {"exclude_value": f"{_SUM}::DOUBLE / nullif({_N}, 0)", "exclude_unit": f"CASE WHEN {_N} = 3 THEN {_SUM}::DOUBLE / 3 END", "zero": f"{_SUM}::DOUBLE / 3"}.items():
    register(_mean_sql(_score, _LABELLED), f"km_mean_criteria_{_policy}")(_criteria("mean_criteria", _policy))
register(_mean_sql("least(quality, clean, long)::DOUBLE", _LABELLED), "km_all_criteria")(_criteria("all_criteria", "exclude_value"))


def _votes(method: str, *columns: str, **more) -> Query:
    return lambda spark, sf: metric_table(_labelled(spark, sf), _plan(method, *(Source(c, "assessor_vote") for c in columns), **more))


register(_mean_sql("least(coalesce(quality, 0), coalesce(clean, 0), long)::DOUBLE", _LABELLED), "km_all_assessors")(_votes("all_assessors", "quality", "clean", "long", missing_policy="zero"))
register(_mean_sql(f"CASE WHEN {_N} = 0 OR 2 * {_SUM} = 3 THEN NULL ELSE (2 * {_SUM} > 3)::INT END::DOUBLE", _LABELLED), "km_majority_declared")(
    _votes("majority", "quality", "clean", "long", missing_policy="exclude_unit"))
register(_mean_sql(f"CASE WHEN {_N} = 0 OR 2 * {_SUM} = {_N} THEN NULL ELSE (2 * {_SUM} > {_N})::INT END::DOUBLE", _LABELLED), "km_majority_present")(
    _votes("majority", "quality", "clean", "long", missing_policy="exclude_unit", majority_denominator="present"))
register(_mean_sql("CASE WHEN coalesce(quality, 0) + long = 1 THEN 0 ELSE (coalesce(quality, 0) + long > 1)::INT END::DOUBLE", _LABELLED), "km_majority_tie")(
    _votes("majority", "quality", "long", missing_policy="zero"))

_FLAGS = (("A", Decimal(1)), ("N", Decimal("0.5")), ("R", Decimal(0)))
_FLAG = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0.5 WHEN 'R' THEN 0 END::DOUBLE"


@register(_mean_sql(_FLAG, "lineitem", "l_quantity::BIGINT"))
def km_weighted_mean(spark, sf):
    return metric_table(table(spark, sf, "lineitem"), _plan("identity", Source("l_returnflag", normalization="value_map", value_map=_FLAGS), weight="l_quantity"))


@register("""
SELECT l_linestatus, count(*) AS total_units, count(s) AS scored_units, count(*) - count(s) AS excluded_units, sum(w)::BIGINT AS weight_sum, round(sum(s * w)::DOUBLE / sum(w), 9) AS value
FROM (SELECT l_linestatus, %s AS s, l_quantity::BIGINT AS w FROM lineitem) GROUP BY l_linestatus""" % _FLAG)
def km_weighted_by_status(spark, sf):
    plan = _plan("identity", Source("l_returnflag", normalization="value_map", value_map=_FLAGS), weight="l_quantity")
    return metric_table(table(spark, sf, "lineitem"), plan, ["l_linestatus"])


def _dialogues(spark, sf) -> DataFrame:
    """Conversations with a score on their first turn only and a weight on all."""
    df = table(spark, sf, "conversations")
    return df.withColumns({"score": F.when(F.col("turn") == 0, F.col("conv_id") % 2), "w": F.col("conv_id") % 5 + 1})


def _dialogue_plan(**more) -> MetricPlan:
    return _plan("identity", Source("score"), unit="dialogue", group="conv_id", order="turn", missing_policy="exclude_unit", **more)


_CONVS = "(SELECT conv_id, max(CASE WHEN turn = 0 THEN conv_id % 2 END) AS s0, max(conv_id % 5 + 1) AS w0 FROM conversations GROUP BY conv_id)"
register(_mean_sql("s0::DOUBLE", _CONVS), "km_dialogue_mean")(lambda spark, sf: metric_table(_dialogues(spark, sf), _dialogue_plan()))
register(_mean_sql("s0::DOUBLE", _CONVS, "w0"), "km_dialogue_weighted")(lambda spark, sf: metric_table(_dialogues(spark, sf), _dialogue_plan(weight="w")))


@register("SELECT l_orderkey AS unit FROM lineitem GROUP BY l_orderkey HAVING min(l_returnflag) <> max(l_returnflag)")
def km_dialogue_nonconstant(spark, sf):
    plan = _plan("identity", Source("l_returnflag", normalization="value_map", value_map=_FLAGS), unit="dialogue", group="l_orderkey")
    return units(table(spark, sf, "lineitem"), plan).filter("unsteady > 0").select("unit")


@register(f"SELECT doc_id, round({_SUM}::DOUBLE / nullif({_N}, 0), 9) AS main_metric FROM {_LABELLED}")
def km_per_row_writeback(spark, sf):
    scored = with_scores(_labelled(spark, sf), _plan("mean_criteria", *_CRITERIA, missing_policy="exclude_value"))
    return scored.select("doc_id", F.round("main_metric", 9).alias("main_metric"))


@register("SELECT conv_id, turn, max(CASE WHEN turn = 0 THEN conv_id % 2 END) OVER (PARTITION BY conv_id)::DOUBLE AS main_metric FROM conversations")
def km_dialogue_writeback(spark, sf):
    return with_scores(_dialogues(spark, sf), _dialogue_plan()).select("conv_id", "turn", "main_metric")


@register(f"""
SELECT lang, count(*) AS total_units, count(quality) AS scored_units, count(*) - count(quality) AS excluded_units, count(quality) AS weight_sum,
       round(100 * sum(quality)::DOUBLE / nullif(count(quality), 0), 9) AS value FROM {_LABELLED} GROUP BY lang""")
def km_by_scenario(spark, sf):
    return metric_table(_labelled(spark, sf), _plan("identity", Source("quality"), missing_policy="exclude_unit", scale="percent"), ["lang"])


_CASES = (("strict", "0.99", ">=", None, None), ("loose", "0.5", ">=", None, None), ("reported", "0.9", ">=", "0.9", "0.9"), ("far", "0.3", "<=", "0.25", "25%"))


@register("""
WITH m AS (SELECT avg(quality) AS v FROM labels),
c(case_name, threshold, comparator, reported, quantum) AS (VALUES ('strict', 0.99, '>=', NULL, NULL), ('loose', 0.5, '>=', NULL, NULL), ('reported', 0.9, '>=', 0.9, 0.1), ('far', 0.3, '<=', 0.25, 0.01))
SELECT case_name, round(coalesce(reported::DOUBLE, v), 9) AS value,
       CASE WHEN (comparator = '>=' AND coalesce(reported::DOUBLE, v) >= threshold) OR (comparator = '<=' AND coalesce(reported::DOUBLE, v) <= threshold) THEN 'passed' ELSE 'failed' END AS verdict,
       CASE WHEN reported IS NULL THEN 'not_applicable' WHEN abs(reported::DOUBLE - v) <= quantum THEN 'match' ELSE 'mismatch' END AS reconciliation
FROM m, c""")
def km_verdict_reconciliation(spark, sf):
    labels, rows = table(spark, sf, "labels"), []
    for name, threshold, comparator, reported, raw in _CASES:
        plan = _plan("identity", Source("quality"), threshold=Decimal(threshold), comparator=comparator, reported_value=reported and Decimal(reported), reported_raw=raw)
        r = evaluate(labels, plan)
        rows.append((name, round(float(r.value), 9), r.verdict, r.reconciliation))
    return spark.createDataFrame(rows, "case_name string, value double, verdict string, reconciliation string")


@register(f"SELECT count(*) AS total_units, count(quality) AS scored_units, count(*) - count(quality) AS excluded_units, count(quality) AS weight_sum FROM {_LABELLED}")
def km_coverage(spark, sf):
    return metric_table(_labelled(spark, sf), _plan("identity", Source("quality"), missing_policy="exclude_unit")).drop("value")


# ---- grouping and canonical rows


@register("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = (SELECT min(event_id) % 3 FROM events) THEN event_type END AS k FROM events),
f AS (SELECT event_id, last_value(k IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM e),
n AS (SELECT g, row_number() OVER (ORDER BY min(event_id)) - 1 AS group_index FROM f GROUP BY g)
SELECT event_id AS source_row_id, group_index FROM f JOIN n USING (g)""")
def group_by_column_ffill(spark, sf):
    e = table(spark, sf, "events")
    first = e.agg(F.min("event_id")).first()[0] or 0
    e = e.select(F.col("event_id").alias("source_row_id"), F.when(F.col("event_id") % 3 == first % 3, F.concat(F.lit(" "), "event_type")).alias("k"))
    return grouping.group_by_column(e, "k").select("source_row_id", "group_index")


@register("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS turn_index FROM conversations")
def group_turn_index(spark, sf):
    return grouping.with_turn_index(table(spark, sf, "conversations"), "conv_id", ("turn",)).select("conv_id", "turn", "turn_index")


@register("""
WITH r AS (SELECT l_suppkey, (l_orderkey * 7 + l_linenumber) AS r1, (l_orderkey * 7 + l_linenumber) + l_quantity::BIGINT * 40 AS r2 FROM lineitem),
s AS (SELECT *, CASE WHEN r1 > max(r2) OVER (PARTITION BY l_suppkey ORDER BY r1, r2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM r),
i AS (SELECT *, sum(new) OVER (PARTITION BY l_suppkey ORDER BY r1, r2 ROWS UNBOUNDED PRECEDING) AS n FROM s)
SELECT l_suppkey, min(r1) AS r1, max(r2) AS r2 FROM i GROUP BY l_suppkey, n""")
def group_islands(spark, sf):
    r1 = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    ranges = table(spark, sf, "lineitem").select("l_suppkey", r1.alias("r1"), (r1 + F.col("l_quantity").cast("long") * 40).alias("r2"))
    return grouping.merge_islands(ranges, partition=("l_suppkey",))


_CELL = "'USER: ' || role || ' BOT: ' || text"


@register(r"""
WITH c AS (SELECT conv_id * 1000 + turn AS source_row_id, role, trim(regexp_replace(text, '^[\s_]+|[\s_]+$', '', 'g')) AS t FROM conversations)
SELECT source_row_id, 'row-' || source_row_id || '-t1' AS query_id, 1 AS blob_turn, role AS question, nullif(t, '') AS answer FROM c
UNION ALL SELECT source_row_id, 'row-' || source_row_id || '-t2', 2, 'next', 'end' FROM c""")
def blob_unroll_markers(spark, sf):
    c = table(spark, sf, "conversations")
    cell = F.concat(F.lit("USER: "), "role", F.lit(" BOT: "), "text", F.lit(" _USER: next BOT : end"))
    rows = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("source_row_id"), cell.alias("cell"))
    out = grouping.unroll_cell(rows, "cell", "USER", "BOT")
    return out.select("source_row_id", F.col("query_id_override").alias("query_id"), "blob_turn", F.col("blob_question").alias("question"), F.col("blob_answer").alias("answer"))


def _canon(df: DataFrame, **plan) -> DataFrame:
    return build_canon(df, LayoutPlan(**plan))[0]


@register(r"""
SELECT doc_id AS source_row_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source END AS output_answer FROM documents""")
def canon_coalesce_output(spark, sf):
    i = F.col("doc_id") % 3
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("source_row_id"), "text", F.when(i == 0, F.col("lang")).otherwise("   ").alias("a"), F.when(i < 2, F.col("source")).alias("b"))
    return _canon(rows, input_query="text", output_answer=("a", "b")).select("source_row_id", "output_answer")


@register("""
SELECT o_orderkey AS source_row_id, 'row-' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS query_id, o_custkey::VARCHAR AS session_id, 1::BIGINT AS input_query_count FROM orders""")
def canon_identity_scoped(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_row_id"), "o_custkey", "o_orderstatus", "o_orderpriority")
    out = _canon(rows, input_query="o_orderpriority", query_id="o_orderstatus", session_id="o_custkey")
    return out.select("source_row_id", "query_id", "session_id", "input_query_count")


@register("SELECT event_id AS source_row_id FROM events WHERE value IS NULL OR value < 1 OR value <> floor(value)")
def canon_weight_violations(spark, sf):
    return weight_violations(table(spark, sf, "events").withColumn("source_row_id", F.col("event_id")), "value").select("source_row_id")


@register("""
WITH c AS (SELECT o_orderstatus AS query_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS q FROM orders)
SELECT 'blank' AS check_name, 'input_query' AS column_name, count(*) AS violations FROM c WHERE q IS NULL HAVING count(*) > 0
UNION ALL SELECT 'duplicate_id', 'query_id', count(*) FROM (SELECT query_id FROM c GROUP BY query_id HAVING count(*) > 1) HAVING count(*) > 0""")
def canon_validation_report(spark, sf):
    o = table(spark, sf, "orders")
    canon = o.select(F.col("o_orderkey").alias("source_row_id"), F.col("o_orderstatus").alias("query_id"), F.lit("s").alias("session_id"),
                     F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).otherwise(" ").alias("input_query"), F.lit(None).cast("string").alias("output_answer"))
    return spark.createDataFrame([(v["check"], v["column"], v["count"]) for v in validate.violations(canon)], "check_name string, column_name string, violations long")


# ---- publishing


def _published(spark, sf, mode: str) -> publish.Published:
    c = table(spark, sf, "conversations")
    rows = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("source_row_id"), F.concat(F.lit("c"), "conv_id").alias("conv"), F.col("text").alias("asked"), F.col("role").alias("told"),
                    (F.col("conv_id") % 3).cast("string").alias("topic"), F.col("role").alias("who"), (F.col("conv_id") % 2).alias("mark"))
    ids = dict(zip("ABCDEF", ("conv", "asked", "told", "topic", "who", "mark")))
    layout = LayoutPlan(input_query="asked", output_answer=("told",), scenario="topic", assessor_id="who", grouping="column", group_column="conv", column_ids=ids)
    canon, _ = build_canon(rows, layout)
    plan = _plan("identity", Source("mark", column_id="F"), unit="dialogue" if mode == "dialogue" else "turn", assessment_mode=mode, missing_policy="exclude_unit")
    return publish.publish(with_scores(canon, plan), layout, plan)


@register(r"""
SELECT (conv_id % 3)::VARCHAR AS scenario, 'c' || conv_id AS session_id,
       'row-' || (row_number() OVER (ORDER BY conv_id, turn) - 1) AS query_id, 1::BIGINT AS input_query_count,
       CASE WHEN regexp_matches(text, '\S') THEN text END AS input_query, role AS output_answer, (conv_id % 2)::DOUBLE AS mark_metric, (conv_id % 2)::DOUBLE AS main_metric, role AS assessor_id
FROM conversations""")
def publish_flat(spark, sf):
    return _published(spark, sf, "turn_with_history").frame


@register(r"""
WITH t AS (SELECT *, 'row-' || (row_number() OVER (ORDER BY conv_id, turn) - 1) AS q FROM conversations)
SELECT (conv_id % 3)::VARCHAR AS scenario, 'c' || conv_id AS session_id, (conv_id % 2)::DOUBLE AS mark_metric, (conv_id % 2)::DOUBLE AS main_metric,
       sha256(string_agg(q || chr(31) || CASE WHEN regexp_matches(text, '\S') THEN text ELSE '' END || chr(31) || role, chr(30) ORDER BY turn)) AS dialogue_digest
FROM t GROUP BY conv_id""")
def publish_dialogue(spark, sf):
    df = _published(spark, sf, "dialogue").frame
    turns = F.array_join(F.transform("dialogue", lambda x: F.concat_ws("\x1f", x["query_id"], x["question"], x["answer"])), "\x1e")
    return df.withColumn("dialogue_digest", F.sha2(turns, 256)).drop("dialogue", "assessor_id")


@register("SELECT 'assessor_id' AS dropped WHERE EXISTS (SELECT 1 FROM conversations GROUP BY conv_id HAVING count(DISTINCT role) > 1)")
def publish_dropped_columns(spark, sf):
    return spark.createDataFrame([(c,) for c in _published(spark, sf, "dialogue").dropped], "dropped string")


# ---- profiles, documents, reconciliation


_CUSTOMER = ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count(*) AS non_null, count(try_cast({c}::VARCHAR AS DOUBLE)) AS "numeric", count(DISTINCT {c}) AS distinct_values FROM customer""" for c in _CUSTOMER))
def profile_columns(spark, sf):
    return profile.profile_columns(table(spark, sf, "customer"), list(_CUSTOMER), "c_custkey").select("column_name", "non_null", "numeric", "distinct_values")


_DOCUMENT = ("lang", "source", "n_chars", "text")
_WHITE = r"[\s\x{A0}\x{85}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1C-\x1F]+"
_LISTED = "string_agg(v || '=' || n, '|' ORDER BY n DESC, f)"


@register(f"""
WITH cells AS (SELECT c, doc_id, trim(regexp_replace(raw, '{_WHITE}', ' ', 'g')) AS v FROM ({' UNION ALL '.join(f"SELECT '{c}' AS c, doc_id, {c}::VARCHAR AS raw FROM documents" for c in _DOCUMENT)})),
kept AS (SELECT * FROM cells WHERE v <> ''),
counts AS (SELECT c, v, count(*) AS n, min(doc_id) AS f FROM kept GROUP BY ALL),
whole AS (SELECT c, sum(n)::BIGINT AS non_null, sum(CASE WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN n ELSE 0 END)::BIGINT AS numbers, CASE WHEN count(*) <= 30 THEN {_LISTED} END AS listed FROM counts GROUP BY c),
firsts AS (SELECT c, string_agg(CASE WHEN length(v) > 200 THEN left(v, 199) || '…' ELSE v END, chr(31) ORDER BY doc_id) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY doc_id) AS r FROM kept) WHERE r <= 3 GROUP BY c)
SELECT c AS column_name, non_null, numbers AS "numeric", samples, listed AS "values" FROM whole JOIN firsts USING (c)""")
def profile_evidence(spark, sf):
    """What a proposer sees of each column of whole documents, texts included."""
    told = profile.profile_columns(table(spark, sf, "documents"), list(_DOCUMENT), "doc_id", distinct=False)
    listed = F.array_join(F.transform("values", lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), "|")
    return told.select("column_name", "non_null", "numeric", F.array_join("samples", "\x1f").alias("samples"), listed.alias("values"))


@register("\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, {c} AS value, count(*) AS n, min(o_orderkey) AS first_row FROM orders GROUP BY {c}""" for c in ("o_orderstatus", "o_orderpriority")))
def profile_top_values(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderkey")


def _spans(spark, sf) -> DataFrame:
    return docs_source.paragraphs(table(spark, sf, "documents"), "doc_id", "text")


_LINES = r"""
lines AS (SELECT doc_id, l, unnest(string_split(regexp_replace(text, '\r\n|[\n\x0B\x0C\r\x{85}\x{2028}\x{2029}\x1C-\x1E]', chr(10), 'g'), chr(10))) AS raw, generate_subscripts(string_split(regexp_replace(text, '\r\n|[\n\x0B\x0C\r\x{85}\x{2028}\x{2029}\x1C-\x1E]', chr(10), 'g'), chr(10)), 1) AS i FROM (SELECT doc_id, text, 0 AS l FROM documents)),
kept AS (SELECT doc_id, i, regexp_replace(raw, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS t FROM lines),
spans AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos, t AS text FROM kept WHERE t <> '')"""


@register(f"WITH {_LINES} SELECT doc_id::VARCHAR AS document_id, pos::INT AS pos, doc_id || ':p' || CASE WHEN pos < 10000 THEN lpad(pos::VARCHAR, 4, '0') ELSE pos::VARCHAR END AS span_id, sha256(text) AS digest FROM spans")
def doc_spans(spark, sf):
    return _spans(spark, sf).select("document_id", "pos", "span_id", F.sha2("text", 256).alias("digest"))


_NUMS = r"regexp_extract_all(text, '-?[0-9]+(?:[\s\x{A0}][0-9]{3})*(?:[.,][0-9]+)?[\s\x{A0}]*%?')"


@register(rf"""
WITH {_LINES} SELECT document_id, pos, n, sum_percent FROM (
  SELECT doc_id::VARCHAR AS document_id, pos::INT AS pos, len({_NUMS})::INT AS n, len(list_filter({_NUMS}, lambda x: ends_with(x, '%')))::INT AS sum_percent FROM spans) WHERE n > 0""")
def doc_numbers(spark, sf):
    found = _spans(spark, sf).withColumn("found", S.numbers(F.col("text"))).filter(F.size("found") > 0)
    return found.select("document_id", "pos", F.size("found").alias("n"), F.size(F.filter("found", lambda x: x["percent"])).alias("sum_percent"))


@register(r"""
SELECT conv_id, turn, (conv_id % 50 = 25) OR (turn = 3) AS hit FROM conversations""")
def doc_span_has_value(spark, sf):
    c = table(spark, sf, "conversations")
    text = F.concat(F.lit("share "), (F.col("conv_id") % 50).cast("string"), F.lit(" %, rate "), F.when(F.col("turn") == 3, "0,25").otherwise("0,26"))
    return c.select("conv_id", "turn", S.span_has_value(text, Decimal(25), "percent").alias("hit"))


@register(r"SELECT page_id, sha256(regexp_replace(html, '<[^>]*>', '', 'g')) AS digest FROM pages")
def html_strip_markup(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.sha2(docs_source.strip_markup(F.col("html")), 256).alias("digest"))


@register(None)
def html_to_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", docs_source.markup_to_text(F.col("html")).alias("text"))


@register("""
SELECT conv_id::VARCHAR AS document_id, (turn + 1)::INT AS label_pos, (nxt + 1)::INT AS value_pos, round((conv_id % 100)::DOUBLE / 100, 6) AS value
FROM (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole FROM conversations)
WHERE role = 'user' AND nrole = 'assistant'""")
def reducer_candidates(spark, sf):
    c = table(spark, sf, "conversations")
    text = F.when(F.col("role") == "user", "Macro mean").when(F.col("role") == "assistant", F.concat((F.col("conv_id") % 100).cast("string"), F.lit("%"))).otherwise("Weighted mean of all")
    spans = c.select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).cast("int").alias("pos"), text.alias("text"))
    return reconcile.reported_candidates(spans, "mean", "ratio").select("document_id", "label_pos", "value_pos", F.col("value").cast("double").alias("value"))


@register("\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, 'qa' AS assessment_mode, 'mean' AS reducer, round(avg({c}::DOUBLE), 6) AS value FROM lineitem
UNION ALL SELECT '{c}', 'qa', 'frequency_weighted_mean', round(sum({c} * l_quantity) / sum(l_quantity), 6) FROM lineitem""" for c in ("l_discount", "l_tax", "l_linenumber")))
def reconcile_identity_plans(spark, sf):
    out = reconcile.identity_candidates(table(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_linenumber"], weight="l_quantity", order="l_orderkey")
    return out.select("column_name", "assessment_mode", "reducer", F.round("value", 6).alias("value"))


_CANDIDATES = ("o_custkey", "o_totalprice", "o_orderpriority", "part")


def _candidate_sql(source: str, unit: str) -> str:
    two = lambda c: (("mean", f"avg(try_cast({c} AS DOUBLE))"), ("frequency_weighted_mean", f"sum(try_cast({c} AS DOUBLE) * w) / sum(CASE WHEN try_cast({c} AS DOUBLE) IS NOT NULL THEN w END)"))
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, '{unit}' AS assessment_mode, '{name}' AS reducer, {e} AS value FROM {source}" for c in _CANDIDATES for name, e in two(c))


@register(f"""
WITH r AS (SELECT o_orderkey, o_orderkey % 97 AS g, o_custkey, o_totalprice, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 7 END AS part, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 7)::DOUBLE END AS w FROM orders),
f AS (SELECT {', '.join(f"arg_min({c}, o_orderkey) FILTER ({c} IS NOT NULL) AS {c}" for c in (*_CANDIDATES, 'w'))} FROM r GROUP BY g)
SELECT column_name, assessment_mode, reducer, round(value, 4) AS value FROM ({_candidate_sql('r', 'qa')}
UNION ALL {_candidate_sql('f', 'dialogue')}) WHERE value IS NOT NULL""")
def reconcile_candidates(spark, sf):
    """Every mean of every column, over rows and over first values of groups, with weights that are partly missing."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k, (k % 97).alias("g"), *_CANDIDATES[:3], F.when(k % 3 == 0, F.col("o_totalprice") / 7).alias("part"), F.when(k % 5 != 0, (k % 7).cast("double")).alias("w"))
    found = reconcile.identity_candidates(rows, list(_CANDIDATES), weight="w", group="g", order="o_orderkey")
    return found.select("column_name", "assessment_mode", "reducer", F.round("value", 4).alias("value"))


_DIGESTED = ("o_custkey", "o_orderstatus", "o_orderpriority")


#: levels of the digest trees, enough for 64^4 rows
_DEPTH = 4


def _tree_sql(c: str) -> str:
    d = f"SELECT o_orderkey AS n, coalesce('v' || strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, 'n') AS d FROM orders"
    for _ in range(_DEPTH):
        d = f"SELECT n // 64 AS n, sha256(string_agg(d, chr(31) ORDER BY n)) AS d FROM ({d}) AS t GROUP BY t.n // 64"
    return f"SELECT '{c}' AS column_name, d AS digest FROM ({d})"


@register("\nUNION ALL\n".join(map(_tree_sql, _DIGESTED)), "frame_digest")
def frame_digest_query(spark, sf):
    return frame_digest(table(spark, sf, "orders"), "o_orderkey", list(_DIGESTED), depth=_DEPTH)


@register(r"""
SELECT p_partkey, lower(trim(regexp_replace(p_name, '\s+', ' ', 'g'))) AS name_key,
       coalesce(nullif(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'metric') AS type_slug FROM part""")
def normalize_slug(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.normalize_key(F.concat(F.lit("  "), F.col("p_name"), F.lit("\n"))).alias("name_key"), S.slug(F.col("p_type")).alias("type_slug"))


from gaugeworks import queries_durable, queries_rules  # noqa: E402,F401  (register their own)


#: cases of rules that read no table: the tests run them with their SQL, but they are no queries
CASES = (
    "column_addresses", "decimals_parsed", "formula_references", "package_documents", "package_gate", "package_kinds",
    "package_ports", "percent_readings", "plan_reducers", "plan_scores", "proposal_loops", "replies_read",
)


def queries() -> dict[str, Query]:
    return {name: q for name, (q, _) in CATALOGUE.items() if name not in CASES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOGUE.items() if sql and name not in CASES}
