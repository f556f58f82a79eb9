"""Queries of sheets, layouts, plans, checks and reports, over tables made from the whole given ones.

A workbook is laid out from ``customer``: a title, two header rows of which the upper is
merged over three columns, a row a customer, a row of sums and a note.  Cases that have
to be refused come back as (case_name, outcome).
"""

from __future__ import annotations

import io
import json
import zipfile
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from gaugeworks.errors import GaugeError
from gaugeworks.functions import scalars as S
from gaugeworks.operators import canon as canons, grouping, metric, profile, publish, reconcile, region, validate
from gaugeworks.plans import contracts, proposals
from gaugeworks.plans.contracts import MetricPlan, Source
from gaugeworks.plans.layout import LayoutPlan
from gaugeworks.plans.resolve_layout import resolve_layout, unrolled
from gaugeworks.plans.resolve_measurement import canonical_score, prove_reducer, resolve_measurement
from gaugeworks.queries import _FLAGS, _LABELLED, _LINES, _PRIORITIES, _dialogues, _labelled, _plan, _spans, register, table
from gaugeworks.sources import package, sinks
from gaugeworks.sources.workbook import Workbook
from gaugeworks.streaming import metric_by_batch, scratch, stream_files, total_table


def _values(rows: list[tuple], columns: str) -> str:
    said = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(said, r)) + ')' for r in rows)}) AS t({columns})"


def _outcome(f) -> str:
    try:
        f()
    except GaugeError as e:
        return e.reason_code
    return "accepted"


# ---- sheets


def _book(spark, sf, merged: bool = False) -> Workbook:
    c = table(spark, sf, "customer")
    row = (F.col("c_custkey") + 3).cast("int")  # keys count from 0
    weight, mark = F.col("c_custkey") % 5 + 1, F.col("c_nationkey") % 2
    n = c.agg(F.coalesce(F.max("c_custkey") + 1, F.lit(0)).cast("int").alias("n"), F.sum(weight).cast("string").alias("all"))
    in_merge = F.col("c_custkey") < F.floor(F.col("n") / 3) * 3
    c = c.crossJoin(F.broadcast(n.select("n")))  # one row
    name = F.when(in_merge & (F.col("c_custkey") % 3 != 0), F.lit(None).cast("string")).otherwise(F.col("c_name")) if merged else F.col("c_name")
    one = [name, F.col("c_mktsegment"), weight.cast("string"), mark.cast("string"), (weight + mark).cast("string")]
    spread = F.explode(F.array(*(F.struct(F.lit(i).alias("col"), F.lit("n" if i > 1 else "str").alias("kind"), s.alias("s")) for i, s in enumerate(one))))
    data = c.select(row.alias("row"), spread.alias("x")).select("row", "x.*").filter("s is not null")
    fixed = spark.createDataFrame(
        [(0, 0, "str", "Title"), (1, 0, "str", "Question"), (1, 1, "str", " Result\n"), (1, 4, "str", "Total"), (2, 1, "str", "answer"), (2, 2, "str", "weight"), (2, 3, "str", "score")],
        "row int, col int, kind string, s string")
    foot = n.select((F.col("n") + 3).alias("row"), F.lit(2).alias("col"), F.lit("n").alias("kind"), F.col("all").alias("s")).union(n.select(F.col("n") + 5, F.lit(5), F.lit("str"), F.lit("note")))
    cells = fixed.union(data).union(foot).select(F.lit("Data").alias("sheet"), "row", "col", "kind", "s")
    cells = cells.union(spark.createDataFrame([("Notes", 0, 0, "str", "n")], cells.schema))
    merges = spark.createDataFrame([("Data", 1, 1, 1, 3)], "sheet string, row int, col int, row2 int, col2 int")
    if merged:
        merges = merges.union(c.filter(in_merge & (F.col("c_custkey") % 3 == 0)).select(F.lit("Data"), row, F.lit(0), row + 2, F.lit(0)))
    sums = c.select(F.lit("Data").alias("sheet"), row.alias("row"), F.lit(4).alias("col"), F.concat(F.lit("=SUM(C"), row + 1, F.lit(":D"), row + 1, F.lit(")")).alias("formula"))
    sums = sums.union(n.select(F.lit("Data"), F.col("n") + 3, F.lit(2), F.concat(F.lit("=SUM(C4:C"), F.col("n") + 3, F.lit(")"))))
    return Workbook(cells, merges, sums, ("Data", "Notes"))


def _address(column: str, header: str | None) -> dict:
    return {"column": column, "header": header}


def _layout(**more) -> dict:
    roles = {"input_query": _address("A", "Question"), "output_answer": _address("B", "answer"), "query_id": "synthesize", "scenario": None, "assessor_id": None, "reference_answers": []}
    return {"basket_id": "CI042", "sheet_name": "Data", "ignored_sheets": ["Notes"], "header_rows": [2, 3], "roles": roles | more.pop("roles", {}),
            "grouping": {"kind": "none", "column": None}, "dialogue_blob": None, "weight": _address("C", "Result weight")} | more


_NAMES = ((0, "Question"), (1, "Result answer"), (2, "Result weight"), (3, "Result score"), (4, "Total"), (5, "unnamed_F"))


@register("SELECT max(c_custkey)::BIGINT + 7 AS n_rows, 6::BIGINT AS n_columns FROM customer")
def sheet_bounds(spark, sf):
    return spark.createDataFrame([_book(spark, sf).sheet("Data").bounds()], "n_rows long, n_columns long")


@register(_values(_NAMES, "col, header"))
def sheet_headers(spark, sf):
    parts = region.header_parts(_book(spark, sf).sheet("Data"), [1, 2])
    return spark.createDataFrame(list(enumerate(region.header_names(parts, 6))), "col int, header string")


@register("""
SELECT n_nationkey, CASE WHEN k = 1 THEN r_name ELSE r_name || '#' || k END AS header
FROM (SELECT n_nationkey, r_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS k FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def headers_deduped(spark, sf):
    rows = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").select("n_nationkey", "r_name").collect()
    return spark.createDataFrame(list(zip((r[0] for r in rows), region.deduped([r[1] for r in rows]))), "n_nationkey int, header string")


@register("""
SELECT (c_custkey + 4)::BIGINT AS source_row_id, c_name AS question, c_mktsegment AS answer, (c_custkey % 5 + 1)::VARCHAR AS weight, (c_nationkey % 2)::VARCHAR AS score, (c_custkey % 5 + 1 + c_nationkey % 2)::VARCHAR AS total FROM customer""")
def region_rows(spark, sf):
    sheet = _book(spark, sf).sheet("Data")
    last = sheet.bounds()[0] - 3
    return region.build_region(sheet, [2, 3], last, [n for _, n in _NAMES]).select("source_row_id", *(F.col(f"`{n}`").alias(a) for (_, n), a in zip(_NAMES, ("question", "answer", "weight", "score", "total"))))


_FORMULAS = (("=SUM(A2:A9)", True), ("=SUM(A2:C2)", False), ("=AVERAGE(B:B)", True), ("=A2+A9", False), ("=COUNT($A$2:$A$5)", True), ("=MAX(A1:A9)", False), ("=СУММ(Data!D:D)+1", True), ("=SUM(2:9)", False))


@register(f"SELECT l_orderkey % {len(_FORMULAS)} AS pattern, ({' OR '.join(f'l_orderkey % {len(_FORMULAS)} = {i}' for i, (_, v) in enumerate(_FORMULAS) if v)}) AS vertical, count(*) AS n FROM lineitem GROUP BY ALL")
def formula_aggregates(spark, sf):
    n = F.col("l_orderkey") % len(_FORMULAS)
    text = F.element_at(F.array(*(F.lit(f) for f, _ in _FORMULAS)), (n + 1).cast("int"))
    return table(spark, sf, "lineitem").select(n.alias("pattern"), region.is_vertical_aggregate(text).alias("vertical")).groupBy("pattern", "vertical").agg(F.count("*").alias("n"))


@register(_values([(0, "A"), (1, "A,C"), (2, ""), (3, "A"), (4, "A"), (5, "A"), (6, ""), (7, "")], "pattern, parts"))
def formula_references(spark, sf):
    return spark.createDataFrame([(i, ",".join(region.formula_columns(f, "B"))) for i, (f, _) in enumerate(_FORMULAS)], "pattern int, parts string")


@register("SELECT i::BIGINT AS i, (CASE WHEN i >= 26 THEN chr((64 + i // 26)::INT) ELSE '' END) || chr((65 + i % 26)::INT) AS letters, i::BIGINT AS back FROM range(702) t(i)")
def column_addresses(spark, sf):
    return spark.createDataFrame([(i, S.column_letters(i), S.column_index(S.column_letters(i))) for i in range(702)], "i long, letters string, back long")


@register("SELECT 1::BIGINT AS header_row")
def header_candidate(spark, sf):
    return spark.createDataFrame([(profile.header_candidate(_book(spark, sf).sheet("Data").cells),)], "header_row long")


_COLUMN_SQL = "SELECT {i} AS col, {e} AS v, c_custkey FROM customer"


@register(f"""
WITH cells AS ({' UNION ALL '.join(_COLUMN_SQL.format(i=i, e=e) for i, e in enumerate(("c_name", "c_mktsegment", "(c_custkey % 5 + 1)::VARCHAR", "(c_nationkey % 2)::VARCHAR", "(c_custkey % 5 + 1 + c_nationkey % 2)::VARCHAR")))}),
counts AS (SELECT col, v, count(*) AS n, min(c_custkey) AS first FROM cells GROUP BY ALL)
SELECT col::INT AS col, sum(n)::BIGINT AS non_null, sum(CASE WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN n ELSE 0 END)::BIGINT AS "numeric",
       (SELECT string_agg(v, '|' ORDER BY c_custkey) FROM cells c WHERE c.col = counts.col AND c_custkey < 3) AS samples,
       CASE WHEN count(*) <= 30 THEN string_agg(v || '=' || n, '|' ORDER BY n DESC, first) END AS "values" FROM counts GROUP BY col""")
def sheet_column_profiles(spark, sf):
    told = profile.sheet_columns(_data_cells(spark, sf), 2)
    shown = F.array_join(F.transform("values", lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), "|")
    return told.select("col", "non_null", "numeric", F.array_join("samples", "|").alias("samples"), F.when(F.col("values").isNotNull(), shown).alias("values"))


def _data_cells(spark, sf) -> DataFrame:
    n = table(spark, sf, "customer").agg(F.coalesce(F.max("c_custkey") + 1, F.lit(0))).first()[0]
    return _book(spark, sf).sheet("Data").cells.filter(F.col("row") < n + 3)


@register("""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'USER,BOT' ELSE 'ASK_1,БОТ' END AS marks FROM conversations WHERE turn % 3 <> 2""")
def dialogue_hints(spark, sf):
    even = F.col("turn") % 2 == 0
    one = F.when(even, "USER: a BOT: b USER: c").otherwise("lower: ASK_1")
    text = F.when(F.col("turn") % 3 == 2, "USER: only").when(even, one).otherwise("ASK_A: x БОТ: y X: z")
    found = profile.dialogue_hints(table(spark, sf, "conversations").withColumn("cell", text), "cell")
    return found.select("conv_id", "turn", F.replace(F.array_join("marks", ","), F.lit("ASK_A"), F.lit("ASK_1")).alias("marks"))


@register(f"WITH {_LINES} SELECT doc_id::VARCHAR AS document_id, sha256(substr(string_agg(text, ' ' ORDER BY pos), 1, 6000)) AS digest FROM spans WHERE pos <= 40 GROUP BY doc_id")
def document_intro(spark, sf):
    return profile.document_intro(_spans(spark, sf)).select("document_id", F.sha2("intro", 256).alias("digest"))


@register("SELECT doc_id, sha256(CASE WHEN length(text) > 120 THEN substr(text, 1, 119) || '…' ELSE text END) AS digest FROM documents")
def text_cap(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(S.cap(F.col("text"), 120), 256).alias("digest"))


# ---- layouts


@register("""
WITH n AS (SELECT max(c_custkey) + 1 AS n FROM customer)
SELECT (c_custkey + 4)::BIGINT AS row, 'data' AS role, 5::BIGINT AS nonempty_cells FROM customer
UNION ALL SELECT 1, 'preamble', 1 UNION ALL SELECT 2, 'header', 3 UNION ALL SELECT 3, 'header', 3
UNION ALL SELECT n + 4, 'derived_summary', 1 FROM n UNION ALL SELECT n + 6, 'metadata', 1 FROM n""")
def layout_ledger(spark, sf):
    return resolve_layout(_layout(), _book(spark, sf), "CI042").ledger.select(F.col("row").cast("long").alias("row"), "role", F.col("nonempty_cells").cast("long").alias("nonempty_cells"))


@register(_values([("input_query", "Question"), ("output_answer", "Result answer"), ("weight", "Result weight"), ("scenario", "Total"), ("reference_answers", "Result score"), ("grouping", "none"),
                   ("column_ids", "A=Question,B=Result answer,C=Result weight,D=Result score,E=Total,F=unnamed_F"), ("formula_columns", "E"), ("header_rows", "2,3")], "role, said"))
def layout_roles(spark, sf):
    proposal = _layout(roles={"scenario": _address("E", "total"), "reference_answers": [_address("D", "Result score")]})
    found = resolve_layout(proposal | {"grouping": {"kind": "none", "column": _address("B", "answer")}, "first_data_row": 9}, _book(spark, sf), "CI042")
    p = found.plan
    rows = [("input_query", p.input_query), ("output_answer", ",".join(p.output_answer)), ("weight", p.weight), ("scenario", p.scenario), ("reference_answers", ",".join(p.reference_answers)), ("grouping", p.grouping),
            ("column_ids", ",".join(f"{k}={v}" for k, v in p.column_ids.items())), ("formula_columns", ",".join(p.formula_rows)), ("header_rows", ",".join(map(str, found.header_rows)))]
    return spark.createDataFrame(rows, "role string, said string")


_BLOB = {"column": _address("A", "Question"), "container": "plain_text", "question_marker": "Q", "answer_marker": "A"}
_LAYOUTS = {
    "as it is": {}, "another basket": {"basket_id": "x"}, "unknown key": {"surprise": 1}, "unknown version": {"layout_version": "layout.v9"}, "unknown sheet": {"sheet_name": "None"}, "sheet not ignored": {"ignored_sheets": []},
    "header rows apart": {"header_rows": [2, 4]}, "header below the sheet": {"header_rows": [10**6]}, "data as a header": {"header_rows": [2, 3, 4]}, "rows of data above": {"header_rows": [5]}, "column outside": {"weight": _address("Z", None)},
    "another header": {"weight": _address("C", "wrong")}, "no header said": {"weight": _address("C", None)}, "formula as weight": {"weight": _address("E", "Total")}, "text as weight": {"weight": _address("B", "answer")},
    "two roles": {"roles": {"scenario": _address("A", "Question")}}, "two references": {"roles": {"reference_answers": [_address("B", "answer")]}},
    "merges that aren't there": {"grouping": {"kind": "merged_rows", "column": None}}, "no group column": {"grouping": {"kind": "column", "column": None}}, "blob without one": {"grouping": {"kind": "blob_row", "column": None}},
    "blob of another kind": {"dialogue_blob": _BLOB}, "question below the data": {"roles": {"input_query": _address("F", None), "output_answer": None}},
}


@register(_values([(k, "accepted" if k in ("as it is",) else "layout_error") for k in _LAYOUTS], "case_name, outcome"))
def layout_refusals(spark, sf):
    book = _book(spark, sf)
    said = [(k, _outcome(lambda c=c: resolve_layout(_layout(**c), book, "CI042"))) for k, c in _LAYOUTS.items()]
    book.release()
    return spark.createDataFrame(said, "case_name string, outcome string")


@register("""
WITH n AS (SELECT (max(c_custkey) + 1) // 3 AS g FROM customer),
k AS (SELECT c_custkey AS i, c_custkey < 3 * g AS tied, g FROM customer, n)
SELECT (i + 4)::BIGINT AS source_row_id, 'row-' || i AS query_id, (CASE WHEN tied THEN i // 3 ELSE i - 2 * g END)::VARCHAR AS session_id, (CASE WHEN tied THEN i % 3 + 1 ELSE 1 END)::BIGINT AS turn_index,
       t.c_name AS input_query, i % 5 + 1 AS input_query_count FROM k JOIN customer t ON t.c_custkey = CASE WHEN tied THEN i // 3 * 3 ELSE i END""")
def layout_merged_rows(spark, sf):
    found = resolve_layout(_layout(), _book(spark, sf, merged=True), "CI042")
    out = canons.build_canon(found.region, found.plan, found.merges)[0]
    return out.select("source_row_id", "query_id", "session_id", F.col("turn_index").cast("long").alias("turn_index"), "input_query", "input_query_count")


@register("SELECT (c_custkey + 4)::BIGINT AS source_row_id, 'row-' || c_custkey AS query_id, (c_custkey % 5 + 1)::BIGINT AS input_query_count, c_name AS input_query, c_mktsegment AS output_answer, (c_nationkey % 2)::VARCHAR AS score FROM customer")
def layout_canonical_rows(spark, sf):
    found = resolve_layout(_layout(), _book(spark, sf), "CI042")
    return canons.build_canon(found.region, found.plan, found.merges)[0].select("source_row_id", "query_id", "input_query_count", "input_query", "output_answer", F.col("`Result score`").alias("score"))


# ---- grouping and canonical rows


@register("""
SELECT o_orderkey AS source_row_id, dense_rank() OVER (ORDER BY f) - 1 AS group_index
FROM (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS f FROM orders)""")
def group_by_column_spaces(spark, sf):
    i = F.col("o_orderkey") % 4
    ends = F.when(i == 0, "").when(i == 1, "\t").when(i == 2, "  ").otherwise("\r\n")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_row_id"), F.concat(ends, "o_orderpriority", ends).alias("k"))
    return grouping.group_by_column(rows, "k").select("source_row_id", "group_index")


@register("""
SELECT conv_id * 1000 + turn AS source_row_id, (n + 1)::BIGINT AS blob_turn, 'i' || n AS query_id, role || n AS question, CASE WHEN n = 1 THEN NULL ELSE 'turn ' || turn END AS answer
FROM conversations, range(3) t(n)""")
def blob_unroll_literals(spark, sf):
    triple = lambda n, answer: F.concat(F.lit(f"('i{n}', '"), "role", F.lit(f"{n}', "), answer, F.lit(")"))
    said = F.concat(F.lit("'turn "), F.col("turn").cast("string"), F.lit("'"))
    cell = F.concat(F.lit("["), triple(0, said), F.lit(", "), triple(1, F.lit("None")), F.lit(","), triple(2, said), F.lit("]"))
    rows = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("source_row_id"), cell.alias("cell"))
    out = grouping.unroll_cell(rows, "cell", "Q", "A")
    return out.select("source_row_id", F.col("blob_turn").cast("long").alias("blob_turn"), F.col("query_id_override").alias("query_id"), F.col("blob_question").alias("question"), F.col("blob_answer").alias("answer"))


@register("""
SELECT conv_id * 1000 + turn AS source_row_id, 1::BIGINT AS blob_turn, role || CASE WHEN turn % 2 = 0 THEN '' ELSE ' it''s' END AS question, 'turn ' || turn AS answer FROM conversations""")
def blob_unroll_lists(spark, sf):
    """Lists of marked strings; those of odd turns hold a quote that ends no item."""
    odd = F.when(F.col("turn") % 2 == 0, "").otherwise(" it's")
    cell = F.concat(F.lit("['USER: "), "role", odd, F.lit("', 'BOT: turn "), F.col("turn").cast("string"), F.lit("']"))
    rows = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("source_row_id"), cell.alias("cell"))
    out = grouping.unroll_cell(rows, "cell", "USER", "BOT", "python_list")
    return out.select("source_row_id", F.col("blob_turn").cast("long").alias("blob_turn"), F.col("blob_question").alias("question"), F.col("blob_answer").alias("answer"))


@register("""
SELECT o_orderkey AS source_row_id, o_orderstatus AS reference_answer, o_orderpriority AS reference_answer_2, o_orderdate::DATE::VARCHAR AS query_id__raw, o_custkey AS scenario__raw,
       o_custkey::VARCHAR AS scenario, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey // 2)::VARCHAR ELSE (o_orderkey // 2)::VARCHAR || '.5' END AS assessor_id FROM orders""")
def canon_references_and_names(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("source_row_id"), F.lit("q").alias("q"), "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("query_id"), F.col("o_custkey").alias("scenario"),
        (F.col("o_orderkey") / 2).alias("half"))
    plan = LayoutPlan(input_query="q", reference_answers=("o_orderstatus", "o_orderpriority"), scenario="scenario", assessor_id="half")
    return canons.build_canon(rows, plan)[0].select("source_row_id", "reference_answer", "reference_answer_2", "query_id__raw", "scenario__raw", "scenario", "assessor_id")


@register("SELECT o_orderkey AS source_row_id, o_orderkey::VARCHAR AS query_id, 'c' || o_custkey AS session_id FROM orders")
def canon_rendered_ids(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_row_id"), F.lit("q").alias("q"), F.col("o_orderkey").cast("double").alias("id"), F.concat(F.lit("\t c"), "o_custkey", F.lit(" \n")).alias("s"))
    return canons.build_canon(rows, LayoutPlan(input_query="q", query_id="id", session_id="s"))[0].select("source_row_id", "query_id", "session_id")


@register(_values([("blank id", "made"), ("vast id", "made"), ("repeated id", "made"), ("unique id", "column"), ("blank session", "layout_error"), ("vast session", "layout_error")], "case_name, outcome"))
def canon_unusable_ids(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_row_id"), F.lit("q").alias("q"), F.col("o_orderkey").cast("double").alias("n"))
    last = F.col("source_row_id") == F.lit(o.agg(F.max("source_row_id")).first()[0])
    cases = {"blank id": F.when(~last, F.col("n")), "vast id": F.when(last, F.lit(2.0**53)).otherwise(F.col("n")), "repeated id": F.when(last, F.lit(1.0)).otherwise(F.col("n")), "unique id": F.col("n")}
    rows = [(k, canons.build_canon(o.withColumn("id", e), LayoutPlan(input_query="q", query_id="id"))[1]["query_id"]) for k, e in cases.items()]
    rows += [(k.replace(" id", " session"), _outcome(lambda e=e: canons.build_canon(o.withColumn("id", e), LayoutPlan(input_query="q", session_id="id")))) for k, e in list(cases.items())[:2]]
    return spark.createDataFrame(rows, "case_name string, outcome string")


def _gappy(spark, sf) -> DataFrame:
    """Orders as canonical rows: questions blank in every seventh, answers in every fifth."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    return o.select(key.alias("source_row_id"), key.cast("string").alias("query_id"), F.lit("s").alias("session_id"), F.when(key % 7 != 0, F.col("o_orderpriority")).otherwise("\t ").alias("input_query"),
                    F.when(key % 5 != 0, F.col("o_orderstatus")).alias("output_answer"), F.col("o_orderpriority").alias("always"), F.when(key % 10 != 0, F.col("o_orderpriority")).alias("often"))


@register("SELECT o_orderkey AS source_row_id, o_orderkey % 7 <> 0 AS kept FROM orders")
def canon_dropped_questions(spark, sf):
    kept, gone = canons.drop_blank_questions(_gappy(spark, sf))
    return kept.select("source_row_id", F.lit(True).alias("kept")).union(gone.select("source_row_id", F.lit(False)))


# ---- checks


@register(_values([("query_id",), ("output_answer",)], "column_name"))
def check_missing_columns(spark, sf):
    found = validate.violations(_gappy(spark, sf).drop("query_id", "output_answer"))
    return spark.createDataFrame([(v["column"],) for v in found if v["check"] == "missing_column"], "column_name string")


@register("SELECT o_orderkey AS source_row_id FROM orders WHERE o_orderkey % 7 = 0 ORDER BY 1 LIMIT 20")
def check_blank_rows(spark, sf):
    """The rows that a report names: the first twenty."""
    found = next((v["rows"] for v in validate.violations(_gappy(spark, sf)) if v["check"] == "blank"), [])
    return spark.createDataFrame([(r,) for r in found], "source_row_id long")


@register("""
SELECT 'a_metric' AS column_name, count(*)::BIGINT AS violations FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'b_metric', count(*) FROM orders UNION ALL SELECT 'main_metric', count(*) FROM orders WHERE o_orderkey % 4 = 0""")
def check_metric_columns(spark, sf):
    key = F.col("source_row_id")
    rows = _gappy(spark, sf).withColumns({
        "a_metric": F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)), "b_metric": key % 2 == 0, "c_metric": key, "d_metric": F.lit(None).cast("string"),
        "main_metric": F.when(key % 4 == 0, F.lit(float("inf"))).when(key % 4 == 1, F.lit(0.5))})
    return spark.createDataFrame([(v["column"], v["count"]) for v in validate.violations(rows) if v["check"] == "metric_not_finite"], "column_name string, violations long")


@register("""
SELECT o_custkey::VARCHAR AS reference_group_id, count_if(o_orderkey % 11 = 0)::BIGINT AS bad, (count(t) - count(DISTINCT t))::BIGINT AS repeated, min(t)::BIGINT AS first
FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 2 ELSE row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS t FROM orders)
GROUP BY o_custkey HAVING count_if(o_orderkey % 11 = 0) > 0 OR count(t) > count(DISTINCT t) OR min(t) IS NULL OR min(t) <> 1""")
def check_turn_faults(spark, sf):
    rows = grouping.with_turn_index(table(spark, sf, "orders"), "o_custkey", ("o_orderkey",))
    turn = F.when(F.col("o_orderkey") % 11 == 0, None).when(F.col("o_orderkey") % 13 == 0, 2).otherwise(F.col("turn_index"))
    found = validate.turn_faults(rows.select(F.col("o_custkey").cast("string").alias("reference_group_id"), turn.alias("turn_index")))
    return found.select("reference_group_id", "bad", "repeated", "first")


@register(_values([("group alone", "group_without_turn"), ("turn alone", "group_without_turn"), ("both", ""), ("neither", "")], "case_name, found"))
def check_groups_and_turns(spark, sf):
    whole = _gappy(spark, sf).filter("trim(replace(input_query, '\t', ' ')) <> ''").withColumns({"reference_group_id": F.col("query_id"), "turn_index": F.lit(1)})
    cases = {"group alone": ["turn_index"], "turn alone": ["reference_group_id"], "both": [], "neither": ["turn_index", "reference_group_id"]}
    return spark.createDataFrame([(k, ",".join(v["check"] for v in validate.violations(whole.drop(*c)))) for k, c in cases.items()], "case_name string, found string")


@register("SELECT count(*)::BIGINT AS blank_answers, 'always' AS fallbacks FROM orders WHERE o_orderkey % 5 = 0")
def check_blank_answers(spark, sf):
    found = validate.blank_answers(_gappy(spark, sf), ["always", "often", "output_answer"])
    return spark.createDataFrame([(found["count"], ",".join(found["fallbacks"]))], "blank_answers long, fallbacks string")


@register(_values([("dialogue", "USER", "BOT", "blob_row")], "column_name, question_marker, answer_marker, repaired"))
def check_dialogue_columns(spark, sf):
    c = table(spark, sf, "conversations")
    turn = lambda q, a: F.concat(F.lit(f"{q}: "), "role", F.lit(f" {a}: "), F.col("turn").cast("string"))
    rows = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("source_row_id"), "role", turn("USER", "BOT").alias("dialogue"), turn("USER", "USER").alias("same"), F.when(F.col("turn") % 2 == 0, turn("USER", "BOT")).otherwise(turn("BOT", "USER")).alias("changing"))
    found = validate.dialogue_columns(rows, ["role", "dialogue", "same", "changing"])
    told = [x | {"column_id": "A", "container": "plain_text"} for x in found]
    repaired = unrolled(_layout(), told)
    return spark.createDataFrame([(x["column"], x["question_marker"], x["answer_marker"], repaired["grouping"]["kind"] if repaired else None) for x in found], "column_name string, question_marker string, answer_marker string, repaired string")


@register(_values([("repeated over a run", True), ("repeated, but apart", False), ("varying", False)], "case_name, found"))
def check_repeated_cells(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_row_id"), F.floor(F.col("o_orderkey") / 4).alias("run"), F.lit("x").alias("same"), F.col("o_orderkey").cast("string").alias("own"))
    apart = o.withColumn("source_row_id", F.col("source_row_id") * 2)
    cases = {"repeated over a run": (o, "same"), "repeated, but apart": (apart, "same"), "varying": (o, "own")}
    return spark.createDataFrame([(k, validate.repeated_in_groups(df, "run", c)) for k, (df, c) in cases.items()], "case_name string, found boolean")


# ---- violations, streams and reports


def _violations_sql(source: str, scored: str, weight: str = "1", **counts: str) -> str:
    shown = ", ".join(f"coalesce({counts.get(c, '0')}, 0)::BIGINT AS {c}" for c in metric.VIOLATIONS)
    return f"""SELECT count(*) AS total_units, count_if({scored}) AS scored_units, count(*) - count_if({scored}) AS excluded_units,
       coalesce(sum(CASE WHEN {scored} THEN {weight} END), 0)::BIGINT AS weight_sum, NULL::DOUBLE AS value, {shown} FROM {source}"""


register(_violations_sql(_LABELLED, "quality IS NOT NULL", missing="count_if(quality IS NULL)"), "km_violations_missing")(
    lambda spark, sf: metric.metric_table(_labelled(spark, sf), _plan("identity", Source("quality"))))
register(_violations_sql("lineitem", "TRUE", odd="count_if(l_discount NOT IN (0, 1) OR l_tax NOT IN (0, 1))"), "km_violations_all_criteria")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "lineitem"), _plan("all_criteria", *(Source(c, "criterion") for c in ("l_discount", "l_tax")), missing_policy="exclude_value")))
register(_violations_sql("lineitem", "TRUE", odd="count_if(l_discount NOT IN (0, 1) OR l_tax NOT IN (0, 1))"), "km_violations_all_assessors")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "lineitem"), _plan("all_assessors", *(Source(c, "assessor_vote") for c in ("l_discount", "l_tax")), missing_policy="zero")))
register(_violations_sql("lineitem", "l_discount + l_linenumber <> 1", odd="count_if(l_discount NOT IN (0, 1) OR l_linenumber NOT IN (0, 1))"), "km_violations_majority")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "lineitem"), _plan("majority", *(Source(c, "assessor_vote") for c in ("l_discount", "l_linenumber")), missing_policy="exclude_unit")))
register(_violations_sql("lineitem", "TRUE", broken="count_if(l_linenumber NOT IN (0, 1))"), "km_violations_inverted")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "lineitem"), _plan("identity", Source("l_linenumber", inverted=True), missing_policy="exclude_unit")))
register(_violations_sql("orders", "o_orderpriority <> '5-LOW'", broken="count_if(o_orderpriority = '5-LOW')"), "km_violations_value_map")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "orders"), _plan("identity", Source("o_orderpriority", normalization="value_map", value_map=tuple((k, Decimal(v)) for k, v in _PRIORITIES.items() if k != "5-LOW")), missing_policy="exclude_unit")))
register(_violations_sql("(SELECT *, CASE WHEN value = floor(value) THEN value END AS w FROM events)", "TRUE", "w", bad_weight="count_if(w IS NULL OR w <= 0)"), "km_violations_weight")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "events").withColumn("s", F.col("event_id") % 2), _plan("identity", Source("s"), weight="value")))
register(_violations_sql("(SELECT l_orderkey, min(l_returnflag) <> max(l_returnflag) AS u FROM lineitem GROUP BY l_orderkey)", "TRUE", unsteady="count_if(u)"), "km_violations_dialogue")(
    lambda spark, sf: metric.metric_table(table(spark, sf, "lineitem"), _plan("identity", Source("l_returnflag", normalization="value_map", value_map=_FLAGS), unit="dialogue", group="l_orderkey", missing_policy="exclude_unit")))
register("""SELECT event_id, event_id % 6 >= 3 AS bad, CASE event_id % 6 WHEN 0 THEN 10 WHEN 1 THEN 0.015 WHEN 2 THEN -2.5 WHEN 5 THEN 0 END::DOUBLE AS value FROM events""", "number_exponents")(
    lambda spark, sf: _numbers(table(spark, sf, "events")))


def _numbers(events: DataFrame) -> DataFrame:
    """Spellings with exponents, and what would lose digits."""
    said = F.element_at(F.array(*map(F.lit, ("1e1", "1.5E-2", " -2,5 ", "1e99", "0.1234567890123", "1e-20"))), (F.col("event_id") % 6 + 1).cast("int"))
    return events.select("event_id", S.bad_number(said).alias("bad"), F.when(F.col("event_id") % 6 != 4, S.parse_number(said).cast("double")).alias("value"))


@register(f"""
SELECT count(*) AS total_units, count(quality) AS scored_units, count(*) - count(quality) AS excluded_units, count(quality) AS weight_sum, round(avg(quality), 9) AS value FROM labels""")
def stream_totals(spark, sf):
    """Micro-batches of a stream over the table, summed one by one, added up."""
    folder, plan = scratch(spark, "stream"), _plan("identity", Source("quality"), missing_policy="exclude_unit")
    stream = stream_files(spark, f"{sf}/labels.parquet")
    run = stream.writeStream.foreachBatch(metric_by_batch(plan, f"{folder}/sums")).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return total_table(spark, plan, f"{folder}/sums").drop(*metric.VIOLATIONS)


def _facts_of(spark, rows: dict[str, object]) -> DataFrame:
    return spark.createDataFrame([(k, v if isinstance(v, str) or v is None else json.dumps(v)) for k, v in rows.items()], "fact string, said string")


_REPORTED = {"threshold": Decimal("0.5"), "comparator": ">=", "reported_value": Decimal("0.25"), "reported_raw": "0.25", "scale": "ratio"}


@register("""
SELECT unnest(['status', 'value_source', 'verdict', 'reconciliation', 'method', 'scored', 'excluded', 'value']) AS fact,
       unnest(['computed', 'validation_report', 'failed', CASE WHEN abs(0.25 - avg(quality)) <= 0.01 THEN 'match' ELSE 'mismatch' END, 'identity', count(quality)::VARCHAR, (count(*) - count(quality))::VARCHAR, '0.25']) AS said FROM labels""")
def report_computed(spark, sf):
    r = metric.evaluate(table(spark, sf, "labels"), _plan("identity", Source("quality"), missing_policy="exclude_unit", **_REPORTED)).report()
    m = r["main_metric"]
    return _facts_of(spark, {"status": r["status"], "value_source": r["value_source"], "verdict": r["threshold_verdict"], "reconciliation": r["reconciliation"]["status"], "method": m["scoring_method"],
                             "scored": str(r["coverage"]["scored_units"]), "excluded": str(r["coverage"]["excluded_units"]), "value": str(m["value"])})


@register(_values([("coverage", "null"), ("main_metric", "null"), ("reason", "Weights must be positive whole numbers"), ("recomputed_value", "null"), ("status", "not_evaluable"), ("verdict", "null")], "fact, said"))
def report_not_evaluable(spark, sf):
    try:
        metric.evaluate(table(spark, sf, "events").withColumn("s", F.col("event_id") % 2), _plan("identity", Source("s"), weight="value"))
        r = {"status": "computed"}
    except GaugeError as e:
        r = metric.not_evaluable_report(e.message, **e.details)
    return _facts_of(spark, {"coverage": json.dumps(r.get("coverage")), "main_metric": json.dumps(r.get("main_metric")), "reason": r.get("reason"), "recomputed_value": json.dumps(r.get("recomputed_value")), "status": r["status"], "verdict": json.dumps(r.get("threshold_verdict"))})


@register(_values([("no plan", "no measurement plan"), ("no metric", "no computed metric"), ("no baseline", "no reported baseline"), ("computed", "quality_metric frequency_weighted_mean input_query_count 0.25 0.5")], "case_name, said"))
def monitoring_contracts(spark, sf):
    labels = table(spark, sf, "labels").withColumn("w", F.lit(1))
    layout = LayoutPlan(input_query="doc_id", weight="w", column_ids={"A": "doc_id", "B": "Quality", "C": "w"})
    plan = _plan("identity", Source("quality", column_id="B"), missing_policy="exclude_unit", weight="w", **_REPORTED)
    bare = _plan("identity", Source("quality", column_id="B"), missing_policy="exclude_unit")
    made = publish.Published("flat", labels, dict(publish.published_names(layout, plan)), ())
    report = metric.evaluate(labels, plan).report()
    tell = lambda c: c["reason"] if c["status"] != "computed" else " ".join(map(str, (c["sources"][0]["column"], c["aggregation"]["method"], c["aggregation"]["weight"], c["baseline"], c["threshold"])))
    cases = {"no plan": (None, None), "no metric": (plan, metric.not_evaluable_report("x")), "no baseline": (bare, report), "computed": (plan, report)}
    return spark.createDataFrame([(k, tell(publish.monitoring_contract(made, *c))) for k, c in cases.items()], "case_name string, said string")


# ---- measurement plans


_REPORT = ("Report", "The weighted mean is 75%", "Threshold 0.7", "Macro", "60%", "Weighted", "75%")
_SPANS = [("doc-1:p0001", "doc-1", "Score"), ("doc-2:p0001", "doc-2", "Rules"), *((f"doc-3:p{i:04d}", "doc-3", t) for i, t in enumerate(_REPORT, 1))]
_SCORE = {"column_id": "D", "role": "final_score", "normalization": "numeric", "polarity": "direct"}
_EVIDENCE = {f: [] for f in contracts.EVIDENCE} | {f: ["doc-3:p0002"] for f in ("metric", "score", "assessment_mode", "reducer", "reported_value")} | {"release": ["doc-3:p0003"]}


def _measurement(score: dict | None = None, evidence: dict | None = None, **more) -> dict:
    return {"basket_id": "CI042", "metric_name": "km", "document_roles": {"instruction": "doc-2", "development_report": "doc-1", "validation_report": "doc-3"}, "assessment_mode": "qa",
            "score": {"method": "identity", "sources": [_SCORE], "missing_policy": "fail", "majority_denominator": None} | (score or {}),
            "reducer": {"method": "frequency_weighted_mean"}, "release": {"threshold": "0.7", "comparator": ">=", "scale": "ratio", "precision": 2},
            "reported_value_state": "unambiguous", "reported_value": {"value": "0.75", "raw": "75%", "span_id": "doc-3:p0002"}, "evidence": _EVIDENCE | (evidence or {})} | more


_RELEASE = {"threshold": "0.7", "comparator": ">=", "scale": "ratio", "precision": 2}
_PLAN_ERROR, _NOT = "measurement_plan_error", "not_evaluable"
#: case to (change of the proposal, outcome)
_PLANS = {
    "as it is": ({}, "accepted"), "another basket": ({"basket_id": "x"}, _PLAN_ERROR), "unknown key": ({"extra": 1}, _PLAN_ERROR), "one document for all roles": ({"document_roles": {r: "doc-1" for r in contracts.DOCUMENT_ROLES}}, _PLAN_ERROR),
    "no evidence": ({"evidence": {"metric": []}}, _PLAN_ERROR), "unknown span": ({"evidence": {"metric": ["doc-1:p0099"]}}, _PLAN_ERROR),
    "unknown column": ({"score": {"sources": [_SCORE | {"column_id": "Q"}]}}, _NOT), "weight as a score": ({"score": {"sources": [_SCORE | {"column_id": "E"}]}}, _NOT), "formula as a score": ({"score": {"sources": [_SCORE | {"column_id": "F"}]}}, _NOT),
    "column named twice": ({"score": {"method": "mean_criteria", "sources": [_SCORE | {"role": "criterion"}] * 2}}, _NOT), "lone vote": ({"score": {"method": "majority", "sources": [_SCORE | {"role": "assessor_vote"}]}}, _NOT),
    "label as a score": ({"score": {"sources": [_SCORE | {"normalization": "label"}]}}, _NOT), "keys that are one": ({"score": {"sources": [_SCORE | {"normalization": {"A": 1, " a": 0}}]}}, _NOT),
    "denominator of a mean": ({"score": {"majority_denominator": "present"}}, _PLAN_ERROR), "threshold alone": ({"release": _RELEASE | {"comparator": None}}, _PLAN_ERROR), "threshold that isn't there": ({"release": _RELEASE | {"threshold": "0.9"}}, _NOT),
    "threshold without evidence": ({"evidence": {"release": []}}, _PLAN_ERROR), "value absent and given": ({"reported_value_state": "absent"}, _PLAN_ERROR), "ambiguous value": ({"reported_value_state": "ambiguous"}, _NOT),
    "value that isn't there": ({"reported_value": {"value": "0.8", "raw": "0.8", "span_id": "doc-3:p0002"}}, _NOT), "value of another document": ({"reported_value": {"value": "0.75", "raw": "75%", "span_id": "doc-1:p0001"}}, _NOT),
    "value without evidence": ({"evidence": {"reported_value": []}}, _PLAN_ERROR), "the other reducer": ({"reducer": {"method": "mean"}}, _NOT), "reducer by a label": ({"evidence": {"reducer": ["doc-3:p0006"]}}, _NOT),
    "gaps and fail": ({"gaps": True}, _NOT), "gaps without evidence": ({"gaps": True, "score": {"missing_policy": "zero"}}, _NOT), "gaps with evidence": ({"gaps": True, "score": {"missing_policy": "zero"}, "evidence": {"missing_policy": ["doc-1:p0001"]}}, "accepted"),
    "no weight": ({"bare": True}, _NOT), "weight by formula": ({"computed": True}, _NOT),
}


def _scored_rows(spark, sf, gaps: bool = False) -> DataFrame:
    key = F.col("o_orderkey")
    mark = F.when(key % 9 == 0, " ").otherwise((key % 2).cast("string")) if gaps else (key % 2).cast("string")
    return table(spark, sf, "orders").select(key.alias("source_row_id"), mark.alias("Mark"), (key % 3 + 1).cast("long").alias("input_query_count"))


def _resolved(spark, sf, change: dict) -> MetricPlan:
    change = dict(change)
    gaps, bare, computed = (change.pop(k, False) for k in ("gaps", "bare", "computed"))
    layout = LayoutPlan("q", ("a",), weight=None if bare else "Weight", column_ids={"D": "Mark", "E": "Weight", "F": "Sum"}, formula_rows={"F": (2,)} | ({"E": (3,)} if computed else {}))
    return resolve_measurement(_measurement(**change), _scored_rows(spark, sf, gaps), layout, _SPANS, "CI042")


@register(_values([(k, v) for k, (_, v) in _PLANS.items()], "case_name, outcome"))
def plan_refusals(spark, sf):
    return spark.createDataFrame([(k, _outcome(lambda c=c: _resolved(spark, sf, c))) for k, (c, _) in _PLANS.items()], "case_name string, outcome string")


@register(_values([("assessment_mode", "qa"), ("comparator", ">="), ("method", "identity"), ("reducer", "frequency_weighted_mean"), ("reported_value", "75"), ("scale", "percent"), ("threshold", "70"), ("unit", "turn"), ("weight", "input_query_count")], "fact, said"))
def plan_resolved(spark, sf):
    """The scale follows the report, and values go with it."""
    report = [(i, d, "Threshold 70%" if i == "doc-3:p0003" else t) for i, d, t in _SPANS]
    layout = LayoutPlan("q", ("a",), weight="Weight", column_ids={"D": "Mark", "E": "Weight"})
    proposal = _measurement(release=_RELEASE | {"threshold": "70", "scale": "ratio"}, reported_value={"value": "75", "raw": "75%", "span_id": "doc-3:p0002"}, assessment_mode="dialogue")
    p = resolve_measurement(proposal, _scored_rows(spark, sf), layout, report, "CI042").to_dict()
    return _facts_of(spark, {k: str(p[k]) for k in ("assessment_mode", "comparator", "method", "reducer", "reported_value", "scale", "threshold", "unit", "weight")})


@register(_values([("column", "turn_with_history", "turn"), ("merged rows, one score a group", "dialogue", "dialogue"), ("merged rows, scores on all rows", "turn_with_history", "turn"), ("none", "qa", "turn")], "case_name, mode, unit"))
def plan_modes(spark, sf):
    o = table(spark, sf, "orders").withColumn("turn_index", (F.col("o_orderkey") % 4 + 1).cast("int")).withColumn("reference_group_id", F.floor(F.col("o_orderkey") / 4).cast("string"))
    first = o.groupBy("reference_group_id").agg(F.min("o_orderkey").alias("first"))
    rows = o.join(first, "reference_group_id").select(F.col("o_orderkey").alias("source_row_id"), "reference_group_id", "turn_index", F.lit(1).cast("long").alias("input_query_count"), (F.col("o_orderkey") % 2).cast("string").alias("Mark"),
                                                      F.when(F.col("o_orderkey") == F.col("first"), "1").alias("Once"))
    out = []
    for name, kind, column in (("none", "none", "Mark"), ("column", "column", "Mark"), ("merged rows, one score a group", "merged_rows", "Once"), ("merged rows, scores on all rows", "merged_rows", "Mark")):
        df = rows if kind != "none" else rows.drop("reference_group_id", "turn_index")
        layout = LayoutPlan("q", ("a",), weight="Weight", grouping=kind, group_column="g" if kind == "column" else None, column_ids={"D": column, "E": "Weight"})
        asked = "dialogue" if kind == "column" else "turn_with_history"
        p = resolve_measurement(_measurement(assessment_mode=asked, score={"missing_policy": "exclude_unit"}, evidence={"missing_policy": ["doc-1:p0001"]}), df, layout, _SPANS, "CI042")
        out.append((name, p.assessment_mode, p.unit))
    return spark.createDataFrame(out, "case_name string, mode string, unit string")


@register(_values([("mean_criteria of one", "identity", "final_score"), ("majority of one", "majority", "assessor_vote"), ("accuracy", "accuracy", "prediction,target"), ("criteria among others", "mean_criteria", "criterion,criterion"),
                   ("a score among others", "identity", "final_score"), ("too few of the role", "all_assessors", "assessor_vote,criterion")], "case_name, method, roles"))
def plan_scores(spark, sf):
    s = lambda *roles: [_SCORE | {"role": r, "column_id": chr(65 + i)} for i, r in enumerate(roles)]
    cases = (("mean_criteria of one", "mean_criteria", s("criterion")), ("majority of one", "majority", s("assessor_vote")), ("accuracy", "accuracy", s("target", "criterion", "prediction")), ("criteria among others", "mean_criteria", s("criterion", "final_score", "criterion")),
             ("a score among others", "identity", s("criterion", "final_score")), ("too few of the role", "all_assessors", s("assessor_vote", "criterion")))
    done = [(name, *canonical_score(m, sources)) for name, m, sources in cases]
    return spark.createDataFrame([(n, m, ",".join(x["role"] for x in kept)) for n, m, kept in done], "case_name string, method string, roles string")


@register(_values([("cited sentence", "accepted"), ("the other one", "not_evaluable"), ("label only", "not_evaluable"), ("both cited", "not_evaluable"), ("only one named", "accepted")], "case_name, outcome"))
def plan_reducers(spark, sf):
    one = [x for x in _SPANS if x[0] != "doc-3:p0004"]
    w = "frequency_weighted_mean"
    cases = {"cited sentence": (w, ("doc-3:p0002",), _SPANS), "the other one": ("mean", ("doc-3:p0002",), _SPANS), "label only": (w, ("doc-3:p0006",), _SPANS), "both cited": (w, ("doc-3:p0002", "doc-3:p0004"), _SPANS), "only one named": ("mean", (), one)}
    return spark.createDataFrame([(k, _outcome(lambda c=c: prove_reducer(*c, "doc-3"))) for k, c in cases.items()], "case_name string, outcome string")


@register("""
WITH f AS (SELECT conv_id, turn, role <> 'system' AS f, lag(role <> 'system', 1, FALSE) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations),
r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM f WHERE f OR p)
SELECT conv_id::VARCHAR AS document_id, (turn + 1)::INT AS pos FROM r WHERE n <= 12""")
def reducer_spans(spark, sf):
    text = F.when(F.col("role") == "user", "the macro figure").when(F.col("role") == "assistant", "взвешенная оценка").otherwise("macroeconomics")
    spans = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).cast("int").alias("pos"), text.alias("text"))
    return reconcile.reducer_spans(spans).select("document_id", "pos")


@register("""
SELECT 'l_discount' AS column_name, 'dialogue' AS assessment_mode, 'mean' AS reducer, round(avg(x), 6) AS value FROM (SELECT min_by(l_discount, (l_orderkey * 8 + l_linenumber) * 1000 + round(l_discount * 1000)) FILTER (l_linenumber % 2 = 0) AS x FROM lineitem GROUP BY l_suppkey)
UNION ALL SELECT 'l_discount', 'qa', 'mean', round(avg(l_discount) FILTER (l_linenumber % 2 = 0), 6) FROM lineitem""")
def reconcile_group_plans(spark, sf):
    """First values of groups where the first row of a group may have none."""
    key = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000 + F.round(F.col("l_discount") * 1000).cast("long")
    rows = table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount")).alias("l_discount"), "l_suppkey", key.alias("o"))
    whole = reconcile.identity_candidates(rows, ["l_discount"], order="o").select("column_name", "assessment_mode", "reducer", "value")
    groups = reconcile.identity_candidates(rows, ["l_discount"], group="l_suppkey", order="o").filter("assessment_mode = 'dialogue'")
    return groups.select("column_name", "assessment_mode", "reducer", "value").union(whole).select("column_name", "assessment_mode", "reducer", F.round("value", 6).alias("value"))


@register(_values([("another column explains it", "not_evaluable"), ("nothing explains it", "accepted"), ("match", "accepted")], "case_name, outcome"))
def reconcile_gate(spark, sf):
    labels = table(spark, sf, "labels").withColumns({"half": F.when(F.col("doc_id").isNotNull(), F.lit(0.5)), "quality": F.col("quality")})
    gate = lambda reported, column: reconcile.gate(metric.evaluate(labels, _plan("identity", Source(column), missing_policy="exclude_unit", reported_value=Decimal(reported), reported_raw=reported)), reconcile.identity_candidates(labels, ["quality", "toxic", "half"], order="doc_id"))
    cases = {"another column explains it": ("0.50", "toxic"), "nothing explains it": ("0.333", "toxic"), "match": ("0.5", "half")}
    return spark.createDataFrame([(k, _outcome(lambda c=c: gate(*c))) for k, c in cases.items()], "case_name string, outcome string")


# ---- packages, digests and scalars


def _zip(*names: str) -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for n in names:
            z.writestr(n, "x")
    return raw.getvalue()


_CONTENTS = (("a.xlsx", _zip("xl/workbook.xml"), "basket_xlsx"), ("b.docx", _zip("word/document.xml"), "document_docx"), ("c.txt", b"PK", "document_txt"), ("d.zip", _zip("other"), "other"), ("e.bin", b"PK broken", "other"), ("f.bin", b"", "other"))


@register(_values([(n, k) for n, _, k in _CONTENTS], "name, kind"))
def package_kinds(spark, sf):
    return spark.createDataFrame([(n, package.classify(n, c)) for n, c, _ in _CONTENTS], "name string, kind string")


_FILES = (("basket.xlsx", "basket_xlsx"), ("b.docx", "document_docx"), ("a.docx", "document_docx"), ("Assessor_Instruction.TXT", "document_txt"), ("distrib.txt", "document_txt"))


def _files(spark, *more: tuple[str, str], without: str = "") -> DataFrame:
    return spark.createDataFrame([(f"/p/{n}", n, k) for n, k in (*_FILES, *more) if n != without], "path string, name string, kind string")


@register(_values([("doc-1", "Assessor_Instruction.TXT"), ("doc-2", "a.docx"), ("doc-3", "b.docx")], "document_id, name"))
def package_documents(spark, sf):
    return package.numbered_documents(_files(spark)).select("document_id", "name")


@register(_values([("as it is", "accepted"), ("a stray text", "package_error"), ("two workbooks", "package_error"), ("no workbook", "package_error"), ("two documents", "package_error"), ("four documents", "package_error")], "case_name, outcome"))
def package_gate(spark, sf):
    cases = {"as it is": _files(spark), "a stray text": _files(spark, ("notes.txt", "document_txt")), "two workbooks": _files(spark, ("c.xlsx", "basket_xlsx")), "no workbook": _files(spark, without="basket.xlsx"),
             "two documents": _files(spark, without="a.docx"), "four documents": _files(spark, ("d.docx", "document_docx"))}
    return spark.createDataFrame([(k, _outcome(lambda f=f: package.check_package(f))) for k, f in cases.items()], "case_name string, outcome string")


@register(r"""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'CI' || p_partkey ELSE p_name END AS basket,
       coalesce(nullif(trim(regexp_replace(p_name || '!', '[^A-Za-z0-9._-]+', '-', 'g'), '-._'), ''), 'basket') AS folder FROM part""")
def package_names(spark, sf):
    """Names are few and short; each goes through the driver's rule."""
    rows = table(spark, sf, "part").select("p_partkey", "p_name").toLocalIterator()
    return spark.createDataFrame([(k, package.basket_id(f"set-ci{k}-x" if k % 2 == 0 else n), package.package_name(n + "!")) for k, n in rows], "p_partkey long, basket string, folder string")


@register(_values([("one deep file", "validation_report.docx"), ("hidden is skipped", "test_set.xlsx"), ("text too", "assessor_instruction.txt"), ("two", "package_error"), ("none of the kind", "package_error")], "case_name, outcome"))
def package_ports(spark, sf):
    cases = {"one deep file": ("validation_report", ["a/b/x.docx", "a/y.xlsx"]), "hidden is skipped": ("test_set", [".git/x.xlsx", "t.XLSX"]), "text too": ("assessor_instruction", ["i.txt"]), "two": ("test_set", ["a.xlsx", "b.xlsx"]), "none of the kind": ("test_set", ["a.docx"])}
    out = []
    for k, (port, paths) in cases.items():
        said = _outcome(lambda p=port, x=paths: package.resolve_port(p, x))
        out.append((k, package.resolve_port(port, paths)[1] if said == "accepted" else said))
    return spark.createDataFrame(out, "case_name string, outcome string")


@register("""SELECT n_nationkey, sha256('{"key":' || n_nationkey || ',"name":"' || n_name || 'é"}') AS digest FROM nation""")
def json_digests(spark, sf):
    return spark.createDataFrame([(r["n_nationkey"], sinks.sha256_json({"name": r["n_name"] + "é", "key": r["n_nationkey"]})) for r in table(spark, sf, "nation").collect()], "n_nationkey int, digest string")


@register("SELECT count(*)::BIGINT AS n_rows, TRUE AS same_in_any_order, TRUE AS differs_by_one_cell FROM orders")
def table_digests(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    a, b = sinks.table_digest(o), sinks.table_digest(o.repartition(5, "o_orderstatus").sortWithinPartitions(F.desc("o_orderkey")))
    c = sinks.table_digest(o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == 1, "?").otherwise(F.col("o_orderstatus"))))
    return spark.createDataFrame([(a["rows"], a == b, a != c)], "n_rows long, same_in_any_order boolean, differs_by_one_cell boolean")


@register("SELECT c_custkey, CASE WHEN substr(t, 1, 1) IN ('=', '+', '-', '@') THEN '''' || t ELSE t END AS said FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '=' WHEN 1 THEN '+' WHEN 2 THEN '-' WHEN 3 THEN '@' ELSE '' END || c_name AS t FROM customer)")
def sheet_text_guard(spark, sf):
    i = F.col("c_custkey") % 5
    return table(spark, sf, "customer").select("c_custkey", sinks.guarded(F.concat(F.when(i == 0, "=").when(i == 1, "+").when(i == 2, "-").when(i == 3, "@").otherwise(""), F.col("c_name"))).alias("said"))


@register("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 1234.5 WHEN 1 THEN 0.125 WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE -3 END::DOUBLE AS value FROM events")
def numbers_coerced(spark, sf):
    said = F.element_at(F.array(*map(F.lit, ("1 234,5", "12,5 %", " ", "n/a", "-3"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", S.coerce_numeric(said).alias("value"))


@register(_values([("0.75 of 1", "0.75", "75"), ("75", "75", "75"), ("75%", "75", "75"), ("0,75 and 75", "75", "75"), ("none", "75", None), ("1 000", "1000", "1000")], "said, target, value"))
def percent_readings(spark, sf):
    cases = [("0.75 of 1", "0.75"), ("75", "75"), ("75%", "75"), ("0,75 and 75", "75"), ("none", "75"), ("1 000", "1000")]
    plain = lambda v: None if v is None else f"{v.normalize():f}"
    return spark.createDataFrame([(t, x, plain(S.percent_value(t, Decimal(x)))) for t, x in cases], "said string, target string, value string")


@register(_values([("1e3", "1000"), (" 12,5 ", "12.5"), ("1_000", "1000"), ("nan", None), ("x", None)], "said, value"))
def decimals_parsed(spark, sf):
    def parsed(t: str) -> str | None:
        try:
            return f"{S.decimal_of(t).normalize():f}"
        except ValueError:
            return None

    return spark.createDataFrame([(t, parsed(t)) for t in ("1e3", " 12,5 ", "1_000", "nan", "x")], "said string, value string")


@register("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 2 ELSE 0 END::INT AS marks FROM conversations")
def speaker_marks(spark, sf):
    text = F.when(F.col("turn") % 2 == 0, "USER: x BOT_2: no ИИ: y").otherwise("user: x A: y")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.size(F.regexp_extract_all(text, F.lit(validate.MARKER), F.lit(1))).alias("marks"))


@register(_values([("fenced", "1"), ("later fence", "2"), ("bare", "3"), ("after a stray brace", "4"), ("nothing", "structured_output_error")], "case_name, outcome"))
def replies_read(spark, sf):
    cases = {"fenced": 'x ```json\n{"v": 1}\n``` {"v": 9}', "later fence": '```text\n{no}\n```\n```json\n{"v": 2}\n```', "bare": 'so {"v": 3} it is', "after a stray brace": 'a { b {"v": 4}', "nothing": "none"}
    out = []
    for k, text in cases.items():
        said = _outcome(lambda t=text: proposals.extract_json(t))
        out.append((k, str(proposals.extract_json(text)["v"]) if said == "accepted" else said))
    return spark.createDataFrame(out, "case_name string, outcome string")


@register(_values([("all fail", "not_evaluable", "A"), ("second sheet", "B", "A"), ("pinned", "not_evaluable", ""), ("third reply", "3", ""), ("no turns left", "layout_error", ""), ("too long", "not_evaluable", "")], "case_name, outcome, rejected"))
def proposal_loops(spark, sf):
    from gaugeworks.errors import LayoutError, NotEvaluable

    def sheets(good: str, pinned: str | None = None) -> tuple[str, str]:
        seen: tuple[str, ...] = ()

        def attempt(rejected: tuple[str, ...]):
            nonlocal seen
            seen = rejected
            sheet = next(s for s in ("A", "B") if s not in rejected)
            if sheet != good:
                raise NotEvaluable("no", sheet=sheet)
            return sheet, sheet

        try:
            return proposals.first_sheet_that_proves(("A", "B"), attempt, pinned), ",".join(seen)
        except GaugeError as e:
            return e.reason_code, ",".join(seen)

    def asked(good: int, evidence: object = None) -> str:
        def check(p: dict) -> str:
            if p["v"] != good:
                raise LayoutError("no")
            return str(p["v"])

        try:
            return proposals.prove(proposals.Scripted(*({"v": i} for i in range(1, 6))), "layout", evidence or {}, check)
        except GaugeError as e:
            return e.reason_code

    rows = [("all fail", *sheets("C")), ("second sheet", *sheets("B")), ("pinned", *sheets("B", "A")), ("third reply", asked(3), ""), ("no turns left", asked(9), ""), ("too long", asked(1, {"x": "y" * proposals.PAYLOAD_CHARS}), "")]
    return spark.createDataFrame(rows, "case_name string, outcome string, rejected string")


@register("SELECT conv_id, count(*)::BIGINT AS turns, sha256('[' || string_agg('(''' || turn || ''', ''' || role || ''', '''')', ', ' ORDER BY turn) || ']') AS digest FROM conversations GROUP BY conv_id")
def dialogue_literals(spark, sf):
    turn = F.struct(F.col("turn").cast("string").alias("query_id"), F.col("role").alias("question"), F.lit("").alias("answer"))
    turns = F.transform(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("o"), turn.alias("t")))), lambda x: x["t"])
    d = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("dialogue"))
    return d.select("conv_id", F.size("dialogue").cast("long").alias("turns"), F.sha2(publish.dialogue_literal(F.col("dialogue")), 256).alias("digest"))
