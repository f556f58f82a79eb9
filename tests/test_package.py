"""Workbooks, documents, resolvers and a whole package run."""

import io
import json
import zipfile
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeworks.engine import Engine
from gaugeworks.errors import GaugeError, LayoutError, NotEvaluable, PackageError, PlanError, StructuredOutputError
from gaugeworks.operators import grouping, reconcile
from gaugeworks.operators.metric import checked_table, metric_table
from gaugeworks.operators.region import build_region, deduped, header_names, header_parts, is_vertical_aggregate
from gaugeworks.plans import contracts, proposals
from gaugeworks.plans.layout import LayoutPlan
from gaugeworks.plans.resolve_layout import resolve_layout
from gaugeworks.plans.resolve_measurement import canonical_score, prove_reducer, prove_sources, reported_for, resolve_measurement
from gaugeworks.sources import documents, package, releases, sinks, workbook
from gaugeworks.streaming import batch_table, metric_by_batch, total_table

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def write_xlsx(path, sheets):
    """{name: (cells {ref: value or (formula, value)}, merges)} as a minimal workbook."""
    def cell(ref, v):
        f = ""
        if isinstance(v, tuple):
            f, v = f"<f>{v[0].lstrip('=')}</f>", v[1]
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b">{f}<v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}">{f}<v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'

    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        names = list(sheets)
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/s{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
        for i, n in enumerate(names, 1):
            cells, merges = sheets[n]
            rows = {}
            for ref, v in cells.items():
                rows.setdefault(int("".join(c for c in ref if c.isdigit())), []).append((ref, v))
            body = "".join(f'<row r="{r}">' + "".join(cell(*x) for x in sorted(rows[r], key=lambda x: (len(x[0]), x[0]))) + "</row>" for r in sorted(rows))
            ranges = f'<mergeCells>{"".join(f"<mergeCell ref={chr(34)}{m}{chr(34)}/>" for m in merges)}</mergeCells>' if merges else ""
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData>{ranges}</worksheet>')


def write_docx(path, *paragraphs):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", "<w:document>" + "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs) + "</w:document>")


CELLS = {"A1": "id", "B1": "Question", "C1": "Answer", "D1": "Mark", "E1": "Weight", "F1": "Sum",
         **{f"{c}{r}": v for r, row in enumerate([("x1", "q one", "a one", "1", 2, ("=D2+E2", 3)), ("x2", "q two", "a two", "0", 1, ("=D3", 0)), ("x3", "q three", "a three", "1", 1, ("=D4", 1))], 2) for c, v in zip("ABCDEF", row)},
         "D5": ("=SUM(D2:D4)", 2)}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("in") / "set-ci042"
    d.mkdir()
    write_xlsx(d / "basket.xlsx", {"Data": (CELLS, []), "Other": ({"A1": "n"}, [])})
    write_docx(d / "a_development.docx", "Development report", "The score is the mark")
    write_docx(d / "b_validation.docx", "Validation report", "The weighted mean is 75%", "Threshold 0.7")
    (d / "assessor_instruction.txt").write_bytes("﻿Instruction\n\n Mark 1 or 0 ".encode())
    (d / "distrib.txt").write_text("ignored")
    return d


def address(column, header):
    return {"column": column, "header": header}


def layout(**more):
    base = {"basket_id": "CI042", "sheet_name": "Data", "ignored_sheets": ["Other"], "header_rows": [1],
            "roles": {"input_query": address("B", "question"), "output_answer": address("C", "Answer"), "query_id": address("A", "id"), "scenario": None, "assessor_id": None, "reference_answers": []},
            "grouping": {"kind": "none", "column": None}, "dialogue_blob": None, "weight": address("E", "Weight")}
    return base | more


def measurement(**more):
    base = {"basket_id": "CI042", "metric_name": "km", "document_roles": {"instruction": "doc-2", "development_report": "doc-1", "validation_report": "doc-3"}, "assessment_mode": "qa",
            "score": {"method": "identity", "sources": [{"column_id": "D", "role": "final_score", "normalization": "numeric", "polarity": "direct"}], "missing_policy": "fail", "majority_denominator": None},
            "reducer": {"method": "frequency_weighted_mean"}, "release": {"threshold": "0.7", "comparator": ">=", "scale": "ratio", "precision": 2},
            "reported_value_state": "unambiguous", "reported_value": {"value": "0.75", "raw": "75%", "span_id": "doc-3:p0002"},
            "evidence": {f: [] for f in contracts.EVIDENCE} | {f: ["doc-3:p0002"] for f in ("metric", "score", "assessment_mode", "reducer", "reported_value")} | {"release": ["doc-3:p0003"]}}
    return base | more


def test_package_run(spark, folder, tmp_path):
    bad = layout(header_rows=[2])
    source = proposals.Scripted(bad, "```json\n" + json.dumps(layout()) + "\n```", measurement(reducer={"method": "mean"}), measurement())
    r = Engine(spark).run_package(str(folder), source, str(tmp_path / "out"))
    assert r.status == "computed" and r.report["recomputed_value"] == 0.75 and r.report["reconciliation"]["status"] == "match" and r.report["threshold_verdict"] == "passed"
    assert [len(f) for _, f in source.feedback] == [0, 1, 0, 1]
    rows = r.published.frame.orderBy("query_id").collect()
    assert [(x["query_id"], x["input_query_count"], x["mark_metric"]) for x in rows] == [("x1", 2, 1.0), ("x2", 1, 0.0), ("x3", 1, 1.0)]
    assert r.contract["aggregation"]["weight"] == "input_query_count" and r.contract["baseline"] == 0.75
    released = releases.Releases(spark, str(tmp_path / "out"))
    now = released.current()
    assert now == r.release and released.verify(now) == [] and now.table(spark, "flat").count() == 3
    assert json.loads(Path(now.path.removeprefix("file:"), "report.json").read_text())["provenance"]["plan"]
    assert workbook.read_workbook(spark, f"{now.path}/flat.xlsx").cells.filter("row = 3").count() > 0


def test_a_run_into_its_own_package_loses_nothing(spark, folder):
    before = {p.name: p.read_bytes() for p in folder.iterdir()}
    (folder / "failure.json").write_text("{}")
    for _ in range(2):
        r = Engine(spark).run_package(str(folder), proposals.Scripted(layout(), measurement()), str(folder))
    assert {p.name: p.read_bytes() for p in folder.iterdir() if p.is_file() and not p.name.startswith(".")} == before
    assert r.status == "computed" and releases.Releases(spark, str(folder)).current().number == 2


def test_a_plan_that_never_proves_is_not_evaluable(spark, folder):
    with pytest.raises(GaugeError):
        Engine(spark).run_package(str(folder), proposals.Scripted(*[layout(basket_id="no")] * 5))
    r = Engine(spark).run_package(str(folder), proposals.Scripted(layout(), *[measurement(reported_value_state="ambiguous", reported_value=None)] * 5), sheet="Data")
    assert r.status == "not_evaluable" and r.report["main_metric"] is None and r.contract["status"] == "not_computable" and r.published.variant == "flat"


def test_dialogues_in_cells_are_unrolled(spark, tmp_path):
    cells = {"A1": "talk", "B1": "mark", **{f"A{r}": f"USER: ask {r} BOT: tell {r} USER: more BOT: end" for r in (2, 3)}, "B2": "1", "B3": "0"}
    write_xlsx(tmp_path / "d.xlsx", {"Data": (cells, [])})
    book = workbook.read_workbook(spark, str(tmp_path / "d.xlsx"))
    roles = {"input_query": address("A", "talk"), "output_answer": None, "query_id": "synthesize", "scenario": None, "assessor_id": None, "reference_answers": []}
    proposal = layout(ignored_sheets=[], roles=roles, weight=None)
    found, canon, _ = Engine(spark).propose_layout(proposals.Scripted(proposal), book, "CI042", {})
    assert found.plan.grouping == "blob_row" and canon.count() == 4
    assert [(r["input_query"], r["output_answer"]) for r in canon.orderBy("source_row_id", "turn_index").collect()][:2] == [("ask 2", "tell 2"), ("more", "end")]


def test_package_gates(spark, folder, tmp_path):
    files = package.scan_package(spark, str(folder))
    assert {r["name"]: r["kind"] for r in files.collect()}["basket.xlsx"] == "basket_xlsx" and files.count() == 5
    package.check_package(files)
    assert [(r["document_id"], r["name"]) for r in package.numbered_documents(files).orderBy("name").collect()][1] == ("doc-2", "assessor_instruction.txt")
    with pytest.raises(PackageError):
        package.check_package(files.filter("kind <> 'basket_xlsx'"))
    with pytest.raises(PackageError):
        package.check_package(files.filter("name <> 'a_development.docx'"))
    assert package.basket_id("set-ci042-x") == "CI042" and package.basket_id("plain") == "plain" and package.package_name("a b/c!") == "a-b-c" and package.package_name("--") == "basket"
    assert package.resolve_port("assessor_instruction", ["/p/x.txt", "/p/.h/y.txt"]) == ("/p/x.txt", "assessor_instruction.txt")
    with pytest.raises(PackageError):
        package.resolve_port("test_set", [])
    assert package.classify("x.docx", b"no zip") == "other" and package.classify("x.docx", b"PK broken") == "other"


def test_spans_and_markup(spark, folder):
    spans = documents.read_documents(spark, package.numbered_documents(package.scan_package(spark, str(folder))))
    got = {r["span_id"]: r["text"] for r in spans.collect()}
    assert got["doc-2:p0002"] == "Mark 1 or 0" and got["doc-3:p0002"] == "The weighted mean is 75%" and len(got) == 7
    html = spark.createDataFrame([("<p>a&amp;b</w:p>\n\n\n\n<w:tc>c</w:tc>d </x> ",)], "h string").select(documents.markup_to_text(F.col("h"))).first()[0]
    assert html == "a&b\n\nc\td"


def test_formulas_headers_and_bounds(spark, tmp_path):
    formulas = ["=SUM(D2:D4)", "=SUM(E269:G269)/3", "=СУММ($C$2:$C$364)", "=count(C:C)", "=A1+B2", "=SUM(A1:B1)+1"]
    df = spark.createDataFrame([(f,) for f in formulas], "f string")
    assert [r[0] for r in df.select(is_vertical_aggregate(F.col("f"))).collect()] == [True, False, True, True, False, False]
    assert deduped(["a", "a#2", "a", "a"]) == ["a", "a#2", "a#2", "a#3"]
    write_xlsx(tmp_path / "h.xlsx", {"S": ({"A1": "Group", "C1": "id", "A2": "left  part", "B2": "right", "A3": 1, "B3": 2.5, "C3": True, "B4": "x"}, ["A1:B1", "C1:C2", "A3:A6"])})
    book = workbook.read_workbook(spark, str(tmp_path / "h.xlsx"))
    s = book.sheet("S")
    assert s.bounds() == (6, 3)
    parts = header_parts(s, [0, 1])
    names = header_names(parts, 4)
    assert names == ["Group left part", "Group right", "id", "unnamed_D"]
    rows = build_region(s, [1, 2], 6, names[:3]).orderBy("source_row_id").collect()
    assert [tuple(r) for r in rows] == [(3, "1", "2.5", "True"), (4, None, "x", None), (5, None, None, None), (6, None, None, None)]


def test_merged_rows_are_forced_and_filled(spark, tmp_path):
    cells = {"A1": "dialogue", "B1": "q", "C1": "a", "A2": "d1", "B2": "q1", "C2": "a1", "B3": "q2", "C3": "a2", "A4": "d2", "B4": "q3", "C4": "a3", "A6": "note"}
    write_xlsx(tmp_path / "m.xlsx", {"Data": (cells, ["A2:A3"])})
    book = workbook.read_workbook(spark, str(tmp_path / "m.xlsx"))
    roles = {"input_query": address("B", "q"), "output_answer": address("C", "a"), "query_id": "synthesize", "scenario": None, "assessor_id": None, "reference_answers": []}
    r = resolve_layout(layout(ignored_sheets=[], roles=roles, weight=None), book, "CI042")
    assert r.plan.grouping == "merged_rows" and r.last_row == 4
    canon = Engine(spark).canonicalize(r.region, r.plan, r.merges).orderBy("source_row_id").collect()
    assert [(x["reference_group_id"], x["turn_index"], x["dialogue"]) for x in canon] == [("0", 1, "d1"), ("0", 2, "d1"), ("1", 1, "d2")]
    assert {x["row"]: x["role"] for x in r.ledger.collect()} == {1: "header", 2: "data", 3: "data", 4: "data", 6: "metadata"}


@pytest.mark.parametrize("change", [
    {"basket_id": "other"}, {"sheet_name": "None"}, {"ignored_sheets": []}, {"header_rows": [1, 3]}, {"header_rows": [9]}, {"header_rows": [1, 2]}, {"weight": address("F", "Sum")}, {"weight": address("D", "wrong")},
    {"weight": address("Z", None)}, {"grouping": {"kind": "column", "column": None}}, {"grouping": {"kind": "merged_rows", "column": None}}, {"grouping": {"kind": "blob_row", "column": None}}, {"surprise": 1},
    {"roles": layout()["roles"] | {"scenario": address("B", "question")}}, {"roles": layout()["roles"] | {"reference_answers": [address("C", "Answer")]}},
    {"dialogue_blob": {"column": address("B", "question"), "container": "plain_text", "question_marker": "Q", "answer_marker": "A"}},
])
def test_layouts_that_are_refused(spark, folder, change, request):
    book = request.getfixturevalue("book")
    with pytest.raises(LayoutError):
        resolve_layout(layout(**change), book, "CI042")


@pytest.fixture(scope="module")
def book(spark, folder):
    return workbook.read_workbook(spark, str(folder / "basket.xlsx"))


SPANS = [("doc-1:p0001", "doc-1", "Score"), ("doc-2:p0001", "doc-2", "Rules"), ("doc-3:p0001", "doc-3", "Report"), ("doc-3:p0002", "doc-3", "The weighted mean is 75%"), ("doc-3:p0003", "doc-3", "Threshold 0.7")]


def change_score(**more):
    return {"score": measurement()["score"] | more}


@pytest.mark.parametrize("change,error", [
    ({"basket_id": "x"}, PlanError), ({"extra": 1}, PlanError), ({"document_roles": {r: "doc-1" for r in contracts.DOCUMENT_ROLES}}, PlanError),
    ({"evidence": measurement()["evidence"] | {"metric": []}}, PlanError), ({"evidence": measurement()["evidence"] | {"metric": ["doc-1:p0099"]}}, PlanError),
    (change_score(sources=[measurement()["score"]["sources"][0] | {"column_id": "Q"}]), NotEvaluable), (change_score(sources=[measurement()["score"]["sources"][0] | {"column_id": "E"}]), NotEvaluable),
    (change_score(sources=[measurement()["score"]["sources"][0] | {"column_id": "F"}]), NotEvaluable), (change_score(majority_denominator="present"), PlanError), (change_score(method="majority", sources=[measurement()["score"]["sources"][0] | {"role": "assessor_vote"}]), NotEvaluable),
    ({"release": {"threshold": "0.7", "comparator": None, "scale": "ratio", "precision": 2}}, PlanError), ({"release": {"threshold": "0.9", "comparator": ">=", "scale": "ratio", "precision": 2}}, NotEvaluable),
    ({"reported_value_state": "absent"}, PlanError), ({"reported_value_state": "ambiguous"}, NotEvaluable), ({"reported_value": {"value": "0.8", "raw": "0.8", "span_id": "doc-3:p0002"}}, NotEvaluable),
    ({"reported_value": {"value": "0.75", "raw": "75%", "span_id": "doc-1:p0001"}}, NotEvaluable), ({"evidence": measurement()["evidence"] | {"reported_value": []}}, PlanError),
])
def test_plans_that_are_refused(spark, change, error):
    rows = spark.createDataFrame([(2, "1", 2), (3, "0", 1)], "source_row_id long, Mark string, input_query_count long")
    plan = LayoutPlan("q", ("a",), weight="Weight", column_ids={"D": "Mark", "E": "Weight", "F": "Sum"}, formula_rows={"F": (2,)})
    good = resolve_measurement(measurement(), rows, plan, SPANS, "CI042")
    assert good.reported_value == Decimal("0.75") and good.weight == "input_query_count" and good.reducer == "frequency_weighted_mean"
    with pytest.raises(error):
        resolve_measurement(measurement(**change), rows, plan, SPANS, "CI042")


def test_missing_policies_need_evidence(spark):
    rows = spark.createDataFrame([(2, "1", 2), (3, " ", 1)], "source_row_id long, Mark string, input_query_count long")
    plan = LayoutPlan("q", ("a",), weight="Weight", column_ids={"D": "Mark", "E": "Weight"})
    for change in ({}, change_score(missing_policy="zero")):
        with pytest.raises(NotEvaluable):
            resolve_measurement(measurement(**change), rows, plan, SPANS, "CI042")
    with_proof = measurement(**change_score(missing_policy="zero"), evidence=measurement()["evidence"] | {"missing_policy": ["doc-1:p0001"]})
    assert resolve_measurement(with_proof, rows, plan, SPANS, "CI042").missing_policy == "zero"


def test_scores_reducers_and_reports(spark):
    s = lambda role, c="A", n="numeric": {"column_id": c, "role": role, "normalization": n, "polarity": "direct"}
    assert canonical_score("mean_criteria", [s("criterion")])[0] == "identity"
    assert canonical_score("majority", [s("assessor_vote")])[0] == "majority"
    assert [x["role"] for x in canonical_score("accuracy", [s("target"), s("prediction", "B"), s("criterion", "C")])[1]] == ["prediction", "target"]
    for method, sources in [("majority", [s("assessor_vote")]), ("accuracy", [s("prediction"), s("target", "B")]), ("identity", [s("final_score", n="label")]), ("identity", [s("final_score", n={"A": 1, " a": 0})])]:
        with pytest.raises(NotEvaluable):
            prove_sources(method, sources)
    spans = [("doc-3:p0001", "doc-3", "Macro"), ("doc-3:p0002", "doc-3", "71,5%"), ("doc-3:p0003", "doc-3", "Weighted"), ("doc-3:p0004", "doc-3", "we publish the weighted figure")]
    assert reported_for(spark, "mean", "ratio", spans, "doc-3") == [{"value": "0.715", "raw": "71,5%", "span_id": "doc-3:p0002", "label_span_id": "doc-3:p0001"}]
    prove_reducer("frequency_weighted_mean", ("doc-3:p0004",), spans, "doc-3")
    for reducer, cited in [("mean", ("doc-3:p0001",)), ("frequency_weighted_mean", ("doc-3:p0001", "doc-3:p0004")), ("frequency_weighted_mean", ("doc-3:p0003",))]:
        with pytest.raises(NotEvaluable):
            prove_reducer(reducer, cited, spans, "doc-3")


def test_proposals():
    assert proposals.extract_json('text {"a": 1} tail') == {"a": 1} and proposals.extract_json('```json\n{"b": 2}\n```') == {"b": 2}
    with pytest.raises(StructuredOutputError):
        proposals.extract_json("nothing")
    with pytest.raises(NotEvaluable):
        proposals.bounded("x" * 10, 5)

    def attempt(rejected):
        if len(rejected) < 1:
            raise NotEvaluable("no", sheet="A")
        return "B", rejected

    assert proposals.first_sheet_that_proves(("A", "B"), attempt) == ("A",)
    with pytest.raises(NotEvaluable):
        proposals.first_sheet_that_proves(("A",), attempt)


def test_sinks_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "=1+1", 0.5), (2, None, 1.0)], "n long, t string, x double")
    assert sinks.write_workbook(df, tmp_path / "w.xlsx") == 2
    got = workbook.read_workbook(spark, str(tmp_path / "w.xlsx")).cells.orderBy("row", "col").collect()
    assert [r["s"] for r in got] == ["n", "t", "x", "1", "=1+1", "0.5", "2", "1"]
    sinks.write_table(df, str(tmp_path / "csv"), "csv")
    assert spark.read.csv(str(tmp_path / "csv"), header=True).orderBy("n").first()["t"] == "'=1+1"
    a, b = (dict(sinks.frame_digest(x, "n").collect()) for x in (df, df.repartition(2)))
    assert a == b and a != dict(sinks.frame_digest(df.withColumn("x", F.lit(2.0)), "n").collect())
    assert a["t"] != dict(sinks.frame_digest(df.fillna("", ["t"]), "n").collect())["t"]  # null is no empty text
    assert sinks.sha256_json({"b": 1, "a": "é"}) == sinks.sha256_json({"a": "é", "b": 1})
    df.write.parquet(str(tmp_path / "stream"))
    plan = contracts.MetricPlan("m", "identity", (contracts.Source("x"),))
    q = spark.readStream.schema(df.schema).parquet(str(tmp_path / "stream")).writeStream.foreachBatch(metric_by_batch(plan, str(tmp_path / "sums"))).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    metric_by_batch(plan, str(tmp_path / "sums"))(df.withColumn("x", F.lit(0.0)), 7)
    assert {r["batch"]: r["value"] for r in batch_table(spark, plan, str(tmp_path / "sums")).collect()} == {0: 0.75, 7: 0.0}
    total, whole = total_table(spark, plan, str(tmp_path / "sums")), metric_table(df.union(df.withColumn("x", F.lit(0.0))), plan)
    assert total.columns == whole.columns and total.first() == whole.first() and total.first()["value"] == 0.375
    with pytest.raises(PlanError):
        metric_by_batch(contracts.MetricPlan("m", "identity", (contracts.Source("x"),), unit="dialogue"), str(tmp_path))
    sinks.write_workbook(spark.createDataFrame([("a\x01b",)], "t string"), f"file://{tmp_path}/odd.xlsx")
    assert workbook.read_workbook(spark, str(tmp_path / "odd.xlsx")).cells.filter("row = 1").first()["s"] == "ab"


def test_shared_formulas_are_those_of_each_cell():
    assert workbook.shifted("SUM(A1:$B$2)+C$3*$D4&\"A1\"&'A1 x'!E5+LOG10(F6)", 2, 1) == "SUM(B3:$B$2)+D$3*$D6&\"A1\"&'A1 x'!F7+LOG10(G8)"
    assert workbook.shifted("SUM(A:B,$C:$C)", 3, 2) == "SUM(C:D,$C:$C)"
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="C1"><f t="shared" ref="C1:C2" si="0">SUM(A1:A9)</f><v>1</v></c></row><row r="2"><c r="C2"><f t="shared" si="0"/><v>2</v></c></row></sheetData></worksheet>'
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    found = {(p[3], p[4]): p[8] for p in workbook.parse_workbook(raw.getvalue()) if p[0] == "formula"}
    assert found == {(0, 2): "=SUM(A1:A9)", (1, 2): "=SUM(A2:A10)"}


def test_ports_settings_and_later_fences(spark, tmp_path):
    (tmp_path / "report/deep").mkdir(parents=True)
    (tmp_path / "report/deep/v.docx").write_bytes(b"PK")
    (tmp_path / "report/.hidden.docx").write_bytes(b"PK")
    assert package.port_files(spark, str(tmp_path / "report")) == [".hidden.docx", "deep/v.docx"]
    made = package.prepare_package(spark, {"validation_report": str(tmp_path / "report")}, str(tmp_path / "out"), "set one")
    assert (tmp_path / "out/set-one/validation_report.docx").exists() and made.endswith("/set-one")
    (tmp_path / "s.json").write_text('{"sheet": "Data", "model": null}')
    assert package.read_settings(spark, str(tmp_path / "s.json")) == {"sheet": "Data"}
    assert proposals.extract_json("```text\n{no}\n```\nthen ```json\n{\"a\": {\"b\": 1}}\n```") == {"a": {"b": 1}}

    def check(proposal):
        return proposal["missing"]

    with pytest.raises(StructuredOutputError):
        proposals.prove(proposals.Scripted({}, {}), "layout", {}, check, turns=2)


def test_tables_show_what_breaks_a_plan(spark):
    p = contracts.MetricPlan("m", "identity", (contracts.Source("s"),), weight="w")
    df = spark.createDataFrame([("a", "1", "-3"), ("a", "abc", "1"), ("b", "1", "2.4"), ("c", "1e-20", "1"), ("d", "1e1", "2")], "g string, s string, w string")
    got = {r["g"]: r for r in metric_table(df, p, ["g"]).collect()}
    assert got["a"]["value"] is None and (got["a"]["broken"], got["a"]["bad_weight"], got["a"]["missing"]) == (1, 1, 1)
    assert got["b"]["value"] is None and got["b"]["bad_weight"] == 1 and got["c"]["broken"] == 1 and got["d"]["value"] == 10
    with pytest.raises(PlanError):
        checked_table(df, p, ["g"])
    assert checked_table(df.filter("g = 'd'"), p, ["g"]).first()["value"] == 10


def test_first_values_of_groups_and_white_space(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 1.0), (3, "b", 0.0)], "source_row_id long, g string, x double")
    got = {(r["assessment_mode"], r["reducer"]): r["value"] for r in reconcile.identity_candidates(df, ["x"], group="g").collect()}
    assert got[("dialogue", "mean")] == 0.5
    rows = spark.createDataFrame([(1, "A"), (2, "A\t"), (3, "\u00a0B"), (4, "B\n"), (5, " \t")], "source_row_id long, k string")
    assert [r["group_index"] for r in grouping.group_by_column(rows, "k").orderBy("source_row_id").collect()] == [0, 0, 1, 1, 1]


def test_sheet_evidence_is_whole(spark, tmp_path):
    letters = [f"{a}{b}" for a in ["", *"ABCDEFGH"] for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"][:210]
    cells = {f"{c}{r}": f"h{i}" if r == 1 else f"v{i}" for i, c in enumerate(letters) for r in range(1, 6)}
    cells |= {"A2": "USER: hi BOT: yes", "A3": "USER: more", "A4": "BOT: end", "C2": 1, "C3": 2, "C4": 2, "C5": "x"}
    cells |= {f"B{r}": (f"=C{r}+1", r) for r in range(6, 156)}
    write_xlsx(tmp_path / "b.xlsx", {"Data": (cells, [f"D{r}:E{r}" for r in range(6, 156)]), "Empty": ({}, [])})
    all_ = Engine(spark).sheet_evidence(workbook.read_workbook(spark, str(tmp_path / "b.xlsx")))
    got = all_["Data"]
    assert len(got["merges"]) == len(got["formulas"]) == 150 and got["formulas"][-1] == [155, 1, "=C155+1"] and len(got["preview"]) == 5 * 210
    assert [p["column_id"] for p in got["column_profiles"]] == letters and got["column_profiles"][209]["header"] == "h209"
    c = got["column_profiles"][2]
    assert (c["non_null"], c["numeric_count"], c["samples"], list(c["values"].items())) == (4, 3, ["1", "2", "2"], [("2", 2), ("1", 1), ("x", 1)])
    assert "values" not in got["column_profiles"][1] and got["dialogue_hints"] == [{"column_id": "A", "markers": ["USER", "BOT"]}]
    assert all_["Empty"]["column_profiles"] == all_["Empty"]["dialogue_hints"] == []
