"""The engine's front: single operators, and a whole package from files to published tables."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.errors import GaugeError, LayoutError, NotEvaluable, PlanError
from gaugeworks.functions import scalars as S
from gaugeworks.operators import metric, profile, publish, reconcile, validate
from gaugeworks.operators.canon import build_canon, drop_blank_questions
from gaugeworks.operators.region import header_parts
from gaugeworks.plans.contracts import MetricPlan
from gaugeworks.plans.layout import LayoutPlan, raw_names
from gaugeworks.plans.proposals import ProposalSource, first_sheet_that_proves, prove
from gaugeworks.plans.resolve_layout import Resolved, resolve_layout, unrolled
from gaugeworks.plans.resolve_measurement import resolve_measurement
from gaugeworks.sources import documents, package, releases, sinks, workbook


@dataclass(frozen=True)
class RunResult:
    status: str
    published: publish.Published | None
    report: dict[str, object]
    plan: MetricPlan | None
    contract: dict[str, object]
    release: releases.Release | None = None


class Engine:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def canonicalize(self, df: DataFrame, layout: LayoutPlan, merges: DataFrame | None = None) -> DataFrame:
        return build_canon(df, layout, merges)[0]

    def validate(self, canon: DataFrame) -> list[dict[str, object]]:
        return validate.violations(canon)

    def evaluate(self, df: DataFrame, plan: MetricPlan) -> metric.Evaluation:
        return metric.evaluate(df, plan)

    def score(self, df: DataFrame, plan: MetricPlan) -> DataFrame:
        return metric.with_scores(df, plan)

    def publish(self, canon: DataFrame, layout: LayoutPlan, plan: MetricPlan | None = None) -> publish.Published:
        return publish.publish(canon, layout, plan)

    def profile(self, df: DataFrame, columns: list[str], order: str) -> DataFrame:
        return profile.profile_columns(df, columns, order)

    def reconcile(self, result: metric.Evaluation, df: DataFrame, columns: list[str], weight: str | None = None) -> None:
        group = "reference_group_id" if "reference_group_id" in df.columns else None
        reconcile.gate(result, reconcile.identity_candidates(df, columns, weight, group))

    # ---- whole packages

    def sheet_evidence(self, book: workbook.Workbook) -> dict[str, object]:
        """What a proposer sees of each sheet: whole, cells apart; what is too long in all is refused later."""
        out = {}
        for name in book.sheets:
            sheet = book.sheet(name)
            height, width = sheet.bounds()
            header = profile.header_candidate(sheet.cells)
            head = sheet.cells.filter(F.col("row") < 5).orderBy("row", "col").collect()
            told = profile.sheet_columns(sheet.cells, header)
            hints = profile.dialogue_hints(told.withColumn("shown", F.array_join("samples", "\n")), "shown").orderBy("col").collect()
            out[name] = {
                "rows": height, "columns": width, "header_candidate": header + 1,
                "preview": [[r["row"] + 1, r["col"], r["s"][:80]] for r in head],
                "column_profiles": self._column_profiles(told.collect(), header_parts(sheet, [header]), width),
                "merges": [list(r)[1:] for r in sheet.merges.orderBy("row", "col").collect()],
                "formulas": [[r["row"] + 1, r["col"], r["formula"][:120]] for r in sheet.formulas.orderBy("row", "col").collect()],
                "dialogue_hints": [{"column_id": S.column_letters(r["col"]), "markers": r["marks"]} for r in hints],
            }
        return out

    def _column_profiles(self, told: list, parts: dict[int, list[str]], width: int) -> list[dict[str, object]]:
        """Every column of a sheet by letter and header; frequencies only where values are few."""
        found = {r["col"]: r for r in told}
        out = []
        for c in range(width):
            r, letter = found.get(c), S.column_letters(c)
            one = {"column_id": letter, "header": " ".join(parts.get(c, ())) or f"unnamed_{letter}", "non_null": r["non_null"] if r else 0, "numeric_count": r["numeric"] if r else 0, "samples": r["samples"] if r else []}
            out.append(one | ({"values": {x["value"]: x["n"] for x in r["values"]}} if r and r["values"] else {}))
        return out

    def dialogue_cells(self, found: Resolved) -> list[dict[str, object]]:
        """Columns whose cells are whole dialogues, and aren't one cell repeated over the rows of a group."""
        names = list(found.plan.column_ids.values())
        out = []
        for c in validate.dialogue_columns(found.region, names):
            keys = [k for k in (found.plan.session_id, found.plan.query_id) if k and k != c["column"]]
            if any(validate.repeated_in_groups(found.region, k, c["column"]) for k in keys):
                continue
            first = profile.samples(found.region, [c["column"]], "source_row_id", 1)[c["column"]]
            container = "python_list" if first and first[0].lstrip().startswith("[") else "plain_text"
            out.append(c | {"column_id": found.plan.letter(c["column"]), "container": container})
        return out

    def inventory(self, found: Resolved) -> list[dict[str, object]]:
        """Columns of the region: name, samples, formula rows, and whether a vertical merge covers them."""
        names = list(found.plan.column_ids.values())
        shown = profile.samples(found.region, names, "source_row_id")
        filled = {r["column_name"]: r["non_null"] for r in profile.profile_columns(found.region, names, "source_row_id", distinct=False).select("column_name", "non_null").collect()}
        tall = [(r["c1"], r["c2"]) for r in found.merges.filter("r2 > r1").select("c1", "c2").collect()]
        return [
            {"column_id": i, "name": n, "non_null": filled.get(n, 0), "samples": [v[:120] for v in shown[n]], "formula_rows": list(found.plan.formula_rows.get(i, ())),
             "vertically_merged": any(a <= workbook.column_index(i) <= b for a, b in tall)}
            for i, n in found.plan.column_ids.items()
        ]

    def propose_layout(self, source: ProposalSource, book: workbook.Workbook, basket: str, evidence: dict, rejected: tuple[str, ...] = (), pinned: str | None = None):
        def check(proposal: dict):
            sheet = proposal.get("sheet_name")
            if pinned and sheet != pinned or sheet in rejected:
                raise LayoutError("This sheet isn't open to choice", sheet=sheet, pinned=pinned, rejected=list(rejected))
            found = resolve_layout(proposal, book, basket)
            if found.plan.grouping != "blob_row":
                cells = self.dialogue_cells(found)
                better = unrolled(proposal, cells) if cells else None
                if better:
                    found = resolve_layout(better, book, basket)
                elif any(c["column"] == found.plan.input_query for c in cells):
                    raise LayoutError("The question column holds whole dialogues", candidates=cells)
            canon, account = build_canon(found.region, found.plan, found.merges)
            faults = validate.violations(canon)
            lone = len(faults) == 1 and faults[0]["check"] == "blank" and faults[0]["column"] == "input_query"
            if lone and found.plan.grouping == "none" and faults[0]["count"] < canon.count():
                canon, gone = drop_blank_questions(canon)
                account["dropped_rows"] = [r[0] for r in gone.orderBy("source_row_id").limit(20).collect()]
            elif faults:
                raise LayoutError("The canonical table breaks its rules", violations=faults)
            if found.plan.grouping != "blob_row" and not proposal.get("evidence", {}).get("blank_answers"):
                kept = list(raw_names(list(found.plan.column_ids.values())).values())
                gaps = validate.blank_answers(canon, kept)
                if gaps["count"]:
                    raise LayoutError("Answers are blank; say why under evidence.blank_answers, or name further columns", **gaps)
            return found, canon, account

        return prove(source, "layout", {"basket_id": basket, "sheets": evidence, "rejected": list(rejected)}, check)

    def run_package(self, path: str, source: ProposalSource, out: str | None = None, sheet: str | None = None) -> RunResult:
        files = package.scan_package(self.spark, path)
        package.check_package(files)
        basket = package.basket_id(PurePosixPath(path).name)
        docs = package.numbered_documents(files)
        spans_df = documents.read_documents(self.spark, docs)
        spans = [(r["span_id"], r["document_id"], r["text"]) for r in spans_df.orderBy("document_id", "pos").collect()]  # three documents
        book_file = files.filter("kind = 'basket_xlsx'").first()
        book = workbook.read_workbook(self.spark, book_file["path"])
        intro = {r["document_id"]: r["intro"] for r in profile.document_intro(spans_df).collect()}
        evidence = self.sheet_evidence(book) | {"documents": intro}
        state: dict[str, object] = {}

        def attempt(rejected: tuple[str, ...]):
            found, canon, _ = self.propose_layout(source, book, basket, evidence, rejected, sheet)
            state["layout"], state["canon"] = found, canon
            inventory = self.inventory(found)

            def check(proposal: dict):
                merges = [tuple(r) for r in found.merges.select("r1", "c1", "r2", "c2").filter(F.col("r2") > max(found.header_rows)).collect()]
                formulas = {}
                for i, rows in found.plan.formula_rows.items():
                    r = book.sheet(found.sheet_name).formulas.filter((F.col("row") == rows[0] - 1) & (F.col("col") == workbook.column_index(i))).first()
                    formulas[i] = r["formula"] if r else ""
                plan = resolve_measurement(proposal, canon, found.plan, spans, basket, merges, formulas)
                result = metric.evaluate(canon, plan)
                kept = raw_names(list(found.plan.column_ids.values()))
                self.reconcile(result, canon, list(kept.values()), "input_query_count" if found.plan.weight else None)
                return plan, result, publish.publish(metric.with_scores(canon, plan), found.plan, plan)

            try:
                return found.sheet_name, prove(source, "measurement", {"basket_id": basket, "columns": inventory, "spans": [[i, t] for i, _, t in spans]}, check)
            except (NotEvaluable, PlanError) as e:
                raise NotEvaluable(e.message, **{**e.details, "sheet": found.sheet_name}) from e

        try:
            plan, result, published = first_sheet_that_proves(book.sheets, attempt, sheet)
            report, status = result.report(), "computed"
        except NotEvaluable as e:
            plan, status = None, "not_evaluable"
            report = metric.not_evaluable_report(e.message, **e.details)
            found = state.get("layout")
            published = publish.publish(state["canon"], found.plan, None) if found else None
        found: Resolved | None = state.get("layout")
        report["provenance"] = {
            "inputs": {r["name"]: r["sha256"] for r in files.select("name", "sha256").collect()},
            "layout": sinks.sha256_json(found.plan.to_dict()) if found else None,
            "plan": sinks.sha256_json(plan.to_dict()) if plan else None,
            "canon": sinks.sha256_json(sinks.table_digest(state["canon"])) if found else None,
            "published": sinks.sha256_json(sinks.table_digest(published.frame)) if published else None,
        }
        contract = publish.monitoring_contract(published, plan, report)
        released = self._release(out, published, report, contract) if out else None
        return RunResult(status, published, report, plan, contract, released)

    def _release(self, out: str, published: publish.Published | None, report: dict, contract: dict) -> releases.Release:
        """Stage everything, then make it the current release of the folder in one step; other files there stay."""
        draft = releases.Releases(self.spark, out).begin()
        if published:
            draft.put_table(published.variant, published.frame)
            sheet_of = draft.table(published.variant)
            if published.variant == "dialogue":
                sheet_of = sheet_of.withColumn("dialogue", publish.dialogue_literal(F.col("dialogue")))
            draft.put_workbook(f"{published.variant}.xlsx", sheet_of, published.variant)
        draft.put_json("report.json", report)
        draft.put_json("monitoring.json", contract)
        done = draft.commit()
        sinks.clear_failure(self.spark, out)
        return done


def main(argv: list[str] | None = None) -> int:
    """``python -m gaugeworks.engine run FOLDER --proposals FILE [-o OUT]``: 0 also for what can't be evaluated, 5 where proposals fail, 1 for the unexpected."""
    import argparse
    import json
    import traceback

    from gaugeworks.errors import ProposalError
    from gaugeworks.plans.proposals import Scripted

    p = argparse.ArgumentParser(prog="gaugeworks")
    p.add_argument("command", choices=["run"])
    p.add_argument("folder")
    p.add_argument("--proposals", required=True, help="a JSON list of proposals, in the order they are asked for")
    p.add_argument("--sheet")
    p.add_argument("-o", "--out")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    try:
        result = Engine(spark).run_package(a.folder, Scripted(*json.loads(Path(a.proposals).read_text("utf-8"))), a.out or f"{a.folder}/out", a.sheet)
        print(json.dumps({"status": result.status, "metric": result.report.get("main_metric")}, ensure_ascii=False))
    except ProposalError as e:
        print(e)
        return 5
    except GaugeError as e:
        sinks.write_failure(a.out or f"{a.folder}/out", e)
        print(json.dumps(e.to_dict(), ensure_ascii=False, default=str))
    except Exception:  # nothing that a package can be blamed for
        traceback.print_exc()
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
