"""A layout proposal, proved against the cells of its sheet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gaugeworks.errors import LayoutError
from gaugeworks.functions import scalars as S
from gaugeworks.operators.grouping import ROW, first_rows
from gaugeworks.operators.region import build_region, header_names, header_parts, is_vertical_aggregate
from gaugeworks.sources.workbook import Workbook

from .contracts import LAYOUT, validate
from .layout import Cell, LayoutPlan, raw_names


@dataclass(frozen=True)
class Resolved:
    plan: LayoutPlan
    region: DataFrame
    merges: DataFrame  # 1-based rows, of the region's sheet
    ledger: DataFrame
    header_rows: tuple[int, ...]
    last_row: int
    sheet_name: str


def unrolled(proposal: dict, candidates: list[dict]) -> dict | None:
    """The proposal with its question column unrolled, if exactly that column holds whole dialogues."""
    question = proposal["roles"]["input_query"]
    own = [c for c in candidates if c["column_id"] == question["column"]]
    if len(own) != 1 or len(candidates) != 1:
        return None
    cell = {"column": question, "container": own[0]["container"], "question_marker": own[0]["question_marker"], "answer_marker": own[0]["answer_marker"]}
    return proposal | {"roles": proposal["roles"] | {"output_answer": None}, "grouping": {"kind": "blob_row", "column": None}, "dialogue_blob": cell}


def addresses(proposal: dict) -> list[tuple[str, dict]]:
    """All named columns, as (path, address)."""
    roles, out = proposal["roles"], []
    for name in ("input_query", "output_answer", "query_id", "session_id", "scenario", "assessor_id"):
        value = roles.get(name)
        if isinstance(value, dict) and "coalesce" in value:
            out += [(f"roles.{name}.coalesce[{i}]", a) for i, a in enumerate(value["coalesce"])]
        elif isinstance(value, dict):
            out.append((f"roles.{name}", value))
    out += [(f"roles.reference_answers[{i}]", a) for i, a in enumerate(roles["reference_answers"])]
    for path, value in (("grouping.column", proposal["grouping"]["column"]), ("dialogue_blob.column", (proposal["dialogue_blob"] or {}).get("column")), ("weight", proposal["weight"])):
        if value:
            out.append((path, value))
    return out


def kept_rows(sheet: Workbook) -> DataFrame:
    """A sheet's rows with text, kept for further looks: row, filled (columns with text), sums (those of them that sum rows up)."""
    def work():
        none = F.lit(None).cast("int")
        texts = sheet.cells.filter(S.collapse(F.col("s")) != "").select("row", F.col("col").alias("filled"), none.alias("sums"))
        tall = sheet.formulas.filter(is_vertical_aggregate(F.col("formula"))).select("row", none, "col")
        rows = texts.union(tall).groupBy("row").agg(F.collect_set("filled").alias("filled"), F.collect_set("sums").alias("sums"))
        return rows.filter(F.size("filled") > 0).withColumn("sums", F.array_intersect("filled", "sums")).persist()

    return sheet.once("rows", work)


def resolve_layout(proposal: dict, book: Workbook, basket_id: str) -> Resolved:
    validate(proposal, LAYOUT, LayoutError)
    grouping = dict(proposal["grouping"])
    if grouping["kind"] != "column":
        grouping["column"] = None
    proposal = proposal | {"grouping": grouping}
    if proposal["basket_id"] != basket_id:
        raise LayoutError("The layout is for another basket", expected=basket_id)
    name = proposal["sheet_name"]
    if name not in book.sheets:
        raise LayoutError("Unknown sheet", sheet=name, available=list(book.sheets))
    if set(proposal["ignored_sheets"]) != set(book.sheets) - {name}:
        raise LayoutError("Every other sheet has to be ignored explicitly", expected=sorted(set(book.sheets) - {name}))
    header = proposal["header_rows"]
    if header != list(range(header[0], header[0] + len(header))):
        raise LayoutError("Header rows must follow each other", header_rows=header)
    sheet = book.sheet(name)
    height, width = sheet.bounds()
    if header[-1] >= height:
        raise LayoutError("There are no rows below the header", header_rows=header)
    named = addresses(proposal)
    index = {}
    for path, a in named:
        index[path] = S.column_index(a["column"])
        if index[path] >= width:
            raise LayoutError("A column lies outside the sheet", column=a["column"], role_path=path)

    first, mapped = header[-1], sorted(set(index.values()))
    query = index["roles.input_query"]
    rows = kept_rows(sheet)
    _prove_header(header, named, index, sheet)
    last = sheet.once(("last row", query, first), lambda: _last_row(sheet, query, first, height))
    # vertical merges of the data: whether there are any, and whether one ties questions
    tied = sheet.merges.filter((F.col("row2") > F.col("row")) & (F.col("row2") >= first) & (F.col("row") <= last))
    vertical, questions = sheet.once(("tied", query, first, last), lambda: tied.agg(F.count("*"), F.count_if(F.lit(query).between(F.col("col"), F.col("col2")))).first())
    if questions or (grouping["kind"] == "none" and vertical):
        grouping.update(kind="merged_rows", column=None)

    within = F.array(*(F.lit(c) for c in mapped)).cast("array<int>")
    ours = F.array_intersect("filled", within)
    per_row = rows.select(
        "row", F.size("filled").cast("long").alias("nonempty"), F.size(ours).alias("mapped"), F.size(F.array_except(ours, "sums")).alias("unsafe"), F.size("sums").alias("sums"),
        (F.array_contains("filled", query) & ~F.array_contains("sums", query)).cast("int").alias("asked"))
    # a summary row below the data sums something up and asks nothing
    summary = (F.col("sums") > 0) & (F.col("asked") == 0)
    role = (F.when(F.col("row").isin([h - 1 for h in header]), "header").when(F.col("row").between(first, last), "data")
            .when(F.col("row") < header[0] - 1, "preamble").when(summary, "derived_summary").otherwise("metadata"))
    ledger = per_row.withColumn("role", role)
    cut, left = sheet.once(("outside", tuple(header), tuple(mapped), query, last), lambda: ledger.agg(
        F.min(F.when((F.col("role") == "preamble") & (F.col("mapped") >= 2), F.col("row"))),
        F.min(F.when((F.col("row") > last) & (F.col("role") == "metadata") & (F.col("unsafe") > 0), F.col("row")))).first())
    if cut is not None:
        raise LayoutError("A row above the header looks like data", row=cut + 1)
    if left is not None:
        raise LayoutError("Mapped columns hold data below the last row", row=left + 1)

    parts = sheet.once(("header parts", *header), lambda: header_parts(sheet, [h - 1 for h in header]))
    names = header_names(parts, width)
    for path, a in named:
        _prove_name(path, a, parts.get(index[path], []), names[index[path]])
    region = build_region(sheet, header, last + 1, names)
    column = lambda path: names[index[path]] if path in index else None
    answers = tuple(names[index[p]] for p, _ in named if p.startswith("roles.output_answer"))
    references = tuple(names[index[p]] for p, _ in named if p.startswith("roles.reference_answers"))
    roles = {r: column(f"roles.{r}") for r in ("input_query", "query_id", "session_id", "scenario", "assessor_id")}
    group = column("grouping.column") if grouping["kind"] == "column" else None
    kind, group = _prove_roles(roles, answers, references, grouping["kind"], group, column("dialogue_blob.column"), proposal)
    if kind == "merged_rows" and not vertical:
        raise LayoutError("No vertical merge supports grouping by merged rows")
    weight = column("weight")
    if weight:
        _prove_weight(sheet, index["weight"], first, last)
    blob = proposal["dialogue_blob"]
    formulas = sheet.formulas.filter(F.col("row").between(first, last)).groupBy("col").agg(F.array_sort(F.collect_list(F.col("row") + 1)).alias("rows")).collect()
    kept = raw_names(names)
    plan = LayoutPlan(
        input_query=roles["input_query"], output_answer=answers, query_id=roles["query_id"], session_id=roles["session_id"],
        scenario=roles["scenario"], assessor_id=roles["assessor_id"], reference_answers=references, grouping=kind, group_column=group,
        cell=Cell(column("dialogue_blob.column"), blob["container"], blob["question_marker"], blob["answer_marker"]) if blob else None,
        weight=weight, column_ids={S.column_letters(i): n for i, n in enumerate(names)},
        formula_rows={S.column_letters(r["col"]): tuple(r["rows"]) for r in formulas}, accounting={"raw_names": kept},
    )
    shifted = sheet.merges.select((F.col("row") + 1).alias("r1"), F.col("col").alias("c1"), (F.col("row2") + 1).alias("r2"), F.col("col2").alias("c2"))
    return Resolved(plan, region, shifted, ledger.select((F.col("row") + 1).alias("row"), "role", F.col("nonempty").alias("nonempty_cells")), tuple(header), last + 1, name)


def _prove_header(header, named, index, sheet: Workbook) -> None:
    """A further header row needs a horizontal merge above each mapped value."""
    if len(header) == 1:
        return

    def work():
        seen = sheet.cells.filter(F.col("row").isin([h - 1 for h in header[1:]]) & (S.collapse(F.col("s")) != ""))
        wide = sheet.merges.filter((F.col("col2") > F.col("col")) & (F.col("row") < header[-1]) & (F.col("row2") >= header[0] - 1))
        return {(r["row"], r["col"]): r["s"] for r in seen.select("row", "col", "s").collect()}, [tuple(r) for r in wide.select("row", "col", "row2", "col2").collect()]

    cells, merges = sheet.once(("header", *header), work)  # of the header's rows
    for h in header[1:]:
        above = [x - 1 for x in header if x < h]
        for path, a in named:
            value = cells.get((h - 1, index[path]))
            if value is None:
                continue
            over = [m for m in merges if m[1] <= index[path] <= m[3]]
            if not any(m[0] <= row <= m[2] for m in over for row in above):
                raise LayoutError("A further header row holds a value without a merged cell above; it looks like data", row=h, column=a["column"], role_path=path, value=value[:120])


def _last_row(sheet: Workbook, query: int, first: int, height: int) -> int:
    """The last row that asks something, merged cells to their end."""
    rows = kept_rows(sheet)
    asked = rows.filter((F.col("row") >= first) & F.array_contains("filled", query) & ~F.array_contains("sums", query)).agg(F.max("row").alias("end"))
    over = sheet.merges.filter((F.col("row") >= first) & F.lit(query).between(F.col("col"), F.col("col2")))
    tops = over.join(rows, "row").filter(F.array_contains("filled", F.col("col"))).agg(F.max("row2").alias("end"))
    end = asked.union(tops).agg(F.max("end")).first()[0]
    if end is None:
        raise LayoutError("The question column holds no rows")
    return min(end, height - 1)


def _prove_name(path: str, address: dict, parts: list[str], name: str) -> None:
    """A proposed header repeats one visible part or the whole name; none only where nothing is visible."""
    said = address["header"]
    if said is None or not said.strip():
        if parts:
            raise LayoutError("The column has a header", role_path=path, column=address["column"], header=" ".join(parts))
        return
    if S.key_of(said) not in {S.key_of(p) for p in [*parts, " ".join(parts), name]}:
        raise LayoutError("The header isn't that of the column", role_path=path, column=address["column"], said=said, header=" ".join(parts))


def _prove_roles(roles, answers, references, kind, group, blob_column, proposal) -> tuple[str, str | None]:
    if kind == "blob_row":
        if blob_column is None or roles["input_query"] != blob_column:
            raise LayoutError("Unrolling takes question and dialogue from the same column", input_query=roles["input_query"], dialogue_blob=blob_column)
        if answers:
            raise LayoutError("Unrolling takes answers from the cell; the role must be null")
    elif proposal["dialogue_blob"] is not None:
        raise LayoutError("A dialogue cell needs grouping by it", actual=kind)
    claimed: dict[str, str] = {}
    claims = [(roles[r], r) for r in ("input_query", "query_id", "session_id", "scenario", "assessor_id")]
    claims += [(a, "output_answer") for a in answers] + [(a, "reference_answer") for a in references]
    for column, role in claims:
        if column is None:
            continue
        if column in claimed:
            raise LayoutError("A column has two roles", column=column, roles=[claimed[column], role])
        claimed[column] = role
    if kind == "column":
        if roles["session_id"] and roles["session_id"] != group:
            raise LayoutError("The session role and the grouping column differ")
        if group is None:
            raise LayoutError("Grouping by a column needs one")
        if claimed.get(group, "session_id") not in ("query_id", "session_id"):
            return "none", None
    return kind, group


def _prove_weight(sheet: Workbook, column: int, first: int, last: int) -> None:
    inside = F.col("row").between(first, last) & (F.col("col") == column)
    value = S.parse_number(F.col("s"))
    bad = (F.col("kind") == "b") | S.bad_number(F.col("s")) | (value < 1) | (value != F.floor(value))
    rows = sheet.cells.filter(inside & ~S.blank(F.col("s")) & F.coalesce(bad, F.lit(True))).select("row").union(sheet.formulas.filter(inside).select("row")).distinct()
    r = first_rows(rows.select((F.col("row") + 1).alias(ROW)), F.lit(True))
    if r["n"]:
        raise LayoutError("Weights must be stored whole numbers from one on", invalid_count=r["n"], rows=r["rows"])
