"""The two plan contracts and their closed validation.

A contract is a small grammar of nested values; anything that it doesn't name is
refused.  Plans are never data: they compile to Column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from gaugeworks.errors import GaugeError

METHODS = ("identity", "accuracy", "mean_criteria", "all_criteria", "majority", "all_assessors")
POLICIES = ("fail", "exclude_unit", "exclude_value", "zero")
SCORE_ROLES = ("final_score", "criterion", "assessor_vote", "prediction", "target")
REDUCERS = ("mean", "frequency_weighted_mean")
SCALES = ("ratio", "percent", "raw")
MODES = ("qa", "turn_with_history", "dialogue")
GROUPINGS = ("none", "merged_rows", "column", "blob_row")
DOCUMENT_ROLES = ("instruction", "development_report", "validation_report")
EVIDENCE = ("metric", "score", "assessment_mode", "missing_policy", "denominator", "reducer", "release", "reported_value")

Check = Callable[[object, str], None]


class Mismatch(ValueError):
    def __init__(self, path: str, what: str):
        super().__init__(f"{path or '$'}: {what}")
        self.path = path


def text(pattern: str = ".+") -> Check:
    def check(x, at):
        if not isinstance(x, str) or not re.search(pattern, x, re.S):
            raise Mismatch(at, f"text like {pattern} expected")
    return check


def one_of(*values) -> Check:
    def check(x, at):
        if not any(x is v or (type(x) is type(v) and x == v) for v in values):
            raise Mismatch(at, f"one of {values} expected")
    return check


def integer(low: int, high: float = float("inf")) -> Check:
    def check(x, at):
        if isinstance(x, bool) or not isinstance(x, int) or not low <= x <= high:
            raise Mismatch(at, f"a whole number from {low} on expected")
    return check


def listed(item: Check, least: int = 0, unique: bool = False) -> Check:
    def check(x, at):
        if not isinstance(x, list) or len(x) < least:
            raise Mismatch(at, f"a list of at least {least} expected")
        for i, v in enumerate(x):
            item(v, f"{at}[{i}]")
        if unique and len({repr(v) for v in x}) < len(x):
            raise Mismatch(at, "entries repeat")
    return check


def record(required: dict[str, Check], optional: dict[str, Check] | None = None) -> Check:
    allowed = required | (optional or {})

    def check(x, at):
        if not isinstance(x, dict):
            raise Mismatch(at, "an object expected")
        for k in required:
            if k not in x:
                raise Mismatch(f"{at}.{k}", "missing")
        for k, v in x.items():
            if k not in allowed:
                raise Mismatch(f"{at}.{k}", "not a known key")
            allowed[k](v, f"{at}.{k}")
    return check


def mapping(value: Check, least: int = 0) -> Check:
    def check(x, at):
        if not isinstance(x, dict) or len(x) < least:
            raise Mismatch(at, f"an object of at least {least} expected")
        for k, v in x.items():
            value(v, f"{at}.{k}")
    return check


def either(*checks: Check) -> Check:
    def check(x, at):
        tried = []
        for c in checks:
            try:
                return c(x, at)
            except Mismatch as e:
                tried.append(str(e))
        raise Mismatch(at, " / ".join(tried))
    return check


def number(x, at) -> None:
    if isinstance(x, bool) or not isinstance(x, (int, float, Decimal)):
        raise Mismatch(at, "a number expected")


NULL = one_of(None)
ADDRESS = record({"column": text(r"^[A-Z]{1,3}$"), "header": either(text(""), NULL)})
_MAYBE = either(ADDRESS, NULL)
_DECIMAL = text(r"^-?[0-9]+(?:[.,][0-9]+)?$")
_SPAN_ID = text(r"^doc-[1-3]:p[0-9]{4}$")

LAYOUT = record(
    {
        "basket_id": text(), "sheet_name": text(), "ignored_sheets": listed(text(""), unique=True),
        "header_rows": listed(integer(1), 1, True),
        "roles": record(
            {
                "input_query": ADDRESS,
                "output_answer": either(ADDRESS, record({"coalesce": listed(ADDRESS, 2)}), NULL),
                "query_id": either(ADDRESS, one_of("synthesize")),
                "scenario": _MAYBE, "assessor_id": _MAYBE, "reference_answers": listed(ADDRESS),
            },
            {"session_id": _MAYBE},
        ),
        "grouping": record({"kind": one_of(*GROUPINGS), "column": _MAYBE}),
        "dialogue_blob": either(NULL, record({"column": ADDRESS, "container": one_of("python_list", "plain_text"), "question_marker": text(), "answer_marker": text()})),
        "weight": _MAYBE,
    },
    {"layout_version": text(r"(^|-)layout\.v1$"), "first_data_row": integer(1), "last_data_row": integer(1), "evidence": mapping(text())},
)

MEASUREMENT = record(
    {
        "basket_id": text(), "metric_name": text(),
        "document_roles": record({r: text(r"^doc-[1-3]$") for r in DOCUMENT_ROLES}),
        "assessment_mode": one_of(*MODES),
        "score": record({
            "method": one_of(*METHODS),
            "sources": listed(record({
                "column_id": text(r"^[A-Z]{1,3}$"), "role": one_of(*SCORE_ROLES),
                "normalization": either(one_of("numeric", "label"), mapping(number, 1)), "polarity": one_of("direct", "inverted"),
            }), 1),
            "missing_policy": one_of(*POLICIES), "majority_denominator": one_of("declared", "present", None),
        }),
        "reducer": record({"method": one_of(*REDUCERS)}),
        "release": record({"threshold": either(_DECIMAL, NULL), "comparator": one_of(">=", "<=", None), "scale": one_of(*SCALES), "precision": integer(0, 12)}),
        "reported_value_state": one_of("absent", "unambiguous", "ambiguous"),
        "reported_value": either(NULL, record({"value": _DECIMAL, "raw": text(), "span_id": _SPAN_ID})),
        "evidence": record({f: listed(_SPAN_ID, unique=True) for f in EVIDENCE}),
    },
    {"plan_version": text(r"(^|-)measurement-plan\.v2$")},
)


def validate(proposal: object, contract: Check, error: type[GaugeError]) -> None:
    try:
        contract(proposal, "")
    except Mismatch as e:
        raise error(f"The proposal breaks its contract at {e}", path=e.path) from None


@dataclass(frozen=True)
class Source:
    """One column that a score is made of."""

    column: str
    role: str = "final_score"
    normalization: str = "numeric"  # numeric, label or value_map
    value_map: tuple[tuple[str, Decimal], ...] = ()
    inverted: bool = False
    column_id: str | None = None


@dataclass(frozen=True)
class MetricPlan:
    """How a table becomes one figure."""

    name: str
    method: str
    sources: tuple[Source, ...]
    missing_policy: str = "fail"
    majority_denominator: str = "declared"
    weight: str | None = None  # a column makes it a frequency-weighted mean
    unit: str = "turn"  # or dialogue
    group: str = "reference_group_id"
    order: str = "turn_index"
    scale: str = "ratio"
    precision: int = 4
    threshold: Decimal | None = None
    comparator: str | None = None
    reported_value: Decimal | None = None
    reported_raw: str | None = None
    reported_span_id: str | None = None
    assessment_mode: str = "qa"
    basket_id: str = ""
    document_roles: dict[str, str] = field(default_factory=dict)
    evidence: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def reducer(self) -> str:
        return REDUCERS[self.weight is not None]

    def to_dict(self) -> dict[str, object]:
        plain = lambda x: str(x) if isinstance(x, Decimal) else [plain(v) for v in x] if isinstance(x, (tuple, list)) else {k: plain(v) for k, v in x.items()} if isinstance(x, dict) else x
        out = {k: plain(v) for k, v in self.__dict__.items() if k != "sources"}
        out["sources"] = [{k: plain(v) for k, v in s.__dict__.items()} for s in self.sources]
        return out | {"reducer": self.reducer}
