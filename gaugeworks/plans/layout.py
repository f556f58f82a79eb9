"""A resolved layout: which column plays which role, and how rows form dialogues."""

from __future__ import annotations

from dataclasses import dataclass, field

CANONICAL = ("source_row_id", "query_id", "session_id", "input_query_count", "input_query", "output_answer",
             "scenario", "assessor_id", "reference_answer", "reference_group_id", "turn_index")


@dataclass(frozen=True)
class Cell:
    """How one cell holds a dialogue."""

    column: str
    container: str
    question_marker: str
    answer_marker: str


@dataclass(frozen=True)
class LayoutPlan:
    input_query: str | None
    output_answer: tuple[str, ...] = ()
    query_id: str | None = None
    session_id: str | None = None
    scenario: str | None = None
    assessor_id: str | None = None
    reference_answers: tuple[str, ...] = ()
    grouping: str = "none"
    group_column: str | None = None
    cell: Cell | None = None
    weight: str | None = None
    column_ids: dict[str, str] = field(default_factory=dict)  # letter to name
    formula_rows: dict[str, tuple[int, ...]] = field(default_factory=dict)
    accounting: dict[str, object] = field(default_factory=dict)

    def letter(self, name: str) -> str:
        return next(k for k, v in self.column_ids.items() if v == name)

    def to_dict(self) -> dict[str, object]:
        return {k: (v.__dict__ if isinstance(v, Cell) else list(v) if isinstance(v, tuple) else v) for k, v in self.__dict__.items()}


def raw_names(columns: list[str]) -> dict[str, str]:
    """Names that raw columns keep beside the canonical ones."""
    taken, out = set(CANONICAL), {}
    for c in columns:
        name = c
        while name in taken:
            name += "__raw"
        taken.add(name)
        out[c] = name
    return out
