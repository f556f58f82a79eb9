"""The proposal loop: a source proposes, the engine proves, failures go back as feedback."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Protocol, TypeVar

from gaugeworks.errors import GaugeError, NotEvaluable, ProposalError, StructuredOutputError

Proved = TypeVar("Proved")
TURNS = 5
PAYLOAD_CHARS = 300_000


class ProposalSource(Protocol):
    """Whatever proposes: a model, a person, a script."""

    def propose(self, task: str, evidence: dict, feedback: list[dict]) -> str: ...


class Scripted:
    """Proposals given beforehand, in order."""

    def __init__(self, *replies: object):
        self.replies, self.feedback = list(replies), []

    def propose(self, task: str, evidence: dict, feedback: list[dict]) -> str:
        self.feedback.append((task, list(feedback)))
        if not self.replies:
            raise ProposalError("The script has ended", task=task)
        reply = self.replies.pop(0)
        return reply if isinstance(reply, str) else json.dumps(reply, ensure_ascii=False)


def extract_json(content: str) -> dict:
    """The first object that a fenced block holds, else the first one in the text."""
    starts = [m.end() for m in re.finditer(r"```[^\S\n]*\w*\s*(?=\{)", content)]
    decoder, reason = json.JSONDecoder(), "no brace"
    for at in [*starts, *(m.start() for m in re.finditer(r"\{", content))]:
        try:
            return decoder.raw_decode(content, at)[0]
        except ValueError as e:
            reason = str(e)
    raise StructuredOutputError("The reply holds no JSON object", reason=reason)


def bounded(payload: object, limit: int = PAYLOAD_CHARS) -> str:
    """A payload as text; what is too long is refused, not cut."""
    text = json.dumps(payload, ensure_ascii=False, default=str)
    if len(text) > limit:
        raise NotEvaluable("The evidence is too long", chars=len(text), limit=limit)
    return text


def prove(source: ProposalSource, task: str, evidence: dict, check: Callable[[dict], Proved], turns: int = TURNS) -> Proved:
    """Ask until a proposal is proved; the last failure is raised."""
    bounded(evidence)
    feedback: list[dict] = []
    for turn in range(turns):
        try:
            return check(extract_json(source.propose(task, evidence, feedback)))
        except ProposalError:
            raise
        except GaugeError as e:
            if turn == turns - 1:
                raise
            feedback.append(e.to_dict())
        except (ArithmeticError, AttributeError, LookupError, TypeError, ValueError) as e:  # a proposal of an unforeseen shape
            if turn == turns - 1:
                raise StructuredOutputError("The proposal can't be read", kind=type(e).__name__, reason=str(e)) from e
            feedback.append({"reason_code": StructuredOutputError.reason_code, "message": "The proposal can't be read", "details": {"kind": type(e).__name__, "reason": str(e)}})
    raise StructuredOutputError("No turns are left")


def first_sheet_that_proves(sheets: tuple[str, ...], attempt: Callable[[tuple[str, ...]], tuple[str, Proved]], pinned: str | None = None) -> Proved:
    """Try again without each sheet whose plan fails; a pinned sheet, or the last one, settles it."""
    rejected: tuple[str, ...] = ()
    while True:
        try:
            return attempt(rejected)[1]
        except NotEvaluable as e:
            sheet = e.details.get("sheet")
            if pinned or sheet is None or sheet in rejected or len(rejected) + 1 >= len(sheets):
                raise
            rejected = (*rejected, sheet)
