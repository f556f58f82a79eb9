"""Failures that a caller can act on; each has a reason code and details."""

from __future__ import annotations


class GaugeError(Exception):
    reason_code = "error"

    def __init__(self, message: str, **details: object):
        super().__init__(message)
        self.message, self.details = message, details

    def to_dict(self) -> dict[str, object]:
        return {"reason_code": self.reason_code, "message": self.message, "details": self.details}


class PackageError(GaugeError):
    reason_code = "package_error"


class ReadError(GaugeError):
    reason_code = "read_error"


class ProposalError(GaugeError):
    """The proposal source itself failed."""

    reason_code = "llm_error"


class StructuredOutputError(GaugeError):
    reason_code = "structured_output_error"


class LayoutError(GaugeError):
    reason_code = "layout_error"


class PlanError(GaugeError):
    reason_code = "measurement_plan_error"


class NotEvaluable(GaugeError):
    reason_code = "not_evaluable"
