"""Errors of a run, with what is needed to go on."""

from __future__ import annotations


class PlanError(Exception):
    """``stage`` and ``source`` say where; ``recoverable`` errors may be tried again."""

    recoverable = False

    def __init__(self, message: str, stage: str | None = None, source: str | None = None, **details):
        super().__init__(message)
        self.message, self.stage, self.source, self.details = message, stage, source, details

    def __str__(self) -> str:
        where = ", ".join(f"{k}={v}" for k, v in (("stage", self.stage), ("source", self.source)) if v)
        return f"{self.message} ({where})" if where else self.message

    def to_dict(self) -> dict:
        return {"type": type(self).__name__, "message": self.message, "stage": self.stage, "source": self.source, "recoverable": self.recoverable, "details": self.details}


class ManifestError(PlanError):
    pass


class PreflightError(PlanError):
    pass


class FetchError(PlanError):
    recoverable = True


class ConvertError(PlanError):
    pass


class AlignError(PlanError):
    recoverable = True


class CheckpointError(PlanError):
    pass
