"""Errors a job stops with."""


class MissingColumnsError(ValueError):
    """A source lacks columns its contract asks for."""


class MissingTableError(RuntimeError):
    """A job needs a table that no earlier job has written."""


class DuplicateKeyError(RuntimeError):
    """Several source rows of an upsert claim the same target row."""


class CalibrationError(RuntimeError):
    """There is no history to calibrate thresholds from."""


class NoActiveThresholdsError(RuntimeError):
    """Scoring was asked for before any thresholds were published."""


class WatermarkError(RuntimeError):
    """A batch has rows but no ingest time to move the watermark to."""


class QualityGateError(RuntimeError):
    """A scored batch failed blocking checks and was not written."""

    def __init__(self, failures: list[str]):
        self.failures = failures
        super().__init__("quality gate failed: " + "; ".join(failures))
