"""Exceptions raised by the ingest engine."""


class IngestError(Exception):
    """Any refusal or failure of an insert."""


class OptionError(IngestError, ValueError):
    """An option is missing, unknown or out of range."""


class UnsupportedType(IngestError, TypeError):
    """A column type that no table column can hold."""


class SchemaMismatch(IngestError):
    """Stream and table do not agree."""


class InsertFailed(IngestError):
    """Batches were rejected and the failure policy is ``fail``."""

    def __init__(self, message: str, batches_failed: int = 0, rows_failed: int = 0):
        super().__init__(message)
        self.batches_failed = batches_failed
        self.rows_failed = rows_failed


class DrainLimitExceeded(IngestError):
    """An epoch was not stored within the drain limit; it was cancelled and can run again."""
