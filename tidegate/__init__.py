"""Typed, batched and replay-safe ingest of batch and streaming DataFrames on Spark."""

from .api import create_table, epoch_writer, forget, insert, read_log, read_table
from .errors import IngestError, InsertFailed, OptionError, SchemaMismatch, UnsupportedType
from .operators.keys import audit_keys
from .operators.sink import InsertResult
from .storage import clear_scratch

__all__ = [
    "IngestError", "InsertFailed", "InsertResult", "OptionError", "SchemaMismatch",
    "UnsupportedType", "audit_keys", "clear_scratch", "create_table", "epoch_writer", "forget", "insert", "read_log",
    "read_table",
]
