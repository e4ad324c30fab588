"""Options of an insert: defaults, then arguments, then a named configuration."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, fields, replace

from .errors import OptionError
from .functions.types import split_keys

CONFIG_PREFIX = "tidegate.config."
# The options a named configuration may set.
CONFIGURABLE = ("database", "table", "path", "batch_size")


@dataclass(frozen=True)
class InsertOptions:
    table: str | None = None
    database: str | None = None
    path: str | None = None
    schema: object = None
    partitioning_key: object = None
    primary_key: object = None
    shards: int | None = None
    batch_size: int | None = None
    channels: object = 1
    order_by: object = None
    reject_when: object = None
    on_failure: str = "report"
    optional_mode: str = "null"
    timestamp_precision: str = "us"
    match: str = "position"
    dedupe_on_key: bool = False
    dry_run: bool = False
    results: bool = True
    track_batches: bool = False
    evaluate_once: bool | None = None
    commit: str = "epoch"
    drain_limit: float | None = None
    epoch: int | None = None
    writer: str | None = None
    checkpoint: str | None = None
    trigger: object = None
    config: object = None

    @property
    def order_columns(self) -> list[str]:
        return split_keys(self.order_by)


def resolve(spark, **arguments) -> InsertOptions:
    """Layer the options, then check every rule that needs no data."""
    known = {f.name for f in fields(InsertOptions)}
    unknown = sorted(set(arguments) - known)
    if unknown:
        raise OptionError(f"unknown options: {', '.join(unknown)}")
    options = InsertOptions(**arguments)
    if options.config is not None:
        options = replace(options, **_named_config(spark, options.config))
    return _checked(options)


def _named_config(spark, config) -> dict:
    """Values of a mapping, or of ``tidegate.config.<name>.<option>`` in the session."""
    if isinstance(config, str):
        label = config
        found = {}
        for option in CONFIGURABLE:
            value = spark.conf.get(f"{CONFIG_PREFIX}{config}.{option}", None)
            if value is not None:
                found[option] = value
    else:
        label = "given"
        found = {k: v for k, v in dict(config).items() if k in CONFIGURABLE}
    if not found:
        warnings.warn(f"configuration {label!r} sets no option", stacklevel=4)
    if "batch_size" in found:
        try:
            found["batch_size"] = int(found["batch_size"])
        except ValueError as e:
            raise OptionError(f"batch_size {found['batch_size']!r} is no number") from e
    return found


def _one_of(name: str, value, allowed: tuple) -> None:
    if value not in allowed:
        raise OptionError(f"{name} must be one of {', '.join(map(repr, allowed))}, not {value!r}")


def _checked(o: InsertOptions) -> InsertOptions:
    if not o.dry_run:
        if bool(o.table) == bool(o.path):
            raise OptionError("name a target: either table or path")
        if o.database is not None and not o.table:
            raise OptionError("database is given but no table")
    for part in (o.table, o.database):
        if part is not None and not re.fullmatch(r"\w+(\.\w+)*", part):
            raise OptionError(f"{part!r} is not a table or database name")
    if o.batch_size is not None:
        if o.batch_size < 1:
            raise OptionError(f"batch_size must be at least 1, not {o.batch_size}")
    if isinstance(o.channels, int) and o.channels < 1:
        raise OptionError(f"channels must be at least 1, not {o.channels}")
    if o.shards is not None and o.shards < 1:
        raise OptionError(f"shards must be at least 1, not {o.shards}")
    _one_of("on_failure", o.on_failure, ("report", "fail"))
    _one_of("optional_mode", o.optional_mode, ("null", "zero"))
    _one_of("timestamp_precision", o.timestamp_precision, ("us", "ms"))
    _one_of("match", o.match, ("position", "name"))
    _one_of("commit", o.commit, ("epoch", "channel"))
    if o.commit == "channel" and o.track_batches:
        raise OptionError("track_batches is for inserts that commit as a whole")
    if o.drain_limit is not None and o.drain_limit <= 0:
        raise OptionError(f"drain_limit must be positive, not {o.drain_limit}")
    if o.writer is not None and not re.fullmatch(r"[A-Za-z0-9_-]+", o.writer):
        raise OptionError(f"writer {o.writer!r} may only hold letters, digits, _ and -")
    if o.epoch is not None and o.epoch < 0:
        raise OptionError(f"epoch must not be negative, not {o.epoch}")
    return o
