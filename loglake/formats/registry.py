"""Formats by name: ``fn(lines, **options) -> parsed`` with a ``reject_reason`` column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from loglake.formats.access_log import access_log_events
from loglake.formats.arango import arango_requests
from loglake.formats.audit_log import mysql_audit_events
from loglake.formats.free_text import regex_events
from loglake.formats.json_lines import json_events
from loglake.formats.keyval import keyval_events
from loglake.formats.mongo import mongo_events
from loglake.formats.postgres import postgres_slow_events
from loglake.formats.slow_log import mysql_slow_events
from loglake.schemas import ACCESS_LOG, MYSQL_AUDIT, MYSQL_SLOW, TableSpec

Format = Callable[..., DataFrame]

_formats: dict[str, Format] = {
    "json": json_events,
    "keyval": keyval_events,
    "regex": regex_events,
    "access_log": access_log_events,
    "mysql_slow": mysql_slow_events,
    "mysql_audit": mysql_audit_events,
    "postgres": postgres_slow_events,
    "mongo": mongo_events,
    "arango": arango_requests,
}

# Formats whose events fit a declared table.
TABLE_OF: dict[str, TableSpec] = {
    "access_log": ACCESS_LOG,
    "mysql_slow": MYSQL_SLOW,
    "mysql_audit": MYSQL_AUDIT,
}

# Which common options a format takes.
TAKES_TZ = {"json", "keyval", "regex", "access_log", "mysql_audit", "mongo", "arango"}
TAKES_INGEST_TIME = {"json", "keyval", "regex", "access_log", "mysql_slow", "postgres"}


def register_format(name: str, fn: Format, replace: bool = False) -> None:
    if name in _formats and not replace:
        raise ValueError(f"format {name!r} is taken")
    _formats[name] = fn


def get_format(name: str) -> Format:
    if name not in _formats:
        raise KeyError(f"unknown format {name!r}; known: {', '.join(sorted(_formats))}")
    return _formats[name]


def format_names() -> list[str]:
    return sorted(_formats)
