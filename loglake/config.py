"""Options of one ingest job, checked before anything runs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from loglake.functions.regexes import line_pattern
from loglake.functions.urls import path_pattern


class ConfigError(ValueError):
    """An option is missing or does not fit the others."""


@dataclass
class IngestConfig:
    """What to read, how to read it, how to reshape it, where to put it."""

    format: str
    paths: list[str]
    dataset: str
    format_options: dict[str, Any] = field(default_factory=dict)
    log_prefix: str | None = None
    timezone: str = "UTC"
    sample_rate: int = 1
    sample_seed: int | None = None
    drop_fields: list[str] = field(default_factory=list)
    scrub_fields: list[str] = field(default_factory=list)
    add_fields: Mapping[str, str] = field(default_factory=dict)
    promote_fields: Mapping[str, str] = field(default_factory=dict)
    promote_share: float | None = None
    request_shape: list[str] = field(default_factory=list)
    shape_prefix: str = ""
    request_patterns: list[str] = field(default_factory=list)
    query_mode: str = "whitelist"
    query_keys: list[str] = field(default_factory=list)
    dynamic_keys: list[str] = field(default_factory=list)
    dynamic_window_seconds: int = 30
    dynamic_min_per_second: int = 1
    host_status: str | None = None
    host_field: str = "host"
    host_pattern: str | None = None
    host_status_host: str = "host"
    host_status_time: str = "at"
    read_from: str = "last"
    stop: bool = False
    backfill: bool = False
    flush_seconds: float = 10.0
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    rotated: str | None = None
    status_seconds: int = 60
    status_delay_seconds: int = 60
    checkpoint: str | None = None

    def __post_init__(self) -> None:
        if self.backfill:
            self.read_from, self.stop = "beginning", True
        if self.format == "access_log" and "request" not in self.request_shape:
            self.request_shape = [*self.request_shape, "request"]
        self._check()

    @property
    def dynamic(self) -> bool:
        return bool(self.dynamic_keys)

    @property
    def multi_line(self) -> bool:
        return self.format in ("mysql_slow", "postgres")

    @property
    def line_rate(self) -> int:
        """Rate for sampling lines on the scan; whole statements are sampled after grouping."""
        return 1 if self.dynamic or self.multi_line else self.sample_rate

    @property
    def entry_rate(self) -> int:
        return self.sample_rate if self.multi_line and not self.dynamic else 1

    def _check(self) -> None:
        def need(ok: bool, text: str) -> None:
            if not ok:
                raise ConfigError(text)

        need(bool(self.format), "a format is required")
        need(bool(self.paths), "at least one input path is required")
        need(bool(self.dataset), "a dataset is required")
        need(self.sample_rate >= 1, "the sample rate is an integer of at least 1")
        need(self.read_from in ("beginning", "end", "last"), "read_from is beginning, end or last")
        need(not (self.read_from == "end" and self.stop), "reading from the end and stopping there reads nothing")
        need(self.query_mode in ("whitelist", "all"), "query_mode is whitelist or all")
        need(not self.dynamic or self.sample_rate >= 2, "dynamic sampling needs a sample rate of at least 2")
        need(self.promote_share is None or 0 < self.promote_share <= 1, "the share of rows that promotes a field is above 0 and at most 1")
        need(not (self.promote_share and self.promote_fields), "fields are promoted by name or by share, not both")
        need(all("=" not in k for k in self.add_fields), "a field name holds no '='")
        try:
            ZoneInfo(self.timezone)
        except (ZoneInfoNotFoundError, ValueError) as err:
            raise ConfigError(f"unknown time zone {self.timezone!r}") from err
        if self.log_prefix:
            if not self.log_prefix.startswith("^"):
                self.log_prefix = "^" + self.log_prefix
            line_pattern(self.log_prefix)
        for pattern in self.request_patterns:
            path_pattern(pattern)
        need(not (self.max_files_per_trigger and self.max_bytes_per_trigger), "a batch is bounded by files or by bytes, not by both")
        if self.host_pattern:
            line_pattern(self.host_pattern)

    @staticmethod
    def parse_add_fields(pairs: list[str]) -> dict[str, str]:
        """``key=value`` texts as a mapping."""
        out = {}
        for pair in pairs:
            key, eq, value = pair.partition("=")
            if not eq:
                raise ConfigError(f"not a key=value pair: {pair!r}")
            out[key] = value
        return out
