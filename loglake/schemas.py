"""Declared tables. Unsigned source types take the next wider signed type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TIME = [("_time", "timestamp"), ("_date", "date"), ("_ms", "int")]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]
    sort_by: tuple[str, ...]

    @property
    def fields(self) -> list[str]:
        return [n for n, _ in self.columns]

    @property
    def payload(self) -> list[tuple[str, str]]:
        """Columns that come from the log text."""
        return [c for c in self.columns if not c[0].startswith("_")]

    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))


def _columns(text: str) -> tuple[tuple[str, str], ...]:
    typed = [tuple(part.split()) for part in text.replace("\n", ", ").split(", ") if part.strip()]
    return tuple(_TIME + typed)


# The columns of the three declared tables, which loaded data must fit.
MYSQL_SLOW = TableSpec(
    "mysql_slow",
    _columns(
        """client string, query string, normalized_query string, query_time double
        user string, statement string, tables string, schema string
        rows_examined bigint, rows_sent bigint, lock_time double, connection_id bigint
        error_num bigint, killed int
        rows_affected bigint, database string, comments string
        bytes_sent bigint, tmp_tables bigint, tmp_disk_tables bigint, tmp_table_sizes bigint
        transaction_id string, query_cache_hit boolean, full_scan boolean, full_join boolean
        tmp_table boolean, tmp_table_on_disk boolean, filesort boolean, filesort_on_disk boolean
        merge_passes bigint, IO_r_ops bigint, IO_r_bytes bigint, IO_r_wait_sec double
        rec_lock_wait_sec double, queue_wait_sec double, pages_distinct bigint
        sl_rate_type string, sl_rate_limit int
        hosted_on string, read_only boolean, replica_lag decimal(20,0), role string"""
    ),
    ("_time", "query"),
)

MYSQL_AUDIT = TableSpec(
    "mysql_audit",
    _columns(
        """command_class string, connection_id bigint, db string, host string, ip string
        name string, os_user string, os_login string, os_version string, mysql_version string
        priv_user string, proxy_user string, record string, sqltext string, status bigint
        user string, startup_options string"""
    ),
    ("_time", "host", "user"),
)

ACCESS_LOG = TableSpec(
    "access_log",
    _columns(
        """body_bytes_sent bigint, http_user_agent string, http_referer string, http_host string
        remote_addr string, request string, request_method string, request_path string
        request_pathshape string, request_protocol_version string, request_shape string
        request_uri string, request_query string, request_queryshape string
        remote_user string, status bigint
        strExtra1 string, strExtra2 string, strExtra3 string
        intExtra1 bigint, intExtra2 bigint, intExtra3 bigint
        decExtra1 double, decExtra2 double, decExtra3 double"""
    ),
    ("_time", "request_method", "status"),
)

TABLES = {t.name: t for t in (MYSQL_SLOW, MYSQL_AUDIT, ACCESS_LOG)}
