"""Queries over typing, time, event transforms, sampling and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.catalog import render as R
from loglake.catalog.base import events_table, money, query, stamp_text, table, text
from loglake.config import IngestConfig
from loglake.formats.access_log import access_log_events
from loglake.formats.audit_log import mysql_audit_events
from loglake.formats.registry import format_names, get_format, register_format
from loglake.formats.slow_log import mysql_slow_events
from loglake.functions import times, typing
from loglake.functions.sqltext import sql_fingerprint
from loglake.functions.urls import query_pairs, query_shape, request_shape
from loglake.operators import quality, rollups, sampling, transforms
from loglake.operators.hosts import enrich_host
from loglake.operators.lines import split_rejects
from loglake.plans.jobs import run_batch
from loglake.session import fresh_path
from loglake.sources.files import backfill
from loglake.sources.tables import read_events
from loglake.streaming.ingest import pace
from loglake.streaming.windows import late_events, rate_window, status_window

L = F.lit


def _int(col: Column) -> Column:
    return col.cast("int")


# ---- typing

# A text per event that is a number, a version, a dash or a word.
MIXED_SQL = """CASE event_id % 6 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
  WHEN 2 THEN '-' WHEN 3 THEN '5.1.' || event_id WHEN 4 THEN '-' || event_id ELSE event_type END"""


def _mixed() -> Column:
    kind = F.col("event_id") % 6
    return (
        F.when(kind == 0, text("event_id")).when(kind == 1, money("value").cast("string")).when(kind == 2, "-")
        .when(kind == 3, F.concat(L("5.1."), text("event_id"))).when(kind == 4, F.concat(L("-"), text("event_id")))
        .otherwise(F.col("event_type"))
    )


@query("typeify", f"""SELECT event_id,
  CASE WHEN event_id % 6 = 0 THEN event_id WHEN event_id % 6 = 4 THEN -event_id END AS l,
  CASE WHEN event_id % 6 = 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS d,
  CASE WHEN event_id % 6 IN (3, 5) THEN {MIXED_SQL} END AS s FROM events""")
def _typeify(spark: SparkSession, sf: str) -> DataFrame:
    typed = events_table(spark, sf).select("event_id", typing.typeify(_mixed()).alias("t"))
    return typed.select("event_id", "t.l", "t.d", "t.s")


@query("typeify_keyval", f"""SELECT event_id,
  CASE WHEN {MIXED_SQL} = '1' THEN 1 WHEN {MIXED_SQL} = '0' THEN 0 END AS b,
  CASE WHEN {MIXED_SQL} IN ('0', '1') THEN NULL WHEN event_id % 6 = 0 THEN event_id WHEN event_id % 6 = 4 THEN -event_id END AS l,
  CASE WHEN event_id % 6 = 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS d,
  CASE WHEN event_id % 6 IN (2, 3, 5) THEN {MIXED_SQL} END AS s FROM events""")
def _typeify_keyval(spark: SparkSession, sf: str) -> DataFrame:
    typed = events_table(spark, sf).select("event_id", typing.typeify_keyval(_mixed()).alias("t"))
    return typed.select("event_id", _int(F.col("t.b")).alias("b"), "t.l", "t.d", "t.s")


@query("column_types", """SELECT k AS "key", CASE k WHEN 'id' THEN 'bigint' WHEN 'value' THEN 'double' ELSE 'string' END AS type, count(*) AS n_values
  FROM (SELECT unnest(['id', 'value', 'type', 'mixed']) AS k FROM events) GROUP BY 1, 2""")
def _column_types(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"id": text("event_id"), "value": money("value").cast("string"), "type": F.col("event_type"), "mixed": _mixed()}
    pairs = F.create_map(*[x for k, v in fields.items() for x in (L(k), v)])
    return typing.column_types(events_table(spark, sf).select(F.explode(pairs).alias("key", "value")))


@query("type_pg_meta", """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN event_id WHEN event_id % 6 = 4 THEN -event_id END AS pid FROM events""")
def _type_pg_meta(spark: SparkSession, sf: str) -> DataFrame:
    return events_table(spark, sf).select("event_id", typing.type_pg_meta(_mixed()).alias("pid"))


# ---- time

def _five_layouts() -> Column:
    """The stamp of an event in one of the default layouts, a unix number, or broken."""
    kind = F.col("event_id") % 6
    return (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS' +0000 UTC'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss,SSSSSS'Z'"))
        .when(kind == 2, F.date_format("ts", "EEE MMM dd HH:mm:ss.SSSSSS '+0000' yyyy"))
        .when(kind == 3, F.date_format("ts", "EEE MMM d HH:mm:ss.SSSSSS 'UTC' yyyy"))
        .when(kind == 4, F.concat(F.date_format(F.expr("ts - INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), L("-07:00")))
        .otherwise(F.concat(L("at "), text("event_id")))
    )


@query("parse_time_chain", "SELECT event_id, CASE WHEN event_id % 6 <> 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS at FROM events")
def _parse_time_chain(spark: SparkSession, sf: str) -> DataFrame:
    return events_table(spark, sf).select("event_id", stamp_text(times.parse_time(_five_layouts())).alias("at"))


@query("resolve_time", """SELECT event_id,
  CASE WHEN event_id % 6 = 5 THEN '2030-01-01 00:00:00.000000' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS at,
  CASE WHEN event_id % 6 = 5 THEN 'ingest' WHEN event_id % 2 = 0 THEN 'Timestamp' ELSE 'date' END AS source, 1 AS n_left FROM events""")
def _resolve_time(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("event_id") % 2 == 0, "Timestamp").otherwise("date")
    fields = events_table(spark, sf).select("event_id", F.create_map(name, _five_layouts(), L("x"), L("1")).alias("_fields"))
    timed = times.resolve_time(fields, L("2030-01-01").cast("timestamp"))
    return timed.select("event_id", stamp_text(F.col("_time")).alias("at"), F.col("time_source").alias("source"), F.size("data").alias("n_left"))


@query("to_spark_format", "SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS at FROM events")
def _to_spark_format(spark: SparkSession, sf: str) -> DataFrame:
    kinds = (("%d/%b/%Y %H:%M", "dd/MMM/yyyy HH:mm"), ("%e %B %y, %k:%M", "d MMMM yy, H:mm"), ("%F at %I:%M %p", "yyyy-MM-dd 'at' hh:mm a"))
    pick = F.col("event_id") % len(kinds)
    parsed = [F.when(pick == i, times.to_spark_format(given).parse(F.regexp_replace(F.date_format("ts", shown), ",", ".")))
              for i, (given, shown) in enumerate(kinds)]
    return events_table(spark, sf).select("event_id", stamp_text(F.coalesce(*parsed)).alias("at"))


@query("unix_time", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f')
  WHEN 1 THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') END AS at FROM events""")
def _unix_time(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.floor(F.unix_micros("ts") / 1000).cast("bigint")
    shown = (
        F.when(F.col("event_id") % 3 == 0, text(F.unix_seconds("ts")))
        .when(F.col("event_id") % 3 == 1, F.concat(text(F.unix_seconds("ts")), L("."), F.lpad(text(millis % 1000), 3, "0")))
        .otherwise(F.concat(text(F.unix_seconds("ts")), L(".12")))
    )
    return events_table(spark, sf).select("event_id", stamp_text(times.unix_time(shown)).alias("at"))


@query("infer_year", """SELECT event_id, strftime(CASE WHEN strftime(ts, '%m-%d %H:%M:%S') < '01-15 12:00:00' THEN date_trunc('second', ts)
  ELSE date_trunc('second', ts) - INTERVAL 1 YEAR END, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events""")
def _infer_year(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.date_format("ts", "EEE MMM dd HH:mm:ss")
    layout = times.TimeFormat("MMM d H:m:s[.SSSSSSSSS]", weekday=True)
    at = times.infer_year(shown, L("2024-01-15 12:00:00").cast("timestamp"), layout)
    return events_table(spark, sf).select("event_id", stamp_text(at).alias("at"))


@query("combine_time", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
  WHEN 1 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') WHEN 2 THEN strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') END AS at FROM events""")
def _combine_time(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 4
    # The comment is an hour off: its seconds must not matter where a SET line is there.
    comment = F.when(kind.isin(0, 2), F.expr("ts + INTERVAL 1 HOUR"))
    seconds = F.when(kind.isin(0, 1), F.unix_seconds("ts"))
    return events_table(spark, sf).select("event_id", stamp_text(times.combine_time(comment, seconds)).alias("at"))


@query("with_timezone", "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events")
def _with_timezone(spark: SparkSession, sf: str) -> DataFrame:
    local = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    at = times.parse_time(local, "%Y-%m-%d %H:%M:%S", "America/Los_Angeles")
    return events_table(spark, sf).select("event_id", stamp_text(at).alias("at"))


@query("time_columns", """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS second, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  CAST(floor(epoch_us(ts) / 1000) AS BIGINT) % 1000 AS ms FROM events""")
def _time_columns(spark: SparkSession, sf: str) -> DataFrame:
    cut = events_table(spark, sf).select("event_id", *times.time_columns(F.col("ts")))
    return cut.select("event_id", F.date_format("_time", "yyyy-MM-dd HH:mm:ss").alias("second"), F.col("_date").cast("string").alias("day"), F.col("_ms").cast("bigint").alias("ms"))


# ---- transforms

@query("drop_fields", "SELECT event_id, event_type FROM events")
def _drop_fields(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.drop_fields(events_table(spark, sf), ["ts", "user_id", "value", "props", "not there"])


@query("scrub_fields", "SELECT event_id, sha256(event_type) AS event_type, sha256(CAST(user_id AS VARCHAR)) AS user_id FROM events")
def _scrub_fields(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.scrub_fields(events_table(spark, sf).select("event_id", "event_type", "user_id"), ["event_type", "user_id", "not there"])


@query("add_fields", "SELECT event_id, 'fixed' AS event_type, 'eu-1' AS zone FROM events")
def _add_fields(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.add_fields(events_table(spark, sf).select("event_id", "event_type"), {"event_type": "fixed", "zone": "eu-1"})


# The page URL as a request for even pages, as a bare URL for odd ones.
def _requests(spark: SparkSession, sf: str) -> DataFrame:
    request = F.when(F.col("page_id") % 2 == 0, F.concat(L("GET "), F.col("url"), L(" HTTP/1.1"))).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", request.alias("request"))


PATHS = ("/:lang/:id", "/:lang/:section/:id")
_LOCAL = "regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-z]+://[^/?#]*', '')"
_PATH = f"regexp_extract({_LOCAL}, '^[^?]*')"
_QUERY = f"nullif(regexp_extract({_LOCAL}, '\\?(.*)$', 1), '')"
_FITS = f"regexp_matches({_PATH}, '^/[^/]+/[^/]+/?$')"
_SHAPE = f"CASE WHEN {_FITS} THEN '/:lang/:id' WHEN regexp_matches({_PATH}, '^/[^/]+/[^/]+/[^/]+/?$') THEN '/:lang/:section/:id' ELSE {_PATH} END"
_QSHAPE = f"""(SELECT string_agg(p || '=?', '&' ORDER BY p) FROM (SELECT regexp_extract(x, '^[^=]*') AS p FROM (SELECT unnest(string_split({_QUERY}, '&')) AS x)))"""


@query("request_shape", f"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'GET' END AS method, url AS uri, {_PATH} AS path, {_QUERY} AS query,
  {_SHAPE} AS pathshape, {_QSHAPE} AS queryshape, concat_ws('?', {_SHAPE}, {_QSHAPE}) AS shape FROM pages""")
def _request_shape(spark: SparkSession, sf: str) -> DataFrame:
    shaped = request_shape(_requests(spark, sf), "request", PATHS)
    return shaped.select("page_id", *[F.col(f"request_{n}").alias(n) for n in ("method", "uri", "path", "query", "pathshape", "queryshape", "shape")])


@query("query_params", """SELECT page_id, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
  nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, CASE WHEN url LIKE '%?%' THEN length(regexp_replace(url, '[^&]', '', 'g')) + 1 ELSE 0 END AS n_params FROM pages""")
def _query_params(spark: SparkSession, sf: str) -> DataFrame:
    listed = request_shape(_requests(spark, sf), "request", PATHS, keys=["ref"])
    both = request_shape(listed.select("page_id", "request", "request_query_ref"), "request", PATHS, mode="all")
    return both.select("page_id", F.col("request_query_ref").alias("ref"), F.element_at("request_query_params", L("page")).alias("page"),
                       F.size("request_query_params").alias("n_params"))


@query("match_path", f"""SELECT page_id, {_SHAPE} AS shape, CASE WHEN {_FITS} THEN regexp_extract({_PATH}, '^/([^/]+)/', 1) END AS lang,
  CASE WHEN {_FITS} THEN regexp_extract({_PATH}, '^/[^/]+/([^/]+)/?$', 1) END AS id FROM pages""")
def _match_path(spark: SparkSession, sf: str) -> DataFrame:
    shaped = request_shape(_requests(spark, sf), "request", PATHS)
    return shaped.select("page_id", F.col("request_pathshape").alias("shape"), F.col("request_path_lang").alias("lang"), F.col("request_path_id").alias("id"))


@query("query_shape", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a=?&b=?&z=?' WHEN 1 THEN 'k=?&k=?' END AS shape FROM events""")
def _query_shape(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 3
    given = F.when(kind == 0, F.concat(L("z=1&a="), text("event_id"), L("&b"))).when(kind == 1, F.concat(L("k="), text("user_id"), L("&k=2"))).otherwise("")
    return events_table(spark, sf).select("event_id", query_shape(query_pairs(given)).alias("shape"))


def _statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of hosts: per host every 12 hours through January, the lag changing every second time."""
    hosts = events_table(spark, sf).select((F.col("user_id") % 10).alias("host")).distinct()
    step = F.explode(F.sequence(L(0), L(59))).alias("step")
    at = F.timestamp_seconds(F.unix_seconds(L("2024-01-01 06:00:00").cast("timestamp")) + F.col("step") * 43200)
    return hosts.select("host", step).select(
        "host", at.alias("at"), F.concat(L("db"), text("host")).alias("hosted_on"), (F.col("host") % 2 == 0).alias("read_only"),
        F.floor(F.col("step") / 2).alias("replica_lag"), F.when(F.col("host") == 0, "primary").otherwise("secondary").alias("role"))


@query("enrich_host", """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-01 06:00:00' THEN 'db' || (user_id % 10) END AS hosted_on,
  CASE WHEN ts >= TIMESTAMP '2024-01-01 06:00:00' THEN least(59, CAST(floor((epoch_us(ts) / 1000000 - epoch(TIMESTAMP '2024-01-01 06:00:00')) / 43200) AS BIGINT)) // 2 END AS replica_lag,
  CASE WHEN ts >= TIMESTAMP '2024-01-01 06:00:00' THEN CASE WHEN user_id % 10 = 0 THEN 'primary' ELSE 'secondary' END END AS role FROM events""")
def _enrich_host(spark: SparkSession, sf: str) -> DataFrame:
    events = events_table(spark, sf).select("event_id", F.col("ts").alias("_time"), (F.col("user_id") % 10).alias("host"))
    return enrich_host(events, _statuses(spark, sf)).select("event_id", "hosted_on", "replica_lag", "role")


@query("sql_fingerprint", """SELECT doc_id, 'select * from t where b = ? and c in (?, ?, ?) and d = `x1`' AS normalized_query, 't' AS "tables", 'select' AS statement,
  '/* ' || lang || ' */' AS comments FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, 'insert into logs values (?, ?)', 'logs', 'insert', NULL FROM documents WHERE doc_id % 2 = 1""")
def _sql_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    # Whole documents as string literals: long, with line feeds and quotes of both kinds.
    literal = F.concat(L("'"), F.regexp_replace(F.regexp_replace("text", r"\\", r"\\\\\\\\"), "'", "''"), L("'"))
    even = F.concat(L("SELECT /* "), F.col("lang"), L(" */ *\n FROM t WHERE b = "), literal, L(" AND c IN ("), text("doc_id"), L(", 2.5,\t0x1F) AND d = `x1`"))
    odd = F.concat(L("INSERT INTO logs VALUES ("), literal, L(", -- no\n"), text("n_chars"), L(")"))
    odd = F.regexp_replace(odd, r", -- no\n(\d+\))$", ", $1")
    queries = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, even).otherwise(odd).alias("query"))
    return sql_fingerprint(queries).drop("query")


# ---- sampling

_HASH = "('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8))::BIGINT"


@query("sample_lines")
def _sample_lines(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_lines(R.keyval_lines(spark, sf), 3, seed=7).select("pos", "value")


@query("sample_entries")
def _sample_entries(spark: SparkSession, sf: str) -> DataFrame:
    events = mysql_slow_events(backfill(spark, R.slow_log_path(spark, sf)), rate=2, seed=3)
    return split_rejects(events)[0].select("rows_examined", "query", "sample_rate")


def _sample_checks(all_rows: DataFrame, kept: DataFrame, keys: list[str], rate: int) -> DataFrame:
    """One row: rows read, kept rows that are none of them, and whether the weighted count is within 6 deviations."""
    n, m = all_rows.agg(F.count("*").alias("n")), kept.agg(F.count("*").alias("m"))
    strange = kept.join(all_rows.select(*keys).distinct(), keys, "left_anti").agg(F.count("*").alias("not_read"))
    spread = F.sqrt(F.col("n") * (rate - 1)) * 6
    return n.crossJoin(m).crossJoin(strange).select("n", "not_read", (F.abs(F.col("m") * rate - F.col("n")) <= spread).alias("within"))


@query("sample_lines_checks", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_read, TRUE AS within FROM events")
def _sample_lines_checks(spark: SparkSession, sf: str) -> DataFrame:
    lines = R.keyval_lines(spark, sf)
    return _sample_checks(lines, sampling.sample_lines(lines, 3, seed=7), ["pos", "value"], 3)


@query("sample_entries_checks", f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_read, TRUE AS within FROM ({R.SLOW_SQL})")
def _sample_entries_checks(spark: SparkSession, sf: str) -> DataFrame:
    lines = backfill(spark, R.slow_log_path(spark, sf))
    every, kept = (split_rejects(mysql_slow_events(lines, rate=r, seed=3))[0].select("rows_examined", "query") for r in (1, 2))
    return _sample_checks(every, kept, ["rows_examined", "query"], 2)


@query(
    "promote_fields",
    """SELECT event_id, CAST(user_id AS BIGINT) AS visitor, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id AS BIGINT) END AS page,
       CASE WHEN event_id % 3 = 0 THEN 'kind=' || event_type || ',page=p' || event_id ELSE 'kind=' || event_type END AS rest FROM events""",
)
def _promote_fields(spark: SparkSession, sf: str) -> DataFrame:
    events = events_table(spark, sf)
    page = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("p"), F.col("event_id"))).otherwise(F.col("event_id").cast("string"))
    data = F.create_map(F.lit("visitor"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type"), F.lit("page"), page)
    out = transforms.promote_fields(events.select("event_id", data.alias("data")), {"visitor": "bigint", "page": "bigint"})
    rest = F.array_join(F.array_sort(F.transform(F.map_entries("data"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return out.select("event_id", "visitor", "page", rest.alias("rest"))


@query("hash_sample", f"SELECT event_id, user_id, 4 AS sample_rate FROM events WHERE {_HASH.format('user_id')} * 4 < 4294967296")
def _hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_sample(events_table(spark, sf), ["user_id"], 4).select("event_id", "user_id", "sample_rate")


DYNAMIC_SQL = f"""
WITH e AS (SELECT event_id, event_type || '_' || (CASE WHEN user_id % 10 < 8 THEN 0 ELSE user_id END) AS k,
             CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 AS w FROM events),
c AS (SELECT w, k, count(*) AS n FROM e GROUP BY ALL),
t AS (SELECT w, sum(n) AS total, sum(CAST(ln(n + 1) AS DECIMAL(20,12))) AS weight FROM c GROUP BY w),
r AS (SELECT c.w + 21600 AS w, k, CASE WHEN total < 10 THEN 1 ELSE
        greatest(1, ceil(round(n / ((total / 4) * ln(n + 1) / CAST(weight AS DOUBLE)), 6))) END AS rate FROM c JOIN t USING (w)),
j AS (SELECT e.event_id, e.k, coalesce(r.rate, CASE WHEN EXISTS (SELECT 1 FROM t WHERE t.w + 21600 = e.w) THEN 1 ELSE 4 END) AS rate
      FROM e LEFT JOIN r ON r.w = e.w AND r.k = e.k)
SELECT event_id, k AS sample_key, CAST(rate AS BIGINT) AS sample_rate FROM j
WHERE {_HASH.format('event_id')} * rate < 4294967296"""


@query("dynamic_sample", DYNAMIC_SQL)
def _dynamic_sample(spark: SparkSession, sf: str) -> DataFrame:
    group = F.when(F.col("user_id") % 10 < 8, 0).otherwise(F.col("user_id"))
    events = events_table(spark, sf).select("event_id", "event_type", group.alias("group"), F.col("ts").alias("_time"))
    kept = sampling.dynamic_sample(events, ["event_type", "group"], 4, 21600, row_key=["event_id"], min_per_second=10 / 21600)
    return kept.select("event_id", "sample_key", F.col("sample_rate").cast("bigint").alias("sample_rate"))


@query("sample_key", "SELECT event_id, event_type || '_' || CASE WHEN user_id % 3 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END || '_' || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS sample_key FROM events")
def _sample_key(spark: SparkSession, sf: str) -> DataFrame:
    fields = [F.col("event_type"), F.when(F.col("user_id") % 3 != 0, F.col("user_id")), F.col("user_id") % 2 == 0]
    return events_table(spark, sf).select("event_id", transforms.sample_key(fields).alias("sample_key"))


@query("weighted_rollup", """SELECT event_type, count(*) AS kept, sum(user_id % 4 + 1) AS n, CAST(sum(CAST(value AS DECIMAL(18,2)) * (user_id % 4 + 1)) AS DOUBLE) AS total
  FROM events GROUP BY event_type""")
def _weighted_rollup(spark: SparkSession, sf: str) -> DataFrame:
    events = events_table(spark, sf).select("event_type", money("value").alias("value"), (F.col("user_id") % 4 + 1).alias("sample_rate"))
    rolled = sampling.weighted_rollup(events, ["event_type"], ["value"])
    return rolled.select("event_type", "kept", "n", F.col("total_value").cast("double").alias("total"))


# ---- outcomes

def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as responses: status by type, a message, an error for some, a duration."""
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 429).otherwise(200)
    return events_table(spark, sf).select(
        F.col("ts").alias("_time"), F.col("event_id").alias("pos"), status.alias("status"), F.concat(L("m"), text(F.col("user_id") % 3)).alias("message"),
        F.when(F.col("event_type") == "error", F.concat(L("e"), text(F.col("user_id") % 2))).alias("error"), "value", "event_type")


_W = "strftime(to_timestamp(CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f')"
_OUT = f"""(SELECT {_W} AS w, CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 429 ELSE 200 END AS VARCHAR) AS status,
  'm' || (user_id % 3) AS message, CASE WHEN event_type = 'error' THEN 'e' || (user_id % 2) END AS error FROM events)"""


@query("outcome_counts", f"""SELECT w, 'status' AS kind, status AS item, count(*) AS n FROM {_OUT} GROUP BY ALL
  UNION ALL SELECT w, 'message', message, count(*) FROM {_OUT} GROUP BY ALL
  UNION ALL SELECT w, 'error', error, count(*) FROM {_OUT} WHERE error IS NOT NULL GROUP BY ALL""")
def _outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.outcome_counts(_outcomes(spark, sf), seconds=3600).select(stamp_text(F.col("window_start")).alias("w"), "kind", "item", "n")


@query("duration_stats", f"""SELECT {_W} AS w, count(*) AS n, min(us) AS fastest, max(us) AS slowest,
  CAST(sum(us) AS BIGINT) / count(*) AS average FROM (SELECT ts, CAST(round(value * 10000) AS BIGINT) AS us FROM events) GROUP BY 1""")
def _duration_stats(spark: SparkSession, sf: str) -> DataFrame:
    timed = _outcomes(spark, sf).withColumn("us", F.round(F.col("value") * 10000).cast("bigint"))
    stats = quality.duration_stats(timed, "us", seconds=3600)
    return stats.select(stamp_text(F.col("window_start")).alias("w"), "n", "fastest", "slowest", "average")


@query("lifetime_totals", f"SELECT w, n, CAST(sum(n) OVER (ORDER BY w) AS BIGINT) AS lifetime FROM (SELECT {_W} AS w, count(*) AS n FROM events GROUP BY 1)")
def _lifetime_totals(spark: SparkSession, sf: str) -> DataFrame:
    per_window = quality.with_window(_outcomes(spark, sf), 3600).groupBy("window_start").agg(F.count("*").alias("n"))
    return quality.lifetime_totals(per_window).select(stamp_text(F.col("window_start")).alias("w"), "n", "lifetime")


@query("last_event", f"SELECT w, event_type, value FROM (SELECT {_W} AS w, event_type, value, row_number() OVER (PARTITION BY {_W} ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def _last_event(spark: SparkSession, sf: str) -> DataFrame:
    newest = quality.last_event(_outcomes(spark, sf), ["event_type", "value"], seconds=3600)
    return newest.select(stamp_text(F.col("window_start")).alias("w"), "event_type", "value")


# ---- rollups

def _slow(spark: SparkSession, sf: str) -> DataFrame:
    return split_rejects(mysql_slow_events(backfill(spark, R.slow_log_path(spark, sf))))[0]


_DIGEST_SQL = f"""
WITH s AS ({R.SLOW_SQL}), v AS (SELECT normalized_query, CAST(round(query_time * 1000000) AS BIGINT) AS us, rows_examined, rows_sent,
  row_number() OVER (PARTITION BY normalized_query ORDER BY query_time) AS r, count(*) OVER (PARTITION BY normalized_query) AS n FROM s)
SELECT normalized_query, count(*) AS calls, CAST(sum(us) AS BIGINT) / 1000000 AS total_time, CAST(sum(us) AS BIGINT) / count(*) / 1000000 AS avg_time,
  min(us) FILTER (r >= (n * 950 + 999) // 1000) / 1000000 AS p95_time, max(us) / 1000000 AS max_time,
  CAST(sum(rows_examined) AS BIGINT) AS rows_examined, CAST(sum(rows_sent) AS BIGINT) AS rows_sent,
  CAST(sum(us) AS BIGINT) / (SELECT CAST(sum(us) AS BIGINT) FROM v) AS time_share FROM v GROUP BY normalized_query"""


@query("slow_query_digest", _DIGEST_SQL)
def _slow_query_digest(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.slow_query_digest(_slow(spark, sf))


@query("slow_query_top", f"SELECT normalized_query, calls, total_time, row_number() OVER (ORDER BY total_time DESC) AS rank FROM ({_DIGEST_SQL}) ORDER BY total_time DESC LIMIT 2")
def _slow_query_top(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.slow_query_digest(_slow(spark, sf), top=2).select("normalized_query", "calls", "total_time", "rank")


@query("slow_by_table", f"""SELECT "table", count(*) AS calls, CAST(sum(CAST(round(query_time * 1000000) AS BIGINT)) AS BIGINT) / 1000000 AS total_time,
  CAST(sum(rows_examined) AS BIGINT) AS rows_examined FROM (SELECT unnest(string_split("tables", ' ')) AS "table", query_time, rows_examined FROM ({R.SLOW_SQL})) GROUP BY 1""")
def _slow_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.slow_by_table(_slow(spark, sf))


ITEM_PATHS = ("/parts/:part", "/parts/:part/suppliers/:supplier")


@query("traffic_by_shape", """SELECT method, shape, status, count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes, grouping(method, shape, status) AS level
  FROM (SELECT CASE WHEN l_linestatus = 'O' THEN 'GET' ELSE 'POST' END AS method,
    '/parts/:part' || CASE WHEN l_linenumber % 2 = 0 THEN '/suppliers/:supplier' ELSE '' END || CASE WHEN l_returnflag = 'A' THEN '?flag=?&qty=?' ELSE '' END AS shape,
    CASE l_returnflag WHEN 'N' THEN 200 WHEN 'R' THEN 404 ELSE 301 END AS status, CAST(trunc(l_extendedprice) AS BIGINT) AS bytes
    FROM lineitem WHERE l_orderkey % 13 <> 0) GROUP BY ROLLUP (method, shape, status)""")
def _traffic_by_shape(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(access_log_events(R.access_lines(spark, sf), R.ACCESS_FORMAT))
    shaped = request_shape(events, "request", ITEM_PATHS)
    return rollups.traffic_by_shape(shaped, "request_method", "request_shape", "status", "body_bytes_sent")


@query("page_traffic", f"""SELECT lang, shape, count(*) AS requests, grouping(lang, shape) AS level FROM (SELECT CASE WHEN {_FITS} THEN regexp_extract({_PATH}, '^/([^/]+)/', 1) END AS lang,
  concat_ws('?', {_SHAPE}, {_QSHAPE}) AS shape FROM pages) GROUP BY ROLLUP (lang, shape)""")
def _page_traffic(spark: SparkSession, sf: str) -> DataFrame:
    shaped = request_shape(_requests(spark, sf), "request", PATHS)
    return shaped.rollup(F.col("request_path_lang").alias("lang"), F.col("request_shape").alias("shape")).agg(
        F.count("*").alias("requests"), F.grouping_id().alias("level"))


@query("audit_activity", """SELECT "user", host, command_class, count(*) AS actions, count(DISTINCT u) AS users, grouping("user", host, command_class) AS level
  FROM (SELECT 'u' || (user_id % 40) AS "user", 'u' || (user_id % 40) AS u, 'h' || (user_id % 7) AS host, event_type AS command_class FROM events
        WHERE event_id % 14 <> 0 AND event_id % 15 <> 0) GROUP BY CUBE ("user", host, command_class)""")
def _audit_activity(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.audit_activity(split_rejects(mysql_audit_events(R.audit_lines(spark, sf)))[0])


@query("audit_users_approx", """SELECT 'h' || (user_id % 7) AS host, count(*) AS actions, count(DISTINCT user_id % 40) AS users, 1 AS near
  FROM events WHERE event_id % 14 <> 0 AND event_id % 15 <> 0 GROUP BY 1""")
def _audit_users_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch beside the exact count: it must come within a fifth of it."""
    events, _ = split_rejects(mysql_audit_events(R.audit_lines(spark, sf)))
    exact = events.groupBy("host").agg(F.count_distinct("user").alias("exact"))
    both = rollups.audit_users_approx(events, ["host"]).join(exact, "host")
    near = F.abs(F.col("users") - F.col("exact")) <= F.col("exact") / 5
    return both.select("host", "actions", F.col("exact").alias("users"), _int(near).alias("near"))


# ---- streams

def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("_time", F.col("ts").cast("timestamp"))


def _finished(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Run a windowed count to its end; each batch rewrites its own folder."""
    out = fresh_path(spark, "windows")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/_batch={number}")

    writer = rows.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", fresh_path(spark, "windows-state"))
    pace(writer, once=True).start().awaitTermination()
    read = spark.read.option("basePath", out).parquet(out)
    keys = [c for c in ("window_start", "sample_key", "status") if c in rows.columns]
    # In update mode a later batch holds the newer state of a window.
    values = [c for c in rows.columns if c not in keys]
    newest = read.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("s"))
    return newest.select(*keys, "s.*")


@query("rate_window", f"SELECT {_W} AS w, event_type AS sample_key, count(*) AS n FROM events GROUP BY 1, 2")
def _rate_window(spark: SparkSession, sf: str) -> DataFrame:
    counted = _finished(spark, rate_window(_event_stream(spark, sf), F.col("event_type"), 3600, "1 hour"))
    return counted.select(stamp_text(F.col("window_start")).alias("w"), "sample_key", "n")


@query("status_window", f"SELECT {_W} AS w, event_type AS status, count(*) AS n, min(value) AS fastest, max(value) AS slowest FROM events GROUP BY 1, 2")
def _status_window(spark: SparkSession, sf: str) -> DataFrame:
    stats = _finished(spark, status_window(_event_stream(spark, sf).withColumn("status", F.col("event_type")), "value", 3600, "1 hour"))
    return stats.select(stamp_text(F.col("window_start")).alias("w"), "status", "n", "fastest", "slowest")


@query("late_events", """SELECT event_id FROM events
  WHERE (CAST(floor(epoch(ts) / 3600) AS BIGINT) + 1) * 3600 + 1800 <= epoch(date_trunc('second', ts)) + (user_id % 5) * 3600""")
def _late_events(spark: SparkSession, sf: str) -> DataFrame:
    arrival = F.timestamp_seconds(F.unix_seconds("ts") + (F.col("user_id") % 5) * 3600)
    events = events_table(spark, sf).withColumns({"_time": F.col("ts"), "arrival": arrival})
    return late_events(events, "30 MINUTES", 3600).select("event_id")


@query("pace", "SELECT event_id, event_type FROM events")
def _pace(spark: SparkSession, sf: str) -> DataFrame:
    stream = _event_stream(spark, sf).select("event_id", "event_type")
    out = fresh_path(spark, "paced")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "paced-state"))
    running = pace(writer, seconds=1).start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(out)


# ---- options and formats

@query("register_format", "SELECT event_id, event_type AS kind FROM events WHERE user_id % 2 = 0")
def _register_format(spark: SparkSession, sf: str) -> DataFrame:
    def pipes(lines: DataFrame) -> DataFrame:
        parts = F.split("value", r"\|")
        return lines.select("file", "block", "pos", "value", F.get(parts, L(1)).alias("kind"),
                            F.when(F.size(parts) != 2, "parts").alias("reject_reason"))

    if "pipes" not in format_names():
        register_format("pipes", pipes)
    events = events_table(spark, sf)
    line = F.when(F.col("user_id") % 2 == 0, F.concat(text("event_id"), L("|"), F.col("event_type"))).otherwise("no bars")
    lines = events.select(L("t").alias("file"), L(0).alias("block"), F.col("event_id").alias("pos"), line.alias("value"))
    good, _ = split_rejects(lines.transform(get_format("pipes")))
    return good.select(F.col("pos").alias("event_id"), "kind")


@query("ingest_config", f"""SELECT o_orderkey, strftime(date_trunc('second', CAST("at" AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S.%f') AS at, sha256("user") AS "user", NULL AS client,
  'r1' AS role, query_time FROM ({R.SLOW_SQL})""")
def _ingest_config(spark: SparkSession, sf: str) -> DataFrame:
    """A whole job from options: read files, parse, drop, scrub, add, fit, store, read back."""
    out = fresh_path(spark, "slow-table")
    cfg = IngestConfig("mysql_slow", [R.slow_log_path(spark, sf)], out, drop_fields=["client"], scrub_fields=["user"],
                       add_fields={"role": "r1"}, backfill=True)
    run_batch(spark, cfg)
    stored = read_events(spark, out)
    return stored.select(F.col("rows_examined").alias("o_orderkey"), stamp_text(F.col("_time")).alias("at"), "user", "client", "role", "query_time")
