"""Queries over sources, lines, grouping and formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake.catalog import render as R
from loglake.catalog.base import events_table, query, stamp_text, table, text, written
from loglake.formats.access_log import access_log_events
from loglake.formats.arango import arango_requests, pair_requests
from loglake.formats.audit_log import mysql_audit_events
from loglake.formats.free_text import regex_events
from loglake.formats.json_lines import json_events, json_profile
from loglake.formats.keyval import keyval_events
from loglake.formats.mongo import carry_replica_set, flatten_locks, lock_columns, mongo_events
from loglake.formats.postgres import postgres_slow_events
from loglake.formats.slow_log import drop_admin_and_empty, fold_entry, mysql_slow_events
from loglake.functions.typing import typeify_keyval
from loglake.operators.grouping import group_continuations, group_slow_log
from loglake.operators.lines import drop_empty, filter_lines, merge_prefix, split_rejects, strip_prefix, trim_lines
from loglake.operators.quality import ingest_quality
from loglake.schemas import MYSQL_AUDIT, MYSQL_SLOW
from loglake.session import fresh_path
from loglake.sources.files import backfill, lines_from, order_lines, read_lines
from loglake.sources.tables import conform, read_table, write_outcome, write_table
from loglake.functions.times import time_columns
from loglake.streaming.ingest import group_stream, ingest_stream, read_batches, write_batches, write_stream

L = F.lit


def bit(col) -> Column:
    return col.cast("int")


# ---- sources and sinks

EVENT_LINE_SQL = "'id=' || event_id || ' type=' || event_type || ' k=' || json_extract_string(props, '$.k')"


def _event_lines_path(spark: SparkSession, sf: str) -> str:
    """One line per event, in event order inside and across files."""
    line = F.concat(L("id="), text("event_id"), L(" type="), F.col("event_type"), L(" k="), F.get_json_object("props", "$.k"))
    return written(spark, sf, "event-lines", lambda: events_table(spark, sf)
                   .repartitionByRange(4, "event_id").sortWithinPartitions("event_id").select(line.alias("value")))


@query("read_lines", f"SELECT {EVENT_LINE_SQL} AS value FROM events")
def _read_lines(spark: SparkSession, sf: str) -> DataFrame:
    return read_lines(spark, _event_lines_path(spark, sf)).select("value")


@query("file_guard", f"SELECT {EVENT_LINE_SQL} AS value FROM events")
def _file_guard(spark: SparkSession, sf: str) -> DataFrame:
    # Side files of another kind lie between the logs and must not be read.
    path = fresh_path(spark, "mixed")
    spark.read.text(_event_lines_path(spark, sf)).write.option("lineSep", "\n").text(path)
    events_table(spark, sf).select("event_id", "props").write.mode("append").json(path)
    return read_lines(spark, path, exclude=r".*\.json").select("value")


def _id_in_line(col: str = "value") -> Column:
    return F.regexp_extract(col, r"id=(\d+)", 1).cast("bigint")


@query("order_lines", "SELECT event_id, 1 AS in_order FROM events")
def _order_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = order_lines(read_lines(spark, _event_lines_path(spark, sf))).withColumn("event_id", _id_in_line())
    # Order is checked inside each split: the id of a line is one more than the one before.
    before = F.lag("event_id").over(Window.partitionBy("file", "block").orderBy("pos"))
    ok = before.isNull() | (before == F.col("event_id") - 1)
    return lines.select("event_id", bit(ok).alias("in_order"))


@query("backfill", f"SELECT event_id, {EVENT_LINE_SQL} AS value FROM events")
def _backfill(spark: SparkSession, sf: str) -> DataFrame:
    return backfill(spark, _event_lines_path(spark, sf)).select(_id_in_line().alias("event_id"), "value")


@query("ingest_stream", f"SELECT event_id, {EVENT_LINE_SQL} AS value FROM events")
def _ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    lines = ingest_stream(spark, _event_lines_path(spark, sf), read_from="beginning", max_files=2)
    out, state = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")

    def parse(ordered: DataFrame) -> DataFrame:
        dated = ordered.withColumn("event_id", _id_in_line())
        return dated.withColumn("_date", F.date_add(L("2024-01-01").cast("date"), (F.col("event_id") % 3).cast("int"))).withColumn("_time", F.col("_date").cast("timestamp"))

    write_batches(lines, parse, out, state, once=True).awaitTermination()
    return read_batches(spark, out).select("event_id", "value")


def _dated_events(spark: SparkSession, sf: str) -> DataFrame:
    return events_table(spark, sf).select("event_id", "event_type", "value", *time_columns(F.col("ts")))


DATED_SQL = """SELECT event_id, event_type, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS at,
  CAST(floor(epoch_us(ts) / 1000) AS BIGINT) % 1000 AS ms FROM events"""


def _dated_columns(df: DataFrame) -> DataFrame:
    return df.select("event_id", "event_type", stamp_text(F.col("_time")).alias("at"), F.col("_ms").cast("bigint").alias("ms"))


@query("write_table", DATED_SQL)
def _write_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "dated")
    write_table(_dated_events(spark, sf), path, ["_time", "event_type"])
    return _dated_columns(read_table(spark, path))


@query("read_table", DATED_SQL + " WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
def _read_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "dated")
    write_table(_dated_events(spark, sf), path)
    return _dated_columns(read_table(spark, path, "2024-01-05", "2024-01-12"))


@query("write_stream", DATED_SQL)
def _write_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = stream.select("event_id", "event_type", *time_columns(F.col("ts").cast("timestamp")))
    out = fresh_path(spark, "sink")
    write_stream(rows, out, fresh_path(spark, "sink-state"), once=True).awaitTermination()
    return _dated_columns(read_batches(spark, out))


@query(
    "conform",
    """SELECT event_id, event_id AS connection_id, event_type AS command_class, 0 AS status, 'shop' AS db,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day, 0 AS extra_fields
       FROM events WHERE event_id % 14 <> 0 AND event_id % 15 <> 0""",
)
def _conform(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(mysql_audit_events(R.audit_lines(spark, sf)))
    second, day, millis = time_columns(F.col("_stamp"))
    dated = events.withColumn("_stamp", F.col("_time")).withColumn("_time", second).withColumn("_date", day).withColumn("_ms", millis)
    fitted = conform(dated.drop("_stamp"), MYSQL_AUDIT)
    return fitted.select(
        F.regexp_extract("record", r"\d+", 0).cast("bigint").alias("event_id"), "connection_id", "command_class",
        "status", "db", F.col("_date").cast("string").alias("day"), F.size("extra").alias("extra_fields"),
    )


@query(
    "write_outcome",
    """SELECT CASE WHEN event_id % 14 = 0 THEN 'rejected' WHEN event_id % 15 = 0 THEN 'rejected' ELSE 'ok' END AS outcome,
       CASE WHEN event_id % 14 = 0 THEN 'record' WHEN event_id % 15 = 0 THEN 'time' END AS reason, count(*) AS n
       FROM events GROUP BY ALL""",
)
def _write_outcome(spark: SparkSession, sf: str) -> DataFrame:
    parsed = mysql_audit_events(R.audit_lines(spark, sf)).withColumn("_date", F.to_date("_time"))
    path = fresh_path(spark, "outcome")
    write_outcome(parsed, path)
    return spark.read.parquet(path).groupBy(F.col("_outcome").alias("outcome"), F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))


# ---- lines

@query(
    "filter_lines",
    """SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
       WHERE regexp_matches(line, '[0-9]{2,}') AND NOT regexp_matches(line, '(?i)the ') GROUP BY doc_id""",
)
def _filter_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines_from(docs, F.col("line"), text("doc_id"), F.col("doc_id"))
    kept = filter_lines(filter_lines(lines, "[0-9]{2,}"), "(?i)the ", invert=True)
    return kept.groupBy(F.col("file").cast("bigint").alias("doc_id")).agg(F.count("*").alias("n"))


def _syslog_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A syslog-like head before a JSON body; every 4th line has none."""
    head = F.concat(F.date_format("ts", "MMM dd HH:mm:ss"), L(" app"), text(F.col("user_id") % 9), L(": "))
    line = F.when(F.col("event_id") % 4 == 0, F.col("props")).otherwise(F.concat(head, F.col("props")))
    return lines_from(events_table(spark, sf), line, order=F.col("event_id"))


SYSLOG = r"(?P<server_time>\w+ \d\d [0-9:]+) (?P<hostname>[[:alpha:]]+\d): "


@query(
    "strip_prefix",
    """SELECT event_id, props AS value, CASE WHEN event_id % 4 <> 0 THEN 'app' || (user_id % 9) END AS hostname,
       CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%b %d %H:%M:%S') END AS server_time FROM events""",
)
def _strip_prefix(spark: SparkSession, sf: str) -> DataFrame:
    cut = strip_prefix(_syslog_lines(spark, sf), SYSLOG)
    return cut.select(F.col("pos").alias("event_id"), "value", F.element_at("prefix", L("hostname")).alias("hostname"),
                      F.element_at("prefix", L("server_time")).alias("server_time"))


@query(
    "merge_prefix",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'inner' ELSE 'app' || (user_id % 9) END AS hostname,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def _merge_prefix(spark: SparkSession, sf: str) -> DataFrame:
    cut = strip_prefix(_syslog_lines(spark, sf), SYSLOG)
    data = F.create_map(L("hostname"), L("inner"), L("k"), F.get_json_object("value", "$.k"))
    merged = merge_prefix(cut.withColumn("data", data))
    return merged.select(F.col("pos").alias("event_id"), F.element_at("data", L("hostname")).alias("hostname"),
                         F.element_at("data", L("k")).cast("bigint").alias("k"))


@query("trim_lines", "SELECT event_id, event_type || ' ' || event_id AS value FROM events")
def _trim_lines(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(L(" \t "), F.col("event_type"), L(" "), text("event_id"), L(" \r"))
    return trim_lines(lines_from(events_table(spark, sf), padded, order=F.col("event_id"))).select(F.col("pos").alias("event_id"), "value")


@query(
    "split_rejects",
    """SELECT CASE WHEN event_id % 9 = 0 THEN 'empty' WHEN event_id % 23 = 0 THEN 'quote' ELSE 'event' END AS outcome,
       count(*) AS n, sum(event_id) AS ids FROM events GROUP BY ALL""",
)
def _split_rejects(spark: SparkSession, sf: str) -> DataFrame:
    events, rejects = split_rejects(keyval_events(R.keyval_lines(spark, sf)))
    both = events.select("pos", L("event").alias("outcome")).unionByName(rejects.select("pos", F.col("reject_reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("pos").alias("ids"))


@query("drop_empty", "SELECT event_id FROM events WHERE event_type IN ('click', 'error') OR user_id % 2 = 1")
def _drop_empty(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("click", "error"), F.col("event_type")).otherwise("")
    data = F.create_map(L("kind"), kind, L("odd"), F.when(F.col("user_id") % 2 == 1, "1").otherwise(""))
    return drop_empty(events_table(spark, sf).select("event_id", data.alias("data"))).select("event_id")


# ---- grouping

ENTRY_LINES_SQL = """
SELECT o_orderkey,
  4 + CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END
    + CASE WHEN o_orderkey % 7 = 0 THEN 3 ELSE 0 END
    + CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 4 END AS n_lines
FROM orders"""


def _entry_order(lines: str = "lines") -> Column:
    """The order an entry was made from: its number of rows examined."""
    stats = F.get(F.filter(lines, lambda l: l.startswith("# Query_time")), L(0))
    return F.regexp_extract(stats, r"Rows_examined: (\d+)", 1).cast("bigint")


@query("group_slow_log", ENTRY_LINES_SQL)
def _group_slow_log(spark: SparkSession, sf: str) -> DataFrame:
    entries = group_slow_log(backfill(spark, R.slow_log_path(spark, sf)))
    return entries.select(_entry_order().alias("o_orderkey"), F.size("lines").alias("n_lines"))


@query("block_prefix_scan", ENTRY_LINES_SQL)
def _block_prefix_scan(spark: SparkSession, sf: str) -> DataFrame:
    # Cut by hand into splits of eight lines and segments of four splits: most
    # entries cross an edge and take the upper levels.
    lines = backfill(spark, R.slow_log_path(spark, sf))
    small = lines.withColumn("block", F.shiftright("pos", 3))
    entries = group_slow_log(small, segment_bytes=4)
    return entries.select(_entry_order().alias("o_orderkey"), F.size("lines").alias("n_lines"))


@query("group_continuations", "SELECT o_orderkey % 50 AS line_number, o_custkey AS pid, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 3 END AS n_lines FROM orders")
def _group_continuations(spark: SparkSession, sf: str) -> DataFrame:
    entries = group_continuations(backfill(spark, R.postgres_path(spark, sf)))
    first = F.get("lines", L(0))
    return entries.select(
        F.regexp_extract(first, r"\[\d+-(\d+)\]", 1).cast("bigint").alias("line_number"),
        F.regexp_extract(first, r"\[(\d+)-", 1).cast("bigint").alias("pid"), F.size("lines").alias("n_lines"))


@query("group_without_headers", "SELECT event_id, 1 AS bounded, 'no query' AS reason FROM events")
def _group_without_headers(spark: SparkSession, sf: str) -> DataFrame:
    # No line opens an entry: every file is one run. It stays in rows of a few KB, through
    # grouping and fold, and each of its lines is in one of them.
    lines = backfill(spark, _event_lines_path(spark, sf))
    entries = group_slow_log(lines.withColumn("block", F.shiftright("pos", 8)), segment_bytes=16, piece_bytes=4096)
    rejected = fold_entry(entries).filter("reject_reason IS NOT NULL")
    return rejected.select(
        F.explode(F.split("value", "\n")).alias("line"), bit(F.length("value") < 3 * 4096).alias("bounded"), F.col("reject_reason").alias("reason")
    ).select(_id_in_line("line").alias("event_id"), "bounded", "reason")


@query(
    "fold_long_entry",
    f"""SELECT floor(o_orderkey / 64)::BIGINT AS entry, count(*) AS n_lines, arg_max(o_custkey, o_orderkey) AS last_customer,
       max(o_orderkey) AS last_order FROM orders GROUP BY 1""",
)
def _fold_long_entry(spark: SparkSession, sf: str) -> DataFrame:
    # 64 statements under one header, cut into pieces of 512 bytes: the last one counts, and the header stays known.
    each = table(spark, sf, "orders").withColumn("entry", F.floor(F.col("o_orderkey") / 64))
    first = F.row_number().over(Window.partitionBy("entry").orderBy("o_orderkey")) == 1
    statement = F.concat(L("select "), text("o_custkey"), L(" + "), text("o_orderkey"), L(";"))
    head = F.concat(L("# User@Host: entry["), text("entry"), L("] @ web []  Id: "), text("entry"), L("\n"))
    body = each.select("entry", "o_orderkey", F.when(first, F.concat(head, statement)).otherwise(statement).alias("value"))
    path = written(spark, sf, "long-entries", lambda: body.repartitionByRange(4, "entry").sortWithinPartitions("entry", "o_orderkey").select("value"))
    entries = group_slow_log(backfill(spark, path), piece_bytes=512)
    held = entries.groupBy("file", "block", "pos").agg(F.sum(F.size("lines")).alias("n_lines"))
    events = drop_admin_and_empty(fold_entry(entries)).join(held, ["file", "block", "pos"])
    number = lambda i: F.regexp_extract("query", r"select (\d+) \+ (\d+)", i).cast("bigint")
    return events.select(F.col("connection_id").alias("entry"), (F.col("n_lines") - 1).alias("n_lines"), number(1).alias("last_customer"), number(2).alias("last_order"))


def _slow_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("rows_examined").alias("o_orderkey"), stamp_text(F.col("_time")).alias("at"), "user", "client", "connection_id",
        "query_time", "lock_time", "rows_sent", "rows_examined", "bytes_sent", bit(F.col("full_scan")).alias("full_scan"),
        "database", "query", "normalized_query", "tables", "statement", "comments")


@query("mysql_slow_events", R.SLOW_SQL)
def _mysql_slow_events(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(mysql_slow_events(backfill(spark, R.slow_log_path(spark, sf))))
    return _slow_columns(events)


@query("fold_entry", f"SELECT * EXCLUDE (o_orderkey) FROM ({R.SLOW_SQL})")
def _fold_entry(spark: SparkSession, sf: str) -> DataFrame:
    entries = group_slow_log(backfill(spark, R.slow_log_path(spark, sf)))
    return _slow_columns(drop_admin_and_empty(fold_entry(entries))).drop("o_orderkey")


@query(
    "drop_admin_and_empty",
    """SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'ping' WHEN o_orderkey % 19 = 0 AND o_orderkey % 3 <> 2 THEN 'no query' ELSE 'event' END AS outcome,
       count(*) AS n FROM orders GROUP BY ALL""",
)
def _drop_admin_and_empty(spark: SparkSession, sf: str) -> DataFrame:
    folded = mysql_slow_events(backfill(spark, R.slow_log_path(spark, sf)))
    kept = drop_admin_and_empty(folded).groupBy(L("event").alias("outcome")).agg(F.count("*").alias("n"))
    gone = folded.filter(F.col("reject_reason").isNotNull()).groupBy(F.col("reject_reason").alias("outcome")).agg(F.count("*").alias("n"))
    return kept.unionByName(gone)


@query("group_stream", ENTRY_LINES_SQL)
def _group_stream(spark: SparkSession, sf: str) -> DataFrame:
    lines = ingest_stream(spark, R.slow_log_path(spark, sf), read_from="beginning")
    out = fresh_path(spark, "grouped")
    group_stream(lines, group_slow_log, out, fresh_path(spark, "grouped-state"), once=True).awaitTermination()
    return read_batches(spark, out).select(_entry_order().alias("o_orderkey"), F.size("lines").alias("n_lines"))


# ---- formats

@query(
    "json_events",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, 'time' AS time_source, event_type, value,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, 4 AS n_fields
       FROM events WHERE event_id % 10 <> 0 AND event_id % 31 <> 0""",
)
def _json_events(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(json_events(R.json_lines(spark, sf)))

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get(F.element_at("data", L(name)), "$", kind)

    return events.select(
        F.col("pos").alias("event_id"), stamp_text(F.col("_time")).alias("at"), "time_source",
        field("Type", "string").alias("event_type"), field("value", "double").alias("value"),
        field("k", "double").alias("k"), F.size("data").alias("n_fields"))


@query(
    "json_profile",
    """SELECT field, type, count(*) AS n FROM (SELECT unnest(['time', 'Type', 'id', 'value', 'k']) AS field,
       unnest(['STRING', 'STRING', 'NUMBER', 'NUMBER', 'NUMBER']) AS type
       FROM events WHERE event_id % 10 <> 0 AND event_id % 31 <> 0) GROUP BY ALL""",
)
def _json_profile(spark: SparkSession, sf: str) -> DataFrame:
    return json_profile(R.json_lines(spark, sf))


@query(
    "keyval_events",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, event_type || ' "x"' AS type,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS ok, '' AS bare
       FROM events WHERE event_id % 9 <> 0 AND event_id % 23 <> 0""",
)
def _keyval_events(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(keyval_events(R.keyval_lines(spark, sf)))
    get = lambda name: F.element_at("data", L(name))
    return events.select(
        F.col("pos").alias("event_id"), stamp_text(F.col("_time")).alias("at"), get("type").alias("type"),
        F.coalesce(typeify_keyval(get("value"))["d"], typeify_keyval(get("value"))["l"].cast("double"),
                   typeify_keyval(get("value"))["b"].cast("double")).alias("value"),
        bit(typeify_keyval(get("ok"))["b"]).alias("ok"), get("bare").alias("bare"))


TEXT_PATTERNS = (r"(?P<number>[0-9]{3,}) (?P<after>[[:alpha:]]+)", r"(?P<first_word>[A-Za-z]+)")


@query(
    "regex_events",
    """SELECT conv_id, turn,
       CASE WHEN regexp_matches(text, '[0-9]{3,} [[:alpha:]]+') THEN regexp_extract(text, '([0-9]{3,}) ([[:alpha:]]+)', 1) END AS number,
       CASE WHEN regexp_matches(text, '[0-9]{3,} [[:alpha:]]+') THEN regexp_extract(text, '([0-9]{3,}) ([[:alpha:]]+)', 2) END AS after,
       CASE WHEN NOT regexp_matches(text, '[0-9]{3,} [[:alpha:]]+') THEN regexp_extract(text, '([A-Za-z]+)', 1) END AS first_word
       FROM (SELECT conv_id, turn, replace(text, chr(10), ' ') AS text FROM conversations) WHERE regexp_matches(text, '[A-Za-z]')""",
)
def _regex_events(spark: SparkSession, sf: str) -> DataFrame:
    talk = table(spark, sf, "conversations")
    lines = lines_from(talk, F.translate("text", "\n", " "), text("conv_id"), F.col("turn"))
    events, _ = split_rejects(regex_events(lines, TEXT_PATTERNS))
    get = lambda name: F.element_at("data", L(name)).alias(name)
    return events.select(F.col("file").cast("bigint").alias("conv_id"), F.col("pos").alias("turn"), get("number"), get("after"), get("first_word"))


@query(
    "access_log_events",
    """SELECT l_orderkey * 100 + l_linenumber AS line, '10.0.' || (l_suppkey % 256) || '.' || l_linenumber AS remote_addr,
       CASE WHEN l_returnflag <> 'R' THEN 'user' || (l_suppkey % 100) END AS remote_user,
       strftime(CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey % 86400), '%Y-%m-%d %H:%M:%S.%f') AS at,
       CASE WHEN l_linestatus = 'O' THEN 'GET' ELSE 'POST' END || ' /parts/' || l_partkey
         || CASE WHEN l_linenumber % 2 = 0 THEN '/suppliers/' || l_suppkey ELSE '' END
         || CASE WHEN l_returnflag = 'A' THEN '?qty=' || CAST(trunc(l_quantity) AS BIGINT) || '&flag=A' ELSE '' END || ' HTTP/1.1' AS request,
       CASE l_returnflag WHEN 'N' THEN 200 WHEN 'R' THEN 404 ELSE 301 END AS status,
       CAST(trunc(l_extendedprice) AS BIGINT) AS body_bytes_sent, l_discount AS request_time
       FROM lineitem WHERE l_orderkey % 13 <> 0""",
)
def _access_log_events(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(access_log_events(R.access_lines(spark, sf), R.ACCESS_FORMAT))
    return events.select(F.col("pos").alias("line"), "remote_addr", "remote_user", stamp_text(F.col("_time")).alias("at"),
                         "request", "status", "body_bytes_sent", "request_time")


@query(
    "mysql_audit_events",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS at, event_type AS command_class,
       event_id AS connection_id, 'select ' || user_id AS sqltext, 'u' || (user_id % 40) AS "user", 'h' || (user_id % 7) AS host, 0 AS status
       FROM events WHERE event_id % 14 <> 0 AND event_id % 15 <> 0""",
)
def _mysql_audit_events(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(mysql_audit_events(R.audit_lines(spark, sf)))
    return events.select(F.col("pos").alias("event_id"), stamp_text(F.col("_time")).alias("at"), "command_class",
                         "connection_id", "sqltext", "user", "host", "status")


@query(
    "postgres_slow_events",
    f"""SELECT strftime(date_trunc('millisecond', {R.ORDER_TIME_SQL}), '%Y-%m-%d %H:%M:%S.%f') AS at, o_custkey AS pid,
       o_orderkey % 50 AS line_number, 'app' AS "user", 'sales' AS "database", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS duration,
       'SELECT o_orderkey, "Name" FROM orders WHERE o_custkey=' || CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '$1' END || ';' AS query,
       'select o_orderkey, ? from orders where o_custkey=' || CASE WHEN o_orderkey % 2 = 0 THEN '?' ELSE '$?' END || ';' AS normalized_query
       FROM orders WHERE o_orderkey % 11 <> 0""",
)
def _postgres_slow_events(spark: SparkSession, sf: str) -> DataFrame:
    lines = backfill(spark, R.postgres_path(spark, sf))
    events, _ = split_rejects(postgres_slow_events(lines, "%m [%p-%l] %q%u@%d "))
    return events.select(stamp_text(F.col("_time")).alias("at"), "pid", F.col("session_line_number").alias("line_number"),
                         "user", "database", "duration", "query", "normalized_query")


def _mongo(spark: SparkSession, sf: str, partials: bool = False) -> DataFrame:
    # Stamps without a year belong to 2024: the reference time is the end of that year.
    return mongo_events(R.mongo_lines(spark, sf), L("2024-12-31 23:59:59").cast("timestamp"), log_partials=partials)


@query(
    "mongo_events",
    """SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') AS at,
       CASE WHEN event_id % 5 <> 1 THEN 'informational' END AS severity,
       CASE event_id % 5 WHEN 0 THEN 'COMMAND' WHEN 2 THEN 'COMMAND' WHEN 3 THEN 'SHARDING' END AS component,
       CASE event_id % 5 WHEN 0 THEN 'conn' || user_id WHEN 1 THEN 'conn' || user_id ELSE 'conn1' END AS context,
       CASE event_id % 5 WHEN 0 THEN 'command' WHEN 1 THEN 'query' WHEN 2 THEN 'command' END AS operation,
       CASE event_id % 5 WHEN 0 THEN 'find' WHEN 2 THEN 'replSetHeartbeat' END AS command_type,
       CASE event_id % 5 WHEN 0 THEN CAST(event_id AS DOUBLE) END AS keys_examined,
       CASE event_id % 5 WHEN 1 THEN CAST(event_id AS DOUBLE) END AS nscanned,
       CASE event_id % 5 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 0 END AS n_counters,
       CASE WHEN event_id % 5 IN (0, 1) THEN CAST(user_id AS DOUBLE) WHEN event_id % 5 = 2 THEN 0.0 END AS duration_ms
       FROM events WHERE event_id % 5 <> 4""",
)
def _mongo_events(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(_mongo(spark, sf))
    counter = lambda name: F.element_at("counters", L(name))
    return events.select(
        F.col("pos").alias("event_id"), stamp_text(F.col("_time")).alias("at"), "severity", "component", "context", "operation",
        "command_type", counter("keysExamined").alias("keys_examined"), counter("nscanned").alias("nscanned"),
        F.size("counters").alias("n_counters"), "duration_ms")


@query(
    "log_partials",
    """SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS partial,
       CASE event_id % 5 WHEN 4 THEN 'warning' WHEN 1 THEN NULL ELSE 'informational' END AS severity FROM events""",
)
def _log_partials(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(_mongo(spark, sf, partials=True))
    return events.select(F.col("pos").alias("event_id"), bit(F.col("partial")).alias("partial"), "severity")


@query(
    "split_namespace",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'shop' WHEN 1 THEN 'shop' WHEN 2 THEN 'admin' WHEN 3 THEN 'Shop' END AS "database",
       CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN 'old.items' WHEN 2 THEN '$cmd' WHEN 3 THEN 'Items' END AS collection
       FROM events WHERE event_id % 5 <> 4""",
)
def _split_namespace(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(_mongo(spark, sf))
    return events.select(F.col("pos").alias("event_id"), "database", "collection")


@query(
    "flatten_locks",
    """SELECT event_id, 'global_read_lock' AS lock, event_id AS n FROM events WHERE event_id % 5 = 0
       UNION ALL SELECT event_id, 'global_write_lock', 1 FROM events WHERE event_id % 5 = 0
       UNION ALL SELECT event_id, 'database_exclusive_lock', 2 FROM events WHERE event_id % 5 = 0
       UNION ALL SELECT event_id, 'database_write_lock_wait_us', user_id FROM events WHERE event_id % 5 = 0
       UNION ALL SELECT event_id, 'read_lock_held_us', event_id FROM events WHERE event_id % 5 = 1""",
)
def _flatten_locks(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_locks(_mongo(spark, sf)).select(F.col("pos").alias("event_id"), "lock", "n")


@query(
    "lock_columns",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN event_id END AS global_read_lock,
       CASE WHEN event_id % 5 = 1 THEN event_id END AS read_lock_held_us FROM events WHERE event_id % 5 IN (0, 1)""",
)
def _lock_columns(spark: SparkSession, sf: str) -> DataFrame:
    wide = lock_columns(flatten_locks(_mongo(spark, sf)), ["global_read_lock", "read_lock_held_us"])
    return wide.select(F.col("pos").alias("event_id"), "global_read_lock", "read_lock_held_us")


@query(
    "command_query",
    """SELECT event_id, '{"_id":"c0ffee07","kind":"' || event_type || '","user":' || user_id || '}' AS query FROM events WHERE event_id % 5 = 0""",
)
def _command_query(spark: SparkSession, sf: str) -> DataFrame:
    finds = _mongo(spark, sf).filter(F.col("command_type") == "find")
    return finds.select(F.col("pos").alias("event_id"), F.to_json("query").alias("query"))


@query(
    "document_shape",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{ "_id": 1, "kind": 1, "user": 1 }'
       ELSE '{ "$orderby": { "_id": 1 }, "$query": { "tags": { "$in": [ 1, 1 ] } } }' END AS normalized_query
       FROM events WHERE event_id % 5 IN (0, 1)""",
)
def _document_shape(spark: SparkSession, sf: str) -> DataFrame:
    shaped = _mongo(spark, sf).filter(F.col("normalized_query").isNotNull())
    return shaped.select(F.col("pos").alias("event_id"), "normalized_query")


@query(
    "flatten_changelog",
    """SELECT event_id, 'id-' || event_id AS changelog_changeid, event_type AS changelog_what, 'shard0' AS changelog_primary,
       'Shop.Items' AS namespace, user_id AS chunks FROM events WHERE event_id % 5 = 3""",
)
def _flatten_changelog(spark: SparkSession, sf: str) -> DataFrame:
    changes = _mongo(spark, sf).filter(F.col("changelog_changeid").isNotNull())
    return changes.select(F.col("pos").alias("event_id"), "changelog_changeid", "changelog_what", "changelog_primary", "namespace",
                          F.try_variant_get("changelog_details", "$.numChunks", "bigint").alias("chunks"))


@query(
    "carry_replica_set",
    """SELECT event_id, CASE WHEN event_id >= 2 THEN 'rs' || ((event_id - (event_id + 3) % 5) % 3) END AS replica_set FROM events""",
)
def _carry_replica_set(spark: SparkSession, sf: str) -> DataFrame:
    # Chunks of eight lines: the value is carried over many chunk edges.
    return carry_replica_set(_mongo(spark, sf), chunk_bits=3).select(F.col("pos").alias("event_id"), "replica_set")


_ARANGO_KEY = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_extendedprice AS DECIMAL(18,2))"


@query(
    "arango_requests",
    f"""SELECT {_ARANGO_KEY} AS id, side AS level, '10.1.0.' || (l_suppkey % 256) AS ip,
       CASE WHEN l_linestatus = 'O' THEN 'GET' ELSE 'PUT' END AS method, '/_api/doc/' || l_partkey AS url,
       CASE WHEN side = 'INFO' THEN CASE WHEN l_returnflag = 'R' THEN 404 ELSE 200 END END AS code,
       CASE WHEN side = 'INFO' THEN CAST(trunc(l_extendedprice) AS BIGINT) END AS bytes,
       CASE WHEN side = 'INFO' THEN l_tax END AS total_time,
       strftime(CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_partkey % 86400 + CASE WHEN side = 'INFO' THEN l_linenumber ELSE 0 END), '%Y-%m-%d %H:%M:%S.%f') AS at
       FROM lineitem, (VALUES ('INFO'), ('DEBUG')) v(side)""",
)
def _arango_requests(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(arango_requests(R.arango_lines(spark, sf)))
    return events.select("id", F.col("logLevel").alias("level"), F.col("sourceIP").alias("ip"), "method", F.col("fullURL").alias("url"),
                         F.col("responseCode").alias("code"), F.col("resBodyLen").alias("bytes"), F.col("totalTime").alias("total_time"),
                         stamp_text(F.col("_time")).alias("at"))


@query(
    "pair_requests",
    f"""SELECT {_ARANGO_KEY} AS id, count(*) AS n_begin, count(*) AS n_end,
       max(epoch(CAST(l_shipdate AS TIMESTAMP)) + l_partkey % 86400 + l_linenumber) - min(epoch(CAST(l_shipdate AS TIMESTAMP)) + l_partkey % 86400) AS seconds
       FROM lineitem GROUP BY 1""",
)
def _pair_requests(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(arango_requests(R.arango_lines(spark, sf)))
    return pair_requests(events).select("id", "n_begin", "n_end", (F.unix_seconds("end_time") - F.unix_seconds("begin_time")).cast("double").alias("seconds"))


@query(
    "ingest_quality",
    """SELECT CAST(CASE WHEN event_id % 9 <> 0 AND event_id % 23 <> 0 THEN CAST(ts AS DATE) END AS VARCHAR) AS day,
       CASE WHEN min(CASE WHEN event_id % 9 <> 0 AND event_id % 23 <> 0 THEN 1 ELSE 0 END) = 0 THEN (SELECT count(*) FROM events) ELSE 0 END AS lines,
       count(*) FILTER (event_id % 9 <> 0 AND event_id % 23 <> 0) AS events,
       count(*) FILTER (event_id % 9 = 0 OR event_id % 23 = 0) AS rejects,
       coalesce(count(*) FILTER (event_id % 9 = 0), 0) AS empties
       FROM events GROUP BY 1""",
)
def _ingest_quality(spark: SparkSession, sf: str) -> DataFrame:
    lines = R.keyval_lines(spark, sf)
    report = ingest_quality(lines, keyval_events(lines))
    return report.select(F.col("_date").cast("string").alias("day"), "lines", "events", "rejects",
                         F.coalesce(F.element_at("reasons", L("empty")), L(0)).alias("empties"))


@query("conform_slow_log", f"SELECT o_orderkey, query_time, full_scan FROM ({R.SLOW_SQL})")
def _conform_slow(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = split_rejects(mysql_slow_events(backfill(spark, R.slow_log_path(spark, sf))))
    fitted = conform(events, MYSQL_SLOW)
    return fitted.select(F.col("rows_examined").alias("o_orderkey"), "query_time", bit(F.col("full_scan")).alias("full_scan"))
