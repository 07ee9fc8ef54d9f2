"""Queries over whole jobs: datasets of several runs, streams that go on, state across batches and files."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake.catalog import render as R
from loglake.catalog.base import dealt, events_table, query, stamp_text, table, text, written
from loglake.catalog.event_queries import DYNAMIC_SQL
from loglake.catalog.ingest_queries import ENTRY_LINES_SQL, _entry_order
from loglake.config import IngestConfig
from loglake.formats.arango import arango_requests, pair_requests
from loglake.formats.keyval import keyval_events
from loglake.operators import sampling
from loglake.operators.grouping import group_slow_log
from loglake.operators.lines import split_rejects
from loglake.operators.rollups import slow_query_digest
from loglake.plans.jobs import run_batch
from loglake.session import fresh_path
from loglake.sources.evolving import read_typed
from loglake.sources.tables import read_events, read_table
from loglake.streaming.ingest import close_series, group_stream, ingest_stream, read_batches, run_stream, write_batches
from loglake.streaming.state import Slots
from loglake.streaming.status import read_status

L = F.lit


def _keyval_files(spark: SparkSession, sf: str, part: int) -> str:
    """Half of the events as lines, over several files."""
    line = F.concat(L("id="), text("event_id"), L(" type="), F.col("event_type"))
    return written(spark, sf, f"half-{part}", lambda: events_table(spark, sf).filter(F.col("event_id") % 2 == part)
                   .repartitionByRange(5, "event_id").select(line.alias("value")))


def _id() -> Column:
    return F.element_at("data", L("id")).cast("bigint").alias("event_id")


@query("batch_then_stream", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'batch' ELSE 'stream' END AS how FROM events")
def _batch_then_stream(spark: SparkSession, sf: str) -> DataFrame:
    out = fresh_path(spark, "shared-dataset")
    run_batch(spark, IngestConfig("keyval", [_keyval_files(spark, sf, 0)], out))
    cfg = IngestConfig("keyval", [_keyval_files(spark, sf, 1)], out, checkpoint=fresh_path(spark, "shared-state"), stop=True, max_files_per_trigger=2)
    run_stream(spark, cfg).awaitTermination()
    return read_table(spark, out).select(_id(), F.substring_index("_run", "-", 1).alias("how"))


@query("backfill_resumed", "SELECT event_id, event_type FROM events WHERE event_id % 2 = 0")
def _backfill_resumed(spark: SparkSession, sf: str) -> DataFrame:
    # Stopped somewhere on its way and started again with the same options: every line once.
    cfg = dict(format="keyval", paths=[_keyval_files(spark, sf, 0)], dataset=fresh_path(spark, "resumed"), checkpoint=fresh_path(spark, "resumed-state"),
               backfill=True, max_files_per_trigger=1)
    first = run_stream(spark, IngestConfig(**cfg))
    while first.isActive and first.lastProgress is None:
        time.sleep(0.05)
    first.stop()
    run_stream(spark, IngestConfig(**cfg)).awaitTermination()
    return read_events(spark, cfg["dataset"]).select(_id(), F.element_at("data", L("type")).alias("event_type"))


@query("keyval_repeated_key", "SELECT event_id, 'u' || user_id AS who, 2 AS n_fields FROM events")
def _keyval_repeated_key(spark: SparkSession, sf: str) -> DataFrame:
    # A session that nobody has tuned, where Spark ends a job at a repeated key.
    fresh = spark.newSession()
    line = F.concat(L("id="), text("event_id"), L(" who=x who=u"), text("user_id"))
    path = written(spark, sf, "repeated-keys", lambda: events_table(spark, sf).select(line.alias("value")))
    lines = fresh.read.text(path).select(L("f").alias("file"), L(0).cast("bigint").alias("block"), F.monotonically_increasing_id().alias("pos"), "value")
    events, _ = split_rejects(keyval_events(lines))
    return events.select(_id(), F.element_at("data", L("who")).alias("who"), F.size("data").alias("n_fields"))


@query("dynamic_across_batches", DYNAMIC_SQL)
def _dynamic_across_batches(spark: SparkSession, sf: str) -> DataFrame:
    # The first days are one batch, the rest another after a restart: the rates go on.
    half = L("2024-01-15").cast("timestamp")
    group = F.when(F.col("user_id") % 10 < 8, 0).otherwise(F.col("user_id"))
    line = F.concat_ws(" ", text("event_id"), "event_type", text(group), text(F.unix_micros("ts")))
    path, out, state = fresh_path(spark, "rated"), fresh_path(spark, "rated-out"), fresh_path(spark, "rated-state")

    def sampled(ordered: DataFrame, number: int) -> DataFrame:
        word = F.split("value", " ")
        events = ordered.select(
            word[0].cast("bigint").alias("event_id"), word[1].alias("event_type"), word[2].alias("group"),
            F.timestamp_micros(word[3].cast("bigint")).alias("_time"))
        memory = Slots(spark, f"{state}/window-counts", number)
        kept = sampling.dynamic_sample(events, ["event_type", "group"], 4, 21600, row_key=["event_id"], min_per_second=10 / 21600, memory=memory)
        return kept.withColumn("_date", F.to_date("_time"))

    for part in (F.col("ts") < half, F.col("ts") >= half):
        events_table(spark, sf).filter(part).select(line.alias("value")).write.mode("append").text(path)
        write_batches(ingest_stream(spark, path), sampled, out, state, once=True).awaitTermination()
    return read_batches(spark, out).select("event_id", "sample_key", F.col("sample_rate").cast("bigint").alias("sample_rate"))


@query("group_over_rotation", ENTRY_LINES_SQL)
def _group_over_rotation(spark: SparkSession, sf: str) -> DataFrame:
    # Eight servers, three files each, cut anywhere: two files in one batch, the third after a restart.
    orders = table(spark, sf, "orders").withColumns({"server": F.col("o_orderkey") % 8, "n": F.size(F.split(R.slow_log_entry(), "\n"))})
    # Where an entry stands in its log is counted from numbers of lines: orders are shuffled, no texts.
    so_far = Window.partitionBy("server").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = orders.groupBy("server").agg(F.sum("n").alias("total"))
    placed = orders.withColumn("first", F.sum("n").over(so_far) - F.col("n")).join(totals, "server")
    path, out, state = fresh_path(spark, "rotated"), fresh_path(spark, "rotated-out"), fresh_path(spark, "rotated-state")

    def write(part: int) -> None:
        begin, end = (F.ceil(F.col("total") * p / 3) - F.col("first") for p in (part, part + 1))
        inside = placed.withColumns({"from": F.greatest(begin, L(0)).cast("int"), "to": F.least(end, F.col("n")).cast("int")}).filter("from < to")
        held = F.slice(F.split(R.slow_log_entry(), "\n"), F.col("from") + 1, F.col("to") - F.col("from"))
        files = inside.select("server", L(part).alias("cut"), "o_orderkey", F.array_join(held, "\n").alias("value"))
        in_order = files.sortWithinPartitions("server", "cut", "o_orderkey")
        in_order.select("server", "cut", "value").write.mode("append").partitionBy("server", "cut").text(path)

    def run() -> None:
        stream = ingest_stream(spark, path)
        group_stream(stream, group_slow_log, out, state, once=True, rotated=r"/cut=\d+/[^/]*$").awaitTermination()

    write(0)
    write(1)
    run()
    write(2)
    run()
    done = read_batches(spark, out).select("lines").unionByName(close_series(spark, out, state, after_body_only=True).select("lines"))
    return done.select(_entry_order().alias("o_orderkey"), F.size("lines").alias("n_lines"))


_PAIR_KEY = "CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_extendedprice AS DECIMAL(18,2)) END"


@query(
    "pair_across_files",
    f"""WITH e AS (
      SELECT {_PAIR_KEY} AS id, side, l_orderkey * 100 + l_linenumber AS pos,
             CAST(epoch(CAST(l_shipdate AS TIMESTAMP)) AS BIGINT) + l_partkey % 86400 + side * l_linenumber AS t
      FROM lineitem, (VALUES (0), (1)) v(side)
    ), u AS (SELECT *, sum(1 - side) OVER (PARTITION BY id ORDER BY t, side, pos ROWS UNBOUNDED PRECEDING) AS use FROM e)
    SELECT id, count(*) FILTER (side = 0) AS n_begin, count(*) FILTER (side = 1) AS n_end,
           max(t) FILTER (side = 1) - min(t) FILTER (side = 0) AS seconds FROM u GROUP BY id, use""",
)
def _pair_across_files(spark: SparkSession, sf: str) -> DataFrame:
    # Begins stand in one file and ends in another, and a third of all lines has one id.
    events, _ = split_rejects(arango_requests(R.arango_lines(spark, sf)))
    hot = F.split("id", "-")[0].cast("bigint") % 3 == 0
    split = events.withColumns({"file": F.when(F.col("logLevel") == "DEBUG", "a").otherwise("b"), "id": F.when(hot, "hot").otherwise(F.col("id"))})
    pairs = pair_requests(split, keys=("id",), bucket_seconds=86_400)
    return pairs.select("id", "n_begin", "n_end", (F.unix_seconds("end_time") - F.unix_seconds("begin_time")).alias("seconds"))


_POLLED = "floor((epoch_us({at}) / 1000000 - epoch(TIMESTAMP '2024-01-03 06:00:00')) / 43200)"


@query(
    "host_status_job",
    f"""SELECT o_orderkey, CASE WHEN n >= 0 THEN 'on-' || "user" END AS hosted_on, CASE WHEN n >= 0 THEN n // 2 END AS replica_lag,
       CASE WHEN n >= 0 THEN CASE WHEN "user" = 'oapp' THEN 'primary' ELSE 'secondary' END END AS role
       FROM (SELECT o_orderkey, lower(o_orderstatus) || 'app' AS "user", least(39, CAST({_POLLED.format(at=R.ORDER_TIME_SQL)} AS BIGINT)) AS n FROM orders
             WHERE o_orderkey % 17 <> 0 AND (o_orderkey % 19 <> 0 OR o_orderkey % 3 = 2))""",
)
def _host_status_job(spark: SparkSession, sf: str) -> DataFrame:
    """A slow-log job that stamps the state its host was last seen in. Hosts are polled from 3 January on."""
    hosts = table(spark, sf, "orders").select(F.concat(F.lower("o_orderstatus"), L("app")).alias("host")).distinct()
    at = F.timestamp_seconds(F.unix_seconds(L("2024-01-03 06:00:00").cast("timestamp")) + F.col("step") * 43200)
    polled = hosts.select("host", F.explode(F.sequence(L(0), L(39))).alias("step")).select(
        "host", at.alias("at"), F.concat(L("on-"), F.col("host")).alias("hosted_on"), L(True).alias("read_only"),
        F.floor(F.col("step") / 2).alias("replica_lag"), F.when(F.col("host") == "oapp", "primary").otherwise("secondary").alias("role"))
    status, out = fresh_path(spark, "host-status"), fresh_path(spark, "with-status")
    polled.write.parquet(status)
    run_batch(spark, IngestConfig("mysql_slow", [R.slow_log_path(spark, sf)], out, host_status=status, host_field="user"))
    return read_events(spark, out).select(
        F.col("rows_examined").alias("o_orderkey"), "hosted_on", F.col("replica_lag").cast("bigint").alias("replica_lag"), "role")


@query(
    "mongo_job",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS at, replica_set,
       CASE event_id % 5 WHEN 0 THEN event_id END AS read_locks, CASE event_id % 5 WHEN 1 THEN event_id END AS held_us
       FROM (SELECT *, last_value(CASE WHEN event_id % 5 = 2 THEN 'rs' || (event_id % 3) END IGNORE NULLS)
                       OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS replica_set FROM events)
       WHERE event_id % 5 IN (0, 1, 3)""",
)
def _mongo_job(spark: SparkSession, sf: str) -> DataFrame:
    """Four servers' files through the job: the set's name goes along each file, locks are stored by name."""
    events = events_table(spark, sf).select((F.col("event_id") % 4).alias("server"), "event_id", "ts", "user_id", "event_type")
    path, out = fresh_path(spark, "mongo-files"), fresh_path(spark, "mongo-table")
    # The rows are sorted, not the lines made from them.
    in_order = events.repartition("server").sortWithinPartitions("server", "event_id")
    in_order.select("server", R.mongo_line().alias("value")).write.partitionBy("server").text(path)
    run_batch(spark, IngestConfig("mongo", [path], out), ingest_time=L("2024-12-31 23:59:59").cast("timestamp"))
    counter = lambda name: F.element_at("counters", L(name)).cast("bigint")
    changed = F.regexp_extract("changelog_changeid", r"id-(\d+)", 1).cast("bigint")
    lock = lambda name: F.element_at("lock_counts", L(name))
    stored = read_events(spark, out).withColumn("event_id", F.coalesce(counter("keysExamined"), counter("nscanned"), changed))
    return stored.filter("event_id IS NOT NULL").select(
        "event_id", stamp_text(F.col("_time")).alias("at"), "replica_set", lock("global_read_lock").alias("read_locks"), lock("read_lock_held_us").alias("held_us"))


@query(
    "mongo_quoted_markers",
    """SELECT event_id, 'query' AS operation, '{"note":"see command: find { locks:{ r: 1 } update: { a: 2 }","user":' || event_id || '}' AS query,
       0 AS n_locks, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS in_past FROM events WHERE event_id % 5 < 2""",
)
def _mongo_quoted_markers(spark: SparkSession, sf: str) -> DataFrame:
    # Marks and braces inside a text are no documents; half of the stamps have no year, and the job gets no time.
    events = events_table(spark, sf).filter(F.col("event_id") % 5 < 2)
    new = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    old = F.date_format("ts", "EEE MMM dd HH:mm:ss.SSS")
    body = F.concat(L(' [conn1] query shop.items query: { user: '), text("event_id"),
                    L(', note: "see command: find { locks:{ r: 1 } update: { a: 2 }" } nscanned:'), text("event_id"), L(" 3ms"))
    stamp = F.when(F.col("event_id") % 2 == 0, old).otherwise(new)
    path = written(spark, sf, "mongo-quoted", lambda: dealt(events).select(F.concat(stamp, body).alias("value")))
    out = fresh_path(spark, "mongo-quoted-table")
    run_batch(spark, IngestConfig("mongo", [path], out))
    dated = F.when((F.col("_time") <= F.current_timestamp()) & (F.year("_time") > 2024), 1).otherwise(0)
    return read_events(spark, out).select(
        F.element_at("counters", L("nscanned")).cast("bigint").alias("event_id"), "operation", F.to_json("query").alias("query"),
        F.size(F.coalesce("lock_counts", F.create_map().cast("map<string,bigint>"))).alias("n_locks"), dated.alias("in_past"))


@query("digest_untimed_calls", """SELECT 'q' || (event_id % 3) AS normalized_query, count(*) AS calls, avg(CASE WHEN event_id % 4 <> 0 THEN event_id % 7 + 1 END) AS avg_time,
  quantile_disc(CASE WHEN event_id % 4 <> 0 THEN event_id % 7 + 1 END, 0.95)::DOUBLE AS p95_time FROM events GROUP BY 1""")
def _digest_untimed_calls(spark: SparkSession, sf: str) -> DataFrame:
    # Every fourth call has no time: it counts as a call, and takes no part in the average.
    told = events_table(spark, sf).select(
        F.concat(L("q"), text(F.col("event_id") % 3)).alias("normalized_query"),
        F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 7 + 1).cast("double")).alias("query_time"),
        L(1).cast("bigint").alias("rows_examined"), L(1).cast("bigint").alias("rows_sent"))
    return slow_query_digest(told).select("normalized_query", "calls", "avg_time", "p95_time")


@query(
    "status_beside_table",
    """WITH e AS (SELECT epoch(date_trunc('second', ts))::BIGINT AS t, CASE WHEN event_id % 50 = 0 THEN 2 WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS b FROM events),
    m AS (SELECT max(t) FILTER (b = 0) - 3600 AS w0, max(t) FILTER (b < 2) - 3600 AS w1, max(t) - 3600 AS w2 FROM e),
    c AS (SELECT t // 7200 * 7200 AS start, b, w0, w1, w2 FROM e, m)
    SELECT strftime(to_timestamp(start) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f') AS w, count(*) AS n FROM c
    WHERE (b = 0 OR b = 1 AND start + 7200 > w0 OR b = 2 AND start + 7200 > w1) AND start + 7200 <= w2 GROUP BY 1
    UNION ALL SELECT 'table', count(*) FROM events""",
)
def _status_beside_table(spark: SparkSession, sf: str) -> DataFrame:
    # Three batches; the third brings rows of all days, most of them long after their windows have closed.
    line = F.concat(L("id="), text("event_id"), L(" time="), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    late, half = F.col("event_id") % 50 == 0, L("2024-01-15").cast("timestamp")
    path, out, state = fresh_path(spark, "status-lines"), fresh_path(spark, "status-table"), fresh_path(spark, "status-state")
    for part in (~late & (F.col("ts") < half), ~late & (F.col("ts") >= half), late):
        events_table(spark, sf).filter(part).select(line.alias("value")).write.mode("append").text(path)
        cfg = IngestConfig("keyval", [path], out, checkpoint=state, stop=True, status_seconds=7200, status_delay_seconds=3600)
        run_stream(spark, cfg).awaitTermination()
    windows = read_status(spark, out).select(stamp_text(F.col("window_start")).alias("w"), "n")
    return windows.unionByName(read_events(spark, out).agg(F.count("*").alias("n")).withColumn("w", L("table")))


@query(
    "evolving_types",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS DOUBLE) ELSE user_id + 0.5 END AS size,
       CASE WHEN event_id % 2 = 0 THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END ELSE 'v' || user_id || '.50' END AS mark,
       CASE WHEN event_id % 2 = 1 THEN lpad(CAST(user_id AS VARCHAR), 6, '0') ELSE CAST(user_id AS VARCHAR) END AS code FROM events""",
)
def _evolving_types(spark: SparkSession, sf: str) -> DataFrame:
    # Two jobs into one dataset: whole numbers and then others, truth values and then texts, numbers with and without zeros in front.
    events, even = events_table(spark, sf), F.col("event_id") % 2 == 0
    user = text("user_id")
    size = F.when(even, user).otherwise(F.concat(user, L(".5")))
    mark = F.when(even, F.when(F.col("user_id") % 2 == 0, "true").otherwise("false")).otherwise(F.concat(L("v"), user, L(".50")))
    code = F.when(even, user).otherwise(F.concat(L("x"), F.lpad(user, 6, "0")))
    line = F.concat(L("id="), text("event_id"), L(" size="), size, L(" mark="), mark, L(" code="), code, L(" rare"), text("event_id"), L("=1"))
    out = fresh_path(spark, "evolving")
    for part in (0, 1):
        path = written(spark, sf, f"evolving-{part}", lambda part=part: events.filter(F.col("event_id") % 2 == part).select(line.alias("value")))
        run_batch(spark, IngestConfig("keyval", [path], out, promote_share=0.5))
    typed = read_typed(spark, out, ["id", "size", "mark", "code"])
    return typed.select(F.col("id").alias("event_id"), "size", "mark", F.regexp_replace("code", "^x", "").alias("code"))
