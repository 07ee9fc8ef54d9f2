"""Log lines in each format, made from the tables by built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.catalog.base import dealt, events_table, money, table, text, written
from loglake.sources.files import lines_from

L = F.lit


def order_time() -> Column:
    """A moment of January 2024 for each order, to the microsecond."""
    second = L(1_704_067_200) + (F.col("o_orderkey") * 37) % 2_592_000
    return F.timestamp_micros(second * 1_000_000 + (F.col("o_orderkey") * 7919) % 1_000_000)


ORDER_TIME_SQL = (
    "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 37) % 2592000)"
    " + to_microseconds((o_orderkey * 7919) % 1000000))"
)


def slow_log_entry() -> Column:
    """One slow-log entry per order; every 17th is a ping, every 19th is cut short."""
    key, cust = text("o_orderkey"), text("o_custkey")
    priority = F.col("o_orderpriority")
    statement = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(
            L("SELECT * FROM orders\nWHERE o_custkey = "), cust, L(" AND o_orderpriority = '"), priority, L("';")))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(
            L("UPDATE `customer` SET c_acctbal = "), money("o_totalprice").cast("string"), L(" WHERE c_custkey = "), cust, L(";")))
        .otherwise(F.concat(
            L("SELECT /* report */ count(*)\n\tFROM orders AS o, customer\nWHERE o_totalprice > "),
            money("o_totalprice").cast("string"), L(";")))
    )
    cut = F.when(F.col("o_orderkey") % 19 == 0, F.regexp_replace(statement, r";\z", "")).otherwise(statement)
    opening = F.when(F.col("o_orderkey") % 17 == 0, "# administrator command: Ping;\n").otherwise(
        F.when(F.col("o_orderkey") % 5 == 0, "# administrator command: Prepare;\n").otherwise(""))
    use = F.when(F.col("o_orderkey") % 3 == 2, "use sales;\n").otherwise("")
    return F.concat(
        opening,
        L("# Time: "), F.date_format(order_time(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), L("Z\n"),
        L("# User@Host: "), F.lower("o_orderstatus"), L("app[app] @ web"), text(F.col("o_custkey") % 25), L(" [10.0.0."),
        text(F.col("o_custkey") % 256), L("]  Id: "), cust, L("\n"),
        L("# Query_time: "), (F.col("o_totalprice") / 10000).cast("decimal(12,6)").cast("string"),
        L("  Lock_time: 0.000"), F.lpad(text(F.col("o_orderkey") % 1000), 3, "0"),
        L(" Rows_sent: "), text(F.col("o_orderkey") % 100), L("  Rows_examined: "), key, L("\n"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(
            L("# Bytes_sent: "), key, L("  Tmp_tables: 1  Tmp_disk_tables: 2  Tmp_table_sizes: 3\n"
              "# QC_Hit: No  Full_scan: Yes  Full_join: No  Tmp_table: Yes  Tmp_table_on_disk: No\n"
              "#   InnoDB_IO_r_ops: 4  InnoDB_IO_r_bytes: 5  InnoDB_IO_r_wait: 0.250000\n"))).otherwise(""),
        use,
        L("SET timestamp="), text(F.unix_seconds(order_time())), L(";\n"),
        cut,
    )


# The fields an entry of the slow log should give, straight from the orders table.
SLOW_SQL = f"""
SELECT o_orderkey,
  strftime({ORDER_TIME_SQL}, '%Y-%m-%d %H:%M:%S.%f') AS at,
  lower(o_orderstatus) || 'app' AS "user",
  'web' || (o_custkey % 25) || ' [10.0.0.' || (o_custkey % 256) || ']' AS client,
  o_custkey AS connection_id,
  CAST(CAST(o_totalprice / 10000 AS DECIMAL(12,6)) AS DOUBLE) AS query_time,
  CAST((o_orderkey % 1000) AS DOUBLE) / 1000000 AS lock_time,
  o_orderkey % 100 AS rows_sent,
  o_orderkey AS rows_examined,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey END AS bytes_sent,
  CASE WHEN o_orderkey % 7 = 0 THEN 1 END AS full_scan,
  CASE WHEN o_orderkey % 3 = 2 THEN 'sales' END AS "database",
  CASE WHEN o_orderkey % 19 = 0 THEN 'use sales'
       WHEN o_orderkey % 3 = 0 THEN 'SELECT * FROM orders WHERE o_custkey = ' || o_custkey || ' AND o_orderpriority = ''' || o_orderpriority || ''''
       WHEN o_orderkey % 3 = 1 THEN 'UPDATE `customer` SET c_acctbal = ' || CAST(o_totalprice AS DECIMAL(18,2)) || ' WHERE c_custkey = ' || o_custkey
       ELSE 'SELECT /* report */ count(*) FROM orders AS o, customer WHERE o_totalprice > ' || CAST(o_totalprice AS DECIMAL(18,2)) END AS query,
  CASE WHEN o_orderkey % 19 = 0 THEN 'use sales'
       WHEN o_orderkey % 3 = 0 THEN 'select * from orders where o_custkey = ? and o_orderpriority = ?'
       WHEN o_orderkey % 3 = 1 THEN 'update `customer` set c_acctbal = ? where c_custkey = ?'
       ELSE 'select count(*) from orders as o, customer where o_totalprice > ?' END AS normalized_query,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL
       WHEN o_orderkey % 3 = 0 THEN 'orders' WHEN o_orderkey % 3 = 1 THEN 'customer' ELSE 'customer o orders' END AS "tables",
  CASE WHEN o_orderkey % 19 = 0 THEN NULL
       WHEN o_orderkey % 3 = 1 THEN 'update' ELSE 'select' END AS statement,
  CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 3 = 2 THEN '/* report */' END AS comments
FROM orders
WHERE o_orderkey % 17 <> 0 AND (o_orderkey % 19 <> 0 OR o_orderkey % 3 = 2)
"""


def slow_log_path(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "slow-log", lambda: table(spark, sf_dir, "orders").select(slow_log_entry().alias("value")))


def postgres_entry() -> Column:
    """A statement over three lines, or a line that is no statement (every 11th order)."""
    head = F.concat(
        F.date_format(order_time(), "yyyy-MM-dd HH:mm:ss.SSS"), L(" UTC ["), text("o_custkey"), L("-"),
        text(F.col("o_orderkey") % 50), L("] app@sales LOG:  "),
    )
    told = F.concat(
        L("duration: "), money("o_totalprice").cast("string"),
        F.when(F.col("o_orderkey") % 2 == 0, L(" ms  statement: ")).otherwise(L(" ms  execute stmt_1: ")),
        L("SELECT o_orderkey,\n\t  \"Name\"\n\tFROM orders WHERE o_custkey="),
        F.when(F.col("o_orderkey") % 2 == 0, text("o_custkey")).otherwise(L("$1")), L(";"),
    )
    return F.concat(head, F.when(F.col("o_orderkey") % 11 == 0, "connection received").otherwise(told))


def postgres_path(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "postgres-log", lambda: table(spark, sf_dir, "orders").select(postgres_entry().alias("value")))


ACCESS_FORMAT = '$remote_addr - $remote_user [$time_local] "$request" $status $body_bytes_sent $request_time "$http_user_agent"'


def access_line() -> Column:
    """One access-log line per line item; every 13th does not fit the format."""
    at = F.timestamp_seconds(F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") % 86400)
    request = F.concat(
        F.when(F.col("l_linestatus") == "O", "GET").otherwise("POST"), L(" /parts/"), text("l_partkey"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(L("/suppliers/"), text("l_suppkey"))).otherwise(""),
        F.when(F.col("l_returnflag") == "A", F.concat(L("?qty="), text("l_quantity", "bigint"), L("&flag=A"))).otherwise(""),
        L(" HTTP/1.1"),
    )
    line = F.concat(
        L("10.0."), text(F.col("l_suppkey") % 256), L("."), text(F.col("l_linenumber")), L(" - "),
        F.when(F.col("l_returnflag") == "R", "-").otherwise(F.concat(L("user"), text(F.col("l_suppkey") % 100))),
        L(" ["), F.date_format(at, "dd/MMM/yyyy:HH:mm:ss"), L(" +0000] \""), request, L("\" "),
        F.when(F.col("l_returnflag") == "N", "200").when(F.col("l_returnflag") == "R", "404").otherwise("301"), L(" "),
        text("l_extendedprice", "bigint"), L(" "), F.col("l_discount").cast("decimal(4,3)").cast("string"), L(" \"agent/1.0\""),
    )
    return F.when(F.col("l_orderkey") % 13 == 0, L("broken line")).otherwise(line)


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    order = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return lines_from(items, access_line(), order=order)


def keyval_line() -> Column:
    """key=value with a quoted text, a flag, a bare word; every 9th line is all empty."""
    line = F.concat(
        L("id="), text("event_id"), L(" type=\""), F.col("event_type"), L(" \\\"x\\\"\" value="), money("value").cast("string"),
        L(" ok="), F.when(F.col("user_id") % 2 == 0, "true").otherwise("false"), L(" bare time=\""),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), L("Z\""),
    )
    return F.when(F.col("event_id") % 9 == 0, L("one two= three")).when(
        F.col("event_id") % 23 == 0, L("a=\"never closed")).otherwise(line)


def keyval_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(events_table(spark, sf_dir), keyval_line(), order=F.col("event_id"))


def json_line() -> Column:
    doc = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.col("event_id").alias("id"), F.col("event_type").alias("Type"), F.col("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    ))
    return F.when(F.col("event_id") % 10 == 0, F.concat(doc, L("}"))).when(
        F.col("event_id") % 31 == 0, L("[1, 2]")).otherwise(F.concat(L("  "), doc))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(events_table(spark, sf_dir), json_line(), order=F.col("event_id"))


def audit_line() -> Column:
    record = F.to_json(F.struct(F.struct(
        L("Query").alias("name"), F.concat(text("event_id"), L("_x")).alias("record"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss' UTC'").alias("timestamp"),
        F.col("event_type").alias("command_class"), text("event_id").alias("connection_id"),
        F.lit(0).alias("status"), F.concat(L("select "), text("user_id")).alias("sqltext"),
        F.concat(L("u"), text(F.col("user_id") % 40)).alias("user"),
        F.concat(L("h"), text(F.col("user_id") % 7)).alias("host"),
        F.lit("shop").alias("db"),
    ).alias("audit_record")))
    return F.when(F.col("event_id") % 14 == 0, L('{"other": 1}')).when(
        F.col("event_id") % 15 == 0, F.regexp_replace(record, '"timestamp":"[^"]*",', "")).otherwise(record)


def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(events_table(spark, sf_dir), audit_line(), order=F.col("event_id"))


def arango_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A begin and an end line per line item."""
    items = dealt(table(spark, sf_dir, "lineitem"))
    key = F.concat(text("l_orderkey"), L("-"), text("l_linenumber"), L("-"), text("l_partkey"), L("-"), text("l_suppkey"),
                   L("-"), text("l_extendedprice", "decimal(18,2)"))
    start = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + F.col("l_partkey") % 86400
    common = F.concat(
        L('"'), key, L('","10.1.0.'), text(F.col("l_suppkey") % 256), L('","'),
        F.when(F.col("l_linestatus") == "O", "GET").otherwise("PUT"), L('","HTTP/1.1",'),
    )
    url = F.concat(L("/_api/doc/"), text("l_partkey"))

    def clock(at: Column) -> Column:
        return F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    begin = F.concat(clock(start), L(" [6402] DEBUG {requests} \"http-request-begin\","), common, url)
    end = F.concat(
        clock(start + F.col("l_linenumber")), L(" [6402] INFO {requests} \"http-request-end\","), common,
        F.when(F.col("l_returnflag") == "R", "404").otherwise("200"), L(","), text(F.col("l_quantity").cast("bigint")), L(","),
        text("l_extendedprice", "bigint"), L(",\""), url, L("\","), F.col("l_tax").cast("decimal(8,6)").cast("string"),
    )
    noise = F.concat(clock(start), L(" [6402] INFO {general} ready"))
    each = items.select(F.explode(F.array(begin, end, noise)).alias("line"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("o"))
    return lines_from(each, F.col("line"), order=F.col("o"))


def mongo_line() -> Column:
    """Five kinds of lines by event number: command, query, heartbeat, changelog, plain."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    old = F.date_format("ts", "EEE MMM dd HH:mm:ss.SSS")
    user, key = text("user_id"), text("event_id")
    locks = F.concat(L(" locks:{ Global: { acquireCount: { r: "), key, L(", w: 1 } }, Database: { acquireCount: { W: 2 }, timeAcquiringMicros: { w: "), user, L(" } } }"))
    command = F.concat(
        iso, L(" I COMMAND  [conn"), user, L("] command shop."), F.col("event_type"), L(" command: find { find: \""),
        F.col("event_type"), L("\", filter: { user: "), user, L(", kind: \""), F.col("event_type"),
        L("\", _id: ObjectId('c0ffee07') } } planSummary: COLLSCAN keysExamined:"), key, L(" docsExamined:5 numYields:0"), locks,
        L(" protocol:op_command "), user, L("ms"))
    select = F.concat(
        old, L(" [conn"), user, L("] query shop.old.items query: { $query: { tags: { $in: [ \"a\", \"b, c: d\" ] } }, $orderby: { _id: 1 } } ntoreturn:0 nscanned:"),
        key, L(" locks(micros) r:"), key, L(" nreturned:0 reslen:20 "), user, L("ms"))
    beat = F.concat(
        iso, L(" I COMMAND  [conn1] command admin.$cmd command: replSetHeartbeat { replSetHeartbeat: \"rs"),
        text(F.col("event_id") % 3), L("\", from: \"h:1\" } ntoreturn:1 keyUpdates:0 reslen:100 0ms"))
    change = F.concat(
        iso, L(" I SHARDING [conn1] about to log metadata event into changelog: { _id: \"id-"), key,
        L("\", server: \"srv\", clientAddr: \"172.16.9.9:5151\", time: new Date(1942538408250), what: \""), F.col("event_type"),
        L("\", ns: \"Shop.Items\", details: { primary: \"shard0\", numChunks: "), user, L(" } }"))
    broken = F.concat(
        iso, L(" W WRITE    [conn2] update shop.items query: { a: \"left \"open\" [\" } update: { $set: { b: 1 } } nscanned:1 7ms"))
    kind = F.col("event_id") % 5
    return F.when(kind == 0, command).when(kind == 1, select).when(kind == 2, beat).when(kind == 3, change).otherwise(broken)


def mongo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(dealt(events_table(spark, sf_dir)), mongo_line(), order=F.col("event_id"))
