from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglake.formats.access_log import access_log_events
from loglake.formats.arango import arango_requests, pair_requests
from loglake.formats.audit_log import mysql_audit_events
from loglake.formats.free_text import regex_events
from loglake.formats.json_lines import json_events, json_schema
from loglake.formats.keyval import keyval_events
from loglake.formats.mongo import flatten_locks, mongo_events
from loglake.formats.postgres import compile_prefix, postgres_slow_events
from loglake.formats.registry import get_format, register_format
from loglake.formats.slow_log import mysql_slow_events
from loglake.functions.regexes import PatternError
from loglake.operators.lines import split_rejects


def one(parsed):
    return parsed.orderBy("pos").collect()[0]


# ---- slow log

CLOCK = "SET timestamp=1942538408;"
T_CLOCK = datetime(2031, 7, 23, 2, 0, 8)


@pytest.mark.parametrize("texts, expected", [
    (["# Schema: depot  Last_errno: 1205  Killed: 0", "delete from crates where id = 9;"],
     {"schema": "depot", "error_num": 1205, "killed": 0, "query": "delete from crates where id = 9", "tables": "crates"}),
    (["# User@Host: ada[ada] @ gateway7 [192.168.44.5]  Id:  318", "call refill();"],
     {"user": "ada", "client": "gateway7 [192.168.44.5]", "connection_id": 318}),
    (["# User@Host: eve[eve] @  [172.16.9.9]", "call refill();"], {"user": "eve", "client": "[172.16.9.9]", "connection_id": None}),
    ([CLOCK, "use depot;"], {"database": "depot", "query": "use depot", "normalized_query": "use depot", "statement": None, "_time": T_CLOCK}),
    ([CLOCK, "USE `night shift`;", "UPDATE crates", "SET weight = 4;"], {"database": "night shift", "query": "UPDATE crates SET weight = 4"}),
    ([CLOCK, "INSERT INTO x", "use y;", "TRUNCATE crates;"], {"database": "y", "query": "TRUNCATE crates"}),
    ([CLOCK, "CALL a();", "SET timestamp=1942538409;", "CALL b();"], {"query": "CALL b()", "_time": datetime(2031, 7, 23, 2, 0, 9)}),
    (["# Time: 2031-07-23T02:00:08.250125Z", "/* batch 12 */ select /* hint */ 3;"],
     {"comments": "/* batch 12 */ /* hint */", "_time": datetime(2031, 7, 23, 2, 0, 8, 250125)}),
    (["# Time: 2031-07-23T18:44:00.250125Z", CLOCK, "commit;"], {"_time": datetime(2031, 7, 23, 2, 0, 8, 250125)}),
    (["# Time: whenever", CLOCK, "show variables like 'a%';"], {"normalized_query": "show variables like ?", "_time": T_CLOCK}),
    (["# Time: 072331 02:00:08.75", "commit;"], {"_time": datetime(2031, 7, 23, 2, 0, 8, 750000)}),
    (["# Time: 310723  9:05:01", "commit;"], {"_time": datetime(2030, 1, 1)}),
    (["# Query_time: 0.75 Lock_time: 0.125 Rows_sent: 6 Rows_examined: 7 Rows_affected: 8 Rows_read: 5", "commit;"],
     {"query_time": 0.75, "lock_time": 0.125, "rows_sent": 6, "rows_examined": 7, "rows_affected": 8}),
    (["# Query_time: 3.25", "commit;"], {"query_time": 3.25, "lock_time": None}),
    (["# Query_time: 2.0  Lock_time: 0.25 Rows_sent: 4  Rows_examined: 9", "# Query_time: 4.5", "commit;"], {"query_time": 4.5, "lock_time": 0.25}),
    (["# Bytes_sent: 901  Tmp_tables: 4  Tmp_disk_tables: 3  Tmp_table_sizes: 77", "# InnoDB_trx_id: 9F03",
      "# QC_Hit: No  Full_scan: Yes  Full_join: No  Tmp_table: Yes  Tmp_table_on_disk: No",
      "# Filesort: No  Filesort_on_disk: Yes  Merge_passes: 6",
      "#   InnoDB_IO_r_ops: 11  InnoDB_IO_r_bytes: 12  InnoDB_IO_r_wait: 0.25",
      "#   InnoDB_rec_lock_wait: 0.5  InnoDB_queue_wait: 0.75", "#   InnoDB_pages_distinct: 31",
      "# Log_slow_rate_type: session  Log_slow_rate_limit: 25", "commit;"],
     {"bytes_sent": 901, "tmp_tables": 4, "tmp_disk_tables": 3, "tmp_table_sizes": 77, "transaction_id": "9F03", "query_cache_hit": False,
      "full_scan": True, "full_join": False, "tmp_table": True, "tmp_table_on_disk": False, "filesort": False, "filesort_on_disk": True,
      "merge_passes": 6, "IO_r_ops": 11, "IO_r_bytes": 12, "IO_r_wait_sec": 0.25, "rec_lock_wait_sec": 0.5, "queue_wait_sec": 0.75,
      "pages_distinct": 31, "sl_rate_type": "session", "sl_rate_limit": 25}),
    ([CLOCK, "", "  DELETE\t", "   FROM crates WHERE  ", "", "\tweight < 8;", ""],
     {"query": "DELETE FROM crates WHERE  weight < 8", "normalized_query": "delete from crates where weight < ?"}),
    (["replace crates;"], {"query": "replace crates"}),
])
def test_slow_log_entry(lines, texts, expected):
    row = one(mysql_slow_events(lines(texts), F.lit("2030-01-01").cast("timestamp")))
    assert {k: row[k] for k in expected} == expected
    assert row.reject_reason is None


def test_a_closed_statement_survives_a_reset_inside_its_entry(spark):
    from loglake.formats.slow_log import fold_entry

    texts = ["# Time: 2016-04-01T00:31:09Z", "SELECT 1;", "# Query_time: 0.5", "# User@Host: a @ b", "not closed"]
    entry = spark.createDataFrame([("f", 0, 0, texts)], "file string, block bigint, pos bigint, lines array<string>")
    assert fold_entry(entry).first().query == "SELECT 1"
    both = spark.createDataFrame([("f", 0, 0, [*texts, "SELECT 2;"])], entry.schema)
    assert fold_entry(both).first().query == "not closed SELECT 2"


@pytest.mark.parametrize("texts, reason", [
    (["# administrator command: Ping;", "SELECT 1;"], "ping"),
    (["# Time: 2016-04-01T00:31:09Z", "SELECT * FROM o"], "no query"),
])
def test_slow_log_rejects(lines, texts, reason):
    row = one(mysql_slow_events(lines(texts)))
    assert row.reject_reason == reason and row.value == "\n".join(texts)


def test_sampling_keeps_whole_statements(lines):
    texts = [t for i in range(400) for t in (f"# Query_time: {i}", "select a,", f"b{i};")]
    kept = mysql_slow_events(lines(texts), rate=4, seed=11).collect()
    assert 60 < len(kept) < 140
    assert all(r.query == f"select a, b{int(r.query_time)}" and r.sample_rate == 4 for r in kept)


# ---- the other formats

def test_json(lines):
    texts = [' {"s":"x","n":3,"f":4.25,"arr":[1],"Time":"2014-04-10T19:57:38Z","S":"y"} ', '{"s":', "[1]", "null", '{"a":1,"a":2}', '{"time": 5}']
    rows = json_events(lines(texts), F.lit("2020-01-01").cast("timestamp")).orderBy("pos").collect()
    assert [r.reject_reason for r in rows] == [None, "json", "json", "json", None, None]
    first = rows[0]
    assert first._time == datetime(2014, 4, 10, 19, 57, 38) and "Time" not in first.data
    assert {k: v.toPython() for k, v in first.data.items()}["S"] == "y"
    assert {k: v.toPython() for k, v in rows[4].data.items()} == {"a": 2}
    assert rows[5].time_source == "ingest"


def test_json_prefix_overrides_and_schema(lines):
    parsed = json_events(lines(['host7 {"host":"inner","n":1}']), prefix=r"(?P<host>\w+) ")
    assert {k: v.toPython() for k, v in one(parsed).data.items()} == {"host": "host7", "n": 1}
    assert "n: BIGINT" in json_schema(lines(['{"n":1}', '{"n":2,"m":"x"}'])).first().schema


def test_keyval(lines):
    texts = [r's="x \"q\" \\ y" i=3 f=4.5 b=true bare dup=1 dup=2 e=', "", "one two=", 'a="open', "t=1 time=\"2014-04-10T19:57:38Z\""]
    rows = keyval_events(lines(texts)).orderBy("pos").collect()
    assert rows[0].data == {"s": 'x "q" \\ y', "i": "3", "f": "4.5", "b": "true", "bare": "", "dup": "2", "e": ""}
    assert [r.reject_reason for r in rows] == [None, "no fields", "empty", "quote", None]
    assert rows[4]._time == datetime(2014, 4, 10, 19, 57, 38) and rows[4].data == {"t": "1"}


@pytest.mark.parametrize("regex, invert, kept", [("nope", False, 0), ("k=", False, 3), ("k=1", False, 1), ("k=1", True, 2)])
def test_keyval_filter(lines, regex, invert, kept):
    assert keyval_events(lines(["k=1", "k=2", "k=3"]), filter_regex=regex, invert_filter=invert).count() == kept


def test_regex_first_pattern_wins(lines):
    patterns = [r"(?P<year>\d{4})-(?P<month>\d\d)", r"(?P<word>[a-z]+)"]
    rows = regex_events(lines(["at 2020-11 and 2021-12", " abc def", "!!"]), patterns).orderBy("pos").collect()
    assert [r.data for r in rows] == [{"year": "2020", "month": "11"}, {"word": "abc"}, {}]
    assert rows[2].reject_reason == "no match"
    with pytest.raises(PatternError):
        regex_events(lines(["x"]), [])
    with_prefix = regex_events(lines(["h1: !!"]), [r"(?P<w>[a-z]{3})"], prefix=r"(?P<host>\w+): ")
    assert one(with_prefix).data == {"host": "h1"} and one(with_prefix).reject_reason is None


def test_access_log(lines):
    text = "edge-3 | 172.16.9.9 GET /crates 23/Jul/2031:04:00:08 +0200 503 0 1.25 - "
    layout = "$remote_addr $request_method $uri $time_local $status $body_bytes_sent $request_time $remote_user "
    # The time holds a blank, so a stop character of its own is needed.
    layout = layout.replace("$time_local ", "<$time_local> ")
    text = text.replace("23/Jul/2031:04:00:08 +0200", "<23/Jul/2031:04:00:08 +0200>")
    parsed = access_log_events(lines([text, "no access at all"]), layout, prefix=r"^(?P<edge>[a-z]+-\d) \| ")
    row, other = parsed.orderBy("pos").collect()
    assert (row._time, row.edge, row.status, row.body_bytes_sent, row.request_time) == (T_CLOCK, "edge-3", 503, 0, 1.25)
    assert (row.remote_addr, row.uri, row.remote_user) == ("172.16.9.9", "/crates", None)
    assert other.reject_reason == "format" and other._time is None


def test_audit(lines):
    texts = [
        "no json", '{"other":{}}', '{"audit_record":{"user":""}}', '{"audit_record":{"user":"eve"}}',
        '{"audit_record":{"user":"eve","status":1205,"connection_id":"318","tags":{"a":2},"timestamp":"2031-07-23T02:00:08 UTC"}}',
    ]
    rows = mysql_audit_events(lines(texts)).orderBy("pos").collect()
    assert [r.reject_reason for r in rows] == ["json", "record", "empty", "time", None]
    row = rows[4]
    assert (row._time, row.connection_id, row.status, row.user, row.extra) == (T_CLOCK, 318, 1205, "eve", {"tags": '{"a":2}'})


def test_postgres(lines):
    texts = [
        "2031-07-23 02:00:07 UTC [40-1] LOG:  checkpoint starting",
        '2031-07-23 02:00:08.625 UTC [41-7] ada@depot (9/12) (nightly)LOG:  duration: 18.5 ms  statement: update "Crates"',
        "\tset note = E'x\\t'", "\t  where id = 5;",
        "1942538408000 [9-9] y",
    ]
    rows = postgres_slow_events(lines(texts), "%m [%p-%l] %q%u@%d (%v) (%a)").orderBy("pos").collect()
    assert [r.reject_reason for r in rows] == ["not a statement", None, "not a statement"]
    row = rows[1]
    assert (row.duration, row.pid, row.session_line_number, row.user, row.database) == (18.5, 41, 7, "ada", "depot")
    assert (row.virtual_transaction_id, row.application, row._time) == ("9/12", "nightly", datetime(2031, 7, 23, 2, 0, 8, 625000))
    assert row.query == "update \"Crates\" set note = E'x\\t' where id = 5;"
    assert row.normalized_query == "update ? set note = e? where id = ?;"


def test_postgres_unix_time_and_execute(lines):
    text = "1942538408375 [77-2] eve@depot LOG:  duration: 3.5 ms  execute plan_4: DELETE FROM crates WHERE weight>$3"
    row = one(postgres_slow_events(lines([text]), "%n [%p-%l] %u@%d"))
    assert row._time == datetime(2031, 7, 23, 2, 0, 8, 375000) and row.normalized_query == "delete from crates where weight>$?"


def test_prefix_percent_is_read_left_to_right():
    assert compile_prefix("%%d%u") == r"%d(?P<user>\S+)"


def test_mongo_shapes(lines):
    texts = [
        "three plain words",
        "Wed Jul 23 02:00:08.500 [conn8] query depot.night.crates query: { note: { $exists: false } } locks(micros) w:45 W:9 nreturned:2 12ms",
        'Wed Jul 23 02:00:08.500 I COMMAND  [conn8] command depot.$cmd command: delete { delete: "crates", deletes: [ { q: { row: 7, bay: { $gt: 2 } }, limit: 0 } ] } 3ms',
        "2031-07-23T02:00:08.500Z W STORAGE [ttl] disk almost full",
        '2031-07-23T02:00:08.500+0000 I COMMAND [conn8] command depot.crates command: find { find: "crates", filter: { $where: "this.row < this.bay" } } keysExamined:8 40ms',
        '2031-07-23T04:00:08.500+0200 I COMMAND [conn8] command depot.crates command: findAndModify { findAndModify: "crates", query: { bay: 3, row: "b" }, '
        "update: { $inc: { seen: 1 } }, new: true } planSummary: COLLSCAN update: { $inc: { seen: 1 } } nModified:6 "
        "locks:{ Collection: { acquireCount: { r: 5 }, acquireWaitCount: { r: 2 }, timeAcquiringMicros: { r: 640 } } } protocol:op_msg 212ms",
        "2031-07-23T02:00:08.500+0000 I QUERY [conn8] getmore keyUpdates:0 locks:{ Global: { acquireCount: { w: 1 } } } 1ms",
    ]
    now = F.lit("2031-09-01").cast("timestamp")
    rows = mongo_events(lines(texts), now).orderBy("pos").collect()
    at = datetime(2031, 7, 23, 2, 0, 8, 500000)
    assert rows[0].reject_reason == "header" and all(r._time == at for r in rows[1:])
    assert rows[2].normalized_query == '{ "deletes": [ { "$limit": 1, "$query": { "bay": { "$gt": 1 }, "row": 1 } } ] }'
    assert rows[3].message == "disk almost full" and rows[3].severity == "warning"
    assert rows[4].query is None and rows[4].counters == {"keysExamined": 8.0}
    assert rows[5].normalized_query == '{ "bay": 1, "row": 1 }' and rows[5].counters["nModified"] == 6.0
    assert rows[6].operation == "getmore" and rows[6].namespace is None and rows[6].duration_ms == 1.0
    locks = {(r.pos, r.lock): r.n for r in flatten_locks(mongo_events(lines(texts), now)).collect()}
    assert locks[(5, "collection_read_lock_wait_us")] == 640 and locks[(5, "collection_read_lock_wait")] == 2
    assert locks[(1, "write_lock_held_us")] == 45 and locks[(1, "exclusive_lock_held_us")] == 9


def test_mongo_partials(lines):
    broken = '2031-07-23T02:00:08.500Z E WRITE [conn8] insert depot.crates query: { note: "left "open" [" } nInserted:1 9ms'
    assert one(mongo_events(lines([broken]))).reject_reason == "body"
    kept = one(mongo_events(lines([broken]), log_partials=True))
    assert kept.reject_reason is None and kept.partial and kept.severity == "error"


def test_arango(lines):
    begin = '2031-07-23T02:00:0{}Z [88] DEBUG {{requests}} "start","0xc4","172.16.9.9","PATCH","HTTP/1.1",/crates/{}'
    end = '2031-07-23T02:00:0{}Z [88] WARNING {{requests}} "done","0xc4","172.16.9.9","PATCH","HTTP/1.1",{},31,8,"/crates/{}",0.5'
    texts = [
        "far too short", "2031-07-23T02:00:01Z [88] INFO {startup} a,b", '2031-07-23T02:00:01Z [88] WARNING {requests} "done","0xc4"',
        end.format(0, 404, 0), begin.format(1, 1), end.format(3, 202, 1), begin.format(4, 2), end.format(8, 409, 2),
    ]
    parsed = arango_requests(lines(texts))
    rows = parsed.orderBy("pos").collect()
    assert [r.reject_reason for r in rows] == ["words", "topic", "fields"] + [None] * 5
    assert (rows[4].pid, rows[4].id, rows[4].fullURL, rows[4].responseCode) == ("88", "0xc4", "/crates/1", None)
    assert (rows[5].responseCode, rows[5].reqBodyLen, rows[5].resBodyLen, rows[5].totalTime) == (202, 31, 8, 0.5)
    # One row for each use of the id; the first end has no begin.
    pairs = pair_requests(split_rejects(parsed)[0]).orderBy("end_time").collect()
    assert [(p.n_begin, p.n_end, p.responseCode, p.fullURL) for p in pairs] == [
        (0, 1, 404, "/crates/0"), (1, 1, 202, "/crates/1"), (1, 1, 409, "/crates/2")]
    assert [(p.end_time - p.begin_time).seconds for p in pairs[1:]] == [2, 4]


def test_registry():
    fn = lambda lines: lines
    register_format("mine", fn, replace=True)
    assert get_format("mine") is fn
    with pytest.raises(ValueError):
        register_format("mine", fn)
    with pytest.raises(KeyError):
        get_format("nothing")
