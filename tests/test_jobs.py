import hashlib
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from loglake.config import ConfigError, IngestConfig
from loglake.plans.jobs import run_batch
from loglake.schemas import ACCESS_LOG, MYSQL_SLOW
from loglake.sources.files import file_guard, read_lines
from loglake.sources.tables import conform, read_events, read_rejects, read_table, write_table
from loglake.streaming.ingest import ingest_stream, read_batches, resume_point, run_stream, write_batches
from loglake.streaming.windows import status_window


def config(**changes):
    return IngestConfig(**{"format": "keyval", "paths": ["/x"], "dataset": "d", **changes})


@pytest.mark.parametrize("changes", [
    {"format": ""}, {"paths": []}, {"dataset": ""}, {"sample_rate": 0}, {"read_from": "end", "stop": True}, {"read_from": "middle"},
    {"query_mode": "some"}, {"dynamic_keys": ["a"]}, {"timezone": "Mars/Base"}, {"log_prefix": "("}, {"request_patterns": ["x"]},
])
def test_config_is_checked(changes):
    with pytest.raises(ValueError):
        config(**changes)


def test_config_defaults():
    assert config(backfill=True).read_from == "beginning"
    assert config(format="access_log").request_shape == ["request"]
    assert config(log_prefix="a").log_prefix == "^a"
    assert config(sample_rate=3).line_rate == 3 and config(format="mysql_slow", sample_rate=3).line_rate == 1
    assert config(sample_rate=3, dynamic_keys=["k"]).line_rate == 1
    assert IngestConfig.parse_add_fields(["a=b=c"]) == {"a": "b=c"}
    with pytest.raises(ConfigError):
        IngestConfig.parse_add_fields(["a"])


def test_side_files_are_left_out(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\rstill one\ntwo")
    (tmp_path / "b.log").write_text("\n\nthree\n")
    (tmp_path / "a.log.state").write_text("{}")
    assert sorted(r.value for r in read_lines(spark, str(tmp_path)).collect()) == ["", "", "one\rstill one", "three", "two"]
    raw = spark.read.text(str(tmp_path))
    file_guard(raw, r".*\.state")
    with pytest.raises(FileNotFoundError):
        file_guard(raw, ".*")
    with pytest.raises(FileNotFoundError):
        read_lines(spark, str(tmp_path / "*.state"))


def test_conform_keeps_what_does_not_fit(spark):
    df = spark.createDataFrame([("200", "big", "x", {"status2": "1"})], "status string, body_bytes_sent string, other string, data map<string,string>")
    row = conform(df, ACCESS_LOG).first()
    assert row.status == 200 and row.body_bytes_sent is None
    assert row.extra == {"status2": "1", "body_bytes_sent": "big", "other": "x"}
    assert [f.name for f in MYSQL_SLOW.struct()][:3] == ["_time", "_date", "_ms"] and "startup_options" not in MYSQL_SLOW.fields


def test_date_folders_are_pruned(spark, tmp_path):
    rows = [(datetime(2024, 1, 1 + i % 9, 5), i) for i in range(900)]
    df = spark.createDataFrame(rows, "_time timestamp, n long").withColumn("_date", F.to_date("_time"))
    path = str(tmp_path / "t")
    write_table(df, path)
    write_table(df, path)
    picked = read_table(spark, path, "2024-01-03", "2024-01-04")
    assert picked.count() == 400
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_date" in plan


LOG = ['id={} host=h{} msg="GET /help/en?k={} HTTP/1.1" time="2024-01-0{}T00:00:00Z"'.format(i, i % 2, i, 1 + i % 3) for i in range(30)]


def test_batch_job(spark, tmp_path):
    (tmp_path / "in.log").write_text("\n".join(LOG + ["a=", 'b="']))
    cfg = IngestConfig(
        "keyval", [str(tmp_path / "in.log")], str(tmp_path / "out"), drop_fields=["id"], scrub_fields=["host"], add_fields={"env": "t"},
        request_shape=["msg"], request_patterns=["/help/:lang"], query_keys=["k"], timezone="UTC")
    run_batch(spark, cfg)
    rejects = read_rejects(spark, str(tmp_path / "out")).collect()
    assert sorted((r.reject_reason, r.value) for r in rejects) == [("empty", "a="), ("quote", 'b="')]
    rows = read_events(spark, str(tmp_path / "out")).collect()
    assert len(rows) == 30
    assert all(r.msg_shape == "/help/:lang?k=?" and r.msg_path_lang == "en" and r.data["env"] == "t" for r in rows)
    assert all("id" not in r.data and len(r.data["host"]) == 64 and r.sample_rate == 1 for r in rows)


def test_dynamic_batch_job(spark, tmp_path):
    (tmp_path / "in.log").write_text("\n".join(LOG + ["a="]))
    cfg = IngestConfig("keyval", [str(tmp_path / "in.log")], str(tmp_path / "out"), sample_rate=2, dynamic_keys=["host"])
    run_batch(spark, cfg)
    assert read_rejects(spark, str(tmp_path / "out")).count() == 1
    rows = read_events(spark, str(tmp_path / "out")).collect()
    assert 0 < len(rows) <= 30 and {r.sample_key for r in rows} <= {"h0", "h1"}


def test_stream_gives_what_a_batch_gives_and_resumes(spark, tmp_path):
    source, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    entry = "# Time: 2031-07-0{}T21:40:08Z\n# Query_time: {}\nselect {},\n 2;\n"
    for n in range(3):
        (source / f"{n}.log").write_text("".join(entry.format(1 + i % 5, i, i) for i in range(40)))
    cfg = dict(format="mysql_slow", paths=[str(source)], dataset=out, checkpoint=state, stop=True, max_files_per_trigger=2)
    run_stream(spark, IngestConfig(**cfg)).awaitTermination()
    assert read_batches(spark, out).count() == 120
    (source / "3.log").write_text(entry.format(1, 7, 7))
    run_stream(spark, IngestConfig(**cfg)).awaitTermination()
    run_stream(spark, IngestConfig(**cfg)).awaitTermination()
    rows = read_batches(spark, out)
    assert rows.count() == 121 and rows.filter("query = 'select 7, 2'").count() == 4


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    source, out = tmp_path / "src", str(tmp_path / "out")
    source.mkdir()
    (source / "a.log").write_text("x\ny\n")

    def parse(ordered):
        return ordered.withColumn("_date", F.lit("2024-01-01").cast("date")).withColumn("_time", F.current_timestamp())

    def run(state):
        write_batches(ingest_stream(spark, str(source)), parse, out, str(tmp_path / state), once=True).awaitTermination()

    run("one")
    for left in (tmp_path / "one" / "commits").glob("*0*"):
        left.unlink()  # as if the driver was lost before the batch was marked done
    run("one")
    assert read_batches(spark, out).count() == 2
    run("two")
    assert read_batches(spark, out).count() == 4


def test_a_stream_reads_all_its_paths(spark, tmp_path):
    for name in ("left", "right"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.log").write_text(f"side={name} n=1\n")
    cfg = dict(format="keyval", paths=[str(tmp_path / "left"), str(tmp_path / "right")], checkpoint=str(tmp_path / "c"), stop=True)
    run_stream(spark, IngestConfig(dataset=str(tmp_path / "out"), **cfg), F.lit("2031-02-03").cast("timestamp")).awaitTermination()
    rows = read_batches(spark, str(tmp_path / "out")).collect()
    assert sorted(r.data["side"] for r in rows) == ["left", "right"]
    assert {str(r._date) for r in rows} == {"2031-02-03"}
    with pytest.raises(ValueError):
        run_stream(spark, IngestConfig(dataset=str(tmp_path / "out"), read_from="beginning", **cfg))


def test_dynamic_sampling_keeps_rows_without_a_time(spark, tmp_path):
    (tmp_path / "in.log").write_text("".join(f"host=h{i % 3}\n" for i in range(50)))
    cfg = IngestConfig("keyval", [str(tmp_path / "in.log")], str(tmp_path / "out"), sample_rate=4, dynamic_keys=["host"])
    run_batch(spark, cfg)
    assert {r.sample_rate for r in read_events(spark, str(tmp_path / "out")).collect()} == {1}
    assert read_events(spark, str(tmp_path / "out")).count() == 50


PREFIXED = {
    "mongo": ["2031-05-06T07:08:09.123+0000 I NETWORK [listener] waiting"],
    "arango": ['2031-05-06T07:08:09Z [77] DEBUG {requests} "req","0xb0","10.9.8.7","PUT","HTTP/1.1",/w'],
    "mysql_audit": ['{"audit_record":{"timestamp":"2031-05-06T07:08:09 UTC","user":"ada"}}'],
}


@pytest.mark.parametrize("name", sorted(PREFIXED))
def test_prefix_fields_are_stored(spark, tmp_path, name):
    (tmp_path / "in.log").write_text("".join(f"rack-9 {t}\n" for t in PREFIXED[name]))
    run_batch(spark, IngestConfig(name, [str(tmp_path / "in.log")], str(tmp_path / "out"), log_prefix=r"(?P<rack>rack-\d+) "))
    row = read_events(spark, str(tmp_path / "out")).first()
    assert row.extra["rack"] == "rack-9"


def test_a_number_field_keeps_text_that_is_no_number(spark, tmp_path):
    (tmp_path / "in.log").write_text("10.0.0.9 abc 0.1, 0.2;\n10.0.0.9 204 0.3;\n")
    cfg = IngestConfig("access_log", [str(tmp_path / "in.log")], str(tmp_path / "out"),
                       format_options={"log_format": "$remote_addr $status $upstream_response_time;"})
    run_batch(spark, cfg)
    extras = [r.extra for r in read_events(spark, str(tmp_path / "out")).collect()]
    assert sorted(e.get("status", "") for e in extras) == ["", "abc"]
    assert sorted(e["upstream_response_time"] for e in extras) == ["0.1, 0.2", "0.3"]


def test_a_number_that_is_no_time_stays_a_field(spark, tmp_path):
    (tmp_path / "in.log").write_text("a=x time=5\n")
    run_batch(spark, IngestConfig("keyval", [str(tmp_path / "in.log")], str(tmp_path / "out")))
    assert read_events(spark, str(tmp_path / "out")).first().data == {"a": "x", "time": "5"}


@pytest.mark.parametrize("name,line", [("json", '{"value":"v","pos":7,"n":{"k":1}}'), ("keyval", "value=v pos=7 n=1")])
def test_scrub_and_drop_take_event_fields_only(spark, tmp_path, name, line):
    bad = "{" if name == "json" else "="
    (tmp_path / "in.log").write_text(f"{line}\n{bad}\n")
    cfg = IngestConfig(name, [str(tmp_path / "in.log")], str(tmp_path / "out"), drop_fields=["value"], scrub_fields=["pos", "n"])
    run_batch(spark, cfg)
    row = read_events(spark, str(tmp_path / "out")).first()
    held = {k: str(v).strip('"') if name == "keyval" else v.toPython() for k, v in row.data.items()}
    assert set(held) == {"pos", "n"} and held["pos"] == hashlib.sha256(b"7").hexdigest()
    assert read_rejects(spark, str(tmp_path / "out")).first().value == bad


def test_reading_from_the_end_skips_old_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("old\n")
    later = datetime(2100, 1, 1, tzinfo=timezone.utc)
    for since, n in ((later, 0), (datetime(2000, 1, 1, tzinfo=timezone.utc), 1)):
        lines = ingest_stream(spark, str(tmp_path), "end", since)
        query = lines.writeStream.format("memory").queryName(f"end_{n}").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(f"end_{n}").count() == n
    assert resume_point("/c", "last") == "/c" and resume_point("/c", "beginning") == "/c/beginning"


def test_status_interval_zero_is_off(spark):
    assert status_window(None, "d", 0) is None


JOBS = {
    "json": (['{"a":1,"time":"2024-01-01T00:00:00Z","o":{"x":[1]}}', "{"], {}),
    "keyval": (['a=1 time="2024-01-01T00:00:00Z"', "="], {}),
    "regex": (["2024-01-01T00:00:00Z word", "!"], {"patterns": [r"(?P<time>\S+Z) (?P<w>\w+)"]}),
    "access_log": (['10.1.1.1 [19/Jul/2031:21:40:08 +0000] "GET /carts?open=1 HTTP/1.1" 206', "x"],
                   {"log_format": '$remote_addr [$time_local] "$request" $status'}),
    "mysql_slow": (["# Time: 2031-07-19T21:40:08Z", "# Query_time: 3", "select 6;", "# administrator command: Ping;", "a;"], {}),
    "mysql_audit": (['{"audit_record":{"timestamp":"2031-07-19T21:40:08 UTC","user":"ada","more":"1"}}', "{}"], {}),
    "postgres": (["2031-07-19 21:40:08 UTC [31-2] ada@shop LOG:  duration: 14.5 ms  statement: select 6", "\t;", "2031 x"], {}),
    "mongo": (["2031-07-19T21:40:08.016+0000 I COMMAND [conn5] command shop.cart command: find { find: \"cart\", filter: { paid: false } } locks:{ Global: { acquireCount: { r: 4 } } } 61ms", "x"], {}),
    "arango": (['2031-07-19T21:40:08Z [88] DEBUG {requests} "start","0xc4","10.1.1.1","PATCH","HTTP/1.1",/carts', "x"], {}),
}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_every_format_as_a_job(spark, tmp_path, name):
    texts, options = JOBS[name]
    (tmp_path / "in.log").write_text("\n".join(texts) + "\n")
    out = str(tmp_path / "out")
    run_batch(spark, IngestConfig(name, [str(tmp_path / "in.log")], out, format_options=options, add_fields={"zone": "z1"}))
    events, rejects = read_events(spark, out), read_rejects(spark, out)
    assert events.count() == 1 and rejects.count() == 1
    row = events.first()
    assert row._time is not None and row._date == row._time.date()
    assert rejects.first().reject_reason


def test_joins_without_broadcast_agree(spark):
    import os

    import __spark_entry__ as entry_points

    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    key = "spark.sql.autoBroadcastJoinThreshold"
    seen = {}
    for limit in ("10485760", "-1"):
        spark.conf.set(key, limit)
        try:
            for name in ("enrich_host", "dynamic_sample", "lifetime_totals", "carry_replica_set", "slow_query_digest"):
                rows = sorted(str(r) for r in entry_points.queries()[name](spark, sf_dir).collect())
                assert seen.setdefault(name, rows) == rows
        finally:
            spark.conf.unset(key)


def test_promoted_fields_are_columns(spark, tmp_path):
    (tmp_path / "in.log").write_text("size=12 Size=3 name=box\nsize=big name=bag\n")
    run_batch(spark, IngestConfig("keyval", [str(tmp_path / "in.log")], str(tmp_path / "out"), promote_fields={"size": "bigint", "Size": "bigint"}))
    rows = {r.data["name"]: r for r in read_events(spark, str(tmp_path / "out")).collect()}
    assert (rows["box"].size, rows["box"].data) == (12, {"Size": "3", "name": "box"})
    assert (rows["bag"].size, rows["bag"].data["size"]) == (None, "big")


def test_types_widen_over_batches_and_reads_are_pruned(spark, tmp_path):
    from loglake.sources.evolving import field_types, read_typed

    out = str(tmp_path / "out")
    for name, lines in (("a", "n=1 t=true k=007\nn=2 t=false k=8\n"), ("b", "n=1.50 t=7 k=x\nn=3 t=1 k=\n"), ("c", "n=5 t=true\n")):
        (tmp_path / f"{name}.log").write_text(lines)
        run_batch(spark, IngestConfig("keyval", [str(tmp_path / f"{name}.log")], out, promote_share=0.5))
    assert field_types(spark, out) == {"n": "double", "t": "string", "k": "string"}
    rows = read_typed(spark, out, ["n", "t", "k"]).collect()
    assert sorted((r.n, r.t, r.k) for r in rows if r.k) == [(1.0, "true", "007"), (1.5, "7", "x"), (2.0, "false", "8")]
    plan = read_typed(spark, out, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "fields:struct<n:struct<l:bigint,d:double>>" in plan and "data" not in plan.split("ReadSchema")[1]


def test_a_failed_job_shows_nothing(spark, tmp_path):
    (tmp_path / "in.log").write_text("a=1\n")
    out = str(tmp_path / "out")
    run_batch(spark, IngestConfig("keyval", [str(tmp_path / "in.log")], out))
    lost = tmp_path / "out" / "_run=batch-lost" / "_batch=0" / "_outcome=ok" / "_date=__HIVE_DEFAULT_PARTITION__"
    lost.mkdir(parents=True)
    part = next((tmp_path / "out").glob("_run=batch-*/_batch=0/_outcome=ok/*/*.parquet"))
    (lost / part.name).write_bytes(part.read_bytes())
    assert read_events(spark, out).count() == 1


def test_staged_tables_of_a_job_are_emptied(spark, tmp_path):
    from loglake.session import shared_dir

    (tmp_path / "in.log").write_text("# Time: 2031-07-19T21:40:08Z\n# Query_time: 3\nselect 6;\n" * 3)
    before = set(os.listdir(shared_dir(spark)))
    run_batch(spark, IngestConfig("mysql_slow", [str(tmp_path / "in.log")], str(tmp_path / "out")))
    new = {f for f in set(os.listdir(shared_dir(spark))) - before if f.startswith("batch-")}
    assert len(new) == 1 and read_events(spark, str(tmp_path / "out")).count() == 3
    for folder in os.listdir(f"{shared_dir(spark)}/{new.copy().pop()}"):
        assert spark.read.parquet(f"{shared_dir(spark)}/{next(iter(new))}/{folder}").isEmpty()


def test_plans_of_statements_and_hosts(spark, tmp_path):
    """One scan of the log for statements; the as-of join reads its events once."""
    from loglake.formats.slow_log import mysql_slow_events
    from loglake.operators.hosts import enrich_host
    from loglake.sources.files import backfill

    (tmp_path / "in.log").write_text("# Time: 2031-07-19T21:40:08Z\n# User@Host: a[a] @ b []\nselect 6;\n" * 3)
    events = mysql_slow_events(backfill(spark, str(tmp_path / "in.log")))
    assert "FileScan text" not in events._jdf.queryExecution().executedPlan().toString()
    status = spark.createDataFrame([("a", datetime(2031, 7, 1), "h")], "host string, at timestamp, role string")
    rows = spark.read.text(str(tmp_path / "in.log")).select(F.lit("a").alias("host"), F.lit(datetime(2031, 7, 19)).alias("_time"), "value")
    joined = enrich_host(rows, status, fields=["role"])
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        assert {r.role for r in joined.collect()} == {"h"}
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset(key)
    assert plan.count("FileScan text") == 1 and "ReusedExchange" in plan


def test_other_variables_of_an_access_log_are_typed(spark, tmp_path):
    from loglake.sources.evolving import field_types, read_typed

    lines = ["10.0.0.9 2031-07-19T21:40:08Z 200 5 0.25 5.1.0 -;", "10.0.0.8 2031-07-19T21:40:09Z 404 -7 4 5.2 -;"]
    (tmp_path / "in.log").write_text("\n".join(lines) + "\n")
    cfg = IngestConfig("access_log", [str(tmp_path / "in.log")], str(tmp_path / "out"), promote_share=0.5,
                       format_options={"log_format": "$remote_addr $timestamp $status $upstream_status $upstream_time $version $gone;"})
    run_batch(spark, cfg)
    types = field_types(spark, str(tmp_path / "out"))
    assert {k: types[k] for k in ("upstream_status", "upstream_time", "version")} == {"upstream_status": "bigint", "upstream_time": "double", "version": "string"}
    rows = read_typed(spark, str(tmp_path / "out"), ["upstream_status", "upstream_time", "version"]).collect()
    assert sorted((r.upstream_status, r.upstream_time, r.version) for r in rows) == [(-7, 4.0, "5.2"), (5, 0.25, "5.1.0")]
    assert {str(r._time) for r in read_events(spark, str(tmp_path / "out")).collect()} == {"2031-07-19 21:40:08", "2031-07-19 21:40:09"}
