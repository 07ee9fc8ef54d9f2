import pytest
from pyspark.sql import functions as F

from loglake.formats.mongo import carry_replica_set, mongo_events
from loglake.formats.slow_log import fold_entry, fold_parts, mysql_slow_events
from loglake.operators.grouping import (
    carry_forward, group_continuations, group_slow_log, in_file_order,
)
from loglake.operators.lines import split_rejects
from loglake.sources.files import backfill

BANNER = [
    "/opt/db/bin/mysqld, Version: 5.6.1-log (MySQL Community Server (GPL)). started with:",
    "Tcp port: 3306  Unix socket: /tmp/db.sock",
    "Time                 Id Command    Argument",
]


def serial(texts, after_body_only):
    """The rule in plain Python, line by line."""
    out, seen_body = [], False
    for t in texts:
        opens = (t.startswith("# ") or t in BANNER) if after_body_only else not t.startswith("\t")
        if out and (opens and seen_body if after_body_only else opens):
            out.append([])
            seen_body = False
        if not out:
            out.append([])
        seen_body = seen_body or not opens
        out[-1].append(t)
    if after_body_only and out and not seen_body:
        out.pop()
    return out


def collected(entries):
    return [r.lines for r in entries.orderBy("file", "block", "pos").collect()]


SAMPLE = ["body first", "# a", "# b", "", "select 1", "from t;", *BANNER, "# c", "x;", "# d", "y", "z;", "# tail"]


def test_slow_log_entries(lines):
    assert collected(group_slow_log(lines(SAMPLE))) == serial(SAMPLE, True)


def test_continuations(lines):
    texts = ["\torphan", "a", "\tb", "\t\tc", "d", "e", "\tf"]
    assert collected(group_continuations(lines(texts))) == serial(texts, False)


@pytest.mark.parametrize("split, segment", [(1, 1), (1, 3), (2, 2), (3, 8), (7, 1)])
def test_entries_do_not_depend_on_splits(lines, split, segment):
    texts = SAMPLE[:-1] * 3 + ["# open", "never", "ends" * 3, "here"] + SAMPLE
    cut = lines(texts).withColumn("block", F.floor(F.col("pos") / split))
    assert collected(group_slow_log(cut, segment_bytes=segment)) == serial(texts, True)
    assert collected(group_continuations(cut, segment_bytes=segment)) == serial(texts, False)


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_entries_do_not_depend_on_arrow_batches(spark, lines, batch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        two = lines(SAMPLE).unionByName(lines(SAMPLE[1:], "g"))
        expected = serial(SAMPLE, True) + serial(SAMPLE[1:], True)
        assert collected(group_slow_log(two)) == expected
        # Several files in one partition.
        assert collected(group_slow_log(in_file_order(two).coalesce(1))) == expected
    finally:
        spark.conf.set(key, before)


def test_real_files_at_any_split_size(spark, tmp_path):
    entry = ["# Time: 2016-04-01T00:31:09Z", "# Query_time: 1.5", "select {}", "  from t", "where x = 'ü {}';"]
    for n in range(2):
        text = "\n".join(line.format(i, n) for i in range(700) for line in entry)
        (tmp_path / f"slow{n}.log").write_text(text + ("\n" if n else ""))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    seen = []
    try:
        for size in ("2000", "20000", "134217728"):
            spark.conf.set(key, size)
            events, rejects = split_rejects(mysql_slow_events(backfill(spark, str(tmp_path))))
            seen.append(sorted((r.file, r.query) for r in events.select("file", "query").collect()))
            assert rejects.count() == 0
    finally:
        spark.conf.set(key, before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 1400
    assert seen[0][0][1].startswith("select ")


def joined_parts(entries):
    """Lines of every entry, its parts put together."""
    out = {}
    for r in entries.orderBy("file", "block", "pos", "part").collect():
        out.setdefault((r.file, r.block, r.pos), []).append(r)
    for rows in out.values():
        assert [r.part for r in rows] == list(range(len(rows))) and {r.parts for r in rows} == {len(rows)}
    return [[line for r in rows for line in r.lines] for rows in out.values()], max(len(r.lines) for rows in out.values() for r in rows)


@pytest.mark.parametrize("split, batch", [(1000, "10000"), (7, "10000"), (30, "5")])
def test_long_runs_stay_in_bounded_rows(spark, lines, split, batch):
    texts = SAMPLE[:-1] + ["# Time: x"] + [f"body {i}" for i in range(300)] + ["end;"] + SAMPLE[1:] + [f"more {i}" for i in range(200)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        cut = lines(texts).withColumn("block", F.floor(F.col("pos") / split))
        got, longest = joined_parts(group_slow_log(cut, segment_bytes=4, piece_bytes=100))
        assert got == serial(texts, True) and longest <= 30
        got, longest = joined_parts(group_continuations(lines(["a"] + ["\t" + "b" * 30] * 50 + ["c", "\td"]), piece_bytes=100))
        assert got == [["a"] + ["\t" + "b" * 30] * 50, ["c", "\td"]] and longest <= 6
    finally:
        spark.conf.set(key, before)


def folded(entries):
    names = ["reject_reason", "query", "user", "query_time", "database", "_time", "rows_sent"]
    return sorted((tuple(str(r[n]) for n in names) for r in entries.collect()), key=str)


LONG_ENTRIES = [
    "select before any header;", "use shop;", "# Time: 2031-07-19T21:40:08Z", "# User@Host: ada[ada] @ web1 [10.0.0.1]  Id: 7", "# Query_time: 1.5",
    *[f"drop {i}" for i in range(20)], "# Query_time: 2.5  Lock_time: 0.1 Rows_sent: 3  Rows_examined: 4", "use books;", "SET timestamp=1942538408;",
    *[f"first {i};" for i in range(30)], "select", *[f" c{i}," for i in range(40)], "1 from t;", "never closed", "# Time: 2031-07-20T21:40:08Z", "a;",
    "# administrator command: Ping;", *[f"x {i};" for i in range(40)], "# Time: 2031-07-21T21:40:08Z", *[f"open {i}" for i in range(90)],
]


@pytest.mark.parametrize("split, piece", [(1000, 60), (5, 60), (9, 200)])
def test_states_of_parts_fold_like_the_whole(lines, split, piece):
    """Every way of cutting gives the events of the uncut entries, and rejects keep every line."""
    whole = fold_entry(group_slow_log(lines(LONG_ENTRIES)))
    cut = lines(LONG_ENTRIES).withColumn("block", F.floor(F.col("pos") / split))
    parts = fold_entry(group_slow_log(cut, segment_bytes=3, piece_bytes=piece))
    assert folded(parts.filter("reject_reason IS NULL")) == folded(whole.filter("reject_reason IS NULL"))
    texts = [sorted(line for r in f.filter("reject_reason IS NOT NULL").collect() for line in r.value.split("\n")) for f in (parts, whole)]
    assert texts[0] == texts[1] and len(texts[0]) > 100


def test_a_statement_beyond_the_limit_is_rejected_in_parts(lines):
    texts = ["# Time: 2031-07-19T21:40:08Z", *[f"part {i}" for i in range(500)], "end;", "short;", "# Time: 2031-07-19T21:40:08Z", *[f"part {i}" for i in range(500)], "end;"]
    entries = group_slow_log(lines(texts), piece_bytes=200)
    several = entries.filter("parts > 1")
    got = {tuple(r.lines) for r in fold_parts(several, 100, limit=1000).collect()}
    assert {len(lines) for lines in got} <= {3, 4, 5} and max(sum(map(len, g)) for g in got) < 100
    assert {r.query for r in fold_entry(entries).collect()} == {"short", " ".join(texts[1:501]) + " end"}


@pytest.mark.parametrize("bits", [0, 1, 3, 16])
def test_carry_forward(spark, bits):
    values = [None, "a", None, None, None, "b", None, "c", None, None, None, None]
    rows = [("f", i // 5, i, v) for i, v in enumerate(values)] + [("g", 0, 0, None), ("g", 0, 1, "z")]
    df = spark.createDataFrame(rows, "file string, block bigint, pos bigint, v string")
    got = carry_forward(df, F.col("v"), "out", chunk_bits=bits).orderBy("file", "block", "pos").collect()
    assert [r.out for r in got] == [None, "a", "a", "a", "a", "b", "b", "c", "c", "c", "c", "c", None, "z"]


def test_replica_set_is_carried_inside_its_file(spark, lines):
    beat = '2016-09-18T07:20:03.246Z I COMMAND [c] command admin.$cmd command: replSetHeartbeat { replSetHeartbeat: "rs9" } 0ms'
    other = "2016-09-18T07:20:04.246Z I QUERY [c] query a.b query: { x: 1 } 3ms"
    both = lines([other, beat, other]).unionByName(lines([other], "g"))
    got = carry_replica_set(mongo_events(both)).orderBy("file", "pos").collect()
    assert [r.replica_set for r in got] == [None, "rs9", "rs9", None]
