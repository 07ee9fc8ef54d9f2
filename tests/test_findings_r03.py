"""What the review of round 3 found, on small tables."""

import os
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from loglake.catalog import base, job_queries, queries, render
from loglake.formats.arango import pair_requests
from loglake.formats.mongo import mongo_events
from loglake.formats.slow_log import fold_entry
from loglake.functions.documents import balanced
from loglake.functions.sqltext import normalize
from loglake.functions.text import unbracket, unquote
from loglake.functions.times import ISO_LOCAL, TimeFormat, first_time, plain_time
from loglake.llm import lang_id, near_dup, segment_sampling
from loglake.llm.pieces import PieceTable, load
from loglake.sources.tables import TASK_BYTES_KEY, write_table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_a_filter_on_a_parsed_document_copies_no_parse(spark, lines):
    # the filter held the whole parse many times over, once for each branch of the query document.
    events = mongo_events(lines(["2024-01-01T00:00:00.000+0000 I COMMAND  [conn1] command shop.a command: find { find: \"a\", filter: { k: 1 } } 3ms"]))
    shaped = events.filter(F.col("normalized_query").isNotNull()).select("normalized_query")
    plan = shaped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson(") <= 8
    assert [r[0] for r in shaped.collect()] == ['{ "k": 1 }']


def test_braces_of_any_depth(first):
    # Shallow documents are read by one pattern, deep ones are counted.
    deep = "{ a: " * 12 + '"}"' + " }" * 12
    got = first(balanced, deep + " rest } {", '{ a: "{" } x', "{ a: { b: 1 }", "a { }", '{ "q" open" }', "{}}")
    assert got == [deep, '{ a: "{" }', None, None, '{ "q" open" }', "{}"]


def test_rotated_files_are_made_without_shuffling_texts(spark, monkeypatch):
    # every line was shuffled and sorted twice for each of the three parts.
    plans = []
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path: plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(job_queries, "ingest_stream", lambda *_: (_ for _ in ()).throw(KeyError("written")))
    with pytest.raises(KeyError):
        queries()["group_over_rotation"](spark, SF_DIR)
    assert len(plans) == 2
    for plan in plans:
        assert "Window" in plan and "Generate" not in plan and "RepartitionByExpression" not in plan


def test_a_task_that_lays_out_a_date_sorts_few_rows(spark, tmp_path):
    # rows of one date, small when shuffled, were unpacked and sorted by one task.
    before = spark.conf.get(TASK_BYTES_KEY, None)
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(6)])
    rows = spark.range(0, 60_000, 1, 8).select("id", text.alias("text"), F.timestamp_seconds("id").alias("_time"), F.lit("2024-01-01").alias("_date"))
    write_table(rows, str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "_date=2024-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.count_distinct("id")).first()[0] == 60_000
    assert spark.conf.get(TASK_BYTES_KEY, None) == before


def test_an_entry_is_looked_at_once(spark):
    # Every kind of line had its own pass over the lines, and times, tables and comments were read several times.
    rows = [("f", 0, 0, ["# Time: 2024-01-05T10:00:00.5Z", "# User@Host: a[a] @ w []  Id: 1", "# User@Host: b[b] @ w []  Id: 2",
                         "# Query_time: 1.5 Lock_time: 0.1 Rows_sent: 1  Rows_examined: 2", "# Query_time: 2.5 odd", "Use sales;",
                         "SET timestamp=1704448800;", "SELECT /* a */  1.5,'x',", "a1 FROM t2, t1;"]),
            ("f", 0, 1, ["# Time: 010524 10:00:00", "# administrator command: Ping;"]), ("f", 0, 2, [])]
    told = fold_entry(spark.createDataFrame(rows, "file string, block bigint, pos bigint, lines array<string>"))
    plan = told.select("_time", "tables", "comments")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_to_timestamp") <= 2
    assert plan.count("regexp_extract_all") <= 2
    assert plan.count("filter(lines#") <= 1
    got = told.select("pos", "user", "query_time", "lock_time", "database", "query", "normalized_query", "tables", "comments", "reject_reason", F.col("_time").cast("string"))
    assert [tuple(r) for r in got.orderBy("pos").collect()] == [
        (0, "b", 2.5, 0.1, "sales", "SELECT /* a */  1.5,'x', a1 FROM t2, t1", "select ?,?, a1 from t2, t1", "t1 t2", "/* a */", None, "2024-01-05 10:00:00.5"),
        (1, None, None, None, None, None, None, None, None, "ping", "2024-01-05 10:00:00"),
        (2, None, None, None, None, None, None, None, None, "no query", None)]


def test_white_space_and_numbers_of_a_statement(first):
    got = first(normalize, "SELECT  a\t\n b , .5 1e3 0xff t1.2x", "a\tb", " x  ", "'/* no */' \"q\" /* yes */ 7", "")
    assert got == ["select a b , ? ? ? t1.2x", "a b", "x", "? ? ?", ""]


def test_levels_of_a_lattice_are_sorted_in_linear_time():
    # op2: the orders of a lattice's levels were found by comparing, and again for each rank and level.
    for numbers in ([3, 1, 3, 0, 1], [70_000, 5, 70_000, 0], []):
        got = segment_sampling.argsort(np.array(numbers, np.int64))
        assert got.tolist() == sorted(range(len(numbers)), key=lambda i: numbers[i])
    lattice = segment_sampling.Lattice(load(), PieceTable(load()))
    lattice.place([[" over", " ▁x"], [" over", "\n"]])
    for node in np.flatnonzero(~lattice.last[: lattice.n_nodes]).tolist():
        edges = slice(lattice.start[node], lattice.start[node + 1])
        assert np.isclose(np.exp(lattice.log_odds[edges]).sum(), 1.0)
        assert np.allclose(lattice.upto[edges], np.cumsum(np.exp(lattice.log_odds[edges])))


def test_a_lattice_forgets_only_what_its_room_cannot_hold():
    # op2: twelve edges a character were set aside, so that chunks were forgotten with most of the room still free.
    pieces = load()
    table = PieceTable(pieces)
    words = [f" w{k}ord" for k in range(200)]
    whole = segment_sampling.Lattice(pieces, table)
    first = whole.place([words[:100], words[:100]])
    whole.place([words[100:]])
    lattice = segment_sampling.Lattice(pieces, table)
    lattice.EDGES, lattice.NODES = whole.n_edges, whole.n_nodes
    lattice._room(lattice.EDGES, lattice.NODES)
    for k in range(0, 200, 10):
        lattice.place([words[k : k + 10]])
    assert lattice.n_edges == whole.n_edges and lattice.place([words[:100]])[0].tolist() == first[1].tolist()
    lattice.place([[" more"]])
    assert len(lattice.number) == 1
    texts = ["".join(words[k : k + 9]) + " é" for k in range(90)]
    run = lambda lattice: [[(i.tolist(), p) for i, p, _ in r] for r in segment_sampling.sampled(texts, list(range(90)), 2, lattice, 1, 400)]
    lattice.EDGES, lattice.NODES = 300, 150
    assert run(lattice) == run(segment_sampling.Lattice(pieces, table))


def test_the_language_sample_is_not_laid_out_on_the_driver(spark):
    # pipeline: the driver held the sample as 8,192 shares a row, and copies of it.
    words = F.when(F.col("id") % 2 == 0, "the cat and the dog").otherwise("el perro y la gata")
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "en").otherwise("es").alias("lang"),
                                    F.concat(words, F.lit(" "), F.col("id").cast("string")).alias("text"))
    tracemalloc.start()
    try:
        model = lang_id.fit(docs, sample_rows=1000, epochs=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ["en", "es"] and peak < 16e6


def test_only_wanted_texts_are_shuffled(spark):
    # op9: the texts of all documents were shuffled to find those that share a bucket with another one.
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    ids = spark.range(0, 20_000, 7).select((F.col("id") * 1).alias("doc_id"))
    texts = near_dup.texts_of(docs, ids)
    assert sorted(r[0] for r in texts.select("doc_id").collect()) == list(range(0, 20_000, 7))
    likely = texts._jdf.queryExecution().analyzed().toString()
    assert "getbit" in likely
    assert near_dup.texts_of(docs, ids.limit(0)).count() == 0


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    # a task held all lines of the row groups of its split.
    spark.range(2000).select(F.col("id").alias("event_id"), F.lit(1).alias("user_id"), F.lit("view").alias("event_type"),
                             F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(base, "ROWS_A_TASK", 100)
    lines = render.mongo_lines(spark, str(tmp_path))
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 150


def test_line_items_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    # a task rendered and parsed all request lines of the row groups of its split.
    items = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").limit(2000).coalesce(1)
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(base, "ROWS_A_TASK", 100)
    sizes = [r["count"] for r in render.arango_lines(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 450


def test_uses_of_an_id_are_made_in_one_pass(spark):
    # complete uses and open ones were each made from all lines.
    row = lambda pos, level, second, id="hot": ("f", 0, pos, id, level, second, "GET", "/u", 200 + pos, 0.5)
    rows = [row(0, "INFO", 1), row(1, "DEBUG", 2), row(2, "INFO", 3), row(3, "DEBUG", 4), row(4, "INFO", 5), row(5, "DEBUG", 6),
            row(6, "INFO", 700), row(7, "INFO", 701), row(8, "DEBUG", 702), row(9, "DEBUG", 703), row(10, "INFO", 2000), row(11, "DEBUG", 1, None)]
    events = spark.createDataFrame(rows, "file string, block long, pos long, id string, logLevel string, s long, method string, fullURL string, responseCode long, totalTime double")
    pairs = pair_requests(events.withColumn("_time", F.timestamp_seconds("s")))
    assert "Union" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.id or "", r.n_begin, r.n_end, r.b or 0, r.e or 0, r.responseCode or 0) for r in pairs.select(
        "id", "n_begin", "n_end", F.unix_seconds("begin_time").alias("b"), F.unix_seconds("end_time").alias("e"), "responseCode").collect())
    assert got == [("", 1, 0, 1, 0, 0), ("hot", 0, 1, 0, 1, 200), ("hot", 1, 0, 702, 0, 0), ("hot", 1, 1, 2, 3, 202), ("hot", 1, 1, 4, 5, 204),
                   ("hot", 1, 1, 703, 2000, 210), ("hot", 1, 2, 6, 701, 207)]


def test_plain_stamps_and_marks_are_read_as_before(first):
    # marks were taken off by patterns; a plain stamp needs no layout.
    quoted = ['"a"', '""', '"', '"a', 'a"', 'a"b', '"a"b"', "", "a", '"a"\n', "é", '"é"', None]
    assert first(unquote, *quoted) == first(lambda c: F.regexp_replace(c, '^"|"$', ""), *quoted)
    assert first(unbracket, "[6402]", "(a)", "{}", "[", "(a]", "", "[a]b", "[a\nb]", None) == ["6402", "a", "", "[", "(a]", "", "[a]b", "a\nb", None]
    stamps = ["2024-01-05T10:00:59Z", "2024-01-05T10:00:59", "2024-02-30T10:00:00Z", "2024-01-05T24:00:00", "2024-01-05T10:00:60Z", "0000-01-05T10:00:00Z",
              "2024-1-5T1:2:3Z", "2024-01-05T10:00:59.25Z", "2024-01-05 10:00:59", "x", None]
    formats = (TimeFormat("yyyy-M-d'T'H:m:s[.SSSSSSSSS]'Z'"), ISO_LOCAL)
    for tz in ("UTC", "Europe/Berlin"):
        layouts = first(lambda c, tz=tz: F.unix_micros(first_time(c, formats, tz)), *stamps)
        assert first(lambda c, tz=tz: F.unix_micros(F.coalesce(plain_time(c, tz), first_time(c, formats, tz))), *stamps) == layouts
        assert first(lambda c, tz=tz: F.unix_micros(plain_time(c, tz)), *stamps) == layouts[:2] + [None] * 9


def test_counters_of_a_line_are_found_once(spark, lines):
    # Names and values of counters were looked for apart, each in the line without its strings.
    events = mongo_events(lines(["2024-01-01T00:00:00.000+0000 I COMMAND  [conn1] command shop.a command: find { find: \"a:1 b:2 \" } a:1 b_2:30 c:x d:4e 7: e:5 a:9 3ms", "x", "Mon Jan  1 10:00:00.000 [conn1] query shop.a query: { a: 1 } locks(micros) r:7 n:1 1ms"]))
    counters = events.select("pos", "counters")
    assert counters._jdf.queryExecution().optimizedPlan().toString().count("[A-Za-z_]") == 1
    assert [r.counters for r in counters.orderBy("pos").collect()] == [{"a": 9.0, "b_2": 30.0, "e": 5.0}, None, {"n": 1.0}]


def test_rows_are_sorted_before_lines_are_made_from_them(spark, monkeypatch):
    # the lines themselves were shuffled and sorted by four tasks.
    class Stop(Exception):
        pass

    seen = []
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path, **more: seen.append(self._df._jdf.queryExecution().optimizedPlan().toString()) or (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        queries()["mongo_job"](spark, SF_DIR)
    assert "Repartition" in seen[0] and "COMMAND" in seen[0] and "COMMAND" not in seen[0].split("Repartition")[1]
