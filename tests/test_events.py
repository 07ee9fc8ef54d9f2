import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglake.functions.regexes import PatternError
from loglake.functions.urls import request_shape
from loglake.operators import quality, sampling, transforms
from loglake.operators.hosts import enrich_host
from loglake.operators.lines import drop_empty, over, strip_prefix
from loglake.operators.quantiles import exact_quantile, value_counts

PATTERNS = ["/depots/:depot/crates/:crate", "/depots/:depot", "/status"]


@pytest.mark.parametrize("request_text, expected", [
    ("http://gw.example/status#now", {"path": "/status", "shape": "/status", "path_depot": None}),
    ("PATCH /depots/d4/crates/17?note=x HTTP/2.0", {
        "method": "PATCH", "protocol_version": "HTTP/2.0", "path": "/depots/d4/crates/17", "path_depot": "d4", "path_crate": "17",
        "query": "note=x", "pathshape": "/depots/:depot/crates/:crate", "shape": "/depots/:depot/crates/:crate?note=?"}),
    ("/unknown/<y>?z=%q1#end", {"path": "/unknown/<y>", "pathshape": "/unknown/<y>", "query": "z=%q1", "queryshape": None}),
    ("/depots/d9?tag=r&size=&tag=b&skip=1&tag=g", {
        "method": None, "path_depot": "d9", "path_crate": None, "query_tag": "b, g, r", "query_size": "",
        "queryshape": "size=?&skip=?&tag=?&tag=?&tag=?", "shape": "/depots/:depot?size=?&skip=?&tag=?&tag=?&tag=?"}),
    ("DELETE /status HTTP/1.1", {"method": "DELETE", "uri": "/status", "query": None, "queryshape": None, "shape": "/status"}),
    ("GET /depots/a%20b HTTP/1.0", {"uri": "/depots/a%20b", "protocol_version": "HTTP/1.0", "pathshape": "/depots/:depot"}),
])
def test_request_shape(spark, request_text, expected):
    df = spark.createDataFrame([(request_text,)], "request string")
    row = request_shape(df, "request", PATTERNS, keys=["tag", "size"]).first()
    assert {k: row[f"request_{k}"] for k in expected} == expected
    assert "request_query_skip" not in row.asDict()


def test_all_query_keys_and_prefix(spark):
    df = spark.createDataFrame([("/help?b=2&a=1&b=1",)], "url string")
    row = request_shape(df, "url", PATTERNS, prefix="p", mode="all").first()
    assert row.p_url_query_params == {"a": "1", "b": "1, 2"}
    with pytest.raises(ValueError):
        request_shape(df, "url", mode="some")
    with pytest.raises(PatternError):
        request_shape(df, "url", ["no/slash"])


def test_drop_scrub_add_on_maps(spark):
    df = spark.createDataFrame([({"a": "1", "b": "x", "c": "3"},)], "data map<string,string>")
    out = transforms.add_fields(transforms.scrub_fields(transforms.drop_fields(df, ["a"]), ["b", "zz"]), {"c": "new", "d": "4"})
    assert out.first().data == {"b": hashlib.sha256(b"x").hexdigest(), "c": "new", "d": "4"}


def test_prefix_and_empty(spark, lines):
    cut = strip_prefix(lines(["app1: rest", "rest"]), r"(?P<host>\w+): ").orderBy("pos").collect()
    assert [(r.value, r.prefix) for r in cut] == [("rest", {"host": "app1"}), ("rest", {})]
    maps = spark.createDataFrame([({"a": ""},), ({"a": "", "b": "0"},), ({},)], "data map<string,string>")
    assert drop_empty(maps).count() == 1
    both = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"})], "l map<string,string>, r map<string,string>")
    assert both.select(over(F.col("l"), F.col("r")).alias("m")).first().m == {"a": "1", "b": "3"}


def test_latest_status_before_an_event(spark):
    at = lambda h, m=0: datetime(2024, 1, 1 + h // 24, h % 24, m)
    status = spark.createDataFrame(
        [("a", at(1), "h1", True, 0, "p"), ("a", at(2), "h1", True, 0, "p"), ("a", at(40), "h1", False, 5, None), ("b", at(3), "h2", None, None, "s")],
        "host string, at timestamp, hosted_on string, read_only boolean, replica_lag long, role string")
    events = spark.createDataFrame(
        [("a", at(0, 59)), ("a", at(1)), ("a", at(39)), ("a", at(40)), ("a", at(400)), ("b", at(700)), ("c", at(5))], "host string, _time timestamp")
    got = {(r.host, r._time): (r.hosted_on, r.replica_lag) for r in enrich_host(events, status).collect()}
    assert got == {
        ("a", at(0, 59)): (None, None), ("a", at(1)): ("h1", 0), ("a", at(39)): ("h1", 0), ("a", at(40)): ("h1", 5),
        ("a", at(400)): ("h1", 5), ("b", at(700)): ("h2", None), ("c", at(5)): (None, None)}


def test_rates_of_the_window_before(spark):
    rows = [(f"{k}", 0) for k, n in (("hot", 900), ("rare", 3)) for _ in range(n)] + [("hot", 30)] * 500 + [("rare", 30)] * 3 + [("new", 30)] * 2
    events = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(rows)], "k string, s long, pos long").select(
        "k", "pos", F.lit("f").alias("file"), F.timestamp_seconds("s").alias("_time"))
    kept = sampling.dynamic_sample(events, ["k"], goal=5)
    later = kept.filter(F.unix_seconds("_time") == 30).groupBy("k").agg(F.count("*").alias("n"), F.max("sample_rate").alias("r"))
    got = {r.k: (r.n, r.r) for r in later.collect()}
    assert got["rare"] == (3, 1) and got["new"] == (2, 1)
    assert got["hot"][1] > 4 and 30 < got["hot"][0] * 1 < 250
    first = kept.filter(F.unix_seconds("_time") == 0).select("sample_rate").distinct().collect()
    assert [r.sample_rate for r in first] == [5]
    assert sampling.weighted_rollup(kept, ["k"]).filter("k = 'rare'").count() == 1
    with pytest.raises(ValueError):
        sampling.dynamic_sample(events, ["k"], goal=1)


def test_line_sampling(spark, lines):
    many = lines([str(i) for i in range(3000)])
    assert sampling.sample_lines(many, 1).count() == 3000
    assert 850 < sampling.sample_lines(many, 3, seed=1).count() < 1150
    with pytest.raises(ValueError):
        sampling.sample_lines(many, 0)


@pytest.mark.parametrize("permille", [1, 500, 950, 1000])
def test_exact_quantile_with_one_hot_group(spark, permille):
    rows = [("hot", (i * 7919) % 5_000_011) for i in range(4000)] + [("hot", 77)] * 900 + [("small", v) for v in (5, 1, 9)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: r.q for r in exact_quantile(value_counts(df, ["k"], "v"), ["k"], "v", permille, "q").collect()}
    for k in ("hot", "small"):
        values = sorted(v for key, v in rows if key == k)
        assert got[k] == values[max(0, -(-permille * len(values) // 1000) - 1)]
    assert set(got) == {"hot", "small"}


def test_totals_run_over_days(spark):
    rows = [(datetime(2024, 1, 1 + i // 3, i % 3), i) for i in range(12)]
    df = spark.createDataFrame(rows, "window_start timestamp, n long")
    got = [r.lifetime for r in quality.lifetime_totals(df).orderBy("window_start").collect()]
    assert got == [sum(range(i + 1)) for i in range(12)]
