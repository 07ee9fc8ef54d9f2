from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglake.functions import sqltext, times, typing
from loglake.functions.documents import balanced, document_shape, parse_doc, parse_whole
from loglake.functions.regexes import PatternError, line_pattern, require_named
from loglake.functions.text import trim_space, unbracket, unquote


def test_named_groups_and_posix_classes(first):
    p = line_pattern(r"^(?P<a_b>[[:alpha:]]+)(-(?P<n>\d+))?")
    assert p.names == ("a_b", None, "n")
    got = first(lambda c: p.as_map(p.captures(c)), "abc-12 rest", "xyz", "9")
    assert got == [{"a_b": "abc", "n": "12"}, {"a_b": "xyz", "n": ""}, None]


def test_first_match_inside_a_line(first):
    p = line_pattern(r"(?P<n>\d+)")
    assert first(lambda c: p.field(p.captures(c), "n"), "ab 12 cd 34", "none") == ["12", None]


def test_brackets_in_classes_and_choices(first):
    p = line_pattern(r"(?P<x>[[&]+|b)")
    assert first(lambda c: p.field(p.captures(c), "x"), "a[&z", "ccb") == ["[&", "b"]
    assert not line_pattern("^a|b").anchored


@pytest.mark.parametrize("bad", ["", "(", "(?P<x>[)", "[[:nope:]]"])
def test_bad_patterns_are_refused(bad):
    with pytest.raises(PatternError):
        line_pattern(bad)


def test_a_named_group_is_needed():
    with pytest.raises(PatternError):
        require_named(r"\d+")


def test_trim_and_unwrap(first):
    assert first(trim_space, "\t\u2003 x y \r") == ["x y"]
    assert first(unbracket, "[12]", "{a}", "(", "[a)") == ["12", "a", "(", "[a)"]
    assert first(unquote, '"a"', '"', "b") == ["a", "", "b"]


def test_typeify(first):
    got = first(typing.typeify, "5.1.0", "-", "-5", "4.25", "1.5f", " 12 ", "99999999999999999999")
    assert [(r.l, r.d, r.s) for r in got] == [
        (None, None, "5.1.0"), (None, None, None), (-5, None, None), (None, 4.25, None),
        (None, None, "1.5f"), (None, None, " 12 "), (None, None, "99999999999999999999"),
    ]


def test_typeify_keyval_reads_truth_values_first(first):
    got = first(typing.typeify_keyval, "1", "F", "7", "2e3", "tRuE", "yes")
    assert [(r.b, r.l, r.d, r.s) for r in got] == [
        (True, None, None, None), (False, None, None, None), (None, 7, None, None),
        (None, None, 2000.0, None), (None, None, None, "tRuE"), (None, None, None, "yes"),
    ]


AT = datetime(2031, 7, 23, 2, 0, 8, 654321)


@pytest.mark.parametrize("shown, expected", [
    ("no clock here", None),
    ("2031-07-23T02:00:08Z", datetime(2031, 7, 23, 2, 0, 8)),
    ("2031-07-23T05:30:08,654321+03:30", AT),
    ("2031-07-23T05:30:08.654321999+03:30", AT),
    ("Wed Jul 23 05:30:08.654321999 +0330 2031", AT),
    ("Sat Jul  5 11:22:33 UTC 2031", datetime(2031, 7, 5, 11, 22, 33)),
    ("2031-07-23 05:30:08.654321999 +0330 IRST", AT),
])
def test_default_layouts(first, shown, expected):
    assert first(lambda c: times.parse_time(c), shown) == [expected]


@pytest.mark.parametrize("fmt, shown, tz, expected", [
    (times.UNIX_FORMAT, "1942538408", "UTC", datetime(2031, 7, 23, 2, 0, 8)),
    (times.UNIX_FORMAT, "1942538408.654", "UTC", datetime(2031, 7, 23, 2, 0, 8, 654000)),
    (times.UNIX_FORMAT, "1942538408.65", "UTC", None),
    ("02/Jan/2006:15:04:05 -0700", "22/Jul/2031:21:00:08 -0500", "UTC", datetime(2031, 7, 23, 2, 0, 8)),
    ("2006-01-02T15:04:05.000000", "2031-07-23T02:00:08.25", "UTC", datetime(2031, 7, 23, 2, 0, 8, 250000)),
    ("%d/%b/%y %I:%M %p", "23/Jul/31 02:00 AM", "UTC", datetime(2031, 7, 23, 2)),
    ("%a %b %e %T %Y", "Sat Jul  5 11:22:33 2031", "UTC", datetime(2031, 7, 5, 11, 22, 33)),
    ("%Y-%m-%d %z", "2031-07-23 +0330", "UTC", datetime(2031, 7, 22, 20, 30)),
    ("%Y-%m-%d %H:%M:%S,%L", "2031-07-23 02:00:08,125", "UTC", datetime(2031, 7, 23, 2, 0, 8, 125000)),
    ("%Y-%m-%d %k:%M", "2031-07-23  2:00", "UTC", datetime(2031, 7, 23, 2)),
    ("%Y-%m-%d %H:%M", "2031-07-23 04:00", "Europe/Berlin", datetime(2031, 7, 23, 2)),
    ("%b %d %Y %H:%M %Z", "Dec 01 2031 03:00 CET", "Europe/Berlin", datetime(2031, 12, 1, 2)),
])
def test_given_formats(first, fmt, shown, tz, expected):
    assert first(lambda c: times.parse_time(c, fmt, tz), shown) == [expected]


@pytest.mark.parametrize("fmt", ["%j", "%C%y", "%U"])
def test_unsupported_formats_are_refused(fmt):
    with pytest.raises(ValueError):
        times.to_spark_format(fmt)


def test_year_of_stamps_without_one(first):
    layout = times.TimeFormat("MMM d H:m:s[.SSSSSSSSS]", weekday=True)
    now = F.lit("2031-03-15 08:00:00").cast("timestamp")
    got = first(lambda c: times.infer_year(c, now, layout), "Fri Dec 26 23:59:59", "Sat Feb  1 06:05:04.75")
    assert got == [datetime(2030, 12, 26, 23, 59, 59), datetime(2031, 2, 1, 6, 5, 4, 750000)]


def test_time_field_is_resolved_and_removed(spark):
    rows = [({"b": "2"},), ({"DateTime": "2031-07-23T02:00:08Z", "b": "2"},), ({"Date": "tomorrow", "datetime": "never"},), ({"time": "12", "b": "2"},)]
    df = spark.createDataFrame(rows, "_fields map<string,string>")
    got = times.resolve_time(df, F.lit("2032-01-01").cast("timestamp")).collect()
    assert got[0]["_time"] == datetime(2032, 1, 1) and got[0]["data"] == {"b": "2"}
    assert got[1]["_time"] == datetime(2031, 7, 23, 2, 0, 8) and got[1]["data"] == {"b": "2"}
    assert got[2]["time_source"] == "ingest" and got[2]["data"] == {"Date": "tomorrow"}
    assert got[3]["time_source"] == "ingest" and got[3]["data"] == {"time": "12", "b": "2"}


@pytest.mark.parametrize("query, normal, tables", [
    ("INSERT INTO `bay 4`.crates VALUES (0x1F, 2e5, .25)", "insert into `bay 4`.crates values (?, ?, ?)", None),
    ("select 'two''s /* kept */ \\' --' -- tail", "select ? -- tail", None),
    ("select @@global.max_rows", "select @@global.max_rows", None),
    ("update depot.crates set note = E'\\t' where id=$12 limit 3;", "update depot.crates set note = e? where id=$? limit ?;", "depot.crates"),
    ("DELETE FROM crates WHERE weight < 8", "delete from crates where weight < ?", "crates"),
    ("SELECT w FROM bays AS B, `rows` WHERE k='-' AND m=\"z\"", "select w from bays as b, `rows` where k=? and m=?", "b bays rows"),
])
def test_fingerprint(spark, query, normal, tables):
    got = sqltext.sql_fingerprint(spark.createDataFrame([(query,)], "query string")).first()
    assert got.normalized_query == normal
    if tables is not None:
        assert got.tables == tables


def test_comments_and_long_literals(spark):
    long = "x" * 200_000
    df = spark.createDataFrame([(f"SELECT /* a # b */ '{long}' /*c*/ FROM t",)], "query string")
    got = sqltext.sql_fingerprint(df).first()
    assert got.normalized_query == "select ? from t"
    assert got.comments == "/* a # b */ /* c */"


def test_documents(first):
    doc = "{ _id: ObjectId('5ab'), $set: { when: new Date(12), t: Timestamp 7|1 }, n: [ 1.5, \"a: {b\" ] } rest: 1"
    assert first(balanced, doc, "{ open: { }", "none") == [doc[:-8], None, None]
    shape = first(lambda c: document_shape(parse_doc(balanced(c))), doc, "{ b: 1, a: { c: true } }", "{}")
    assert shape == [
        '{ "$set": { "t": 1, "when": 1 }, "_id": 1, "n": [ 1, 1 ] }', '{ "a": { "c": 1 }, "b": 1 }', "{  }",
    ]


def test_json_with_anything_after_it_is_refused(first):
    got = first(lambda c: F.to_json(parse_whole(c)), '{"a":1}', '{"a":1}}', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}]', "")
    assert got == ['{"a":1}', None, None, None, None, None]


def test_a_table_of_patterns_fits_like_the_chain(spark):
    from loglake.functions.urls import match_chain, match_table

    few = ["/", "/a", "/a/:x", "/:y/b", "/a/b", "/:x/:y/c", "/a/:x/c/", "/:z", "/a/b/c/:x/:x", "/é/:x"]
    paths = ["/", "", "a", "/a", "/a/", "/a//", "//a", "/a/b", "/q/b", "/q/b/", "/a/q", "/a/q/c", "/q/r/c", "/zz", "/a/b/c/1/2", "/é/1", "/a/b/c", "/x/y/z/w", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = []
    for match in (match_chain, match_table):
        shape, values = match(F.col("p"), few)
        got.append([tuple(r) for r in df.select(shape.alias("s"), *[F.when(shape != F.col("p"), v).alias(n) for n, v in sorted(values.items())]).collect()])
    assert got[0] == got[1]


def test_a_thousand_patterns_make_no_larger_plan(spark):
    from loglake.functions.urls import match_path

    def plan(n):
        many = [f"/s{k % 40}/:id/t{k}" for k in range(n)] + [f"/s{k}/t{k}" for k in range(n)]
        shape, values = match_path(F.col("p"), many)
        df = spark.createDataFrame([("/s7/abc/t47",), ("/s5/t5",), ("/s5/t6",)], "p string").select(shape.alias("s"), values["id"].alias("id"))
        nodes = sum(line.count("get(") for line in df._jdf.queryExecution().analyzed().toString().splitlines())
        return nodes, [tuple(r) for r in df.collect()]

    small, large = plan(50), plan(1000)
    assert small[0] == large[0]
    assert large[1] == [("/s7/:id/t47", "abc"), ("/s5/t5", None), ("/s5/t6", None)]
