"""Fingerprints of SQL text by rules, without a grammar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.text import once

# The parts of SQL text the rules look for. Quantifiers on repeated
# groups are possessive, so long literals neither backtrack nor deepen the stack.
SINGLE = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
DOUBLE = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"'
BLOCK_COMMENT = r"/\*((?s:.*?))\*/"
# The first look spares most characters the look behind.
NUMBER = r"(?=[0-9.])(?<![\w`])(?:0x[0-9a-f]+|[0-9]+(?:\.[0-9]*)?(?:e[+-]?[0-9]+)?|\.[0-9]+)(?![\w`])"
TABLE_LIST = (
    r"\b(?:from|join|into|update)\s+"
    r"(`?[\w.$@]+`?(?:\s+as\s+`?\w+`?)?(?:\s*,\s*`?[\w.$@]+`?(?:\s+as\s+`?\w+`?)?)*)"
)


def comments(query: Column) -> Column:
    """Block comments outside of literals, as ``/* a */ /* b */``; NULL if there are none."""
    found = F.regexp_extract_all(query, F.lit(f"(?s)(?:{SINGLE}|{DOUBLE}|{BLOCK_COMMENT})"), F.lit(1))
    inner = F.transform(F.filter(found, lambda c: c != ""), lambda c: F.btrim(c))
    marked = F.transform(inner, lambda c: F.concat(F.lit("/* "), c, F.lit(" */")))
    return F.when(query.contains("/*"), once(F.array_join(marked, " "), lambda t: F.when(t != "", t)))


def without_comments(query: Column) -> Column:
    bare = F.regexp_replace(query, f"(?s)({SINGLE}|{DOUBLE})|{BLOCK_COMMENT.replace('((?s:.*?))', '(?s:.*?)')}", "$1")
    return F.when(query.contains("/*"), bare).otherwise(query)


def normalize(query: Column) -> Column:
    """Lower case, literals as ``?``, white space collapsed, comments gone."""
    bare = F.regexp_replace(without_comments(query), f"(?s){SINGLE}|{DOUBLE}", "?")
    numbers = F.regexp_replace(F.lower(bare), NUMBER, "?")
    # A single blank is left where it is.
    return F.btrim(F.regexp_replace(numbers, r"[^\S ]\s*| \s+", " "))


def tables_in(normalized: Column) -> Column:
    """Names and aliases after FROM, JOIN, INTO and UPDATE: distinct, sorted, space-joined."""
    lists = F.regexp_extract_all(normalized, F.lit(TABLE_LIST), F.lit(1))
    words = F.split(F.translate(F.array_join(lists, ","), "`", ""), r"[\s,]+")
    names = F.sort_array(F.array_distinct(F.filter(words, lambda w: (w != "") & (w != "as"))))
    return once(F.array_join(names, " "), lambda t: F.when(t != "", t))


def statement(normalized: Column) -> Column:
    return F.regexp_extract(normalized, r"^\W*([a-z]+)", 1)


def sql_fingerprint(df: DataFrame, query: str = "query") -> DataFrame:
    """Add ``normalized_query``, ``tables``, ``statement`` and ``comments``."""
    normal = df.withColumn("normalized_query", normalize(F.col(query)))
    return normal.withColumns({
        "tables": tables_in(F.col("normalized_query")),
        "statement": statement(F.col("normalized_query")),
        "comments": comments(F.col(query)),
    })
