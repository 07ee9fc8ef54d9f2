"""Typing of text values: numbers and booleans out of strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a number or a truth value in log text.
INT_RE = r"\A[+-]?[0-9]+\z"
POINT_RE = r"\A[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
FLOAT_RE = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
TRUE_WORDS = ("1", "t", "T", "TRUE", "true", "True")
FALSE_WORDS = ("0", "f", "F", "FALSE", "false", "False")
ABSENT = "-"


def as_long(col: Column) -> Column:
    """BIGINT or NULL. The guard matters: a bare cast also takes ``' 12 '``."""
    return F.when(col.rlike(INT_RE), col.try_cast("bigint"))


def as_double(col: Column) -> Column:
    return F.when(col.rlike(FLOAT_RE), col.try_cast("double"))


def as_bool(col: Column) -> Column:
    return F.when(col.isin(*TRUE_WORDS), F.lit(True)).when(col.isin(*FALSE_WORDS), F.lit(False))


def typeify(col: Column) -> Column:
    """A number where the text is one: with a point DOUBLE, else BIGINT; ``-`` is no value.

    The result is ``struct<l BIGINT, d DOUBLE, s STRING>`` with at most one field set.
    """
    pointed = col.contains(".")
    d = F.when(pointed & col.rlike(POINT_RE), col.try_cast("double"))
    l = F.when(~pointed, as_long(col))
    s = F.when((col != ABSENT) & d.isNull() & l.isNull(), col)
    return F.struct(l.alias("l"), d.alias("d"), s.alias("s"))


def typeify_keyval(col: Column) -> Column:
    """Boolean first (so ``1`` and ``0`` are truth values), then BIGINT, DOUBLE, STRING."""
    b = as_bool(col)
    l = F.when(b.isNull(), as_long(col))
    d = F.when(b.isNull() & l.isNull(), as_double(col))
    s = F.when(b.isNull() & l.isNull() & d.isNull(), col)
    return F.struct(b.alias("b"), l.alias("l"), d.alias("d"), s.alias("s"))


def present(col: Column) -> Column:
    """The text, with ``-`` read as no value."""
    return F.when(col != ABSENT, col)


def column_types(pairs: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """One type per key over a long table of text values: BIGINT, else DOUBLE, else STRING.

    Empty and ``-`` values do not vote. Plain boolean aggregates, so they combine
    before the shuffle and one frequent key costs no more than a rare one.
    """
    v = F.col(value)
    votes = v.isNotNull() & (v != "") & (v != ABSENT)
    is_int = v.rlike(INT_RE) & v.try_cast("bigint").isNotNull()
    typed = pairs.groupBy(key).agg(
        F.count("*").alias("n_values"),
        F.coalesce(F.bool_and(F.when(votes, is_int)), F.lit(False)).alias("_int"),
        F.coalesce(F.bool_and(F.when(votes, is_int | v.rlike(FLOAT_RE))), F.lit(False)).alias("_float"),
    )
    return typed.select(
        key,
        F.when(F.col("_int"), "bigint").when(F.col("_float"), "double").otherwise("string").alias("type"),
        "n_values",
    )


def type_pg_meta(col: Column) -> Column:
    """``pid``-like prefix values: BIGINT where possible; the format keeps other text in ``extra``."""
    return as_long(col)


# A type fits all values of the ones before it, as numbers or as their text.
LATTICE = ("boolean", "bigint", "double", "string")


def widest(types: Column) -> Column:
    """The least type that holds values of all these types; truth values and numbers together are text."""
    has = lambda name: F.array_contains(types, name)
    numbers = has("bigint") | has("double")
    return (
        F.when(has("string") | (has("boolean") & numbers), "string")
        .when(has("double"), "double").when(has("bigint"), "bigint").when(has("boolean"), "boolean")
    )


def exact_parts(text: Column) -> Column:
    """``struct<b, l, d, s>``: the value by its type, and the text besides where the value does not print as it.

    So every value can be read by its own type and, where other batches hold other types, as text.
    """
    words = text.isin("true", "false")
    b = F.when(words, text == "true")
    l = as_long(text)
    d = F.when(l.isNull(), as_double(text))
    printed = F.coalesce(b.cast("string"), l.cast("string"), d.cast("string"))
    return F.when(text.isNotNull(), F.struct(
        b.alias("b"), l.alias("l"), d.alias("d"), F.when(printed.isNull() | (printed != text), text).alias("s")))


def type_of(parts: Column) -> Column:
    return F.when(parts["b"].isNotNull(), "boolean").when(parts["l"].isNotNull(), "bigint").when(parts["d"].isNotNull(), "double").otherwise("string")


def as_type(parts: Column, kind: str) -> Column:
    """A value of ``exact_parts`` as one type; the text is asked for only where the type is text."""
    if kind == "boolean":
        return parts["b"]
    if kind == "bigint":
        return parts["l"]
    if kind == "double":
        return F.coalesce(parts["d"], parts["l"].cast("double"))
    return F.coalesce(parts["s"], parts["b"].cast("string"), parts["l"].cast("string"), parts["d"].cast("string"))
