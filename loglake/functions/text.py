"""Small text expressions shared by the line formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_space(col: Column) -> Column:
    """Trim every kind of white space on both ends (``trim`` takes spaces only)."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def unquote(col: Column) -> Column:
    """Remove one double quote at the start and one at the end."""
    both = F.startswith(col, F.lit('"')) & F.endswith(col, F.lit('"')) & (F.length(col) > 1)
    inside = F.substring(col, F.lit(2), F.length(col) - 2)
    return F.when(both, inside).when(~F.contains(col, F.lit('"')), col).otherwise(F.regexp_replace(col, '^"|"$', ""))


def unbracket(col: Column) -> Column:
    """Remove one matching pair of (), [] or {} around the text."""
    pairs = [F.startswith(col, F.lit(one)) & F.endswith(col, F.lit(two)) for one, two in ("()", "[]", "{}")]
    wrapped = pairs[0] | pairs[1] | pairs[2]
    return F.when(wrapped, F.substring(col, F.lit(2), F.length(col) - 2)).otherwise(col)


def settled(col: Column) -> Column:
    """A costly result that is filtered on later, computed once where it stands.

    A filter is normally pushed below the projection that makes its column, with the
    whole expression copied into it, so every line would be parsed twice. The test on a
    random number always holds; it only keeps the optimizer from copying.
    """
    return F.when(F.rand(0) != 2.0, col)


def once(col: Column, then: Callable[[Column], Column]) -> Column:
    """``then(col)``, with ``col`` computed once however often ``then`` names it, also below a condition."""
    return F.get(F.transform(F.array(col), then), F.lit(0))


def last_wins(entries: Column) -> Column:
    """A map of ``(key, value)`` entries; of entries with one key the last counts, whatever the session says."""
    keys = F.transform(entries, lambda e: e["key"])

    def is_last(entry: Column, i: Column) -> Column:
        return ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), entry["key"])

    single = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.map_from_entries(F.when(single, entries).otherwise(F.filter(entries, is_last)))
