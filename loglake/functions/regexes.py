"""Named-group regular expressions as native Spark expressions.

Users write patterns with named groups (``(?P<name>...)``) and POSIX classes.
The JVM regex engine spells both differently, so a pattern is rewritten once on
the driver; the work itself stays in built-in string functions.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# POSIX character classes and their JVM spelling.
POSIX_CLASSES = {
    "alnum": r"\p{Alnum}",
    "alpha": r"\p{Alpha}",
    "ascii": r"\p{ASCII}",
    "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}",
    "graph": r"\p{Graph}",
    "lower": r"\p{Lower}",
    "print": r"\p{Print}",
    "punct": r"\p{Punct}",
    "space": r"\s",
    "upper": r"\p{Upper}",
    "word": r"\w",
    "xdigit": r"\p{XDigit}",
}

_NAMED_GROUP = re.compile(r"\(\?P?<([A-Za-z_]\w*)>")
_POSIX = re.compile(r"\[:(\^?)([a-z]+):\]")

# A line never holds a line feed, so it is a safe separator between captures.
_SEP = "\n"


class PatternError(ValueError):
    """The pattern cannot be used."""


@dataclass(frozen=True)
class LinePattern:
    """A rewritten pattern: ``java`` has plain groups, ``names`` lists them in order."""

    source: str
    java: str
    names: tuple[str | None, ...]
    anchored: bool

    def field_names(self) -> list[str]:
        return [n for n in dict.fromkeys(self.names) if n]

    def matches(self, col: Column) -> Column:
        return col.rlike("(?d)" + self.java)

    def captures(self, col: Column) -> Column:
        """All groups of the first match in one pass over the text.

        The result is ``['', whole match, group 1, ...]``; a text that does not
        match gives a one-element array, so ``get`` on it is NULL.
        """
        lead = r"\A" if self.anchored else r"\A(?s:.*?)"
        whole = f"(?d){lead}({self.java})(?s:.*)\\z"
        parts = "".join(f"{_SEP}${i}" for i in range(1, len(self.names) + 2))
        return F.split(F.regexp_replace(col, whole, parts), _SEP)

    def index(self, name: str) -> int:
        """Position of a named group in the ``captures`` array (last one wins)."""
        hits = [i for i, n in enumerate(self.names) if n == name]
        if not hits:
            raise PatternError(f"no group named {name!r} in {self.source!r}")
        return hits[-1] + 2

    def field(self, captured: Column, name: str) -> Column:
        return F.get(captured, F.lit(self.index(name)))

    def as_map(self, captured: Column) -> Column:
        """Named groups as a string map; NULL where the text did not match."""
        pairs: list[Column] = []
        for name in self.field_names():
            pairs += [F.lit(name), self.field(captured, name)]
        made = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        return F.when(is_match(captured), made)


def is_match(captured: Column) -> Column:
    return F.size(captured) > 1


def matched_text(captured: Column) -> Column:
    return F.get(captured, F.lit(1))


@lru_cache(maxsize=256)
def line_pattern(source: str) -> LinePattern:
    """Rewrite a pattern with named groups for the JVM, or refuse it."""
    if not source:
        raise PatternError("the pattern is empty")
    _check(source)
    out: list[str] = []
    names: list[str | None] = []
    depth = 0
    top_level_choice = False
    i = 0
    while i < len(source):
        ch = source[i]
        if ch == "\\":
            out.append(source[i : i + 2])
            i += 2
        elif ch == "[":
            piece, i = _char_class(source, i)
            out.append(piece)
        elif ch == "(":
            depth += 1
            named = _NAMED_GROUP.match(source, i)
            if named:
                names.append(named.group(1))
                out.append("(")
                i = named.end()
            else:
                if not source.startswith("(?", i):
                    names.append(None)
                out.append(ch)
                i += 1
        else:
            depth -= ch == ")"
            top_level_choice |= ch == "|" and depth == 0
            out.append(ch)
            i += 1
    anchored = source.startswith("^") and not top_level_choice
    return LinePattern(source, "".join(out), tuple(names), anchored)


def _char_class(source: str, start: int) -> tuple[str, int]:
    """Copy one bracket expression; the JVM reads a bare ``[`` or ``&&`` in it as set algebra."""
    out = ["["]
    i = start + 1
    if source.startswith("^", i):
        out.append("^")
        i += 1
    if source.startswith("]", i):
        out.append("\\]")
        i += 1
    while i < len(source) and source[i] != "]":
        posix = _POSIX.match(source, i)
        if posix:
            name = POSIX_CLASSES.get(posix.group(2))
            if name is None:
                raise PatternError(f"unknown character class in {source!r}")
            out.append(f"[^{name}]" if posix.group(1) else name)
            i = posix.end()
        elif source[i] == "\\":
            out.append(source[i : i + 2])
            i += 2
        else:
            out.append("\\" + source[i] if source[i] in "[&" else source[i])
            i += 1
    return "".join(out) + "]", i + 1


def _check(source: str) -> None:
    if re.search(r"\(\?[a-z]*U", source):
        raise PatternError("the ungreedy flag is not supported")
    probe = _POSIX.sub("a", source)
    probe = re.sub(r"\\[pP](\{\^?\w+\}|\w)", r"\\w", probe)
    probe = re.sub(r"\(\?<([A-Za-z_]\w*)>", r"(?P<\1>", probe).replace("\\z", "\\Z")
    probe = re.sub(r"(?<!^)\(\?([ims]+)\)", "", probe)
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", FutureWarning)
            re.compile(probe)
    except re.error as err:
        raise PatternError(f"bad pattern {source!r}: {err}") from err


def require_named(source: str) -> LinePattern:
    pattern = line_pattern(source)
    if not pattern.field_names():
        raise PatternError(f"no named group in {source!r}")
    return pattern
