"""Documents printed in shell notation, as JSON text and variants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TEXT_OR_REST = rf'(?s){_STRING}|[^"]++|"'
# How deep braces are read by one pattern; deeper ones are counted.
_DEPTH = 8

# Wrappers the shell prints around plain values.
_UNWRAP = (
    (r"\b(?:ObjectId|UUID)\('([^']*)'\)", '"$1"'),
    (r"\b(?:new )?(?:Date|ISODate)\((-?[0-9]+)\)", "$1"),
    (r"\bNumber(?:Long|Int|Decimal)\((-?[0-9.]+)\)", "$1"),
    (r"\bTimestamp(?: |\()([0-9]+)(?:\||, )([0-9]+)\)?", '"$1|$2"'),
    (r"\b(?:undefined|MinKey|MaxKey)\b", "null"),
)
# Fixed value: what every text with a wrapper holds.
_WRAPPED = r"\(|Timestamp |undefined|MinKey|MaxKey"
# Fixed value: closes the wrapped text, so that nothing can trail after the value.
_END = r'"\u0001end\u0001"'
_KEY = r"(?<=[{,])(\s*)([A-Za-z_$][\w$.\-]*)\s*:"


def parse_whole(text: Column) -> Column:
    """JSON text as a variant; NULL also where anything follows the value.

    The parser stops after the first value, so the value is read as the first of two
    elements of an array: text after it breaks the array or moves the end mark.
    """
    pair = F.array(F.try_parse_json(F.concat(F.lit("["), text, F.lit(f",{_END}]"))))

    def first(both: Column) -> Column:
        whole = F.try_variant_get(both, "$[1]", "string") == "\u0001end\u0001"
        return F.when(whole, F.try_variant_get(both, "$[0]", "variant"))

    return F.get(F.transform(pair, first), F.lit(0))


def _let(col: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(col), then), F.lit(0))


def masked(text: Column) -> Column:
    """The text with every letter inside string literals written as ``x``: same length, no marks or braces inside."""
    pieces = F.regexp_extract_all(text, F.lit(_TEXT_OR_REST), F.lit(0))
    quoted = lambda p: p.startswith('"') & (F.length(p) > 1)
    hidden = F.transform(pieces, lambda p: F.when(quoted(p), F.concat(F.lit('"'), F.repeat(F.lit("x"), F.length(p) - 2), F.lit('"'))).otherwise(p))
    return F.when(text.contains('"'), F.array_join(hidden, "")).otherwise(text)


def _nested(depth: int) -> str:
    """A pattern of balanced braces, up to so many inside each other."""
    inner = rf"|{_nested(depth - 1)}" if depth > 1 else ""
    return rf"\{{(?:[^{{}}]++{inner})*+\}}"


def balanced(text: Column, hidden: Column | None = None) -> Column:
    """The leading ``{...}`` of a text with its braces balanced; NULL if it never closes.

    ``hidden`` is the ``masked`` text, where it is known.
    """
    if hidden is None:
        return _let(masked(text), lambda h: balanced(text, h))
    size = F.length(F.regexp_extract(hidden, rf"\A{_nested(_DEPTH)}", 0))
    deep = _let(size, lambda n: F.when(n > 0, n).otherwise(_counted(hidden)))
    return F.when(text.startswith("{"), _let(deep, lambda n: F.when(n > 0, F.substring(text, F.lit(1), n))))


def _counted(hidden: Column) -> Column:
    """The length of the leading ``{...}`` of a masked text of any depth; 0 if it never closes."""
    tokens = F.regexp_extract_all(hidden, F.lit(r"[{}]|[^{}]++"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(False).alias("done"))

    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        stepped = F.struct(
            depth.cast("int").alias("depth"),
            (state["size"] + F.length(token)).alias("size"),
            (depth == 0).alias("done"),
        )
        return F.when(state["done"], state).otherwise(stepped)

    return F.aggregate(tokens, start, step, lambda end: F.when(end["done"], end["size"]).otherwise(0))


def to_json_text(doc: Column) -> Column:
    """Quote keys and unwrap typed values, outside of string literals only."""
    def outside(chunk: Column) -> Column:
        out = chunk
        for pattern, plain in _UNWRAP:
            out = F.regexp_replace(out, pattern, plain)
        return F.regexp_replace(F.when(chunk.rlike(_WRAPPED), out).otherwise(chunk), _KEY, '$1"$2":')

    pieces = F.regexp_extract_all(doc, F.lit(_TEXT_OR_REST), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.startswith('"'), p).otherwise(outside(p))), "")


def parse_doc(doc: Column) -> Column:
    return F.try_parse_json(to_json_text(doc))


def document_shape(doc: Column) -> Column:
    """Leaf values as ``1``, keys sorted: ``{ "a": 1, "b": { "$ne": 1 } }``.

    A variant keeps the fields of an object sorted, so printing it sorts the keys.
    """
    pieces = F.regexp_extract_all(F.to_json(doc), F.lit(rf'(?s){_STRING}:?|[^"]++'), F.lit(0))

    def plain(chunk: Column) -> Column:
        ones = F.regexp_replace(chunk, r"-?[0-9][0-9.eE+\-]*|true|false|null", "1")
        opened = F.regexp_replace(ones, r"([{\[])", "$1 ")
        return F.regexp_replace(F.regexp_replace(opened, r"([}\]])", " $1"), ",", ", ")

    shaped = F.transform(
        pieces,
        lambda p: F.when(p.endswith('":'), F.concat(p, F.lit(" "))).when(p.startswith('"'), "1").otherwise(plain(p)),
    )
    return F.array_join(shaped, "")
