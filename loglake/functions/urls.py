"""Shapes of request lines and URLs."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.regexes import PatternError

# Up to so many patterns are tried one by one.
FEW_PATTERNS = 16
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*"


def path_pattern(pattern: str) -> tuple[str, list[str]]:
    """``/a/:x/b`` as an anchored regex and the names of its variables."""
    if not pattern.startswith("/"):
        raise PatternError(f"a path pattern starts with '/': {pattern!r}")
    names: list[str] = []
    parts: list[str] = []
    for part in pattern.strip("/").split("/"):
        if part.startswith(":"):
            names.append(part[1:])
            parts.append("([^/]+)")
        else:
            parts.append(re.escape(part))
    return "^/" + "/".join(parts) + "/?$", names


def segments_of(path: Column) -> Column:
    """The parts of a path between its slashes; one slash at the end counts for nothing."""
    return F.split(F.regexp_replace(path, "^/|/$", ""), "/")


def match_path(path: Column, patterns: Sequence[str]) -> tuple[Column, dict[str, Column]]:
    """First pattern in the given order that fits: its text, and ``{variable: value}``.

    A path that fits none keeps its own text. A few patterns are tried one by one; many
    are looked up in a table, with the same result.
    """
    return match_chain(path, patterns) if len(patterns) <= FEW_PATTERNS else match_table(path, patterns)


def pattern_table(patterns: Sequence[str]) -> tuple[dict[int, list[list[int]]], list[list[list]]]:
    """For each number of segments the sets of places that are literal in some pattern; and buckets of
    ``[key, rank]``, where the key is the segment count, the literal places and their text."""
    masks: dict[int, list[list[int]]] = {}
    entries: dict[str, int] = {}
    for rank, pattern in enumerate(patterns):
        path_pattern(pattern)
        parts = pattern.strip("/").split("/")
        literal = [k for k, part in enumerate(parts) if not part.startswith(":")]
        if literal not in masks.setdefault(len(parts), []):
            masks[len(parts)].append(literal)
        entries.setdefault(_key_text(len(parts), literal, [parts[k] for k in literal]), rank)
    buckets: list[list[list]] = [[] for _ in range(1 << max(1, len(entries) - 1).bit_length())]
    for key, rank in entries.items():
        buckets[zlib.crc32(key.encode()) % len(buckets)].append([key, rank])
    return masks, buckets


def _key_text(size: int, literal: list[int], texts: list[str]) -> str:
    return "/".join([str(size), ",".join(map(str, literal)), *texts])


def match_table(path: Column, patterns: Sequence[str]) -> tuple[Column, dict[str, Column]]:
    """``match_path`` by a look-up for each set of literal places, not for each pattern.

    The patterns are one constant array of hash buckets. The plan grows with the number of
    different sets of literal places, of which paths of a few segments have few.
    """
    masks, buckets = pattern_table(patterns)
    table = F.from_json(F.lit(json.dumps([[{"k": k, "r": r} for k, r in b] for b in buckets])), "array<array<struct<k:string,r:int>>>")

    def rank_of(parts: Column, size: int, literal: list[int]) -> Column:
        key = F.concat_ws("/", F.lit(str(size)), F.lit(",".join(map(str, literal))), *[F.get(parts, F.lit(k)) for k in literal])
        bucket = F.get(table, (F.crc32(key) % len(buckets)).cast("int"))
        found = F.get(F.transform(F.filter(bucket, lambda e: e["k"] == key), lambda e: e["r"]), F.lit(0))
        # A variable takes at least one character.
        filled = [F.get(parts, F.lit(k)) != "" for k in range(size) if k not in literal]
        return F.when(reduce(Column.__and__, filled), found) if filled else found

    def best_of(parts: Column) -> Column:
        best = F.lit(None).cast("int")
        for size, literals in sorted(masks.items()):
            best = F.when(F.size(parts) == size, F.array_min(F.array(*[rank_of(parts, size, x) for x in literals]))).otherwise(best)
        return best

    best = F.when(path.startswith("/"), F.get(F.transform(F.array(segments_of(path)), best_of), F.lit(0)))
    shape = F.coalesce(F.get(F.from_json(F.lit(json.dumps(list(patterns))), "array<string>"), best), path)
    places: dict[str, list[int]] = {}
    for rank, pattern in enumerate(patterns):
        for k, part in enumerate(pattern.strip("/").split("/")):
            # Of a name that a pattern has twice the first place counts, as in the chain.
            if part.startswith(":") and places.setdefault(part[1:], [-1] * len(patterns))[rank] < 0:
                places[part[1:]][rank] = k
    values = {}
    for name, at in places.items():
        place = F.get(F.from_json(F.lit(json.dumps(at)), "array<int>"), best)
        values[name] = F.when(place >= 0, F.get(segments_of(path), place))
    return shape, values


def match_chain(path: Column, patterns: Sequence[str]) -> tuple[Column, dict[str, Column]]:
    """``match_path`` by one test after another. Patterns are tried only against paths with their number of segments."""
    compiled = [(p, *path_pattern(p)) for p in patterns]
    segments = F.size(segments_of(path))
    fits = [(segments == p.strip("/").count("/") + 1) & path.rlike(regex) for p, regex, _ in compiled]

    def first_fit(results: list[Column]) -> Column:
        chosen = F.when(fits[0], results[0])
        for fit, result in zip(fits[1:], results[1:]):
            chosen = chosen.when(fit, result)
        return chosen

    if not compiled:
        return path, {}
    shape = F.coalesce(first_fit([F.lit(p) for p, _, _ in compiled]), path)
    variables = dict.fromkeys(name for _, _, names in compiled for name in names)
    values = {
        name: first_fit([
            F.regexp_extract(path, regex, names.index(name) + 1) if name in names else F.lit(None)
            for _, regex, names in compiled
        ])
        for name in variables
    }
    return shape, values


def query_pairs(query: Column) -> Column:
    """``a=1&b`` as an array of decoded ``(k, v)``; what cannot be decoded is left out."""
    parts = F.filter(F.split(query, "&"), lambda p: p != "")

    def pair(part: Column) -> Column:
        key = F.substring_index(part, "=", 1)
        value = F.substring(part, F.length(key) + 2, F.length(part))
        return F.struct(F.try_url_decode(key).alias("k"), F.try_url_decode(value).alias("v"))

    return F.filter(F.transform(parts, pair), lambda p: p["k"].isNotNull() & p["v"].isNotNull())


def query_value(pairs: Column, key: Column) -> Column:
    """Values of one key, sorted and joined; NULL if the key is absent."""
    mine = F.array_sort(F.transform(F.filter(pairs, lambda p: p["k"] == key), lambda p: p["v"]))
    return F.when(F.size(mine) > 0, F.array_join(mine, ", "))


def query_params(pairs: Column) -> Column:
    """Every key of the query as a map, values sorted and joined; stays on the row."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), query_value(pairs, k).alias("value"))))


def query_shape(pairs: Column) -> Column:
    """Sorted ``k=?`` for each occurrence of each key; NULL for an empty query."""
    marks = F.array_sort(F.transform(pairs, lambda p: F.concat(p["k"], F.lit("=?"))))
    return F.when(F.size(marks) > 0, F.array_join(marks, "&"))


def request_shape(
    df: DataFrame,
    field: str = "request",
    patterns: Sequence[str] = (),
    prefix: str = "",
    mode: str = "whitelist",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Take a request line or URL apart into ``<prefix_><field>_*`` columns.

    ``METHOD target PROTOCOL`` gives method and protocol; anything else is read as
    a target up to its first space. With mode ``all`` every query key goes to the
    map ``…_query_params``; otherwise each listed key gets a column ``…_query_<key>``.
    """
    if mode not in ("whitelist", "all"):
        raise ValueError("query mode is 'whitelist' or 'all'")
    head = f"{prefix}_{field}" if prefix else field
    request = F.col(f"`{field}`").cast("string")
    words = df.withColumn("_words", F.split(request, " "))
    three = F.size("_words") == 3
    target = words.withColumn("_uri", F.when(three, F.get("_words", F.lit(1))).otherwise(F.get("_words", F.lit(0))))
    # The fragment is not sent to a server and takes no part in any shape.
    local = target.withColumn("_local", F.regexp_replace(F.regexp_replace("_uri", "#.*$", ""), _HOST, ""))
    split = local.withColumn("_halves", F.split("_local", r"\?", 2))
    parts = split.withColumn("_path", F.get("_halves", F.lit(0))).withColumn(
        "_pairs", F.coalesce(query_pairs(F.get("_halves", F.lit(1))), F.expr("array()").cast("array<struct<k:string,v:string>>"))
    )
    shape, variables = match_path(F.col("_path"), patterns)
    shaped = parts.withColumn("_pathshape", shape).withColumn("_queryshape", query_shape(F.col("_pairs")))
    query = F.get("_halves", F.lit(1))
    out = [
        F.when(three, F.get("_words", F.lit(0))).alias(f"{head}_method"),
        F.when(three, F.get("_words", F.lit(2))).alias(f"{head}_protocol_version"),
        F.col("_uri").alias(f"{head}_uri"),
        F.col("_path").alias(f"{head}_path"),
        F.when(query != "", query).alias(f"{head}_query"),
        F.when(F.col("_queryshape").isNull(), F.col("_pathshape"))
        .otherwise(F.concat_ws("?", "_pathshape", "_queryshape")).alias(f"{head}_shape"),
        F.col("_pathshape").alias(f"{head}_pathshape"),
        F.col("_queryshape").alias(f"{head}_queryshape"),
    ]
    out += [v.alias(f"{head}_path_{name}") for name, v in variables.items()]
    if mode == "all":
        out.append(query_params(F.col("_pairs")).alias(f"{head}_query_params"))
    else:
        out += [query_value(F.col("_pairs"), F.lit(k)).alias(f"{head}_query_{k}") for k in keys]
    return shaped.select(*[F.col(f"`{c}`") for c in df.columns], *out)
