"""Document-store server logs, old and new line headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.documents import balanced, document_shape, masked, parse_doc
from loglake.functions.regexes import is_match, line_pattern
from loglake.functions.text import last_wins, settled, trim_space
from loglake.functions.times import ISO_LOCAL, ISO_OFFSET, TimeFormat, infer_year
from loglake.functions.typing import as_double
from loglake.operators.grouping import carry_forward, carry_in_scan
from loglake.operators.lines import strip_prefix
from loglake.operators.transforms import split_namespace

# The line header, the operations and what the fields look like.
HEADER = (
    r"^(?P<stamp>\d{4}-\d\d-\d\dT\S+|[A-Z][a-z]{2} [A-Z][a-z]{2} +\d+ [0-9:.]+) +"
    r"(?:(?P<severity>[DIWEF]) (?P<component>[A-Z_\-]+) +)?\[(?P<context>[^\]]*)\] (?P<body>.*)$"
)
SEVERITIES = {"D": "debug", "I": "informational", "W": "warning", "E": "error", "F": "fatal"}
OPERATION = r"^(?P<operation>query|insert|update|remove|getmore|command|killcursors)\b(?: (?P<namespace>[^\s{}]+\.[^\s{}]+))?"
_CTIME = TimeFormat("MMM d H:m:s[.SSSSSSSSS]", weekday=True)
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'

# Short names of lock modes. Upper-case modes get words of their own,
# since column names do not tell case apart.
LOCK_MODES = {"r": "read", "w": "write", "R": "shared", "W": "exclusive"}
LOCK_METRICS = {"acquireCount": "lock", "acquireWaitCount": "lock_wait", "timeAcquiringMicros": "lock_wait_us"}


# What stands before each document of a line, as plain text to look for
# first and as a pattern.
DOCUMENTS = {
    "command": ("command: ", r"command: \w+ "),
    "query": ("query: ", "query: "),
    "update": ("update: ", "update: "),
    "locks": ("locks:{", "locks:"),
    "changelog": ("changelog: ", "into changelog: "),
}


def _place(name: str) -> Column:
    """The length of the line from the first brace after a marker on; 0 or NULL if there is none.

    A marker inside a string literal is none, so it is looked for in the line with the literals masked.
    """
    mark, pattern = DOCUMENTS[name]
    return F.when(F.col("_hidden").contains(mark), F.length(F.regexp_extract("_hidden", rf"(?s)(?:^|\s){pattern}(\{{.*)$", 1)))


def _from_end(text: str, size: str) -> Column:
    return F.when(F.col(size) > 0, F.substring(F.col(text), F.length(text) - F.col(size) + 1, F.col(size)))


def mongo_events(
    lines: DataFrame,
    reference_time: Column | None = None,
    tz: str = "UTC",
    prefix: str | None = None,
    log_partials: bool = False,
) -> DataFrame:
    """Header, operation, namespace, counters, duration and documents of each line.

    Documents come as variants. A line whose documents cannot be read is rejected
    with reason ``body``; with ``log_partials`` it stays an event with what was read,
    and ``partial`` is set. ``reference_time`` gives the year to stamps without one. A column
    ``replica_set`` of the lines stays.
    """
    header = line_pattern(HEADER)
    operation = line_pattern(OPERATION)
    cut = strip_prefix(lines.withColumn("value", trim_space(F.col("value"))), prefix)
    read = cut.withColumn("_cap", header.captures(F.col("value")))

    def head(name: str) -> Column:
        return header.field(F.col("_cap"), name)

    read = read.withColumn("_body", head("body")).withColumn("_op", operation.captures(F.col("_body")))
    # Each step is settled: its results are used several times, and a filter on one of them must not copy the steps before.
    read = read.withColumn("_hidden", settled(masked(F.col("_body"))))
    read = read.withColumns({f"_{d}_size": settled(_place(d)) for d in DOCUMENTS})
    read = read.withColumns({f"_{d}": _from_end("_body", f"_{d}_size") for d in DOCUMENTS})
    read = read.withColumns({f"_{d}_v": settled(parse_doc(balanced(F.col(f"_{d}"), _from_end("_hidden", f"_{d}_size")))) for d in DOCUMENTS})
    # Counters stand outside of documents and strings: name, colon, digits, without a space.
    outside = F.when(F.col("_body").contains('"'), F.regexp_replace("_body", _STRING, '""')).otherwise(F.col("_body"))
    old_locks = F.col("_body").contains("locks(micros)")
    plain = F.when(old_locks, F.regexp_replace(outside, r"locks\(micros\)(?: [rRwW]:\d+)+", "")).otherwise(outside)
    counters = F.transform(
        F.regexp_extract_all(plain, F.lit(r"(?:^|\s)([A-Za-z_]\w*:\d+)(?=\s|$)"), F.lit(1)),
        lambda c: F.struct(F.substring_index(c, ":", 1).alias("key"), F.substring_index(c, ":", -1).try_cast("double").alias("value")),
    )
    micros = F.regexp_extract("_body", r"locks\(micros\)((?: [rRwW]:\d+)+)", 1)
    held = F.map_from_arrays(
        F.regexp_extract_all(micros, F.lit(r"([rRwW]):(\d+)"), F.lit(1)),
        F.transform(F.regexp_extract_all(micros, F.lit(r"([rRwW]):(\d+)"), F.lit(2)), lambda v: v.try_cast("bigint")),
    )
    broken = F.lit(False)
    for d in DOCUMENTS:
        broken = broken | (F.col(f"_{d}").isNotNull() & F.col(f"_{d}_v").isNull())
    now = reference_time if reference_time is not None else F.lit(None).cast("timestamp")
    stamp = F.when(
        head("stamp").rlike(r"^\d{4}"),
        F.coalesce(ISO_OFFSET.parse(head("stamp")), TimeFormat("yyyy-M-d'T'H:m:s[.SSSSSSSSS]'Z'").parse(head("stamp")), ISO_LOCAL.parse(head("stamp"), tz)),
    ).otherwise(infer_year(head("stamp"), now, _CTIME, tz))
    severity = F.lit(None).cast("string")
    for letter, word in SEVERITIES.items():
        severity = F.when(head("severity") == letter, word).otherwise(severity)
    is_op = is_match(F.col("_op"))

    def no_blank(col: Column) -> Column:
        return F.when(col != "", col)

    reason = (
        F.when(~F.col("_header"), "header")
        .when(F.col("_time").isNull(), "time")
        .when(F.col("partial") & F.lit(not log_partials), "body")
    )
    out = read.select(
        "file", "block", "pos", "value",
        stamp.alias("_time"),
        severity.alias("severity"),
        no_blank(head("component")).alias("component"),
        head("context").alias("context"),
        F.when(is_op, operation.field(F.col("_op"), "operation")).alias("operation"),
        no_blank(operation.field(F.col("_op"), "namespace")).alias("namespace"),
        no_blank(F.regexp_extract("_body", r"(?:^|\s)command: (\w+) \{", 1)).alias("command_type"),
        F.when(~is_op & F.col("_changelog").isNull(), F.col("_body")).alias("message"),
        F.col("_command_v").alias("command"),
        F.col("_query_v").alias("query"),
        F.col("_update_v").alias("update"),
        F.col("_changelog_v").alias("changelog"),
        F.col("_locks_v").alias("locks"),
        F.when(old_locks, F.when(F.size(held) > 0, held)).alias("locks_held"),
        F.map_from_entries(counters).alias("counters"),
        as_double(no_blank(F.regexp_extract("_body", r"\s(\d+)ms$", 1))).alias("duration_ms"),
        F.coalesce(broken, F.lit(False)).alias("partial"),
        is_match(F.col("_cap")).alias("_header"),
        "prefix",
        *(["replica_set"] if "replica_set" in lines.columns else []),
    )
    shaped = with_document_shape(command_query(split_namespace(flatten_changelog(out))))
    return shaped.withColumn("reject_reason", settled(reason)).drop("_header")


def flatten_changelog(df: DataFrame) -> DataFrame:
    """A sharding change record as ``changelog_*`` fields; its namespace becomes the row's."""
    def text(path: str) -> Column:
        return F.try_variant_get(F.col("changelog"), path, "string")

    return df.withColumns({
        "namespace": F.coalesce(text("$.ns"), F.col("namespace")),
        "changelog_changeid": text("$._id"),
        "changelog_server": text("$.server"),
        "changelog_client_addr": text("$.clientAddr"),
        "changelog_time": text("$.time"),
        "changelog_what": text("$.what"),
        "changelog_primary": text("$.details.primary"),
        "changelog_details": F.try_variant_get(F.col("changelog"), "$.details", "variant"),
        "sharding_collection": F.when(F.col("changelog").isNotNull(), F.lit("changelog")),
    }).drop("changelog")


def command_query(df: DataFrame) -> DataFrame:
    """The query document of find, findAndModify, update and delete commands."""
    def part(path: str) -> Column:
        return F.try_variant_get(F.col("command"), path, "variant")

    def statements(path: str, renamed: dict[str, str]) -> Column:
        each = F.try_variant_get(F.col("command"), path, "array<map<string,variant>>")
        pairs = F.transform(each, lambda u: F.map_from_entries(F.filter(
            F.array(*[F.struct(F.lit(new), F.element_at(u, F.lit(old))) for old, new in renamed.items()]),
            lambda e: e["col2"].isNotNull(),
        )))
        whole = F.create_map(F.lit(path[2:]), pairs)
        return F.when(each.isNotNull(), F.parse_json(F.to_json(whole)))

    kind = F.col("command_type")
    found = (
        F.when(kind == "find", F.when(part('$.filter["$where"]').isNull(), part("$.filter")))
        .when(kind == "findAndModify", part("$.query"))
        .when(kind == "update", statements("$.updates", {"q": "$query", "u": "$update", "$setOnInsert": "$setOnInsert"}))
        .when(kind == "delete", statements("$.deletes", {"q": "$query", "limit": "$limit"}))
    )
    return df.withColumn("query", F.coalesce(found, F.col("query")))


def with_document_shape(df: DataFrame) -> DataFrame:
    return df.withColumn("normalized_query", F.when(F.col("query").isNotNull(), document_shape(F.col("query"))))


def flatten_locks(df: DataFrame, keys: tuple[str, ...] = ("file", "block", "pos")) -> DataFrame:
    """Lock counts in long form: ``(keys, lock, n)`` with names like ``global_read_lock``.

    Long form, because the names come from the data. Old held-time maps give
    ``read_lock_held_us``.
    """
    scopes = df.select(*keys, F.explode(F.col("locks").try_cast("map<string,variant>")).alias("scope", "_m"))
    metrics = scopes.select(*keys, "scope", F.explode(F.col("_m").try_cast("map<string,variant>")).alias("metric", "_c"))
    modes = metrics.select(*keys, "scope", "metric", F.explode(F.col("_c").try_cast("map<string,bigint>")).alias("mode", "n"))
    suffix = _named(F.col("metric"), LOCK_METRICS)
    mode = F.coalesce(_named(F.col("mode"), LOCK_MODES), F.col("mode"))
    counted = modes.filter(suffix.isNotNull()).select(
        *keys, F.concat_ws("_", F.lower("scope"), mode, suffix).alias("lock"), "n"
    )
    held = df.select(*keys, F.explode("locks_held").alias("mode", "n"))
    return counted.unionByName(held.select(*keys, F.concat(mode, F.lit("_lock_held_us")).alias("lock"), "n"))


def lock_columns(long: DataFrame, names: list[str], keys: tuple[str, ...] = ("file", "block", "pos")) -> DataFrame:
    """Chosen locks as columns; the caller names them, so no pass over the data finds them."""
    return long.groupBy(*keys).pivot("lock", names).agg(F.sum("n"))


def _named(col: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for short, word in names.items():
        out = F.when(col == short, word).otherwise(out)
    return out


def lock_counts(df: DataFrame) -> DataFrame:
    """Add ``lock_counts``, the names and counts of ``flatten_locks`` as a map on the event itself."""
    def entries(col: Column, kind: str) -> Column:
        return F.coalesce(F.map_entries(col.try_cast(f"map<string,{kind}>")), F.array().cast(f"array<struct<key:string,value:{kind}>>"))

    def of_metric(scope: Column, metric: Column) -> Column:
        suffix = _named(metric["key"], LOCK_METRICS)
        return F.transform(entries(metric["value"], "bigint"), lambda c: F.struct(
            F.when(suffix.isNotNull(), F.concat_ws("_", F.lower(scope["key"]), _mode(c["key"]), suffix)).alias("key"), c["value"].alias("value")))

    def of_scope(scope: Column) -> Column:
        return F.flatten(F.transform(entries(scope["value"], "variant"), lambda metric: of_metric(scope, metric)))

    counted = F.flatten(F.transform(entries(F.col("locks"), "variant"), of_scope))
    held = F.transform(
        F.coalesce(F.map_entries("locks_held"), F.array().cast("array<struct<key:string,value:bigint>>")),
        lambda c: F.struct(F.concat(_mode(c["key"]), F.lit("_lock_held_us")).alias("key"), c["value"].alias("value")))
    named = F.when(  # most lines have no locks
        F.col("locks").isNotNull() | F.col("locks_held").isNotNull(),
        F.filter(F.concat(counted, held), lambda e: e["key"].isNotNull() & e["value"].isNotNull()))
    return df.withColumn("_counts", named).withColumn("lock_counts", F.when(F.size("_counts") > 0, last_wins(F.col("_counts")))).drop("_counts")


def _mode(col: Column) -> Column:
    return F.coalesce(_named(col, LOCK_MODES), col)


# Fixed value: the line in which a server names its set.
HEARTBEAT = r'\] command admin\.\$cmd (?:.* )?command: replSetHeartbeat \{ replSetHeartbeat: "((?:[^"\\]|\\.)*)"'


def with_replica_set(lines: DataFrame) -> DataFrame:
    """Stamp the set name of the last heartbeat on its line and the later lines of its file, before they are parsed."""
    name = F.regexp_extract("value", HEARTBEAT, 1)
    return carry_in_scan(lines, F.when(F.col("value").contains("replSetHeartbeat") & (name != ""), name), "replica_set")


def carry_replica_set(df: DataFrame, **sizes: int) -> DataFrame:
    """Stamp the set name of the last heartbeat on it and on the later lines of its file.

    For parsed tables in any order of rows; a job over log files uses ``with_replica_set``.
    """
    heartbeat = (F.col("namespace") == "admin.$cmd") & (F.col("command_type") == "replSetHeartbeat")
    name = F.when(heartbeat, F.try_variant_get(F.col("command"), "$.replSetHeartbeat", "string"))
    return carry_forward(df, name, "replica_set", **sizes)
