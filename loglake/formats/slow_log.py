"""MySQL slow-query logs: entries of header comments and a statement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.regexes import line_pattern
from loglake.functions.sqltext import comments, normalize, statement, tables_in
from loglake.functions.text import once, settled, trim_space
from loglake.functions.times import ISO_LOCAL, TimeFormat, combine_time
from loglake.functions.typing import as_double, as_long
from loglake.operators.grouping import STATEMENT_BYTES, group_slow_log, is_banner
from loglake.operators.sampling import sample_entries
from loglake.session import staged

# What the lines of an entry look like. The first word is tested
# before the pattern, which spares most lines the regex.
PATTERNS = {
    "iso_time": ("# Time: ", r"^# Time: (?P<time>[^ ]+)Z *$"),
    "old_time": ("# Time: ", r"^# Time: (?P<datetime>[0-9]+ [0-9:.]+)"),
    "ping": ("# administrator command: ", r"^# administrator command: Ping; *$"),
    "user": ("# User@Host: ", r"^# User@Host: (?P<user>[^#]+) @ (?P<host>[^#]+?)( Id:(?P<connection>.+))?$"),
    "schema": (
        "# Schema: ",
        r"^# Schema: (?P<schema>[^#]+) Last_errno: (?P<error_num>[0-9]+)(  Killed: (?P<killed>[0-9]+))?$",
    ),
    "stats": (
        "# Query_time: ",
        r"^# Query_time: (?P<query_time>[0-9.]+) *Lock_time: (?P<lock_time>[0-9.]+)"
        r" *Rows_sent: (?P<rows_sent>[0-9]+) *Rows_examined: (?P<rows_examined>[0-9]+)"
        r"( *Rows_affected: (?P<rows_affected>[0-9]+))?.*$",
    ),
    "query_time": ("# Query_time: ", r"^# Query_time: (?P<query_time>[0-9.]+).*$"),
    "server": (
        "# Bytes_sent: ",
        r"^# Bytes_sent: (?P<bytes_sent>[0-9.]+) *Tmp_tables: (?P<tmp_tables>[0-9.]+)"
        r" *Tmp_disk_tables: (?P<tmp_disk_tables>[0-9]+) *Tmp_table_sizes: (?P<tmp_table_sizes>[0-9]+).*$",
    ),
    "plan": (
        "# QC_Hit: ",
        r"^# QC_Hit: (?P<query_cache_hit>[[:alpha:]]+)  Full_scan: (?P<full_scan>[[:alpha:]]+)"
        r"  Full_join: (?P<full_join>[[:alpha:]]+)  Tmp_table: (?P<tmp_table>[[:alpha:]]+)"
        r"  Tmp_table_on_disk: (?P<tmp_table_on_disk>[[:alpha:]]+).*$",
    ),
    "sort": (
        "# Filesort: ",
        r"^# Filesort: (?P<filesort>[[:alpha:]]+)  Filesort_on_disk: (?P<filesort_on_disk>[[:alpha:]]+)"
        r"  Merge_passes: (?P<merge_passes>[0-9]+).*$",
    ),
    "reads": (
        "# ",
        r"^# +InnoDB_IO_r_ops: (?P<IO_r_ops>[0-9]+)  InnoDB_IO_r_bytes: (?P<IO_r_bytes>[0-9]+)"
        r"  InnoDB_IO_r_wait: (?P<IO_r_wait_sec>[0-9.]+).*$",
    ),
    "waits": (
        "# ",
        r"^# +InnoDB_rec_lock_wait: (?P<rec_lock_wait_sec>[0-9.]+)"
        r"  InnoDB_queue_wait: (?P<queue_wait_sec>[0-9.]+).*$",
    ),
    "pages": ("# ", r"^# +InnoDB_pages_distinct: (?P<pages_distinct>[0-9]+).*"),
    "transaction": ("# InnoDB_trx_id: ", r"^# InnoDB_trx_id: (?P<transaction_id>[A-F0-9]+) *$"),
    "rates": (
        "# Log_slow_rate_type: ",
        r"^# Log_slow_rate_type: (?P<sl_rate_type>[^#]+)  Log_slow_rate_limit: (?P<sl_rate_limit>[0-9]+)$",
    ),
    "set_time": ("SET timestamp=", r"^SET timestamp=(?P<seconds>[0-9]+);$"),
}
USE = r"^(?i)use "
DOUBLES = ("query_time", "lock_time", "IO_r_wait_sec", "rec_lock_wait_sec", "queue_wait_sec")
FLAGS = ("query_cache_hit", "full_scan", "full_join", "tmp_table", "tmp_table_on_disk", "filesort", "filesort_on_disk")
TEXTS = ("transaction_id", "sl_rate_type")
_OLD_TIME = TimeFormat("MMddyy HH:m:s[.SSSSSSSSS]")

# Roles of a line for the statement text.
_IGNORED, _RESET, _USE, _BODY, _CLOSE = 0, 1, 2, 3, 4


def _is(line: Column, kind: str) -> Column:
    start, pattern = PATTERNS[kind]
    return line.startswith(start) & line_pattern(pattern).matches(line)


def _role(line: Column) -> Column:
    resets = F.lit(False)
    for kind in ("user", "query_time", "server"):
        resets = resets | _is(line, kind)
    return (
        F.when(line.startswith("# "), F.when(resets, _RESET).otherwise(_IGNORED))
        .when(line_pattern(USE).matches(line), _USE)
        .when(_is(line, "set_time"), _RESET)
        .when(is_banner(line), _IGNORED)
        .when(line.endswith(";"), _CLOSE)
        .otherwise(_BODY)
    )


# A line's kind, or its role if it is of no kind. A line is of one kind only, but for ``stats``, which
# are ``query_time`` too.
_CODES = {kind: 10 + number for number, kind in enumerate(PATTERNS)}
_RESETS = [_CODES[kind] for kind in ("user", "stats", "query_time", "server", "set_time")]


def _code(line: Column) -> Column:
    """Kind and role of a line at one look: all that the fold has to know of it."""
    told = None
    for kind, code in _CODES.items():
        if kind != "set_time":
            told = told.when(_is(line, kind), code) if told is not None else F.when(_is(line, kind), code)
    return (
        F.when(line.startswith("# "), told.otherwise(_IGNORED))
        .when((line.startswith("u") | line.startswith("U")) & line_pattern(USE).matches(line), _USE)
        .when(_is(line, "set_time"), _CODES["set_time"])
        .when(is_banner(line), _IGNORED)
        .when(line.endswith(";"), _CLOSE)
        .otherwise(_BODY)
    )


def _role_of(code: Column) -> Column:
    return F.when(code < 10, code).when(code.isin(_RESETS), _RESET).otherwise(_IGNORED)


def _last(*kinds: str) -> Column:
    """The last line of some kinds, from the codes in ``_back``, last line first; it alone sets the attributes of its kind."""
    places = [F.nullif(F.array_position("_back", F.lit(_CODES[kind])), F.lit(0)) for kind in kinds]
    return F.get("lines", F.size("lines") - (F.least(*places) if len(places) > 1 else places[0]))


_START = {"i": 1, "open": 1, "q_from": 0, "q_to": 0, "use": 0}
FAN_IN = 16
# Stands in the text of a statement where it was cut; no log line begins like this.
_CUT = "\x00text cut here"


def _places(roles: Column) -> Column:
    """Where the open text starts, which closed text counts, and the last ``use``, as places of lines."""
    start = F.struct(*[F.lit(v).alias(n) for n, v in _START.items()])

    def step(s: Column, role: Column) -> Column:
        closes, uses = role == _CLOSE, role == _USE
        return F.struct(
            (s["i"] + 1).alias("i"),
            F.when(closes | uses | (role == _RESET), s["i"] + 1).otherwise(s["open"]).alias("open"),
            F.when(closes, s["open"]).otherwise(s["q_from"]).alias("q_from"),
            F.when(closes, s["i"]).otherwise(s["q_to"]).alias("q_to"),
            F.when(uses, s["i"]).otherwise(s["use"]).alias("use"),
        )

    return F.aggregate(roles, start, step)


def essential(df: DataFrame, limit: int = STATEMENT_BYTES) -> DataFrame:
    """The lines of ``lines`` that can still change what an entry folds to, in their order.

    They are the state of the fold: the last line of each kind, a ping, the last closed
    statement, the text that is still open, and the line that each of these two begins after.
    States are merged by putting their lines one after another and taking the essential ones
    again. Text of more than ``limit`` bytes is cut out and marked.
    """
    kinds = [k for k in PATTERNS if k not in ("iso_time", "old_time")]

    def newest(*of: str) -> Column:
        return F.array_max(F.transform("lines", lambda l, i: F.when(reduce(Column.__or__, [_is(l, k) for k in of]), i)))

    found = {k: newest(k) for k in kinds} | {"stamp": newest("iso_time", "old_time")}
    df = df.withColumn("_roles", F.transform("lines", _role)).withColumn("_at", _places(F.col("_roles")))
    df = df.withColumn("_last", F.array_compact(F.array(*found.values())))

    def too_long(first: Column, last: Column) -> Column:
        text = F.slice("lines", F.greatest(first, F.lit(1)), F.greatest(last - first + 1, F.lit(0)))
        size = F.aggregate(text, F.lit(0).cast("bigint"), lambda n, l: n + F.octet_length(l) + 1)
        return (last > first) & ((size > limit) | F.array_contains(text, _CUT))

    at = {name: F.col(f"_at.{name}") for name in _START}
    df = df.withColumns({"_long": too_long(at["q_from"], at["q_to"]), "_long_open": too_long(at["open"], at["i"] - 1)})

    def state(line: Column, i: Column) -> Column:
        place, role = i + 1, F.get("_roles", i)
        told = (place >= at["q_from"]) & (place <= at["q_to"])
        is_open = place >= at["open"]
        cut = (told & F.col("_long") & (place == at["q_from"])) | (is_open & F.col("_long_open") & (place == at["open"]))
        text = (told & ((role == _CLOSE) | ((role == _BODY) & ~F.col("_long")))) | (is_open & (role == _BODY) & ~F.col("_long_open"))
        begin = (place == at["q_from"] - 1) | (place == at["open"] - 1) | (place == at["use"])
        kept = F.when(text | begin | F.array_contains("_last", i), F.array(line)).otherwise(F.array().cast("array<string>"))
        return F.when(cut, F.concat(F.array(F.lit(_CUT)), kept)).otherwise(kept)

    return df.withColumn("lines", F.flatten(F.transform("lines", state))).drop("_roles", "_at", "_last", "_long", "_long_open")


def fold_parts(parts: DataFrame, most: int, limit: int = STATEMENT_BYTES) -> DataFrame:
    """Entries of up to ``most`` rows as one row each, with their essential lines.

    A tree of merges, ``FAN_IN`` states at a time, in the order of the parts: no task holds
    more of an entry than that many states, whatever the entry's length.
    """
    out = essential(parts.select("file", "block", "pos", "part", "lines"), limit)
    while most > 1:
        grouped = out.withColumn("_in", F.floor(F.col("part") / FAN_IN)).groupBy("file", "block", "pos", "_in")
        joined = grouped.agg(F.sort_array(F.collect_list(F.struct("part", "lines"))).alias("_states"))
        lines = F.flatten(F.transform("_states", lambda s: s["lines"]))
        out = essential(joined.select("file", "block", "pos", F.col("_in").alias("part"), lines.alias("lines")), limit)
        most = -(-most // FAN_IN)
    return out.drop("part")


def fold_entry(entries: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """One row per entry with all attributes and the statement.

    The statement is found by positions: a pass over the line roles keeps where the
    open text starts and which closed text counts, so long statements cost one join
    of their lines at the end. A reset discards open text but no closed statement.

    Entries of several rows are folded to states, merged, and read like the others; their
    rejected text stays in as many rows. A statement longer than ``STATEMENT_BYTES`` is rejected.
    """
    if "parts" not in entries.columns:
        return _fold(entries, ingest_time)
    several = entries.filter("parts > 1")
    most = several.agg(F.max("parts")).first()[0]
    one = _fold(entries.filter("parts = 1"), ingest_time)
    if most is None:
        return one
    folded = staged(_fold(fold_parts(several, most), ingest_time), "folded")
    reasons = folded.filter("reject_reason IS NOT NULL").select("file", "block", "pos", "reject_reason")
    raw = several.join(reasons, ["file", "block", "pos"]).withColumn("value", F.array_join("lines", "\n"))
    rejected = raw.select([F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in one.schema])
    return one.unionByName(folded.filter("reject_reason IS NULL")).unionByName(rejected)


def _fold(entries: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    late = ingest_time if ingest_time is not None else F.lit(None).cast("timestamp")
    capture_of: dict[str, str] = {}
    df = entries
    kinds = [k for k in PATTERNS if k not in ("iso_time", "old_time", "ping")]
    captures = {}
    df = df.withColumn("_codes", F.transform("lines", _code))
    df = df.withColumns({"_roles": F.transform("_codes", _role_of), "_back": F.reverse("_codes")})
    for kind in kinds:
        pattern = line_pattern(PATTERNS[kind][1])
        captures[f"_{kind}"] = pattern.captures(_last(kind) if kind != "query_time" else _last("stats", kind))
        for name in pattern.field_names():
            if name not in capture_of or kind == "query_time":
                capture_of[name] = kind
    captures["_stamp"] = _last("iso_time", "old_time")
    df = df.withColumns(captures)
    df = df.withColumns({f"_{kind}": line_pattern(PATTERNS[kind][1]).captures(F.col("_stamp")) for kind in ("iso_time", "old_time")})

    df = df.withColumn("_at", _places(F.col("_roles")))
    body = F.filter("lines", lambda l, i: (i >= F.col("_at.q_from") - 1) & (i < F.col("_at.q_to")) & F.get("_roles", i).isin(_BODY, _CLOSE))
    use_line = F.get("lines", F.col("_at.use") - 1)
    is_statement = F.col("_at.q_to") > F.col("_at.use")
    # The line that closes a statement ends with its mark.
    text = once(F.array_join(body, " "), lambda t: F.left(t, F.length(t) - 1))
    df = df.withColumn(
        "query",
        F.when(is_statement, trim_space(text)).when(F.col("_at.use") > 0, F.rtrim(use_line, F.lit(";"))),
    ).withColumn("_real", is_statement)
    df = df.withColumn("normalized_query", F.when(F.col("_real"), normalize(F.col("query"))).otherwise(F.col("query")))

    def field(name: str) -> Column:
        kind = capture_of[name]
        return line_pattern(PATTERNS[kind][1]).field(F.col(f"_{kind}"), name)

    def typed(name: str) -> Column:
        col = field(name)
        if name in DOUBLES:
            return as_double(col).alias(name)
        if name in FLAGS:
            return (col == "Yes").alias(name)
        if name in TEXTS:
            return col.alias(name)
        return as_long(col).alias(name)

    iso = ISO_LOCAL.parse(line_pattern(PATTERNS["iso_time"][1]).field(F.col("_iso_time"), "time"))
    old = _OLD_TIME.parse(line_pattern(PATTERNS["old_time"][1]).field(F.col("_old_time"), "datetime"))
    # The time that is combined is used several times over; as a column it is parsed once.
    df = df.withColumn("_told", F.coalesce(iso, old))
    special = {"user", "host", "connection", "schema", "seconds"}
    database = F.btrim(F.rtrim(F.regexp_replace(use_line, USE.replace("^(?i)", "(?i)^"), ""), F.lit(";")), F.lit("`"))
    is_ping = F.array_contains("_codes", _CODES["ping"])
    cut = F.col("query").contains(_CUT)
    reason = F.when(is_ping, "ping").when(F.coalesce(F.col("query"), F.lit("")) == "", "no query").when(cut, "statement too long")
    return df.select(
        "file", "block", "pos",
        F.coalesce(combine_time(F.col("_told"), as_long(field("seconds"))), late).alias("_time"),
        F.substring_index(field("user"), "[", 1).alias("user"),
        trim_space(field("host")).alias("client"),
        as_long(trim_space(field("connection"))).alias("connection_id"),
        trim_space(field("schema")).alias("schema"),
        *[typed(n) for n in capture_of if n not in special],
        F.when(F.col("_at.use") > 0, database).alias("database"),
        "query", "normalized_query",
        F.when(F.col("_real"), tables_in(F.col("normalized_query"))).alias("tables"),
        F.when(F.col("_real"), statement(F.col("normalized_query"))).alias("statement"),
        F.when(F.col("_real"), comments(F.col("query"))).alias("comments"),
        settled(reason).alias("reject_reason"),
        F.when(reason.isNotNull(), F.array_join("lines", "\n")).alias("value"),
    )


def drop_admin_and_empty(entries: DataFrame) -> DataFrame:
    """Entries that hold an administrator ping, or no statement, are no events."""
    return entries.filter(F.col("reject_reason").isNull())


def mysql_slow_events(
    lines: DataFrame,
    ingest_time: Column | None = None,
    prefix: str | None = None,
    rate: int = 1,
    seed: int | None = None,
    **sizes: int,
) -> DataFrame:
    """Slow-log lines to typed entries; rejected ones keep a reason."""
    entries = group_slow_log(lines, prefix, **sizes)
    if rate > 1:
        return fold_entry(sample_entries(entries, rate, seed), ingest_time).withColumn("sample_rate", F.lit(rate))
    return fold_entry(entries, ingest_time)
