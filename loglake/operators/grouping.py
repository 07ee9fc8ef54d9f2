"""Statements out of lines: multi-line assembly in file order.

A line opens a statement depending only on itself and the line before it. One pass over
the scan cuts the lines of each split into pieces of a bounded size and stages them:

1. A run of lines that begins and ends inside a split is a whole statement. Nearly all are;
   their lines are cut out of the Arrow batches by offsets and never shuffled.
2. The first and the last run of a split, and the parts of a run longer than a piece, are
   open pieces. Each has a summary: its bytes and the kinds of its first and last line.
3. Summaries are numbered by a prefix scan over splits: inside a segment, a bounded stretch
   of a file, then over one row per segment. The state that is combined is the number of
   statements begun, the bytes before, and the bytes before the last beginning. It says
   which statement a piece belongs to, and which part of it.
4. Open pieces of one statement and part are joined. A statement longer than a piece stays in
   several rows, ``part`` 0 .. ``parts - 1``: no row grows with a run, so a file without any
   header is as harmless as any other.

Only open pieces are shuffled, and only their summaries pass through a window.

Step 1 relies on the order of the scan: rows of a partition must be in file order,
as ``order_lines`` delivers them. For other line tables use ``in_file_order`` first.
"""

from __future__ import annotations

import bisect
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.functions.regexes import line_pattern
from loglake.functions.text import trim_space
from loglake.session import staged
from loglake.streaming.state import Slots

# The cutting functions travel with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lines a database server prints when its log is reopened.
BANNERS = (
    "/.*, Version: .* .*MySQL Community Server.*",
    "Tcp port:.* Unix socket:.*",
    "Time.*Id.*Command.*Argument.*",
)
COMMENT_MARK = "# "
CONTINUATION_MARK = "\t"

CHUNK_BITS = 16
SEGMENT_BYTES = 16 * 1024**3
PIECE_BYTES = 1024**2
STATEMENT_BYTES = 16 * 1024**2
BEFORE_ALL = -1
# No file is longer; files of a series take one such span each.
FILE_SPAN = 1 << 46

_ORDER = ("block", "pos")


def is_banner(value: Column) -> Column:
    version, port, heads = (line_pattern(p).matches(value) for p in BANNERS)
    return (value.startswith("/") & version) | (value.startswith("T") & (port | heads))


def is_header(value: Column) -> Column:
    """A comment line, or a line the server prints on reopening."""
    return value.startswith(COMMENT_MARK) | is_banner(value)


def group_slow_log(lines: DataFrame, prefix: str | None = None, **sizes) -> DataFrame:
    """Entries of a slow log: one starts at a header line that follows a body line.

    A trailing run of headers without any body is not an entry. An entry longer than a
    piece has a row for each of its ``parts``.
    """
    clean = lines.withColumn("value", trim_space(F.col("value")))
    if prefix:
        pattern = line_pattern(prefix if prefix.startswith("^") else "^" + prefix)
        clean = clean.withColumn("value", F.regexp_replace("value", "(?d)" + pattern.java, ""))
    opens = clean.withColumn("opens", is_header(F.col("value")))
    return assemble(opens, after_body_only=True, **sizes).filter(~F.col("tail_opens")).drop("tail_opens")


def group_continuations(lines: DataFrame, prefix: str | None = None, **sizes) -> DataFrame:
    """Entries of a log in which a line that starts with a tab belongs to the line above."""
    clean = lines
    if prefix:
        pattern = line_pattern(prefix if prefix.startswith("^") else "^" + prefix)
        clean = clean.withColumn("value", F.regexp_replace("value", "(?d)" + pattern.java, ""))
    opens = clean.withColumn("opens", ~F.col("value").startswith(CONTINUATION_MARK))
    return assemble(opens, after_body_only=False, **sizes).drop("tail_opens")


def left_over(pieces: DataFrame, after_body_only: bool, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The entries that a memory holds, once nothing more is to come."""
    numbered = _numbered(pieces, after_body_only, SEGMENT_BYTES)
    return staged(_joined(pieces, numbered, piece_bytes), "open-entries")


def rejoined(entries: DataFrame, limit: int = STATEMENT_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Entries of several rows as one row again where they have at most ``limit`` bytes; longer ones stay in parts."""
    several = entries.filter("parts > 1")
    if several.isEmpty():
        return entries
    short = F.col("parts") <= max(limit // piece_bytes, 1)
    by = ["file", "block", "pos"]
    one = several.filter(short).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("part", "lines"))).alias("_parts"))
    whole = one.withColumns({
        "part": F.lit(0).cast("bigint"), "parts": F.lit(1).cast("bigint"), "lines": F.flatten(F.transform("_parts", lambda p: p["lines"]))}).drop("_parts")
    return entries.filter("parts = 1").unionByName(whole).unionByName(several.filter(~short))


def in_file_order(lines: DataFrame) -> DataFrame:
    """Bring a shuffled line table back into file order, balanced over its partitions."""
    order = ("file", "block", "pos")
    return lines.repartitionByRange(*order).sortWithinPartitions(*order)


_PIECES = (
    "file string, block bigint, pos bigint, n_bytes bigint, opens boolean, tail_opens boolean, whole boolean, "
    "lines array<string>, open_lines array<string>, changed bigint"
)


def assemble(
    lines: DataFrame, after_body_only: bool, segment_bytes: int = SEGMENT_BYTES, piece_bytes: int = PIECE_BYTES,
    memory: Slots | None = None, rotated: str | None = None,
) -> DataFrame:
    """Merge lines to ``entries(file, block, pos, part, parts, lines, tail_opens)``.

    With a ``memory``, entries go on over files and batches. Files whose path differs only by what
    ``rotated`` matches are one series, in the order of their time of change (column ``changed`` of the
    lines); ``file`` then is the series. The last entry of a series is left to the next batch, unless it is
    longer than ``STATEMENT_BYTES``, and what the batch before left comes before the lines of this one.

    ``opens`` on a line says it may start an entry; with ``after_body_only`` it does
    so only after a line that may not. ``(block, pos)`` is the place of the first line.
    Runs one job over the lines and a small one over the open pieces.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut_pieces(batches, after_body_only, piece_bytes)

    lines = lines if "changed" in lines.columns else lines.withColumn("changed", F.lit(0).cast("bigint"))
    pieces = staged(lines.select("file", *_ORDER, "value", "opens", "changed").mapInArrow(cut, _PIECES), "pieces")
    open_pieces = pieces.filter("NOT whole").drop("whole", "lines")
    if memory is not None:
        # Every file has an open piece, so these few rows know all files.
        by_time = Window.partitionBy("_series").orderBy("changed", "file")
        files = open_pieces.groupBy("file").agg(F.max("changed").alias("changed")).withColumn("_series", F.regexp_replace("file", rotated or "^$", ""))
        ranked = files.select("file", "_series", F.row_number().over(by_time).cast("bigint").alias("_rank"))
        open_pieces = open_pieces.join(ranked, "file").withColumns({"file": F.col("_series"), "block": F.col("_rank") * FILE_SPAN + F.col("block")})
        open_pieces = open_pieces.drop("_series", "_rank")
        pieces = pieces.withColumn("file", F.regexp_replace("file", rotated or "^$", ""))
    whole = pieces.filter("whole").select(
        "file", *_ORDER, F.lit(0).cast("bigint").alias("part"), F.lit(1).cast("bigint").alias("parts"), "lines", F.lit(False).alias("tail_opens"))
    earlier = memory.read() if memory is not None else None
    if earlier is not None:
        open_pieces = open_pieces.unionByName(earlier)
    numbered = _numbered(open_pieces, after_body_only, segment_bytes)
    if memory is not None:
        numbered = staged(numbered, "numbered")
        newest = numbered.groupBy("file").agg(F.max_by(F.struct("entry", "begun"), "entry").alias("_last"), F.max(F.col("before") + F.col("n_bytes")).alias("_end"))
        newest = newest.filter(F.col("_end") - F.col("_last.begun") <= STATEMENT_BYTES).select("file", F.col("_last.entry").alias("entry"))
        left = numbered.join(newest, ["file", "entry"], "left_semi")
        # What goes on is placed before all lines to come, in its order.
        in_order = Window.partitionBy("file").orderBy(*_ORDER)
        later = open_pieces.join(left.select("file", *_ORDER), ["file", *_ORDER], "left_semi")
        memory.write(later.withColumns({"pos": F.row_number().over(in_order).cast("bigint"), "block": F.lit(BEFORE_ALL)}))
        numbered = numbered.join(newest, ["file", "entry"], "left_anti")
        open_pieces = open_pieces.join(numbered.select("file", *_ORDER), ["file", *_ORDER], "left_semi")
    joined = _joined(open_pieces, numbered, piece_bytes)
    return whole.unionByName(staged(joined, "open-entries"))


def _numbered(pieces: DataFrame, after_body_only: bool, segment_bytes: int) -> DataFrame:
    """(file, block, pos, entry, before, begun): the statement of a piece, the bytes of the file's open
    pieces before it, and before the statement. A prefix scan of summaries in two levels."""
    place = F.struct(*_ORDER)
    told = pieces.select("file", *_ORDER, "n_bytes", "opens", "tail_opens", F.floor(F.col("block") / segment_bytes).alias("_segment"))
    ends = told.groupBy("file", "_segment").agg(F.max_by("tail_opens", place).alias("_tail"))
    over_segments = Window.partitionBy("file").orderBy("_segment")
    entering = ends.select("file", "_segment", F.lag("_tail").over(over_segments).alias("_entering"))
    in_order = Window.partitionBy("file", "_segment").orderBy(*_ORDER)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.coalesce(F.lag("tail_opens").over(in_order), F.col("_entering"))
    starts = F.col("opens") & (~before if after_body_only else before.isNotNull())
    local = told.join(entering, ["file", "_segment"]).withColumn("_start", F.coalesce(starts, F.lit(False)))
    local = local.withColumns({"_entry": F.sum(F.col("_start").cast("bigint")).over(so_far), "_before": F.sum("n_bytes").over(so_far) - F.col("n_bytes")})
    local = local.withColumn("_begun", F.last(F.when(F.col("_start"), F.col("_before")), ignorenulls=True).over(so_far))
    sums = local.groupBy("file", "_segment").agg(F.max("_entry").alias("_entries"), F.sum("n_bytes").alias("_bytes"), F.max("_begun").alias("_last"))
    base = over_segments.rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumns({
        "_entries_0": F.coalesce(F.sum("_entries").over(base), F.lit(0)), "_bytes_0": F.coalesce(F.sum("_bytes").over(base), F.lit(0))})
    carried = carried.withColumn("_begun_0", F.coalesce(F.last(F.col("_bytes_0") + F.col("_last"), ignorenulls=True).over(base), F.lit(0)))
    known = local.join(carried.select("file", "_segment", "_entries_0", "_bytes_0", "_begun_0"), ["file", "_segment"])
    return known.select(
        "file", *_ORDER, "n_bytes", "tail_opens", (F.col("_entries_0") + F.col("_entry")).alias("entry"), (F.col("_bytes_0") + F.col("_before")).alias("before"),
        F.coalesce(F.col("_bytes_0") + F.col("_begun"), F.col("_begun_0")).alias("begun"))


def _joined(pieces: DataFrame, numbered: DataFrame, piece_bytes: int) -> DataFrame:
    """Neighbouring pieces of one statement as one row, as long as they are no larger than a piece."""
    place = F.struct(*_ORDER)
    # Pieces that begin in the same stretch of ``piece_bytes`` of their statement are one part.
    placed = numbered.withColumn("_stretch", F.floor((F.col("before") - F.col("begun")) / piece_bytes))
    stretches = placed.groupBy("file", "entry", "_stretch").agg(
        F.min(place).alias("_from"), F.max_by("tail_opens", place).alias("tail_opens"))
    by_entry = Window.partitionBy("file", "entry")
    # One row per part; a statement of many parts has one row for each MB of it here.
    counted = stretches.withColumns({
        "part": F.row_number().over(by_entry.orderBy("_stretch")).cast("bigint") - 1, "parts": F.count("*").over(by_entry),
        "_head": F.min("_from").over(by_entry), "_tail": F.max_by("tail_opens", "_stretch").over(by_entry)})
    told = pieces.select("file", *_ORDER, "open_lines").join(placed.select("file", *_ORDER, "entry", "_stretch"), ["file", *_ORDER])
    texts = told.groupBy("file", "entry", "_stretch").agg(F.sort_array(F.collect_list(F.struct(*_ORDER, "open_lines"))).alias("_texts"))
    return texts.join(counted, ["file", "entry", "_stretch"]).select(
        "file", F.col("_head.block").alias("block"), F.col("_head.pos").alias("pos"), "part", "parts",
        F.flatten(F.transform("_texts", lambda t: t["open_lines"])).alias("lines"), F.col("_tail").alias("tail_opens"))


def _cut_pieces(batches: Iterator[pa.RecordBatch], after_body_only: bool, piece_bytes: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the lines of one partition; the open one waits for the next batch."""
    waiting: list[pa.RecordBatch] = []
    last = None  # (file, block, opens) of the row before
    inside, held, part = False, 0, 0  # whether the open piece began with its run; bytes of the run; its number of pieces
    for batch in batches:
        if batch.num_rows == 0:
            continue
        opens, new_split = batch.column("opens").to_numpy(zero_copy_only=False), _new_splits(batch, last)
        before = np.concatenate([[bool(last and last[2])], opens[:-1]])
        starts = opens & ~before if after_body_only else opens.copy()
        fresh = starts | new_split
        sizes = pc.fill_null(pc.binary_length(batch.column("value")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ahead = np.cumsum(sizes) - sizes
        run_from = np.maximum.accumulate(np.where(fresh, ahead, -held))
        number = (ahead - run_from) // piece_bytes
        cut = fresh | (number != np.concatenate([[part], number[:-1]]))
        last = (batch.column("file")[-1].as_py(), batch.column("block")[-1].as_py(), bool(opens[-1]))
        held, part = int(ahead[-1] + sizes[-1] - run_from[-1]), int(number[-1])
        at = np.flatnonzero(cut)
        if at.size == 0:
            waiting.append(batch)
            continue
        table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
        shift = table.num_rows - batch.num_rows
        ends_whole = (starts & ~new_split)[at]
        first = at + shift
        if shift:
            first, whole = np.concatenate([[0], first]), np.concatenate([[inside], ends_whole])
        else:
            whole = ends_whole
        # A piece is a whole run if it begins and ends where runs of the same split do.
        yield from _as_pieces(table, first, whole[:-1] & whole[1:])
        inside = bool(whole[-1])
        waiting = [pa.Table.from_batches(table.slice(int(first[-1])).to_batches()).combine_chunks().to_batches()[0]]
    if waiting:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield from _as_pieces(table, np.array([0, table.num_rows]), np.array([False]))


def _new_splits(batch: pa.RecordBatch, last: tuple | None) -> np.ndarray:
    """For every row whether it is the first of its split."""
    file, block = batch.column("file"), batch.column("block").to_numpy()
    out = np.zeros(len(block), dtype=bool)
    if len(block) > 1:
        other = pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
        out[1:] = other | (block[1:] != block[:-1])
    out[0] = last is None or (file[0].as_py(), int(block[0])) != last[:2]
    return out


def _as_pieces(table: pa.Table, first: np.ndarray, whole: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``first[i]:first[i + 1]`` as one piece each; whole ones and open ones in batches of their own."""
    if not len(whole):
        return
    groups = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
    sizes = pc.fill_null(pc.binary_length(table.column("value")), 0).to_numpy().astype(np.int64) + 1
    ahead = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in zip(groups, [*groups[1:], len(whole)], strict=True):
        at = first[a : b + 1]
        heads, tails = pa.array(at[:-1]), pa.array(at[1:] - 1)
        values = table.column("value").slice(int(at[0]), int(at[-1] - at[0])).combine_chunks()
        held = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), values)
        nothing = pa.nulls(b - a, held.type)
        done = bool(whole[a])
        columns = [
            *[table.column(c).take(heads).combine_chunks() for c in ("file", "block", "pos")], pa.array(ahead[at[1:]] - ahead[at[:-1]]),
            table.column("opens").take(heads).combine_chunks(), table.column("opens").take(tails).combine_chunks(),
            pa.array(whole[a:b]), held if done else nothing, nothing if done else held, table.column("changed").take(heads).combine_chunks(),
        ]
        names = [c.split()[0] for c in _PIECES.split(", ")]
        yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=names)


def carry_forward(
    events: DataFrame,
    value: Column,
    out: str,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Stamp the last non-null value seen so far in the file, the row itself included.

    Two levels again: a window inside each chunk, and one row per chunk that brings
    in the value known at its start.
    """
    by = ["file", "block", "_part"]
    chunked = events.withColumn("_part", F.shiftright("pos", chunk_bits)).withColumn("_value", value)
    in_chunk = Window.partitionBy(*by).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunked.withColumn("_local", F.last("_value", ignorenulls=True).over(in_chunk))
    # One row per chunk: its last value, and from the chunks before it the one at its start.
    ends = chunked.groupBy(*by).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("pos"))).alias("_end")
    )
    before = Window.partitionBy("file").orderBy("block", "_part").rowsBetween(Window.unboundedPreceding, -1)
    start = ends.select(*by, F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    joined = local.join(start, by, "left")
    return joined.withColumn(out, F.coalesce("_local", "_carried")).drop("_part", "_value", "_local", "_carried")


def carry_in_scan(lines: DataFrame, mark: Column, out: str) -> DataFrame:
    """Stamp the last non-null mark of the file on each line, the line itself included, in the order of the scan.

    A first look at the marks gives one row per split, its last mark; from these follows what
    each split begins with. Only the splits at which that changes, at most as many as the driver lists files
    and splits for the scan, go along with the tasks. Then every split fills in its own lines: no line is shuffled.
    """
    marked = lines.withColumn("_mark", mark.cast("string"))
    last = F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("pos")))
    ends = marked.groupBy("file", "block").agg(last.alias("_end"))
    in_file = Window.partitionBy("file").orderBy("block")
    start = ends.select("file", "block", F.last("_end", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_start"))
    changes = start.withColumn("_before", F.lag("_start").over(in_file)).filter("NOT _start <=> _before").orderBy("file", "block")
    known: dict[str, tuple[list[int], list[str]]] = {}
    for row in changes.toLocalIterator():
        blocks, values = known.setdefault(row.file, ([], []))
        blocks.append(row.block)
        values.append(row["_start"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _filled(batches, known, out)

    kept = [f for f in lines.schema.fields if f.name != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{out}` string"
    return marked.select([f.name for f in kept] + ["_mark"]).mapInArrow(fill, schema)


def _filled(batches: Iterator[pa.RecordBatch], known: dict, out: str) -> Iterator[pa.RecordBatch]:
    last, state = None, None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        marks = batch.column("_mark")
        new, valid = _new_splits(batch, last), marks.is_valid().to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new & ~valid)
        begin = []
        for i in starts.tolist():
            blocks, values = known.get(batch.column("file")[i].as_py(), ([], []))
            at = bisect.bisect_right(blocks, batch.column("block")[i].as_py())
            begin.append(values[at - 1] if at else None)
        pool = pa.concat_arrays([marks, pa.array(begin, pa.string()), pa.array([state], pa.string())])
        source = np.arange(n)
        source[starts] = n + np.arange(len(starts))
        latest = np.maximum.accumulate(np.where(valid | new, np.arange(n), -1))
        filled = pool.take(pa.array(np.where(latest < 0, len(pool) - 1, source[latest])))
        last, state = (batch.column("file")[-1].as_py(), batch.column("block")[-1].as_py(), False), filled[-1].as_py()
        names = [c for c in batch.schema.names if c != "_mark"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], filled], names=[*names, out])
