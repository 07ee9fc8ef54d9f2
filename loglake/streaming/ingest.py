"""Continuous ingest. Files are taken whole: they must be rolled or immutable.

The unit of progress is the file; the checkpoint knows which files were read, so a
lost executor or driver resumes without gap or repeat. What a batch leaves for the next,
open statements and counts of windows, lies beside the checkpoint.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglake.config import IngestConfig
from loglake.operators.grouping import left_over
from loglake.plans.jobs import ingested, sort_columns, typed_fields
from loglake.session import scratch, tune
from loglake.sources.files import SIDE_FILES, order_lines
from loglake.sources.runs import committed, folder, note, others_hold_rows, run_note, stream_run
from loglake.sources.tables import write_table
from loglake.streaming.state import Slots
from loglake.streaming.status import DURATIONS, report_status

Parse = Callable[..., DataFrame]


def ingest_stream(
    spark: SparkSession,
    path: str,
    read_from: str = "last",
    since: datetime | None = None,
    max_files: int | None = None,
    exclude: str | None = SIDE_FILES,
    max_bytes: int | None = None,
) -> DataFrame:
    """New files as unordered lines. ``end`` skips files that were there at ``since`` (now).

    A batch takes at most ``max_files`` files, or as many as ``max_bytes`` reaches and one at least.
    """
    if max_files and max_bytes:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    raw = reader.load(path)
    lines = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_modification_time").alias("_changed"),
        F.unix_micros("_metadata.file_modification_time").alias("changed"),
    )
    if read_from == "end":
        start = since or datetime.now(timezone.utc)
        lines = lines.filter(F.col("_changed") > F.lit(start))
    if exclude:
        lines = lines.filter(~F.col("_name").rlike(f"^(?:{exclude})$"))
    return lines.drop("_name", "_changed")


def resume_point(checkpoint: str, read_from: str) -> str:
    """``last`` goes on where the checkpoint stands; the others have a checkpoint of their own below it.

    It is the same each time, so a job that was cut off goes on from it.
    """
    return checkpoint if read_from == "last" else f"{checkpoint}/{read_from}"


def pace(writer, seconds: float = 10.0, once: bool = False):
    """How often a batch is taken: every ``seconds``, or all there is and then stop."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")


def write_stream(
    events: DataFrame, path: str, checkpoint: str, once: bool = False, seconds: float = 10.0
) -> StreamingQuery:
    """Rows that need no file order to a table, laid out by date as every other job's.

    Late rows are accepted however late they are: there is no watermark on this path.
    """
    return write_batches(events, lambda batch: batch, path, checkpoint, once, seconds)


def write_batches(
    lines: DataFrame, parse_batch: Parse, path: str, checkpoint: str, once: bool = False, seconds: float = 10.0,
    sort_by: Sequence[str] = ("_time",), after: Callable[[str, int], None] | None = None,
) -> StreamingQuery:
    """Formats that need file order: each micro-batch holds whole files and is one batch job.

    The checkpoint and the batch number name the folder and the folder is overwritten, so a
    batch that runs again replaces what it wrote before, and another run's never. Once it
    is written the batch is noted; only noted batches are read. ``parse_batch`` takes the lines
    and, where it wants one, the number of the batch. ``after`` is called with run and number between
    the two.
    """
    run = stream_run(checkpoint)
    numbered = len(inspect.signature(parse_batch).parameters) > 1

    def one_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch(spark, run, empty=False):
            ordered = order_lines(batch) if "block" in batch.columns else batch
            done = parse_batch(ordered, number) if numbered else parse_batch(ordered)
            parts = ["_outcome"] if "_outcome" in done.columns else []
            write_table(done, folder(path, run, number), sort_by, mode="overwrite", extra_partitions=parts)
            if after:
                after(run, number)
        note(spark, path, run, number, checkpoint)

    writer = lines.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return pace(writer, seconds, once).start()


def _undated(entries: DataFrame) -> DataFrame:
    return entries.withColumn("_time", F.lit(None).cast("timestamp")).withColumn("_date", F.lit(None).cast("date"))


def group_stream(
    lines: DataFrame, group: Callable[..., DataFrame], path: str, checkpoint: str, once: bool = False, rotated: str | None = None
) -> StreamingQuery:
    """Statements of a stream of files, ordered inside each batch.

    With ``rotated``, a pattern for what rotation adds to a path, a statement may go on in the next file
    of its series, in this batch or a later one: the last statement of a series waits beside the checkpoint
    for the file that goes on. ``close_series`` returns those that still wait.
    """
    def grouped(ordered: DataFrame, number: int) -> DataFrame:
        if rotated is None:
            return _undated(group(ordered.drop("changed")))
        return _undated(group(ordered, memory=Slots(ordered.sparkSession, f"{checkpoint}/open-statements", number), rotated=rotated))

    return write_batches(lines, grouped, path, checkpoint, once)


def close_series(spark: SparkSession, path: str, checkpoint: str, after_body_only: bool) -> DataFrame:
    """The statements that wait for a next file, as entries, once none will come."""
    last = run_note(spark, path, stream_run(checkpoint))
    waiting = Slots(spark, f"{checkpoint}/open-statements", last.upto + 1).read() if last is not None else None
    if waiting is None:
        raise ValueError(f"no statement waits beside {checkpoint}")
    entries = left_over(waiting, after_body_only)
    return entries.filter("NOT tail_opens").drop("tail_opens") if after_body_only else entries.drop("tail_opens")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return committed(spark, path)


def run_stream(spark: SparkSession, cfg: IngestConfig, ingest_time: Column | None = None) -> StreamingQuery:
    """The job of the options as a stream over all its paths: read, parse, reshape and store each batch.

    A job that was cut off goes on from its checkpoint, also one that began at the beginning
    or the end. Reading from the beginning into a dataset that holds rows of another job could
    repeat them, and is refused. ``ingest_time`` is the time of events that carry none. With ``status_seconds``
    the outcomes are counted per interval beside the table (``read_status``).
    """
    if not cfg.checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    tune(spark)
    checkpoint = resume_point(cfg.checkpoint, cfg.read_from)
    run = stream_run(checkpoint)
    if cfg.read_from == "beginning" and others_hold_rows(spark, cfg.dataset, run):
        raise ValueError(f"{cfg.dataset} holds rows of another job; reading from the beginning could repeat them")
    known = run_note(spark, cfg.dataset, run)
    since = known.since if known is not None else datetime.now(timezone.utc)
    if known is None:
        note(spark, cfg.dataset, run, -1, checkpoint, since)
    streams = [
        ingest_stream(spark, p, cfg.read_from, since, cfg.max_files_per_trigger, max_bytes=cfg.max_bytes_per_trigger) for p in dict.fromkeys(cfg.paths)]
    lines = reduce(DataFrame.unionByName, streams)

    def batch(ordered: DataFrame, number: int) -> DataFrame:
        memory = {name: Slots(ordered.sparkSession, f"{checkpoint}/{name}", number) for name in ("window-counts", "open-statements")}
        return typed_fields(ingested(ordered, cfg, ingest_time, memory)[0], cfg, run, number)

    def status(run: str, number: int) -> None:
        memory = Slots(spark, f"{checkpoint}/status", number)
        report_status(spark, cfg.dataset, run, number, memory, cfg.status_seconds, cfg.status_delay_seconds, DURATIONS.get(cfg.format))

    after = status if cfg.status_seconds else None
    return write_batches(lines, batch, cfg.dataset, checkpoint, cfg.stop, cfg.flush_seconds, sort_columns(cfg), after)
