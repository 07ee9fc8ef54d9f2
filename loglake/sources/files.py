"""Log files as line tables: ``lines(file, block, pos, value)``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Side files a tailing agent leaves next to its logs.
SIDE_FILES = r"\..*|_.*|.*\.(?:state|offset|pos)"


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    exclude: str | None = SIDE_FILES,
    require_input: bool = True,
    changed: bool = False,
) -> DataFrame:
    """All lines of all files under the paths or globs, one row each, without order.

    Only a line feed ends a line, so a carriage return stays part of the text. With ``changed``
    each line carries the time its file was changed, in microseconds.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", "\n").text(wanted)
    if require_input:
        file_guard(raw, exclude)
    return raw.filter(_wanted(exclude)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        *([F.unix_micros("_metadata.file_modification_time").alias("changed")] if changed else []),
    )


def _wanted(exclude: str | None) -> Column:
    """Spark applies a filter on the file name to the listing, before it reads."""
    return ~F.col("_metadata.file_name").rlike(f"^(?:{exclude})$") if exclude else F.lit(True)


def file_guard(raw: DataFrame, exclude: str | None) -> None:
    """An error if no input file is left besides side files.

    One line is enough to know; only where there is none are the file names looked at.
    """
    if not raw.filter(_wanted(exclude)).select("value").limit(1).isEmpty():
        return
    skip = re.compile(exclude) if exclude else None
    if not any(not (skip and skip.fullmatch(name.rsplit("/", 1)[-1])) for name in raw.inputFiles()):
        raise FileNotFoundError("no log file is left to read")


def order_lines(lines: DataFrame) -> DataFrame:
    """Add ``pos``: with ``(file, block)`` it gives the order of lines inside a file.

    It must sit directly on the scan. A split is read front to back by one task, so
    the id grows along the text; splits of one file are ordered by their start byte.
    """
    more = [c for c in ("changed",) if c in lines.columns]
    return lines.withColumn("pos", F.monotonically_increasing_id()).select("file", "block", "pos", "value", *more)


def backfill(spark: SparkSession, paths: str | Sequence[str], exclude: str | None = SIDE_FILES, changed: bool = False) -> DataFrame:
    """Everything that is there now, once, in file order."""
    return order_lines(read_lines(spark, paths, exclude, changed=changed))


def lines_from(df: DataFrame, value, source=None, order=None) -> DataFrame:
    """A line table out of a table that already holds one line per row."""
    return df.select(
        (source if source is not None else F.lit("table")).alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        (order if order is not None else F.monotonically_increasing_id()).alias("pos"),
        value.alias("value"),
    )
