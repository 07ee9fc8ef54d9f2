"""Which runs of a dataset count: one commit record for batch jobs and streams.

Every job writes to ``_run=<id>/_batch=<n>`` below the dataset, and then notes in
``_commits`` that its batches up to n are complete. Readers take what is noted: a job that
failed shows nothing, and batch jobs and streams share a dataset.

Besides the note that opens it, a run has two and writes them in turn, each as a folder of one small
file, so the one before stays whole while the next is written, and their number does not grow with the batches.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
_NOTE = "run string, upto bigint, checkpoint string, since timestamp"


def batch_run() -> str:
    """The id of a batch job: each one adds to the dataset."""
    return f"batch-{uuid.uuid4().hex}"


def stream_run(checkpoint: str) -> str:
    """The id of a stream follows from its checkpoint: started again, it goes on as the same run."""
    return "stream-" + hashlib.sha1(checkpoint.encode()).hexdigest()[:16]


def folder(dataset: str, run: str, number: int) -> str:
    return f"{dataset}/_run={run}/_batch={number}"


def note(spark: SparkSession, dataset: str, run: str, upto: int, checkpoint: str | None = None, since: datetime | None = None) -> None:
    """Batches of the run up to this one are complete; -1 opens the run."""
    row = spark.createDataFrame([(run, upto, checkpoint, since)], _NOTE).coalesce(1)
    place = "open" if upto < 0 else str(upto % 2)
    row.write.mode("overwrite").parquet(f"{dataset}/{COMMITS}/{run}/{place}")


def notes(spark: SparkSession, dataset: str) -> DataFrame | None:
    """One row per run, or None for a folder that no job has written to."""
    reader = spark.read.schema(_NOTE).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        rows = reader.parquet(f"{dataset}/{COMMITS}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return None
        raise
    return rows.groupBy("run").agg(F.max("upto").alias("upto"), F.max_by("checkpoint", "upto").alias("checkpoint"), F.min("since").alias("since"))


def run_note(spark: SparkSession, dataset: str, run: str):
    """The note of one run, or None."""
    known = notes(spark, dataset)
    return None if known is None else known.filter(F.col("run") == run).first()


def committed(spark: SparkSession, dataset: str, merge_schema: bool = False) -> DataFrame:
    """The rows of all complete batches. A folder without notes, written by hand, is read as it is."""
    known = notes(spark, dataset)
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if known is None:
        return reader.parquet(dataset)
    table = reader.option("basePath", dataset).parquet(f"{dataset}/_run=*")
    done = known.filter("upto >= 0").select(F.col("run").alias("_run"), F.col("upto").alias("_upto"))
    # Runs are few; their folders are pruned by the join where Spark finds that worth it.
    return table.join(done, "_run").filter("_batch <= _upto").drop("_upto")


def others_hold_rows(spark: SparkSession, dataset: str, run: str) -> bool:
    """True if another run has committed rows, or files lie there that no job has noted."""
    known = notes(spark, dataset)
    if known is not None:
        return not known.filter((F.col("run") != run) & (F.col("upto") >= 0)).isEmpty()
    try:
        return not spark.read.parquet(dataset).isEmpty()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return False
        raise
