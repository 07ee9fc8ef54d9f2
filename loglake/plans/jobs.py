"""One ingest job from options: lines to events to a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.config import ConfigError, IngestConfig
from loglake.formats.mongo import lock_counts, with_replica_set
from loglake.formats.registry import TABLE_OF, TAKES_INGEST_TIME, TAKES_TZ, get_format
from loglake.functions.regexes import line_pattern
from loglake.functions.times import time_columns
from loglake.functions.urls import request_shape
from loglake.operators.hosts import STATUS_FIELDS, enrich_host
from loglake.operators.lines import split_rejects
from loglake.operators.sampling import dynamic_sample, sample_lines
from loglake.operators.transforms import add_fields, drop_fields, promote_fields, scrub_fields
from loglake.session import scratch, tune
from loglake.sources.evolving import evolve
from loglake.sources.files import backfill
from loglake.sources.runs import batch_run, folder, note
from loglake.sources.tables import conform, with_outcome, write_table
from loglake.streaming.state import Slots


Memory = Mapping[str, Slots]


def parse(lines: DataFrame, cfg: IngestConfig, ingest_time: Column | None = None, memory: Memory | None = None) -> DataFrame:
    """Sample on the scan where the format allows it, then read the lines."""
    options = dict(cfg.format_options)
    if cfg.log_prefix:
        options["prefix"] = cfg.log_prefix
    if cfg.format in TAKES_TZ:
        options.setdefault("tz", cfg.timezone)
    if cfg.format == "mongo":
        # A stamp without a year lies before the last change of its file.
        changed = F.timestamp_micros("changed") if "changed" in lines.columns else None
        options.setdefault("reference_time", ingest_time if ingest_time is not None else changed)
    if cfg.format in TAKES_INGEST_TIME and ingest_time is not None:
        options.setdefault("ingest_time", ingest_time)
    if cfg.entry_rate > 1:
        options |= {"rate": cfg.entry_rate, "seed": cfg.sample_seed}
    if cfg.multi_line and cfg.rotated and memory:
        options |= {"memory": memory["open-statements"], "rotated": cfg.rotated}
    # The name of the set comes from lines that sampling may drop.
    lines = with_replica_set(lines) if cfg.format == "mongo" else lines
    sampled = sample_lines(lines, cfg.line_rate, cfg.sample_seed)
    parsed = get_format(cfg.format)(sampled, **options)
    if cfg.format == "mongo":
        parsed = lock_counts(parsed)
    if cfg.host_status:
        parsed = with_host_status(parsed, cfg)
    if "sample_rate" not in parsed.columns:
        parsed = parsed.withColumn("sample_rate", F.lit(1 if cfg.dynamic else cfg.sample_rate))
    return parsed


def with_host_status(events: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Stamp the state of the host the log came from: a field of the event, or a part of the file's path."""
    status = events.sparkSession.read.parquet(cfg.host_status)
    if cfg.host_pattern:
        host = F.regexp_extract("file", line_pattern(cfg.host_pattern).java, 1)
    elif cfg.host_field in events.columns:
        host = F.col(cfg.host_field).cast("string")
    elif "data" in events.columns:
        host = F.element_at("data", F.lit(cfg.host_field)).cast("string")
    else:
        raise ConfigError(f"events of {cfg.format} have no field {cfg.host_field!r}")
    named = events.withColumn("_host_key", host)
    renamed = status.withColumnsRenamed({cfg.host_status_host: "_host_key", cfg.host_status_time: "_host_at"})
    fields = [f for f in STATUS_FIELDS if f in status.columns]
    return enrich_host(named, renamed, "_host_key", "_time", "_host_at", fields).drop("_host_key")


def reshape(events: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Drop, scrub, add, shape: always in this order."""
    out = drop_fields(events, cfg.drop_fields)
    out = scrub_fields(out, cfg.scrub_fields)
    out = add_fields(out, cfg.add_fields)
    for field in cfg.request_shape:
        if field not in out.columns and "data" in out.columns:
            out = out.withColumn(field, F.element_at("data", F.lit(field)).cast("string"))
        if field in out.columns:
            out = request_shape(out, field, cfg.request_patterns, cfg.shape_prefix, cfg.query_mode, cfg.query_keys)
    return out


def sample(events: DataFrame, cfg: IngestConfig, memory: Memory | None = None) -> DataFrame:
    """Dynamic sampling, last, so that its keys may be shaped fields."""
    out = events
    for key in cfg.dynamic_keys:
        if key not in out.columns:
            have = F.element_at("data", F.lit(key)).cast("string") if "data" in out.columns else F.lit("")
            out = out.withColumn(key, have)
    return dynamic_sample(
        out, cfg.dynamic_keys, cfg.sample_rate, cfg.dynamic_window_seconds, cfg.dynamic_min_per_second,
        memory=memory["window-counts"] if memory else None,
    )


def to_table(events: DataFrame, cfg: IngestConfig) -> tuple[DataFrame, tuple[str, ...]]:
    """Fit events to the table of their format, or add the stored time columns."""
    spec = TABLE_OF.get(cfg.format)
    second, day, millis = time_columns(F.col("_stamp"))
    stored = events.withColumn("_stamp", F.col("_time"))
    stored = stored.withColumn("_time", second).withColumn("_date", day).withColumn("_ms", millis).drop("_stamp")
    if spec is None:
        if cfg.promote_fields and "data" in stored.columns:
            stored = promote_fields(stored, cfg.promote_fields)
        # Formats without a map of fields keep what the line prefix held as ``extra``.
        if "prefix" in stored.columns and "data" not in stored.columns and "extra" not in stored.columns:
            stored = stored.withColumnRenamed("prefix", "extra")
        return stored.drop("block", "prefix"), ("_time",)
    return conform(stored, spec), spec.sort_by


def sort_columns(cfg: IngestConfig) -> tuple[str, ...]:
    spec = TABLE_OF.get(cfg.format)
    return spec.sort_by if spec else ("_time",)


def ingested(
    lines: DataFrame, cfg: IngestConfig, ingest_time: Column | None = None, memory: Memory | None = None
) -> tuple[DataFrame, tuple[str, ...]]:
    """Stored rows of a job, events and rejects marked by ``_outcome``, and their sort order.

    One pass over the lines; dynamic sampling needs its counts first and takes two. ``memory`` has
    what the batch before left, in a stream.
    """
    parsed = parse(lines, cfg, ingest_time, memory)
    if not cfg.dynamic:
        table, sort_by = to_table(reshape(parsed, cfg), cfg)
        return with_outcome(table), sort_by
    events, _ = split_rejects(parsed)
    table, sort_by = to_table(sample(reshape(events, cfg), cfg, memory), cfg)
    rejects, _ = to_table(parsed.filter(F.col("reject_reason").isNotNull()), cfg)
    return with_outcome(table.unionByName(rejects, allowMissingColumns=True)), sort_by


def typed_fields(table: DataFrame, cfg: IngestConfig, run: str, number: int) -> DataFrame:
    """With ``promote_share``, the frequent keys of the map of texts as typed fields.

    Of a declared table it is the map of what the table has no column for: the other variables of an access log, say.
    """
    texts = [c for c in ("data", "extra") if c in table.columns and table.schema[c].dataType.simpleString() == "map<string,string>"]
    return evolve(table, cfg.dataset, run, number, cfg.promote_share, texts[0]) if cfg.promote_share and texts else table


def run_batch(spark: SparkSession, cfg: IngestConfig, ingest_time: Column | None = None) -> None:
    """Read everything once and append it to the dataset, rejects in folders of their own.

    The rows count once all are written; a job that fails shows none of them. What the job
    stages is emptied at its end. Read the rows back with ``read_events`` and ``read_rejects``.
    """
    tune(spark)
    run = batch_run()
    with scratch(spark, run):
        table, sort_by = ingested(backfill(spark, cfg.paths, changed=cfg.format == "mongo"), cfg, ingest_time)
        table = typed_fields(table, cfg, run, 0)
        write_table(table, folder(cfg.dataset, run, 0), sort_by, extra_partitions=["_outcome"])
    note(spark, cfg.dataset, run, 0)
