"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Settings that change results: fixed for every session.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only change the plan.
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile longer methods; wide parse projections go over the limit.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SPLIT_KEY = "spark.sql.files.minPartitionNum"
SHARED_DIR_KEY = "spark.checkpoint.dir"
PARTITION_BYTES = 256 * 1024 * 1024

_own_dirs: dict[str, str] = {}


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the settings above; with ``input_bytes``, size the shuffles for that input."""
    for key, value in {**SEMANTICS, **PLANNING}.items():
        spark.conf.set(key, value)
    # Two scans of the same files must cut them alike, whatever executors come and go.
    if spark.conf.get(SPLIT_KEY, None) is None:
        spark.conf.set(SPLIT_KEY, str(spark.sparkContext.defaultParallelism))
    if input_bytes:
        slots = spark.sparkContext.defaultParallelism
        wanted = max(slots, -(-input_bytes // PARTITION_BYTES))
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


@contextmanager
def with_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that only changes the plan, for the jobs inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def open_session(app: str = "loglake", master: str | None = None, partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Where no folder is named (a local test session) one is made for this application.
    """
    named = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder that every executor can reach")
        _own_dirs[app] = tempfile.mkdtemp(prefix="loglake-")
    return _own_dirs[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back.

    For a result that several branches of a plan need: they read it instead of
    each computing it from the start, and lost executors do not bring that work back.
    """
    scope = _scope.get()
    path = f"{scope.path}/{len(scope.used)}-{name}" if scope else fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    if scope:
        scope.used.append((path, df.schema))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class _Scope:
    path: str
    used: list = field(default_factory=list)


_scope: ContextVar[_Scope | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession, name: str, empty: bool = True) -> Iterator[None]:
    """What is staged inside is needed until the end of the block only.

    It lies below ``name`` in the shared folder, in places that a block of the same name
    writes over. At the end the tables are emptied, unless the next block will do that.
    """
    scope = _Scope(f"{shared_dir(spark)}/{name}")
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        if empty:
            for path, schema in scope.used:
                spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
