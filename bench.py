"""Time the headline queries and print one JSON line.

Each query runs over its whole tables into a sink that drops the rows. Rendered log
files are written before the clock starts; one warm-up run loads code and caches.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINES = (
    "group_slow_log",
    "mysql_slow_events",
    "slow_query_digest",
    "slow_by_table",
    "postgres_slow_events",
    "access_log_events",
    "traffic_by_shape",
    "keyval_events",
    "json_events",
    "mysql_audit_events",
    "audit_activity",
    "arango_requests",
    "pair_requests",
    "mongo_events",
    "carry_replica_set",
    "dynamic_sample",
    "enrich_host",
    "outcome_counts",
    "write_table",
    "ingest_config",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loglake-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from loglake import catalog
    from loglake.catalog import render
    from loglake.session import tune

    tune(spark)
    paths = {"slow_log": render.slow_log_path(spark, sf_dir), "postgres": render.postgres_path(spark, sf_dir)}
    lines = {name: spark.read.text(path).count() for name, path in paths.items()}
    lines["access_log"] = render.table(spark, sf_dir, "lineitem").count()
    lines["arango"] = 3 * lines["access_log"]
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINES
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            begun = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    rates = {
        name: round(lines[corpus] / seconds[name])
        for name, corpus in (
            ("group_slow_log", "slow_log"),
            ("mysql_slow_events", "slow_log"),
            ("postgres_slow_events", "postgres"),
            ("access_log_events", "access_log"),
            ("arango_requests", "arango"),
        )
        if name in seconds
    }
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "lines_per_sec": rates,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
