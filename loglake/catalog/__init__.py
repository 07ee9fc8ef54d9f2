"""The registered queries, one or more per operator."""

from loglake.catalog import event_queries, ingest_queries, job_queries  # noqa: F401
from loglake.catalog.base import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
