"""Log analytics as Spark jobs: raw log lines to typed tables to rollups."""

from loglake.config import IngestConfig
from loglake.session import open_session, tune

__all__ = ["IngestConfig", "open_session", "tune"]
