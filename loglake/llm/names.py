"""Names for helper columns that no column of the caller bears."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(docs: DataFrame, name: str) -> str:
    """The name, with as many ``_`` after it as it takes to differ from all columns."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
