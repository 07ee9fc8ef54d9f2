"""What one micro-batch leaves for the next: small tables in two places, written in turn.

Batch n reads what batch n - 1 left and writes over what batch n - 2 left. A batch that runs
again therefore finds the same state as before, whatever it had written, and the state of a
stream takes two folders however long it runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Slots:
    """A named state of the stream below a folder of its checkpoint."""

    spark: SparkSession
    path: str
    number: int

    def read(self) -> DataFrame | None:
        """What the batch before left; None in the first batch, or where it left nothing."""
        if self.number == 0:
            return None
        try:
            # Every row says which batch left it, so an older place is never taken for the last one.
            rows = self.spark.read.parquet(f"{self.path}/{(self.number - 1) % 2}")
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
                return None
            raise
        return rows.filter(F.col("_left_by") == self.number - 1).drop("_left_by")

    def write(self, rows: DataFrame) -> DataFrame:
        """Leave these rows for the next batch; returns them as they were written."""
        place = f"{self.path}/{self.number % 2}"
        rows.withColumn("_left_by", F.lit(self.number).cast("bigint")).write.mode("overwrite").parquet(place)
        return self.spark.read.parquet(place).drop("_left_by")
