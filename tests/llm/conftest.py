import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in all columns, empty, blank and very long texts, ties, repeated rows, an extra column."""
    rows = [
        (1, None, "en", "s"), (2, "", None, None), (3, " \t\n ", "en", "s"), (4, LONG, "en", "s"), (5, LONG, "en", "s"), (5, LONG, "en", "s"),
        (None, "a text without an id, long enough to be a line of its own", "fr", "s"), (6, "one", "en", "s"), (7, "é ▁   end\n", "fr", "s"),
        (8, "under the MIT License.\nApache-License version 2", "en", "s"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    helpers = {c: F.lit("mine") for c in ("_id", "_gone", "_gone_", "_cut", "_language", "_text", "_key", "_gone_id", "text_hash", "component_id", "node", "rep")}
    return df.withColumns(helpers).withColumns({"score": F.lit("mine"), "kept": F.lit("mine"), "samples": F.lit(1), "lang_pred": F.lit("mine"), "key": F.lit("k")})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
