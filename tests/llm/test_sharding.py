import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loglake.llm import sharding


def plain_jump(key, shards):
    """The published loop, on whole numbers."""
    state = int(hashlib.md5(str("" if key is None else key).encode()).hexdigest()[:16], 16)
    at, following = -1, 0
    while following < shards:
        at = following
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        following = int((at + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_shards_against_the_plain_loop(spark, shards):
    ids = [None, 0, -1, 1 << 62, *range(2, 300)]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: r.s for r in rows.select("doc_id", sharding.jump_shard(F.col("doc_id"), shards).alias("s")).collect()}
    assert got == {i: plain_jump(i, shards) for i in ids}


def test_long_walks_end(spark):
    """With few steps at first, the rest of the walk gives the same shards."""
    rows = spark.range(4000).withColumnRenamed("id", "doc_id")
    got = [r.s for r in rows.orderBy("doc_id").select(sharding.jump_shard(F.col("doc_id"), 100_000).alias("s")).collect()]
    assert got == [plain_jump(i, 100_000) for i in range(4000)]


def test_an_appended_shard_takes_rows_only_into_itself(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    went = sharding.moved(rows, 8).groupBy("grown_shard").count().collect()
    assert [r.grown_shard for r in went] == [8]
    assert abs(went[0]["count"] - 20_000 / 9) < 200


def test_report_on_odd_rows(spark, odd_docs, no_docs):
    got = sharding.shard_report(odd_docs, 8).collect()
    texts = Counter((r.doc_id, r.text) for r in odd_docs.collect())
    wanted = Counter()
    for (i, t), n in texts.items():
        raw = (t or "").encode()
        wanted[(i, len(raw) + 1, zlib.crc32(raw), plain_jump(i, 8), plain_jump(i, 9))] += n
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == wanted
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_report(no_docs, 8).collect() == []


def test_many_equal_rows_fill_neighbouring_places(spark):
    rows = spark.range(10_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    rows = rows.unionByName(spark.range(500).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")))
    got = sharding.shard_report(rows, 2).collect()
    assert len(got) == 10_500
    for shard in (0, 1):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    hot = sorted(r.slot for r in got if r["size"] == 9)
    assert hot == list(range(hot[0], hot[0] + 10_000))


def test_written_shards_hold_every_row(spark, odd_docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(odd_docs, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == odd_docs.count()
    assert all(r.shard == plain_jump(r.doc_id, 4) for r in back.select("doc_id", "shard").collect())
