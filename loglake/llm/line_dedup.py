"""Line dedup that can be taken back: exact reference counts behind sharded cuckoo filters.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
lower-cased. Keys of at least ``min_chars`` code points that ``min_docs`` documents hold
lose all their lines, except in the largest doc_id that holds them.

The state is a folder of plain tables. ``references`` has a row for each insertion or
deletion of a (key, document): a sum of +1 and -1, so nothing that was counted is ever
lost, and a deletion restores the state before the insertion. ``counts`` follows from it:
documents and largest doc_id of every key. ``filters`` holds a cuckoo filter per shard
over the keys that are common now. A batch of insertions or deletions changes the filters
of the shards it touches by the keys that became common or ceased to be; a filter that
is full is rebuilt from the exact counts.

To clean documents, their keys are first held against the filter of their shard. The few
that pass are joined with the exact counts, so a false hit of a filter changes nothing.
Shards are read as a stream, split by a salt, with the filter first: no task holds more
than one filter and one batch, however often a line occurs.

Defined cases: a NULL or empty text is one empty line and stays as it is. Rows without a
doc_id are neither counted nor cleaned. Rows that share a doc_id are one document. A
deletion must name what was inserted; deleting a document that is not there is an error of
the caller that leaves its counts unchanged (sums below one count as none). Columns called
n_lines and n_dropped are replaced.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import cuckoo
from loglake.llm.names import unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANKS = b" \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
SHARDS = 64
SALTS = 16


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit key of a line, or None if the line is too short to count."""
    if len(line) < min_chars:
        return None
    line = line.strip(BLANKS).lower()
    if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(line, digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int, shards: int) -> DataFrame:
    """(doc_id, shard, key): the distinct long keys of every document."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = text.as_py()
                if body is None:
                    continue
                found = {line_key(line, min_chars) for line in body.encode().split(b"\n")} - {None}
                ids += [doc_id] * len(found)
                keys += sorted(found)
            # Other bytes than those the filters use.
            shard = [int.from_bytes(k[8:12], "big") % shards for k in keys]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(shard, pa.int32()), pa.array(keys, pa.binary())],
                                  names=["doc_id", "shard", "key"])

    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return known.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, shard int, key binary")


def as_numbers(keys) -> np.ndarray:
    """The first half of each key as a number, for the filters."""
    return np.frombuffer(b"".join(k[:8] for k in keys), dtype=np.uint64)


_NOTE = "version int, shards int, min_chars int, min_docs int"


class LineIndex:
    """The state in a folder that all executors share; versions are folders, old ones stay.

    An index made on a folder that holds one goes on from it, with its shards and limits: each change
    ends with a note of its version, written to two places in turn. What a lost change has left is written over.
    """

    def __init__(self, spark: SparkSession, root: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 shards: int | None = None) -> None:
        self.spark, self.root = spark, root
        # As many shards as shuffles have partitions: a filter grows no more than a task's share.
        self.shards = shards or max(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.min_chars, self.min_docs = min_chars, min_docs
        self.version = 0
        known = self._noted()
        if known is not None:
            self.version, self.shards, self.min_chars, self.min_docs = known

    def _noted(self) -> tuple | None:
        """The newest note: version, shards and limits."""
        reader = self.spark.read.schema(_NOTE).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        try:
            row = reader.parquet(f"{self.root}/notes").orderBy(F.desc("version")).first()
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err):
                return None
            raise
        return None if row is None else tuple(row)

    def _note(self) -> None:
        row = self.spark.createDataFrame([(self.version, self.shards, self.min_chars, self.min_docs)], _NOTE)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/notes/{self.version % 2}")

    def references(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], "doc_id long, shard int, key binary, change int")
        paths = [f"{self.root}/references-{k}" for k in range(1, self.version + 1)]
        return self.spark.read.schema("doc_id long, shard int, key binary, change int").parquet(*paths)

    def counts(self) -> DataFrame:
        """(shard, key, n_docs, last_doc) of every key, and nothing that is estimated."""
        if not self.version:
            return self.spark.createDataFrame([], "shard int, key binary, n_docs long, last_doc long")
        return self.spark.read.parquet(f"{self.root}/counts-{self.version}")

    def filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], "shard int, filter binary")
        return self.spark.read.parquet(f"{self.root}/filters-{self.version}")

    def insert(self, docs: DataFrame) -> None:
        """Count the lines of new documents."""
        self._apply(line_keys(docs, self.min_chars, self.shards).withColumn("change", F.lit(1)))

    def delete(self, docs: DataFrame) -> None:
        """Take back documents by their doc_id; their texts are not needed."""
        ids = docs.select(F.col("doc_id").cast("long")).distinct()
        held = self.references().join(ids, "doc_id", "left_semi").groupBy("doc_id", "shard", "key")
        self._apply(held.agg(F.sum("change").cast("int").alias("n")).filter("n > 0")
                    .select("doc_id", "shard", "key", (-F.col("n")).alias("change")))

    def _apply(self, changes: DataFrame) -> None:
        before, old_filters, first = self.counts(), self.filters(), not self.version
        changes.write.mode("overwrite").parquet(f"{self.root}/references-{self.version + 1}")
        self.version += 1
        live = self.references().groupBy("shard", "key", "doc_id").agg(F.sum("change").alias("n")).filter("n > 0")
        exact = live.groupBy("shard", "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        exact.write.mode("overwrite").parquet(f"{self.root}/counts-{self.version}")
        now = self.common(self.counts()).select("shard", "key")
        if first:
            moves = now.withColumn("kind", F.lit(1))
        else:
            then = self.common(before).select("shard", "key")
            moves = now.join(then, ["shard", "key"], "left_anti").withColumn("kind", F.lit(1)).union(
                then.join(now, ["shard", "key"], "left_anti").withColumn("kind", F.lit(-1)))
        touched = moves.groupBy("shard").cogroup(old_filters.groupBy("shard")).applyInPandas(
            change_filter, "shard int, filter binary, full boolean").repartition("shard")
        touched.write.mode("overwrite").parquet(f"{self.root}/changed-{self.version}")
        touched = self.spark.read.parquet(f"{self.root}/changed-{self.version}")
        full = touched.filter("full").select("shard")
        rebuilt = now.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(build_filter, "shard int, filter binary")
        touched.filter("not full").select("shard", "filter").unionByName(rebuilt).write.mode("overwrite").parquet(
            f"{self.root}/filters-{self.version}")
        self._note()

    def common(self, counts: DataFrame) -> DataFrame:
        return counts.filter(F.col("n_docs") >= self.min_docs)

    def droppable(self, keys: DataFrame) -> DataFrame:
        """doc_id and the keys whose lines it loses, of rows (doc_id, shard, key)."""
        maybe = screened(keys, self.filters())
        exact = self.common(self.counts()).select("key", "last_doc")
        sure = maybe.join(exact, "key").filter("doc_id <> last_doc")
        return sure.groupBy("doc_id").agg(F.collect_set("key").alias("_gone"))

    def clean(self, docs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """The documents without their common lines, with n_lines (before) and n_dropped.

        ``keys`` may be given where the keys of the documents are at hand.
        """
        keys = line_keys(docs, self.min_chars, self.shards) if keys is None else keys
        name, drop, cut = (unused(docs, n) for n in ("_id", "_gone", "_cut"))
        gone = self.droppable(keys).withColumnsRenamed({"doc_id": name, "_gone": drop})
        joined = docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left")
        joined = joined.withColumn(cut, cut_lines(self.min_chars)(F.col("text"), F.col(drop)))
        out = joined.withColumns({"text": F.when(F.col("text").isNotNull(), F.col(f"{cut}.text")),
                                  "n_lines": F.col(f"{cut}.n_lines"), "n_dropped": F.col(f"{cut}.n_dropped")})
        return out.drop(name, drop, cut)


def change_filter(moves: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    shard = int((moves if len(moves) else old)["shard"].iloc[0])
    held = old["filter"].iloc[0] if len(old) else None
    table = cuckoo.changed(held, as_numbers(moves["key"][moves["kind"] == 1]), as_numbers(moves["key"][moves["kind"] == -1]))
    return pd.DataFrame({"shard": [shard], "filter": [b"" if table is None else cuckoo.to_bytes(table)], "full": [table is None]})


def build_filter(keys: pd.DataFrame) -> pd.DataFrame:
    table = cuckoo.built(as_numbers(keys["key"]))
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "filter": [cuckoo.to_bytes(table)]})


def screened(keys: DataFrame, filters: DataFrame) -> DataFrame:
    """The keys that the filter of their shard lets through.

    Each part of a shard is a stream that begins with a copy of its filter.
    """
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(None).cast("long").alias("doc_id"),
                           F.lit(None).cast("binary").alias("key"), "filter")
    rows = keys.select("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), "doc_id", "key",
                       F.lit(None).cast("binary").alias("filter"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, table = None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(shards)) + 1
            keep = np.zeros(len(shards), dtype=bool)
            keys, held = batch.column("key"), batch.column("filter")
            starts = sorted({0, *edges.tolist(), *np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False)).tolist()})
            for begin, end in zip(starts, [*starts[1:], len(shards)], strict=True):
                if begin == end:
                    continue
                if held[begin].is_valid:
                    current, table = shards[begin], cuckoo.from_bytes(held[begin].as_py())
                    begin += 1
                if begin < end and current == shards[begin] and table is not None:
                    keep[begin:end] = cuckoo.contains(table, as_numbers(keys.slice(begin, end - begin).to_pylist()))
            kept = batch.filter(pa.array(keep))
            yield pa.record_batch([kept.column("doc_id"), kept.column("key")], names=["doc_id", "key"])

    dealt = rows.unionByName(parts).repartition(partitions, "shard", "salt")
    ordered = dealt.sortWithinPartitions("shard", "salt", F.col("filter").isNull())
    return ordered.mapInArrow(probe, "doc_id long, key binary")


def cut_lines(min_chars: int):
    """Text and the keys to drop, to text without them, lines before, lines dropped."""
    @F.arrow_udf("text string, n_lines long, n_dropped long")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        lines = pc.add(pc.count_substring(texts, "\n").cast(pa.int64()), 1)
        dropped = np.zeros(len(texts), np.int64)
        changed = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
        if len(changed):
            bodies = texts.to_pylist()
            for k in changed.tolist():
                drop = set(gone[k].as_py())
                before = bodies[k].encode().split(b"\n")
                kept = [line for line in before if line_key(line, min_chars) not in drop]
                dropped[k] = len(before) - len(kept)
                bodies[k] = b"\n".join(kept).decode()
            texts = pa.array(bodies, pa.string())
        return pa.StructArray.from_arrays([texts, lines, pa.array(dropped)], names=["text", "n_lines", "n_dropped"])

    return cut


def dedup_lines(docs: DataFrame, root: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Count all lines of the documents in a new index at ``root``, and clean the documents by it."""
    index = LineIndex(docs.sparkSession, root, min_chars, min_docs)
    index.insert(docs)
    return index.clean(docs, index.references().select("doc_id", "shard", "key"))


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, as the length of the text as it is now; NULL stays."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(F.coalesce("text", F.lit("")))).cast("long"))
