"""Token ids in training order as binary shards of a fixed stride.

Documents are encoded with a public byte-level vocabulary. The ids of a scan partition are
one stream, each document followed by an end mark, cut into sequences of ``length`` ids; the
last one is filled with end marks. Sequences are written once, compressed in blocks; their number per
partition gives every sequence its place in 0 .. n - 1.

A keyed Feistel permutation of the next power of four, walked on while it leaves 0 .. n - 1,
maps places to global slots: a shuffle in training order that needs no table, and can be
computed for one sequence alone. Slots are dealt by range, in the one shuffle there is, by shard; each task holds one shard at a time and writes it whole,
``per_shard`` slots of ``length`` 16-bit little-endian ids after one another. So slot s
stands in shard s // per_shard at byte (s % per_shard) * length * 2, and a training job that
stopped at slot s reads on from there. A shard is written under another name and then
renamed, and its bytes follow from the input alone, so a task that runs twice does no harm.

The order of the sequences before the permutation is that of the scan, which is fixed by
the files and by how the session cuts them; the written sequences are what later steps use.

Defined cases: a NULL or empty text is an end mark. Repeated rows are written each. A very long text runs
on over as many sequences as it needs. No two sequences have one place, so there are no ties. An empty table gives no shard. The last
shard may be shorter. Ids must fit in 16 bits. Columns other than the text are not looked at.
"""

from __future__ import annotations

import base64
import json
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm.arrays import mix
from loglake.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_MARK = 50256
LENGTH, PER_SHARD = 2048, 1024
# Sequences compressed together, blocks dealt to shards at once, and the level of compression.
BLOCK, DEALT_BLOCKS, LEVEL = 16, 128, 6
ROUNDS = 4
# Fixed value: how this vocabulary cuts texts before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def bpe_encoder(path: str = VOCABULARY_PATH) -> Callable[[], Callable[[str], list[int]]]:
    """Makes an encoder in each task from the vocabulary file that the driver has read."""
    with open(path, "rb") as file:
        content = file.read()

    def make() -> Callable[[str], list[int]]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines())}
        return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    return make


def feistel(places: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. n - 1, for many places at once."""
    half = 1
    while 1 << (2 * half) < n:
        half += 1
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 64) - 1))
    out = places.astype(np.uint64)
    rest = np.arange(len(out))
    while len(rest):
        left, right = out[rest] >> np.uint64(half), out[rest] & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        out[rest] = (left << np.uint64(half)) | right
        rest = rest[out[rest] >= np.uint64(n)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, make_encoder: Callable, length: int, end_mark: int) -> DataFrame:
    """(part, local, n, last, body): the streams of all partitions, cut; ``BLOCK`` sequences compressed together.

    ``local`` numbers the first sequence of a row in its partition; all are full but the last, which has ``last`` ids.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pack = make_encoder(), zstandard.ZstdCompressor(level=LEVEL).compress
        part, local = TaskContext.get().partitionId(), 0
        rest = np.zeros(0, "<u2")

        def rows(stream: np.ndarray, last: int) -> pa.RecordBatch:
            nonlocal local
            n = len(stream) // length
            firsts = np.arange(0, n, BLOCK)
            sizes = np.minimum(BLOCK, n - firsts)
            bodies = [pack(stream[k * length : (k + size) * length].tobytes()) for k, size in zip(firsts, sizes, strict=True)]
            ends = np.where(firsts + sizes == n, last, length)
            out = [pa.array([part] * len(firsts), pa.int32()), pa.array(local + firsts), pa.array(sizes, pa.int32()), pa.array(ends, pa.int32()), pa.array(bodies, pa.binary())]
            local += n
            return pa.record_batch(out, names=["part", "local", "n", "last", "body"])

        for batch in batches:
            held, size = [rest], len(rest)
            for text in batch.column(0):
                ids = encode(text.as_py() or "")
                ids.append(end_mark)
                held.append(np.array(ids, np.int64))
                size += len(ids)
                if size >= length * 4 * BLOCK:
                    stream = checked(np.concatenate(held))
                    whole = len(stream) // (length * BLOCK) * length * BLOCK
                    yield rows(stream[:whole], length)
                    held, size = [stream[whole:]], len(stream) - whole
            rest = checked(np.concatenate(held))
        if len(rest):
            full = np.full(-(-len(rest) // length) * length, end_mark, "<u2")
            full[: len(rest)] = rest
            yield rows(full, len(rest) - len(full) + length)

    return docs.select("text").mapInArrow(cut, "part int, local long, n int, last int, body binary")


def checked(ids: np.ndarray) -> np.ndarray:
    if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
        raise ValueError("token ids do not fit in 16 bits")
    return ids.astype("<u2")


def starts_of(cut: DataFrame) -> tuple[np.ndarray, int]:
    """Place of the first sequence of every partition of the scan, and the number of all: one number a partition."""
    counts = sorted(tuple(r) for r in cut.groupBy("part").agg(F.sum("n")).collect())
    starts = np.zeros(counts[-1][0] + 1 if counts else 1, np.int64)
    n = 0
    for part, count in counts:
        starts[part] = n
        n += count
    return starts, n


_DEALT = "shard long, slots array<long>, places array<long>, sizes array<int>, body binary"
_WRITTEN = "seq_no long, slot long, shard long, byte_offset long, n_tokens int, crc32 long"


def write_shards(docs: DataFrame, root: str, make_encoder: Callable | None = None, key: int = 1, length: int = LENGTH,
                 per_shard: int = PER_SHARD, end_mark: int = END_MARK) -> DataFrame:
    """Write all shards below ``root``; seq_no, slot, shard, byte_offset, n_tokens, crc32 of every sequence.

    The shards are written once, by this call; the result is the written manifest. The layout, without
    which ``read_slots`` reads nothing, comes last: a run that was lost leaves none.
    """
    spark = docs.sparkSession
    cut = staged(sequences(docs, make_encoder or bpe_encoder(), length, end_mark), "token-sequences")
    starts, n = starts_of(cut)
    shards = max(1, -(-n // per_shard))
    layout = {"n": n, "length": length, "per_shard": per_shard, "key": key, "end_mark": end_mark}
    stride = 2 * length

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequences by shard: those of a few blocks that go into one shard are one row."""
        unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=LEVEL).compress
        names = [c.split()[0] for c in _DEALT.split(", ")]
        for batch in batches:
            for begin in range(0, batch.num_rows, DEALT_BLOCKS):
                rows = batch.slice(begin, DEALT_BLOCKS).to_pylist()
                bodies = np.frombuffer(b"".join(unpack(r["body"]) for r in rows), "<u2").reshape(-1, length)
                places = np.concatenate([starts[r["part"]] + r["local"] + np.arange(r["n"]) for r in rows])
                sizes = np.full(len(places), length, np.int32)
                sizes[np.cumsum([r["n"] for r in rows]) - 1] = [r["last"] for r in rows]
                slots = feistel(places, n, key)
                order = np.argsort(slots, kind="stable")
                slots, places, sizes, bodies = slots[order], places[order], sizes[order], bodies[order]
                at = np.flatnonzero(np.concatenate([[True], slots[1:] // per_shard != slots[:-1] // per_shard])).tolist() + [len(slots)]
                spans = list(zip(at[:-1], at[1:], strict=True))
                columns = [
                    pa.array([int(slots[a]) // per_shard for a, _ in spans], pa.int64()),
                    *[pa.array([v[a:b] for a, b in spans], pa.list_(kind)) for v, kind in ((slots, pa.int64()), (places, pa.int64()), (sizes, pa.int32()))],
                    pa.array([pack(bodies[a:b].tobytes()) for a, b in spans], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple[int, int, int, bytes]] = []
        current = None

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                held.sort()
                save(f"{root}/shard-{current:08d}.bin", b"".join(h[3] for h in held))
                slots = np.array([h[0] for h in held])
                yield pa.record_batch(
                    [pa.array([h[1] for h in held]), pa.array(slots), pa.array(slots // per_shard), pa.array(slots % per_shard * stride),
                     pa.array([h[2] for h in held], pa.int32()), pa.array([zlib.crc32(h[3]) for h in held], pa.int64())],
                    names=[c.split()[0] for c in _WRITTEN.split(", ")])
                held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != current:
                    yield from close()
                    current = row["shard"]
                body = unpack(row["body"])
                held += [(s, p, t, body[k * stride : (k + 1) * stride]) for k, (s, p, t) in enumerate(zip(row["slots"], row["places"], row["sizes"], strict=True))]
        yield from close()

    # Slots are 0 .. n - 1, so the borders of equal ranges are known without a look at the rows.
    parts = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    of_range = F.floor(F.col("shard") * parts / shards).cast("int")
    dealt = cut.mapInArrow(deal, _DEALT).repartitionById(parts, of_range).sortWithinPartitions("shard")
    manifest = staged(dealt.mapInArrow(write, _WRITTEN), "token-manifest")
    save(f"{root}/layout.json", json.dumps(layout).encode())
    return manifest


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pyarrow.fs.LocalFileSystem(), path


def save(path: str, content: bytes) -> None:
    """Write a file under another name, then rename it."""
    store, name = file_system(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    task = TaskContext.get()
    other = f"{name}.{task.taskAttemptId() if task else 'driver'}.part"
    with store.open_output_stream(other) as file:
        file.write(content)
    store.move(other, name)


def read_slots(spark: SparkSession, root: str, start: int, stop: int) -> DataFrame:
    """(slot, ids) of the slots from ``start`` up to ``stop``, read from their shards alone."""
    store, name = file_system(f"{root}/layout.json")
    with store.open_input_stream(name) as file:
        layout = json.loads(file.read())
    per_shard, stride = layout["per_shard"], layout["length"] * 2
    stop = min(stop, layout["n"])
    if start >= stop:
        return spark.createDataFrame([], "slot long, ids array<int>")
    paths = [f"{root}/shard-{k:08d}.bin" for k in range(start // per_shard, (stop - 1) // per_shard + 1)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, ids = [], []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first = int(path.rsplit("-", 1)[1].split(".")[0]) * per_shard
                for k in range(len(content) // stride):
                    if start <= first + k < stop:
                        slots.append(first + k)
                        ids.append(np.frombuffer(content, "<u2", layout["length"], k * stride).astype(np.int32))
            yield pa.record_batch([pa.array(slots, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["slot", "ids"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(cut, "slot long, ids array<int>")
