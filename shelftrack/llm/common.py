"""Helpers of the operators on texts and vectors: blocks, word spans, hashes, components."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = np.iinfo(np.int64).max  # a missing id comes after all others
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
BYTE_HASHES = np.random.default_rng(3).integers(0, 2**64, 256, dtype=np.uint64)
_LONG_WORD = 256
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers the package and small Arrow batches, wherever the driver was started."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        top = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="shelftrack-llm-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/shelftrack-llm", "zip", str(top), "shelftrack"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of its own in a local session without."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="shelftrack-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def blocked(docs: DataFrame, n_blocks: int, keep: bool = False) -> DataFrame:
    """``block``, ``doc_id`` and ``text`` of all rows, with ``keep`` also their ``row``; the block follows from id and text.

    Copies of one text spread over the blocks, as their ids differ.
    """
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    block = F.pmod(F.xxhash64(doc_id, text), F.lit(n_blocks)).cast("int")
    others = [F.struct(*(F.lit(None).cast("string").alias(k) if k == "text" else F.col(k) for k in docs.columns)).alias("row")]
    return docs.select(block.alias("block"), doc_id.alias("doc_id"), text.alias("text"), *(others if keep else []))


# In tasks: arrays over the texts of one Arrow table.


def column(table: pa.Table, name: str) -> pa.Array:
    values = table.column(name).combine_chunks()
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one behind the other, and the bounds of each; a null is empty."""
    values = values.cast(pa.large_binary()).fill_null(b"")
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = values.buffers()[2]
    data = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def ids(values: pa.Array) -> np.ndarray:
    return values.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def by_id(table: pa.Table) -> pa.Table:
    """Rows in the order of their ids, missing ones last."""
    return table.take(pa.array(np.argsort(ids(column(table, "doc_id")), kind="stable")))


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are no ASCII white space, and each text's first run."""
    word = ~SPACES[data]
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def joined(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of pairs of hashes."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15 + 2 * salt) + b)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes a step."""
    import xxhash

    lengths = ends - starts
    hashes = mix(lengths.astype(np.uint64) + np.uint64(0x1234567))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    todo = np.flatnonzero((lengths > 0) & (lengths <= _LONG_WORD))
    at = 0
    while len(todo):
        left = lengths[todo] - at
        value = eights[starts[todo] + at] & masks[np.minimum(left, 8)]
        hashes[todo] = joined(hashes[todo], value, 7)
        at += 8
        todo = todo[left > 8]
    for i in np.flatnonzero(lengths > _LONG_WORD):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 42)
    return hashes


class Substrings:
    """Hashes of any substring of some bytes, from sums over powers of a base."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        powers, inverse = np.full(n, np.uint64(BASE)), np.full(n, np.uint64(pow(BASE, -1, 1 << 64)))
        powers[0] = inverse[0] = 1
        powers = np.multiply.accumulate(powers)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_HASHES[data] * powers[:-1])])
        self.inverse = np.multiply.accumulate(inverse)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums = (self.total[stop] - self.total[start]) * self.inverse[start]
        return joined(mix(sums), (stop - start).astype(np.uint64), 9)


def run_hashes(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A hash of every ``n`` consecutive hashes, by doubling; at the index of the first."""
    done, length, power, width = None, 0, words, 1
    left = n
    while left:
        if left & 1:
            if done is None:
                done, length = power, width
            else:
                m = min(len(done), len(power) - length)
                done = joined(done[:m], power[length : length + m], 2 * salt + 1) if m > 0 else power[:0]
                length += width
        left >>= 1
        if left:
            power = joined(power[:-width], power[width:], 2 * salt) if len(power) > width else power[:0]
            width *= 2
    return done


def transposed(values: np.ndarray) -> bytes:
    """Bytes of fixed-width numbers, first bytes first, which compress better."""
    return values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def restored(body: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that brings the rows of a bucket together, and (bucket, from, to) of each."""
    order = np.argsort(bucket, kind="stable")
    if not len(order):
        return order, []
    found, first = np.unique(bucket[order], return_index=True)
    return order, list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True))


def spread(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def contains(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``found``."""
    if not len(found):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(found, values), len(found) - 1)
    return found[at] == values


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``width`` that begins at one of ``starts``."""
    opened = np.bincount(starts, minlength=n + 1)
    closed = np.bincount(np.minimum(starts + width, n), minlength=n + 1)
    return np.cumsum((opened - closed)[:n]) > 0


# Connected components.


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, of all nodes that edges ``a``, ``b`` touch.

    Stars are contracted in turn towards larger and smaller neighbours until
    no link changes, a number of rounds logarithmic in the longest chain.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi != lo")
    links, seen = cut(pairs.distinct()), None
    for _ in range(max_rounds):
        state = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        if state == seen or not state[0]:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi").filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = cut(moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
    raise RuntimeError(f"links still change after {max_rounds} rounds")
