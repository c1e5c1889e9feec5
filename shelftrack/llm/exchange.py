"""Exchange between blocks of documents and buckets of hashes.

Blocks send packed arrays of hashes to buckets, buckets answer to blocks. A
row is one array, so a shuffle has few rows however many hashes there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelftrack.llm import common as c

SENT = "bucket int, block int, body binary"
BACK = "block int, bucket int, body binary"
TO_BUCKET, TO_BLOCK = ("bucket", "block"), ("block", "bucket")


def rows(parts: list[tuple[int, int, bytes]], names: tuple[str, str]) -> pa.Table:
    return pa.table(
        {
            names[0]: pa.array([p[0] for p in parts], pa.int32()),
            names[1]: pa.array([p[1] for p in parts], pa.int32()),
            "body": pa.array([p[2] for p in parts], pa.binary()),
        }
    )


def block_of(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def returned(table: pa.Table, dtype) -> dict[int, np.ndarray]:
    pairs = zip(table.column("bucket").to_pylist(), table.column("body").to_pylist(), strict=True)
    return {bucket: np.frombuffer(body, dtype) for bucket, body in pairs}


def pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def unpack(body: bytes, *dtypes) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(body, np.int64, len(dtypes)), 8 * len(dtypes), []
    for size, dtype in zip(sizes.tolist(), dtypes, strict=True):
        out.append(np.frombuffer(body, dtype, size, at))
        at += size * np.dtype(dtype).itemsize
    return out


def bucket_keys(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Short keys: the bucket above, four bytes of the hash below."""
    return (c.spread(hashes, n_buckets).astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def sent_keys(keys: np.ndarray, block: int) -> list[tuple[int, int, bytes]]:
    """The distinct short keys of a block for each bucket, with a bit for those it has twice."""
    keys, times = np.unique(keys, return_counts=True)
    parts = []
    for bucket, lo, hi in c.by_bucket((keys >> np.uint64(32)).astype(np.int64))[1]:
        low = (keys[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        parts.append((bucket, block, pack(low, np.packbits(times[lo:hi] > 1))))
    return parts


def returned_keys(table: pa.Table) -> np.ndarray:
    """Short keys that came back, sorted."""
    parts = [low.astype(np.uint64) | (np.uint64(b) << np.uint64(32)) for b, low in returned(table, np.uint32).items()]
    return np.sort(np.concatenate([*parts, np.zeros(0, np.uint64)]))


def find_repeated(table: pa.Table) -> pa.Table:
    """Keys that occur twice, in one block or in several, back to their blocks."""
    bucket = table.column("bucket")[0].as_py()
    blocks, values, twice = table.column("block").to_pylist(), [], []
    for body in table.column("body").to_pylist():
        low, bits = unpack(body, np.uint32, np.uint8)
        values.append(low)
        twice.append(np.unpackbits(bits, count=len(low)).astype(bool))
    owner, values, twice = np.repeat(np.arange(len(blocks)), [len(v) for v in values]), np.concatenate(values), np.concatenate(twice)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    live = twice
    live[order[1:][same]] = True
    live[order[:-1][same]] = True
    parts = []
    for i, lo, hi in c.by_bucket(owner)[1]:
        if (found := values[lo:hi][live[lo:hi]]).size:
            parts.append((blocks[i], bucket, found.tobytes()))
    return rows(parts, TO_BLOCK)


def pack_places(hashes: np.ndarray, doc_ids: np.ndarray, check: np.ndarray, place: np.ndarray) -> bytes:
    """Hashes (64 bits), ids, second hashes and places (32 bits each)."""
    columns = (hashes, doc_ids, check.astype(np.uint32), place.astype(np.uint32))
    return b"".join(c.transposed(x) for x in columns)


def find_later(table: pa.Table) -> pa.Table:
    """The hashes that have an equal one at a smaller id or an earlier place of that id, back to their blocks."""
    bucket = table.column("bucket")[0].as_py()
    blocks, columns = [], []
    for block, body in zip(table.column("block").to_pylist(), table.column("body").to_pylist(), strict=True):
        n, at, fields = len(body) // 24, 0, []
        for dtype in (np.uint64, np.int64, np.uint32, np.uint32):
            size = n * np.dtype(dtype).itemsize
            fields.append(c.restored(body[at : at + size], dtype))
            at += size
        columns.append(fields)
        blocks.append(block)
    owner = np.repeat(np.arange(len(blocks)), [len(f[0]) for f in columns])
    hashes, doc_ids, check, place = (np.concatenate(x) for x in zip(*columns, strict=True))
    order = np.lexsort((place, doc_ids, check, hashes))
    kind = np.ones(len(order), bool)
    kind[1:] = (hashes[order][1:] != hashes[order][:-1]) | (check[order][1:] != check[order][:-1])
    first = order[np.maximum.accumulate(np.where(kind, np.arange(len(order)), 0))]
    # Rows that share an id and a start are the same place: neither is earlier.
    later = np.empty(len(order), bool)
    later[order] = (doc_ids[order] != doc_ids[first]) | (place[order] != place[first])
    parts = []
    for i, lo, hi in c.by_bucket(owner)[1]:
        if (found := hashes[lo:hi][later[lo:hi]]).size:
            parts.append((blocks[i], bucket, found.tobytes()))
    return rows(parts, TO_BLOCK)


def later(doc_ids: np.ndarray, place: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which entries of one block have an equal hash at a smaller id or an earlier place of that id."""
    order = np.lexsort((place, doc_ids, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.empty(len(order), bool)
    out[order] = (doc_ids[order] != doc_ids[first]) | (place[order] != place[first])
    return out
