"""Approximate nearest neighbours by counting collisions on sorted projections.

The largest inner product becomes the smallest distance, as one more component
makes all data vectors equally long. Blocks of the data are indexed: each of
``PROJECTIONS`` random directions keeps the block's values on it sorted, with each
row's place in that order. A query lays a window around its own value on every
direction; rows whose place lies inside collide. Rows with at least ``THRESHOLD`` of all collisions possible are
verified by their true product. While fewer than ``k`` verified rows lie within
the radius, the radius grows by ``GROWTH`` and with it every window, on the same
sorted arrays. A block's answer is never cut short by a number of candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm import vectors as v

PROJECTIONS = 64
HALF_WINDOW = 1.0  # in radii: a row at the radius collides with probability 0.68
THRESHOLD = 0.58
GROWTH = 1.25
BLOCK_ROWS = 4096
CHUNK_QUERIES = 512
_TOGETHER = 16
SAMPLE = 1024  # rows from which the first radius is set


def _directions(dims: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((PROJECTIONS, dims))


def _lift(x: np.ndarray, longest: float) -> np.ndarray:
    return np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0))[:, None]


def _index(dims: int, longest: float):
    """One row a block: ids, vectors, and per direction the sorted values and each row's place among them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(c.column(table, "vec_id").to_numpy(), kind="stable")))
        x = v.matrix(table.column("vector"), dims).astype(np.float64)
        values = (np.hstack([x, _lift(x, longest)]) @ _directions(dims + 1).T).T
        order = np.argsort(values, axis=1, kind="stable")
        places = np.empty(order.shape, np.uint32)
        np.put_along_axis(places, order, np.arange(order.shape[1], dtype=np.uint32)[None, :], axis=1)
        parts = {
            "block": table.column("block")[0].as_py(), "names": c.column(table, "vec_id").to_numpy().tobytes(),
            "body": x.tobytes(), "sorted_values": np.take_along_axis(values, order, axis=1).tobytes(),
            "places": places.tobytes(),
        }
        return pa.table({name: pa.array([value], pa.int32() if name == "block" else pa.binary()) for name, value in parts.items()})

    return run


class _Block:
    def __init__(self, row: dict, dims: int):
        self.names = np.frombuffer(row["names"], np.int64)
        self.body = np.frombuffer(row["body"]).reshape(-1, dims)
        n = len(self.names)
        self.values = np.frombuffer(row["sorted_values"]).reshape(PROJECTIONS, n)
        places = np.frombuffer(row["places"], np.uint32).reshape(PROJECTIONS, n)
        self.places = places.astype(np.uint16) if n < 1 << 16 else places

    def _colliding(self, at: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the rows that collide often enough, and whether its windows hold the whole block."""
        hits, whole = np.zeros((len(at), len(self.names)), np.uint8), np.ones(len(at), bool)
        for i, (values, places) in enumerate(zip(self.values, self.places, strict=True)):
            lo, hi = np.searchsorted(values, at[:, i] - reach), np.searchsorted(values, at[:, i] + reach, side="right")
            whole &= (lo == 0) & (hi == len(values))
            # Places below the window wrap around to large numbers.
            hits += (places[None, :] - lo[:, None].astype(places.dtype)) < (hi - lo)[:, None].astype(places.dtype)
        return hits >= np.ceil(THRESHOLD * PROJECTIONS), whole

    def nearest(self, names: np.ndarray, queries: np.ndarray, at: np.ndarray, k: int, radius: float, longest: float):
        """Query, row and product of the ``k`` nearest verified rows of each query, its own left out."""
        active = np.arange(len(names))
        lengths = np.einsum("ij,ij->i", queries, queries)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(names)
        done = np.zeros((len(names), len(self.names)), bool)
        while len(active):
            near, whole = self._colliding(at[active], HALF_WINDOW * radius)
            open_ = []
            for i, own, all_of_it in zip(active.tolist(), near, whole, strict=True):
                rows = np.flatnonzero(own & ~done[i] & (self.names != names[i]))
                done[i, rows] = True
                scores = np.concatenate([found[i][1], self.body[rows] @ queries[i]])
                rows = np.concatenate([found[i][0], rows])
                if len(rows) > k:
                    # All that reach the k-th score, so that ties are settled by id.
                    keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    rows, scores = rows[keep], scores[keep]
                best = np.lexsort((self.names[rows], -scores))[:k]
                found[i] = rows[best], scores[best]
                within = len(best) >= k and lengths[i] + longest - 2 * scores[best[-1]] <= radius * radius
                if not (all_of_it or within):
                    open_.append(i)
            active, radius = np.array(open_, np.int64), radius * GROWTH
        owner = np.repeat(np.arange(len(names)), [len(rows) for rows, _ in found])
        return owner, np.concatenate([rows for rows, _ in found]), np.concatenate([scores for _, scores in found])


def _search(k: int, dims: int, radius: float, longest: float):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0)]}
        if queries.num_rows and blocks.num_rows:
            names = c.column(queries, "vec_id").to_numpy()
            x = v.matrix(queries.column("vector"), dims).astype(np.float64)
            at = x @ _directions(dims + 1)[:, :dims].T
            for row in blocks.to_pylist():
                block = _Block(row, dims)
                for lo in range(0, len(names), _TOGETHER):
                    part = slice(lo, lo + _TOGETHER)
                    owner, rows, scores = block.nearest(names[part], x[part], at[part], k, radius, longest)
                    out["query_id"].append(names[part][owner])
                    out["vec_id"].append(block.names[rows])
                    out["score"].append(scores)
        return pa.table({name: pa.array(np.concatenate(parts)) for name, parts in out.items()})

    return run


def build_index(data: DataFrame) -> tuple[DataFrame, int, float]:
    """The index of all rows of ``vec_id``, ``vector``; its width and the largest squared length."""
    c.ship(data.sparkSession)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    n, dims, longest = data.agg(F.count("*"), F.max(F.size("vector")), F.max(squares)).first()
    dims, longest = max(1, dims or 0), float(longest or 0) * (1 + 1e-12)
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(max(1, -(-n // BLOCK_ROWS)))).cast("int")
    columns = "block int, names binary, body binary, sorted_values binary, places binary"
    return data.withColumn("block", block).groupBy("block").applyInArrow(_index(dims, longest), columns), dims, longest


def _first_radius(queries: DataFrame, data: DataFrame, dims: int, longest: float, k: int) -> float:
    """About the distance of a block's ``k``-th neighbour, from a bounded sample; only speed depends on it."""
    pick = lambda df, m: df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(m).select("vector").collect()

    def stack(rows):
        out = np.zeros((len(rows), dims))
        for i, row in enumerate(rows):
            out[i, : len(row.vector)] = row.vector
        return out

    q, x = stack(pick(queries, 64)), stack(pick(data, SAMPLE))
    if not len(q) or not len(x):
        return 1.0
    squares = np.einsum("ij,ij->i", q, q)[:, None] + longest - 2 * q @ x.T
    share = min(1.0, (k + 1) / BLOCK_ROWS)
    found = float(np.sqrt(np.maximum(np.median(np.quantile(squares, share, axis=1)), 0)))
    return found or max(longest**0.5 / 100, 1e-9)


def nearest_products(queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """About the ``k`` rows of ``data`` with the largest inner product for each query.

    Both have ``vec_id`` and ``vector``, an array of doubles; lengths may differ,
    a missing component counts as zero. Every row is indexed. The result has
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the product in
    doubles; of equal scores the smaller id ranks first. Each block gives ``k``
    verified rows or all it has, so fewer than ``k`` others give fewer rows.
    Data rows that bear the query's id are left out. Repeated data rows are rows
    of their own; query rows that share an id count once, by the smallest
    vector. Rows that are null, zero or not finite, or have no id, take no part.
    """
    usable = F.col("vec_id").isNotNull() & v.finite("vector") & F.exists("vector", lambda x: x != 0)
    data, queries = (df.filter(usable).select("vec_id", "vector") for df in (data, queries))
    queries = v.one_per_id(queries, "vector")
    index, dims, longest = build_index(data)
    index = c.cut(index)
    n_blocks, n_queries = index.count(), queries.count()
    result = "query_id long, vec_id long, score double"
    if not n_blocks or not n_queries:
        return v.ranked(data.sparkSession.createDataFrame([], result), k, "score")
    dims = max(dims, v.width(queries, "vector"))
    radius = _first_radius(queries, data, dims, longest, k)
    n_chunks = -(-n_queries // CHUNK_QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = index.withColumn("chunk", every(n_chunks))
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)).cast("int")).withColumn("block", every(n_blocks))
    key = ["block", "chunk"]
    found = asked.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInArrow(_search(k, dims, radius, longest), result)
    return v.ranked(found, k, "score")
