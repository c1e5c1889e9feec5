"""Exact top-k search by a Voronoi join.

The largest inner product becomes the smallest distance: a data vector gets one
more component, ``sqrt(M^2 - |x|^2)`` with M the longest length, a query gets a
zero there. Data and queries go to their nearest of a few pivots. Summaries -
per data cell the ``k + 1`` ids nearest to its pivot with their smallest distances,
per query cell the least and largest distance to every pivot - bound how far the
``k``-th neighbour of any query of a cell can be. Ids count once there, as a query
leaves out all rows of its own. A data row is sent to a query cell only if
its own distance to its pivot leaves it within that bound. Cells are cut into
groups of bounded size, each solved by one product of matrices; a last ranking
merges the groups of a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm import vectors as v

PIVOTS = 64
GROUP_QUERIES = 512
GROUP_ROWS = 8192
_SLICE = 64


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))


def _distances(x: np.ndarray, pivots: np.ndarray, longest: float, lifted: bool) -> np.ndarray:
    """Distances in the space with one more component; rows of ``x`` are ``lifted`` if they are data."""
    own, extra = _lengths(x), np.zeros(len(x))
    if lifted:
        extra = np.sqrt(np.maximum(longest - own, 0))
    heights = np.sqrt(np.maximum(longest - _lengths(pivots), 0))
    cross = x.astype(np.float64) @ pivots.T + extra[:, None] * heights
    return np.sqrt(np.maximum(own[:, None] + extra[:, None] ** 2 + longest - 2 * cross, 0))


def _assign(pivots: np.ndarray, longest: float, dims: int, lifted: bool):
    def run(batches):
        for batch in batches:
            x = v.matrix(batch.column(1), dims).astype(np.int64)
            far = _distances(x, pivots, longest, lifted)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell.astype(np.int32)), pa.array(far.min(axis=1)), v.packed(x)],
                ["vec_id", "cell", "distance", "body"],
            )

    return run


def _query_summaries(pivots: np.ndarray, longest: float, dims: int):
    def run(batches):
        for batch in batches:
            x = v.unpacked(batch.column(1), dims, np.int64)
            far, cell = _distances(x, pivots, longest, False), batch.column(0).to_numpy()
            for own in np.unique(cell):
                part = far[cell == own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(pivots), own, np.int32)), pa.array(np.arange(len(pivots), dtype=np.int32)),
                        pa.array(part.min(axis=0)), pa.array(part.max(axis=0)), pa.array(np.full(len(pivots), len(part))),
                    ],
                    ["cell", "pivot", "least", "most", "n"],
                )

    return run


def _needed(bounds: np.ndarray, cell: np.ndarray, distance: np.ndarray, group: int) -> np.ndarray:
    least, most = bounds[group, cell, 0], bounds[group, cell, 1]
    return np.flatnonzero((distance >= least) & (distance <= most))


def _count_needed(bounds: np.ndarray):
    def run(batches):
        total = np.zeros(len(bounds), np.int64)
        for batch in batches:
            cell, distance = (batch.column(i).to_numpy() for i in (0, 1))
            total += [len(_needed(bounds, cell, distance, g)) for g in range(len(bounds))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(bounds), dtype=np.int32)), pa.array(total)], ["g", "n"])

    return run


def _replicate(bounds: np.ndarray, splits: np.ndarray, salts: np.ndarray):
    def run(batches):
        for batch in batches:
            salt, cell, distance = (batch.column(i).to_numpy() for i in (0, 1, 2))
            for g in range(len(bounds)):
                at = _needed(bounds, cell, distance, g)
                if not len(at):
                    continue
                rows, n = batch.take(pa.array(at)), len(at)
                for s in range(splits[g]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, g, np.int32)), pa.array(np.full(n, s, np.int32)),
                            pa.array((salt[at] % salts[g]).astype(np.int32)), rows.column(3), rows.column(4),
                        ],
                        ["g", "split", "salt", "vec_id", "body"],
                    )

    return run


def _solve(k: int, dims: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and data.num_rows:
            data = data.take(pa.array(np.argsort(c.column(data, "vec_id").to_numpy(), kind="stable")))
            names, q_names = c.column(data, "vec_id").to_numpy(), c.column(queries, "vec_id").to_numpy()
            x, q = (v.unpacked(t.column("body"), dims, np.int64) for t in (data, queries))
            for at in range(0, len(q), _SLICE):
                scores, own = v.products(q[at : at + _SLICE], x), q_names[at : at + _SLICE]
                rows, columns = v.best_rows(scores, k, own[:, None] == names[None, :])
                for name, values in zip(out, (own[rows], names[columns], scores[rows, columns]), strict=True):
                    out[name].append(values)
        return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for name, x in out.items()})

    return run


def top_products(queries: DataFrame, data: DataFrame, k: int, n_pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` rows of ``data`` with the largest inner product for each query, exactly.

    Both have ``vec_id`` and ``vector``, an array of whole numbers (long);
    lengths may differ, a missing component counts as zero. The result has
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; of equal scores the
    smaller id ranks first. Data rows that bear the query's id are left out;
    fewer than ``k`` others give fewer rows. Repeated data rows are rows of
    their own; query rows that share an id count once, by the smallest vector.
    Rows without an id or vector take no part. Products are exact while they
    fit a long.
    """
    spark = data.sparkSession
    c.ship(spark)
    data = data.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).select("vec_id", "vector")
    queries = v.one_per_id(queries.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()), "vector")
    dims = max(1, v.width(data, "vector"), v.width(queries, "vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    longest = float(data.agg(F.max(squares)).first()[0] or 0)
    picked = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    result = "query_id long, vec_id long, score long"
    if not picked:
        return v.ranked(spark.createDataFrame([], result), k, "score")
    pivots = np.zeros((len(picked), dims))
    for i, row in enumerate(picked):
        pivots[i, : len(row.vector)] = row.vector
    parts = "vec_id long, cell int, distance double, body binary"
    rows = c.cut(data.mapInArrow(_assign(pivots, longest, dims, True), parts))
    asked = c.cut(queries.mapInArrow(_assign(pivots, longest, dims, False), parts))
    seen = asked.select("cell", "body").mapInArrow(
        _query_summaries(pivots, longest, dims), "cell int, pivot int, least double, most double, n long"
    )
    seen = seen.groupBy("cell", "pivot").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"))
    order = Window.partitionBy("cell").orderBy("distance")
    near = rows.groupBy("cell", "vec_id").agg(F.min("distance").alias("distance"))
    near = near.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= k + 1)
    bounds, sizes = _bounds(seen.collect(), near.collect(), len(picked), k, longest)
    splits = np.maximum(1, -(-sizes // GROUP_QUERIES))
    counted = rows.select("cell", "distance").mapInArrow(_count_needed(bounds), "g int, n long")
    needed = np.zeros(len(bounds), np.int64)
    for row in counted.groupBy("g").agg(F.sum("n").alias("n")).collect():
        needed[row.g] = row.n
    salts = np.maximum(1, -(-needed // GROUP_ROWS))

    mixed = F.xxhash64("vec_id", "body")
    sent = rows.select(F.pmod(mixed, F.lit(1 << 30)).alias("salt"), "cell", "distance", "vec_id", "body")
    sent = sent.mapInArrow(_replicate(bounds, splits, salts), "g int, split int, salt int, vec_id long, body binary")
    per_cell = [F.array(*(F.lit(int(x)) for x in counts)) for counts in (splits, salts)]
    placed = asked.select(
        F.col("cell").alias("g"),
        F.pmod(mixed, F.element_at(per_cell[0], F.col("cell") + 1)).cast("int").alias("split"),
        F.explode(F.sequence(F.lit(0), F.element_at(per_cell[1], F.col("cell") + 1) - 1)).alias("salt"),
        "vec_id", "body",
    )
    key = ["g", "split", "salt"]
    found = placed.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_solve(k, dims), result)
    return v.ranked(found, k, "score")


def _bounds(seen, near, n: int, k: int, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """For each query cell and data cell the distances to its pivot that a needed row can have."""
    least, most, sizes = np.full((n, n), np.inf), np.full((n, n), -np.inf), np.zeros(n, np.int64)
    for row in seen:
        least[row.cell, row.pivot], most[row.cell, row.pivot], sizes[row.cell] = row.least, row.most, row.n
    cells, distances = np.array([r.cell for r in near]), np.array([r.distance for r in near])
    ids = np.array([r.vec_id for r in near])
    bounds = np.empty((n, n, 2))
    slack = 1e-6 * (1 + longest**0.5)
    for g in range(n):
        reach = most[g, cells] + distances
        order = np.argsort(reach)
        # Of k + 1 ids one at most is the query's own; an id may lie in several cells.
        nearest = np.sort(np.unique(ids[order], return_index=True)[1])
        theta = reach[order[nearest[k]]] if len(nearest) > k and sizes[g] else np.inf
        bounds[g, :, 0] = least[g] - theta - slack if sizes[g] else np.inf
        bounds[g, :, 1] = most[g] + theta + slack if sizes[g] else -np.inf
    return bounds, sizes
