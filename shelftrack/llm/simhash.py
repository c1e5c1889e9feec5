"""SimHash near-duplicates by a binary trie that is joined with itself.

A text becomes 64 bits: the majority of each bit over the hashes of its word
shingles. Texts of one fingerprint are one entry of the trie from then on, so
a group of copies costs nothing more. Counting prefixes finds trie nodes of at
most ``LEAF`` fingerprints; two nodes whose prefixes already differ in more
bits than allowed are never brought together, all others meet in one task,
which walks both subtrees down side by side. Links of fingerprints become
components by contraction of stars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c

LEAF = 4096
STEP = 8  # bits by which counted prefixes grow
SEED = 42
_CHUNK = 1 << 16
_FRONTIER = 1 << 18
_SMALL = 16


# Fingerprints.


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(whole, SEED)]
        return hashes[0]
    digest = xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        hashes = np.array([digest(whole[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    majority = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            marks = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64)), batch.column(2)], ["doc_id", "mark", "text_hash"])

    return run


# The trie.


def close_pairs(a: np.ndarray, b: np.ndarray | None, max_bits: int):
    """Index pairs of sorted distinct fingerprints that differ in at most ``max_bits``, in chunks.

    ``b`` None joins ``a`` with itself and gives each pair once. Node pairs are
    ranges of both arrays that share a prefix length; a pair whose prefixes
    differ in more bits than allowed is dropped, and few leaves are compared
    outright.
    """
    own, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    stack = [(0, np.array([[0], [len(a)], [0], [len(b)], [0]], np.int64))]
    while stack:
        depth, nodes = stack.pop()
        if nodes.shape[1] > _FRONTIER:
            half = nodes.shape[1] // 2
            stack += [(depth, nodes[:, :half]), (depth, nodes[:, half:])]
            continue
        lo_a, hi_a, lo_b, hi_b, bits = nodes
        small = ((hi_a - lo_a) * (hi_b - lo_b) <= _SMALL) | (depth == 64)
        if small.any():
            x, y = _all_of(*(v[small] for v in (lo_a, hi_a, lo_b, hi_b)))
            near = np.bitwise_count(a[x] ^ b[y]) <= max_bits
            if own:
                near &= x < y
            if near.any():
                yield x[near], y[near]
        lo_a, hi_a, lo_b, hi_b, bits = nodes[:, ~small]
        if not len(lo_a):
            continue
        mid_a, mid_b = _middle(a, lo_a, hi_a, depth), _middle(b, lo_b, hi_b, depth)
        same = (lo_a == lo_b) & (hi_a == hi_b) if own else np.zeros(len(lo_a), bool)
        children = []
        for left_a, left_b in ((True, True), (False, False), (True, False), (False, True)):
            node = np.stack(
                [
                    lo_a if left_a else mid_a, mid_a if left_a else hi_a,
                    lo_b if left_b else mid_b, mid_b if left_b else hi_b,
                    bits + (left_a != left_b),
                ]
            )
            keep = (node[0] < node[1]) & (node[2] < node[3]) & (node[4] <= max_bits)
            if left_b and not left_a:
                keep &= ~same
            children.append(node[:, keep])
        found = np.concatenate(children, axis=1)
        if found.shape[1]:
            stack.append((depth + 1, found))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit after ``depth`` shared ones turns to one."""
    bit = np.uint64(1 << (63 - depth))
    prefix = values[lo] & ~np.uint64(2 * int(bit) - 1)
    return np.clip(np.searchsorted(values, prefix | bit), lo, hi)


def _all_of(lo_a, hi_a, lo_b, hi_b) -> tuple[np.ndarray, np.ndarray]:
    wide = hi_b - lo_b
    sizes = (hi_a - lo_a) * wide
    pair = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return lo_a[pair] + at // wide[pair], lo_b[pair] + at % wide[pair]


def _leaves(marks: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """First fingerprint and prefix length of trie nodes that hold at most ``limit`` each and all together.

    Counts come from the cluster a few bits at a time, for crowded prefixes
    only; the driver holds a number of nodes that is in proportion to
    fingerprints over ``limit``.
    """
    spark = marks.sparkSession
    done, crowded, depth = [], None, 0
    while depth < 64:
        depth += STEP
        prefix = F.shiftrightunsigned("mark", 64 - depth) if depth < 64 else F.col("mark")
        rows = marks.select(prefix.alias("prefix"))
        if crowded is not None:
            parents = spark.createDataFrame([(int(p),) for p in crowded], "parent long")
            rows = rows.withColumn("parent", F.shiftrightunsigned("prefix", STEP)).join(parents, "parent", "left_semi")
        counts = {p & (1 << depth) - 1: n for p, n in rows.groupBy("prefix").count().collect()}
        parents = [0] if crowded is None else crowded
        crowded = []
        for parent in parents:
            todo = [(parent << STEP, STEP)]
            while todo:
                base, free = todo.pop()
                inside = [counts.get(base + i, 0) for i in range(1 << free)]
                if sum(inside) <= limit or depth == 64 and not free:
                    done.append((base << (64 - depth), depth - free))
                elif free:
                    todo += [(base, free - 1), (base + (1 << free - 1), free - 1)]
                else:
                    crowded.append(base)
        if not crowded:
            break
    values, depths = zip(*sorted(done), strict=True)
    return np.array(values, np.uint64), np.array(depths, np.int64)


def _meetings(firsts: np.ndarray, depths: np.ndarray, max_bits: int):
    """Gives every fingerprint to each pair of nodes that may hold a close pair."""

    def partners(node: int) -> np.ndarray:
        shared = np.minimum(depths, depths[node])
        apart = firsts ^ firsts[node]
        differ = np.where(shared > 0, apart >> np.minimum(64 - shared, 63).astype(np.uint64), np.uint64(0))
        return np.flatnonzero(np.bitwise_count(differ) <= max_bits)

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            marks = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            node = np.searchsorted(firsts, marks, side="right") - 1
            for own in np.unique(node):
                if own not in known:
                    known[own] = partners(own)
                mine, others = marks[node == own], known[own]
                other = np.repeat(others, len(mine))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.minimum(own, other).astype(np.int32)), pa.array(np.maximum(own, other).astype(np.int32)),
                        pa.array(other < own), pa.array(np.tile(mine, len(others)).view(np.int64)),
                    ],
                    ["x", "y", "second", "mark"],
                )

    return run


def _join_nodes(max_bits: int):
    def run(table: pa.Table) -> pa.Table:
        marks = c.column(table, "mark").to_numpy().view(np.uint64)
        second = c.column(table, "second").to_numpy(zero_copy_only=False)
        a, b = np.sort(marks[~second]), np.sort(marks[second])
        own = table.column("x")[0] == table.column("y")[0]
        found = list(close_pairs(a, None if own else b, max_bits))
        right = a if own else b
        x = np.concatenate([a[:0], *(a[i] for i, _ in found)])
        y = np.concatenate([a[:0], *(right[j] for _, j in found)])
        return pa.table({"a": pa.array(x.view(np.int64)), "b": pa.array(y.view(np.int64))})

    return run


def close_fingerprints(marks: DataFrame, max_bits: int, leaf: int = LEAF) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``mark``) at most ``max_bits`` apart, each once."""
    c.ship(marks.sparkSession)
    firsts, depths = _leaves(marks, leaf)
    met = marks.select("mark").mapInArrow(_meetings(firsts, depths, max_bits), "x int, y int, second boolean, mark long")
    return met.groupBy("x", "y").applyInArrow(_join_nodes(max_bits), "a long, b long")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``mark``, the 64 bits of each text as a long, 0 if it has no word, and the ``text_hash``."""
    c.ship(docs.sparkSession)
    text = docs["text"].cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, mark long, text_hash long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Each document of ``doc_id`` and ``text`` with its ``fingerprint`` and ``component_id``.

    Texts with A-Z in lower case are cut at ASCII white space into words and
    shingles of ``shingle`` words, repeats included; a text of fewer words is one
    shingle. A bit is one if it is set in over half of the shingles' hashes.
    Documents at most ``max_bits`` apart are linked; ``component_id`` is the
    smallest id reachable over links, the document's own included. ``text_hash``
    is ``xxhash64`` of the text and tells rows of one id apart.

    Null and empty texts have fingerprint zero and link like any other. A row
    without an id keeps its row and takes the smallest id of its component
    (null, if none has one). Repeated rows are rows of their own; other columns
    are ignored; no rows give no rows.
    """
    marked = c.cut(fingerprints(docs, shingle))
    kinds = c.cut(marked.groupBy("mark").agg(F.min("doc_id").alias("least")))
    linked = c.components(close_fingerprints(kinds, max_bits))
    roots = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    owned = roots.join(kinds, roots["node"] == kinds["mark"]).select("root", "node", "least")
    smallest = owned.groupBy("root").agg(F.min("least").alias("component"))
    named = owned.join(smallest, "root").select(F.col("node").alias("mark"), "component")
    every = kinds.join(named, "mark", "left").select("mark", F.coalesce("component", "least").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint")
    return marked.join(every, "mark").select("doc_id", hexed, "component_id", "text_hash")
