"""Repeated and nearly repeated lines, by a segment-partition edit join.

A line within ``max_edits`` of another shares one of that line's
``max_edits + 1`` segments unchanged, at a place that the lengths allow only a few
shifts of. First the equal lines are found and every distinct line gets one
owner, the block of its first place. Owners then send the keys (length, segment
number, segment) of their lines and of the substrings at which a longer line
would hold them. Lines that meet at a key are brought together and verified:
all diagonals within the bound are bits of one byte, a byte for each number of
edits, and a step takes one character of many pairs at once. A line needs one
earlier neighbour only, so pairs are tried in the order of places and lines
leave as soon as they have one.

A key that many distinct lines hold, as lines from one template do, is not brought
together. Its lines are cut finer, into segments of which as many as a neighbour may
change and one more suffice: each line picks its rarest, so that what all share is
never looked up, and only lines that hold a picked one meet. Where a few lines had to
pick what many hold, the many are dealt out and the few go along with each part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm import exchange as x

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
_NEWLINE = 10
_TOGETHER = 1 << 15  # pairs verified at once
HOT = 200  # distinct lines of a key beyond which they are cut finer; below 255
_FINE_BYTES, _FINE_MOST = 2, 256  # a finer segment's size at least, and how many a line has at most
_FEW, _DEALT = 64, 2000  # lines that go along, and lines of a part
_FINE_ROWS = 64  # lines whose finer keys are made at once


class _Lines:
    """Lines of a block's texts in the order of the ids."""

    def __init__(self, table: pa.Table):
        self.table = c.by_id(table)
        self.doc_ids = c.ids(c.column(self.table, "doc_id"))
        self.data, bounds = c.flat(c.column(self.table, "text"))
        breaks = np.flatnonzero(self.data == _NEWLINE)
        filled = np.flatnonzero(np.diff(bounds) > 0)
        self.starts = np.sort(np.concatenate([bounds[filled], breaks + 1]), kind="stable")
        self.ends = np.sort(np.concatenate([breaks, bounds[filled + 1]]), kind="stable")
        counts = np.diff(np.searchsorted(breaks, bounds))
        counts[filled] += 1
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(self.doc)) - self.first[self.doc]
        self.blank = self.starts == self.ends
        # Only a line that begins with white space may be all of it.
        for i in np.flatnonzero(~self.blank & c.SPACES[self.data[np.minimum(self.starts, len(self.data) - 1)]] if len(self.data) else self.blank & False):
            self.blank[i] = c.SPACES[self.data[self.starts[i] : self.ends[i]]].all()
        self.hashes = c.span_hashes(self.data, self.starts, self.ends)

    def distinct(self) -> np.ndarray:
        """The first line of each kind that is not blank."""
        at = np.flatnonzero(~self.blank)
        order = np.lexsort((self.place[at], self.doc_ids[self.doc[at]], self.hashes[at]))
        ranked = self.hashes[at][order]
        new = np.ones(len(at), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        return at[order[new]]

    def owned(self, answers: pa.Table, near: int) -> np.ndarray:
        """Distinct lines of at least ``near`` bytes whose first place of all is here."""
        at = self.distinct()
        later = _found(answers, np.uint64)
        return at[~c.contains(later, self.hashes[at]) & (self.ends[at] - self.starts[at] >= near)]


def _found(table: pa.Table, dtype) -> np.ndarray:
    """All hashes that came back, sorted; a bucket may have answered twice."""
    return np.sort(np.concatenate([*(np.frombuffer(body, dtype) for body in table.column("body").to_pylist()), np.zeros(0, dtype)]))


# Equal lines.


def _send_lines(n_buckets: int):
    def send(table: pa.Table) -> pa.Table:
        lines = _Lines(table)
        at = lines.distinct()
        order, cuts = c.by_bucket(c.spread(lines.hashes[at], n_buckets))
        at = at[order]
        size = (lines.ends - lines.starts)[at]
        parts = []
        for bucket, lo, hi in cuts:
            own = at[lo:hi]
            body = x.pack_places(lines.hashes[own], lines.doc_ids[lines.doc[own]], size[lo:hi], lines.place[own])
            parts.append((bucket, x.block_of(table), body))
        return x.rows(parts, x.TO_BUCKET)

    return send


# Segments.


def _segment(length: np.ndarray, i: int, n: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offset and size of segment ``i`` of ``n`` of lines of a length; the last ones are a byte longer if need be."""
    size, longer = length // n, length % n
    return i * size + np.maximum(0, i - (n - longer)), size + (i >= n - longer)


def _keys(lines: _Lines, at: np.ndarray, max_edits: int, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line (as index into ``at``), key and whether the key is of its own segments, of all keys."""
    substring, length, start = c.Substrings(lines.data), (lines.ends - lines.starts)[at], lines.starts[at]
    who, keys, own = [], [], []
    everyone = np.arange(len(at))

    def add(rows, begin, size, shorter, i, is_own):
        kind = (shorter * (max_edits + 1) + i).astype(np.uint64)
        who.append(rows)
        keys.append(c.joined(substring(begin, begin + size), kind, 5))
        own.append(np.full(len(rows), is_own))

    for i in range(max_edits + 1):
        offset, size = _segment(length, i, max_edits + 1)
        add(everyone, start + offset, size, length, i, True)
        for gap in range(max_edits + 1):
            rows = np.flatnonzero(length - gap >= near)
            offset, size = _segment(length[rows] - gap, i, max_edits + 1)
            left = np.maximum(-i, gap - (max_edits - i))
            right = np.minimum(i, gap + (max_edits - i))
            for shift in range(left, right + 1):
                place = offset + shift
                inside = (place >= 0) & (place + size <= length[rows])
                add(rows[inside], start[rows[inside]] + place[inside], size[inside], length[rows[inside]] - gap, i, False)
    return np.concatenate(who), np.concatenate(keys), np.concatenate(own)


def _send_keys(max_edits: int, near: int, n_buckets: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return x.rows([], x.TO_BUCKET)
        lines = _Lines(table)
        who, keys, own = _keys(lines, lines.owned(answers, near), max_edits, near)
        keys = x.bucket_keys(keys, n_buckets)
        order = np.lexsort((who, keys))
        keys, who, own = keys[order], who[order], own[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        has_own = np.logical_or.reduceat(own, first) if len(first) else own
        other = new.copy()
        other[1:] |= who[1:] != who[:-1]
        held = np.add.reduceat(other.astype(np.int64), first) if len(first) else other
        held = np.minimum(held, 255).astype(np.uint8)
        keys, parts = keys[first], []
        for bucket, lo, hi in c.by_bucket((keys >> np.uint64(32)).astype(np.int64))[1]:
            low = (keys[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            parts.append((bucket, x.block_of(table), x.pack(low, np.packbits(has_own[lo:hi]), held[lo:hi])))
        return x.rows(parts, x.TO_BUCKET)

    return send


def _find_meetings(hot: int):
    """Keys that one line has as its own and another line, here or there, holds; kind 2 if more than ``hot`` lines hold them."""

    def find(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blocks, keys, own, held = table.column("block").to_pylist(), [], [], []
        for body in table.column("body").to_pylist():
            low, bits, lines = x.unpack(body, np.uint32, np.uint8, np.uint8)
            keys.append(low)
            own.append(np.unpackbits(bits, count=len(low)).astype(bool))
            held.append(lines)
        owner = np.repeat(np.arange(len(blocks)), [len(k) for k in keys])
        keys, own, held = np.concatenate(keys), np.concatenate(own), np.concatenate(held).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
        lines = np.add.reduceat(held[order], first)
        kind = np.where(np.logical_or.reduceat(own[order], first) & (lines > 1), np.where(lines > hot, 2, 1), 0)
        out = np.empty(len(keys), np.int64)
        out[order] = np.repeat(kind, np.diff(np.append(first, len(keys))))
        parts, kinds = [], []
        for i, lo, hi in c.by_bucket(owner)[1]:
            for kind in (1, 2):
                if (found := keys[lo:hi][out[lo:hi] == kind]).size:
                    parts.append((blocks[i], bucket, found.tobytes()))
                    kinds.append(kind)
        return x.rows(parts, x.TO_BLOCK).append_column("kind", pa.array(kinds, pa.int32()))

    return find


def _send_candidates(max_edits: int, near: int, n_buckets: int):
    """Lines to the buckets of the keys at which they meet; those of keys with many lines to buckets of their own."""

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return x.rows([], x.TO_BUCKET)
        kind = answers.column("kind").to_numpy(zero_copy_only=False)
        later, *answered = (answers.filter(pa.array(kind == k)) for k in range(3))
        if not any(a.num_rows for a in answered):
            return x.rows([], x.TO_BUCKET)
        lines = _Lines(table)
        at = lines.owned(later, near)
        who, keys, own = _keys(lines, at, max_edits, near)
        keys = x.bucket_keys(keys, n_buckets)
        plain, hot = (np.flatnonzero(c.contains(x.returned_keys(a), keys)) for a in answered)
        order, cuts = c.by_bucket((keys[plain] >> np.uint64(32)).astype(np.int64))
        met = plain[order]
        parts = []

        def body(spans: np.ndarray, *more: np.ndarray) -> bytes:
            text = b"\n".join(lines.data[a:b].tobytes() for a, b in zip(lines.starts[spans], lines.ends[spans], strict=True))
            return x.pack(*more, lines.doc_ids[lines.doc[spans]], lines.place[spans], lines.hashes[spans], np.frombuffer(text, np.uint8))

        for bucket, lo, hi in cuts:
            rows = met[lo:hi]
            sent, index = np.unique(who[rows], return_inverse=True)
            low = (keys[rows] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            parts.append((bucket, x.block_of(table), body(at[sent], low, index.astype(np.uint32), own[rows].astype(np.uint8))))
        spans = at[np.unique(who[hot])]
        order, cuts = c.by_bucket(n_buckets + c.spread(lines.hashes[spans], n_buckets))
        parts += [(bucket, x.block_of(table), body(spans[order][lo:hi])) for bucket, lo, hi in cuts]
        return x.rows(parts, x.TO_BUCKET)

    return send


# Verification.


def within(data: np.ndarray, a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray, max_edits: int) -> np.ndarray:
    """Which pairs of spans lie within ``max_edits`` insertions, deletions and replacements of bytes.

    Bit ``d`` of a state stands for the diagonal ``d - max_edits``; state ``e`` has
    the diagonals reached with at most ``e`` edits. Bytes before and behind a
    span count as no match.
    """
    band = (1 << 2 * max_edits + 1) - 1
    result = np.zeros(len(a), bool)
    order = np.argsort(size_b, kind="stable")
    order = order[np.abs(size_a - size_b)[order] <= max_edits]
    a, size_a, b, size_b = a[order], size_a[order], b[order], size_b[order]
    word = np.uint8 if band < 256 else np.uint32
    top = len(data) - 1
    # Before the first byte of b only leading bytes of a can be left out.
    state = [np.full(len(order), sum(1 << max_edits + k for k in range(e + 1)), word) for e in range(max_edits + 1)]
    j = 0
    while len(order):
        ended = size_b == j
        if ended.any():
            diagonal = (size_a[ended] - size_b[ended] + max_edits).astype(word)
            result[order[ended]] = (state[max_edits][ended] >> diagonal) & 1 == 1
        if ended.any() or j % 16 == 15:
            keep = ~ended & (state[max_edits] != 0)
            order, a, size_a, b, size_b = (v[keep] for v in (order, a, size_a, b, size_b))
            state = [s[keep] for s in state]
            if not len(order):
                break
        symbol = data[b + j]
        match = np.zeros(len(order), word)
        for k in range(2 * max_edits + 1):
            row = j + k - max_edits
            if row >= 0:
                hit = (data[np.minimum(a + row, top)] == symbol) & (row < size_a)
                match |= hit.astype(word) << word(k)
        new = [state[0] & match]
        for e in range(1, max_edits + 1):
            moved = (state[e] & match) | state[e - 1] | (state[e - 1] >> word(1)) | (new[e - 1] << word(1))
            new.append(moved & word(band))
        state = new
        j += 1
    return result


def _verify(max_edits: int, n_buckets: int):
    def verify(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= n_buckets:
            return x.rows([], x.TO_BLOCK)
        blocks, fields, shift = table.column("block").to_pylist(), [], 0
        kinds = (np.uint32, np.uint32, np.uint8, np.int64, np.int64, np.uint64, np.uint8)
        for body in table.column("body").to_pylist():
            got = x.unpack(body, *kinds)
            got[1] = got[1].astype(np.int64) + shift
            got[6] = np.concatenate([got[6], np.array([_NEWLINE], np.uint8)])
            shift += len(got[3])
            fields.append(got)
        owner = np.repeat(np.arange(len(blocks)), [len(f[3]) for f in fields])
        keys, line, own, doc_ids, place, hashes, data = (np.concatenate(f) for f in zip(*fields, strict=True))
        breaks = np.flatnonzero(data == _NEWLINE)
        starts = np.concatenate([[0], breaks[:-1] + 1])
        sizes = breaks - starts
        rank = np.empty(shift, np.int64)
        rank[np.lexsort((place, doc_ids))] = np.arange(shift)
        near = _with_earlier(keys, line, own.astype(bool), rank, data, starts, sizes, max_edits)
        parts = []
        for i, lo, hi in c.by_bucket(owner)[1]:
            if (found := hashes[lo:hi][near[lo:hi]]).size:
                parts.append((blocks[i], bucket, found.tobytes()))
        return x.rows(parts, x.TO_BLOCK)

    return verify


def _with_earlier(keys, line, own, rank, data, starts, sizes, max_edits) -> np.ndarray:
    """Lines that have an earlier one within the bound among those that share a key with them."""
    near = np.zeros(len(starts), bool)
    order = np.lexsort((rank[line], keys))
    keys, line, own = keys[order], line[order], own[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    size = np.diff(np.append(first, len(keys)))
    at = np.arange(len(keys)) - first[group]
    lo, step = 0, 1
    while True:
        # In each group the members from lo to lo + step are tried with all behind them.
        open_ = np.flatnonzero((at > lo) & ~near[line])
        if not len(open_):
            return near
        # Rounds of few members keep the pairs of a round in bounds.
        for mine in np.array_split(open_, max(1, len(open_) * step // _TOGETHER)):
            count = np.minimum(np.minimum(at[mine], lo + step), size[group[mine]]) - lo
            row = np.repeat(mine, count)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            other = first[group[row]] + lo + turn
            fits = (own[row] | own[other]) & (line[row] != line[other]) & ~near[line[row]]
            fits &= np.abs(sizes[line[row]] - sizes[line[other]]) <= max_edits
            pair = np.unique(line[row[fits]] * len(starts) + line[other[fits]])
            later, earlier = pair // len(starts), pair % len(starts)
            found = within(data, starts[earlier], sizes[earlier], starts[later], sizes[later], max_edits)
            near[later[found]] = True
        lo, step = lo + step, step * 2


# Lines of keys that many lines hold.

_HOT_LINES = "line long, doc_id long, place long, block int, text binary"


def _hot_lines(n_buckets: int):
    names, kinds = zip(*(field.split() for field in _HOT_LINES.split(", ")), strict=True)
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()], strict=True)))

    def lines(table: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        if table.column("bucket")[0].as_py() >= n_buckets:
            for block, body in zip(table.column("block").to_pylist(), table.column("body").to_pylist(), strict=True):
                doc_ids, place, hashes, text = x.unpack(body, np.int64, np.int64, np.uint64, np.uint8)
                texts = pa.array(text.tobytes().split(b"\n"), pa.binary())
                columns = [pa.array(hashes.view(np.int64)), pa.array(doc_ids), pa.array(place), pa.array([block] * len(place), pa.int32()), texts]
                out.append(pa.Table.from_arrays(columns, schema=schema))
        return pa.concat_tables(out)

    return lines


def _fine_keys(data: np.ndarray, bounds: np.ndarray, max_edits: int, near: int):
    """Line, key and whether it is of the line's own segments, of all finer keys of some lines."""
    substring, length = c.Substrings(data), np.diff(bounds)
    who, keys, own = [], [], []
    for gap in range(max_edits + 1):
        short = length - gap
        n = np.clip(short // _FINE_BYTES, max_edits + 1, _FINE_MOST)
        # With a shift of s before and gap - s behind a segment, no more than max_edits bytes come or go.
        shifts = [s for s in range(-max_edits, max_edits + 1) if abs(s) + abs(gap - s) <= max_edits]
        for i in range(n.max(initial=0)):
            rows = np.flatnonzero((short >= near) & (i < n))
            offset, width = _segment(short[rows], i, n[rows])
            for shift in shifts:
                place = offset + shift
                inside = (place >= 0) & (place + width <= length[rows])
                begin = bounds[:-1][rows[inside]] + place[inside]
                kind = (short[rows[inside]] * _FINE_MOST + i).astype(np.uint64)
                who.append(rows[inside])
                keys.append(c.joined(substring(begin, begin + width[inside]), kind, 11))
                own.append(np.full(inside.sum(), gap == shift == 0))
    return tuple(np.concatenate(v) for v in (who, keys, own)) if who else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))


def _send_fine(max_edits: int, near: int):
    def send(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _FINE_ROWS):
                some = batch.slice(at, _FINE_ROWS)
                who, keys, own = _fine_keys(*c.flat(some.column("text")), max_edits, near)
                order = np.lexsort((~own, keys, who))
                who, keys, own = who[order], keys[order], own[order]
                new = np.ones(len(who), bool)
                new[1:] = (who[1:] != who[:-1]) | (keys[1:] != keys[:-1])
                line = some.column("line").take(pa.array(who[new]))
                yield pa.RecordBatch.from_arrays([line, pa.array(keys[new].view(np.int64)), pa.array(own[new])], ["line", "key", "own"])

    return send


def _verify_fine(max_edits: int):
    def verify(table: pa.Table) -> pa.Table:
        hashes, first, index = np.unique(table.column("line").to_numpy(), return_index=True, return_inverse=True)
        lines = table.take(pa.array(first))
        data, bounds = c.flat(lines.column("text"))
        rank = np.empty(len(first), np.int64)
        rank[np.lexsort((lines.column("place").to_numpy(), lines.column("doc_id").to_numpy()))] = np.arange(len(first))
        keys, own = table.column("key").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
        data = np.append(data, np.uint8(_NEWLINE))
        near = np.zeros(len(first), bool)
        # Keys of few own lines: these with all. Others: all in turn.
        kind, of = np.unique(keys, return_inverse=True)
        few = (np.bincount(of, own, len(kind)) <= _FEW)[of]
        for chosen, find in ((few, _with_own), (~few, _with_earlier)):
            if chosen.any():
                near |= find(keys[chosen], index[chosen], own[chosen], rank, data, bounds[:-1], np.diff(bounds), max_edits)
        bucket, blocks = table.column("bucket")[0].as_py(), lines.column("block").to_numpy()
        order, cuts = c.by_bucket(blocks[near])
        found = hashes[near][order].view(np.uint64)
        return x.rows([(block, bucket, found[lo:hi].tobytes()) for block, lo, hi in cuts], x.TO_BLOCK)

    return verify


def _with_own(keys, line, own, rank, data, starts, sizes, max_edits) -> np.ndarray:
    """Lines that have an earlier one within the bound, where one of the two has their common key as its own."""
    near = np.zeros(len(starts), bool)
    order = np.argsort(keys, kind="stable")
    keys, line, own = keys[order], line[order], own[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    size = np.diff(np.append(first, len(keys)))
    mine = np.flatnonzero(own)
    for some in np.split(mine, np.flatnonzero(np.diff(np.cumsum(size[group[mine]]) // _TOGETHER)) + 1):
        count = size[group[some]]
        row = np.repeat(some, count)
        other = np.repeat(first[group[some]], count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        a, b = line[row], line[other]
        later, earlier = np.where(rank[a] > rank[b], a, b), np.where(rank[a] > rank[b], b, a)
        fits = (a != b) & ~near[later] & (np.abs(sizes[a] - sizes[b]) <= max_edits)
        pair = np.unique(later[fits] * len(starts) + earlier[fits])
        later, earlier = pair // len(starts), pair % len(starts)
        near[later[within(data, starts[earlier], sizes[earlier], starts[later], sizes[later], max_edits)]] = True
    return near


def _refine(hot: DataFrame, max_edits: int, near: int, n_buckets: int) -> DataFrame:
    """Lines with an earlier neighbour among lines of hot keys, back to their blocks."""
    keys = hot.select("line", "text").mapInArrow(_send_fine(max_edits, near), "line long, key long, own boolean")
    held = keys.groupBy("key").agg(F.count("*").alias("lines"), F.max("own").alias("owned")).filter("owned").drop("owned")
    rarest = Window.partitionBy("line").orderBy("lines", "key")
    picked = keys.filter("own").join(held, "key").withColumn("rank", F.row_number().over(rarest)).filter(F.col("rank") <= max_edits + 1)
    live = picked.filter("lines > 1").groupBy("key").agg(F.max("lines").alias("lines"), F.count("*").alias("owners"))
    members = keys.select("line", "key", F.lit(False).alias("own")).unionByName(picked.select("line", "key", F.lit(True).alias("own")))
    members = members.join(live, "key").groupBy("line", "key", "lines", "owners").agg(F.max("own").alias("own"))
    parts = F.when(F.col("owners") <= _FEW, F.ceil(F.col("lines") / _DEALT)).otherwise(1).cast("int")
    part = F.when(F.col("own"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("line"), parts).cast("int")))
    dealt = members.withColumn("part", F.explode(part)).join(hot, "line").withColumn("key", F.xxhash64("key", "part"))
    dealt = dealt.withColumn("bucket", F.pmod("key", F.lit(n_buckets)).cast("int"))
    return dealt.groupBy("bucket").applyInArrow(_verify_fine(max_edits), x.BACK)


# The texts that stay.


def _finish(digest: bool, keep: bool):
    schema = _DIGEST if digest else _TEXTS

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            empty = schema.empty_table()
            return empty.append_column("row", table.column("row")) if keep else empty
        lines = _Lines(table)
        kind = answers.column("kind").to_numpy(zero_copy_only=False)
        later = _found(answers.filter(pa.array(kind == 0)), np.uint64)
        near = _found(answers.filter(pa.array(kind == 1)), np.uint64)
        again = x.later(lines.doc_ids[lines.doc], lines.place, lines.hashes)
        gone = ~lines.blank & (again | c.contains(later, lines.hashes) | c.contains(near, lines.hashes))
        out = {name: [] for name in schema.names}
        texts = c.column(lines.table, "text")
        for i, doc_id in enumerate(c.column(lines.table, "doc_id").to_pylist()):
            mask, text = gone[lines.first[i] : lines.first[i + 1]], texts[i].as_py()
            if mask.any():
                text = "\n".join(t for t, g in zip(text.split("\n"), mask, strict=True) if not g)
            row = [doc_id, len(mask), int(mask.sum())]
            row += [hashlib.sha256((text or "").encode()).hexdigest()] if digest else [text, np.flatnonzero(mask).tolist()]
            for name, value in zip(out, row, strict=True):
                out[name].append(value)
        found = pa.table(out, schema=schema)
        return found.append_column("row", lines.table.column("row")) if keep else found

    return finish


_COUNTS = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64())]
_DIGEST = pa.schema([*_COUNTS, ("kept_sha256", pa.string())])
_TEXTS = pa.schema([*_COUNTS, ("kept", pa.string()), ("removed", pa.list_(pa.int64()))])


def remove_repeated_lines(docs: DataFrame, max_edits: int = 2, near_bytes: int = 24, digest: bool = False, keep: bool = False) -> DataFrame:
    """Each document of ``doc_id`` and ``text`` without lines that an earlier line equals or nearly equals.

    Lines end at line feeds. One is removed if an equal line stands earlier
    (smaller id, or same id and earlier line), or if both have ``near_bytes``
    bytes at least and at most ``max_edits`` bytes are inserted, deleted or
    replaced between them. All lines are judged on the input: a line may go for
    the sake of one that goes itself. Blank lines stay. The result has
    ``doc_id``, ``n_lines``, ``n_removed``, the ``kept`` text and the numbers of
    the ``removed`` lines; with ``digest`` the SHA-256 of the kept text instead;
    with ``keep`` also the input's ``row``, without its text.

    A null or empty text has no lines and stays as it is. A null id counts as
    larger than every other. Rows that share an id count as one document: of
    equal lines the earlier stays, and at equal places both. Every row gives one
    row; other columns are ignored.
    """
    if not 0 <= max_edits <= 7 or near_bytes < 2 * max_edits + 2:
        raise ValueError("max_edits must be 0 to 7, near_bytes twice that and 2 at least")
    c.ship(docs.sparkSession)
    size = c.text_bytes(docs)
    n_buckets = max(8, size // BUCKET_BYTES)
    blocks = c.blocked(docs, max(1, -(-size // BLOCK_BYTES)), keep)
    of_block = blocks.groupBy("block")
    sent = of_block.applyInArrow(_send_lines(n_buckets), x.SENT)
    later = sent.groupBy("bucket").applyInArrow(x.find_later, x.BACK)
    keys = of_block.cogroup(later.groupBy("block")).applyInArrow(_send_keys(max_edits, near_bytes, n_buckets), x.SENT)
    live = keys.groupBy("bucket").applyInArrow(_find_meetings(HOT), x.BACK + ", kind int")
    candidates = of_block.cogroup(_both(later, live).groupBy("block"))
    candidates = candidates.applyInArrow(_send_candidates(max_edits, near_bytes, n_buckets), x.SENT).groupBy("bucket")
    near = candidates.applyInArrow(_verify(max_edits, n_buckets), x.BACK)
    hot = candidates.applyInArrow(_hot_lines(n_buckets), _HOT_LINES)
    near = near.unionByName(_refine(hot, max_edits, near_bytes, n_buckets)).selectExpr("*", "1 AS kind")
    counts = "doc_id long, n_lines long, n_removed long, "
    result = counts + ("kept_sha256 string" if digest else "kept string, removed array<long>")
    if keep:
        result += f", row {blocks.schema['row'].dataType.simpleString()}"
    return of_block.cogroup(_both(later, near).groupBy("block")).applyInArrow(_finish(digest, keep), result)


def _both(first: DataFrame, second: DataFrame) -> DataFrame:
    """Answers of kind 0 and of those that the second name."""
    return first.selectExpr("*", "0 AS kind").unionByName(second)
