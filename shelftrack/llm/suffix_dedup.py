"""Repeated byte strings, by the Burrows-Wheeler transform of a collection of texts.

The transform is built column by column: each round puts one more byte of every
text in front of its suffix so far, finds where the longer suffix belongs from
the ranks of the bytes already there, and updates the transform and the lengths
of common prefixes. At the end, neighbours with a common prefix of ``width``
bytes are equal strings, and the first place of each stays.

Rounds over whole documents would be as many as the longest has bytes. Two equal
strings of ``width`` bytes hold the same anchor, the ``ANCHOR`` bytes of least hash
among those inside them, at the same offset. So documents are cut into contexts,
one for each anchor with the strings that have it as their own, at most
``2 * width - ANCHOR`` bytes long. Contexts whose anchor occurs once cannot repeat
and stay where they are; equal contexts are one text of the collection; the
others go to the bucket of their anchor. The columns of a collection are read
and written in order, and what the method keeps in files between machines is
the exchange of blocks and buckets.

An anchor inside a very common passage has as many contexts as texts go on
differently behind it. From ``HOT`` contexts on its strings are sent one by one,
equal ones once a block, to the bucket of the string, so that no task gets them all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelftrack.llm import common as c
from shelftrack.llm import exchange as x

ANCHOR = 32
BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 8 << 20
COLLECTION = 2048  # contexts whose columns are built together, about
HOT = 8192  # contexts from which an anchor's strings go to buckets of their own
_TILE = 1 << 16
_PLACE_BITS = np.uint64(20)


def _window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` in a row."""
    size = 1
    while 2 * size <= width:
        hashes = np.minimum(hashes[:-size], hashes[size:])
        size *= 2
    return np.minimum(hashes[: len(hashes) - (width - size)], hashes[width - size :]) if width > size else hashes


def anchor_places(data: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` bytes the place of its anchor: of least hash, the first of equal ones."""
    n = len(data) - width + 1
    out = np.empty(max(n, 0), np.int64)
    low = np.uint64((1 << int(_PLACE_BITS)) - 1)
    for at in range(0, n, _TILE):
        part = data[at : at + _TILE + width - 1]
        hashes = c.BYTE_HASHES[part]
        size = 1
        while size < ANCHOR:
            hashes = hashes[:-size] * np.uint64(c.BASE + 2 * size) + hashes[size:]
            size *= 2
        hashes = (c.mix(hashes) & ~low) | np.arange(len(hashes), dtype=np.uint64)
        minima = _window_minima(hashes, width - ANCHOR + 1)
        out[at : at + _TILE] = (minima & low).astype(np.int64) + at
    return out


class _Contexts:
    """Contexts of a block's documents in the order of the ids.

    ``anchor`` has the place of each anchor in ``data``, ``lo`` and ``hi`` the
    first and last window that has it.
    """

    def __init__(self, table: pa.Table, width: int):
        self.table, self.width = c.by_id(table), width
        self.doc_ids = c.ids(c.column(self.table, "doc_id"))
        self.data, self.bounds = c.flat(c.column(self.table, "text"))
        anchors = anchor_places(self.data, width)
        # Windows that cross the end of a document belong to none.
        inside = np.ones(len(anchors), bool)
        for edge in self.bounds[1:]:
            inside[max(0, edge - width + 1) : edge] = False
        windows = np.flatnonzero(inside)
        new = np.ones(len(windows), bool)
        new[1:] = (anchors[windows][1:] != anchors[windows][:-1]) | (np.diff(windows) > 1)
        first = np.flatnonzero(new)
        self.lo = windows[first]
        self.hi = windows[np.append(first[1:], len(windows)) - 1] if len(first) else windows
        self.anchor = anchors[self.lo]
        self.doc = np.searchsorted(self.bounds, self.lo, side="right") - 1
        self.place = self.lo - self.bounds[self.doc]
        self.substring = c.Substrings(self.data)
        self.hashes = c.joined(self.substring(self.lo, self.hi + width), (self.anchor - self.lo).astype(np.uint64), 3)

    def windows(self, chosen: np.ndarray) -> np.ndarray:
        """Places of all windows of the chosen contexts."""
        return _ranges(self.lo[chosen], (self.hi - self.lo + 1)[chosen])

    def window_names(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, document id and place of windows."""
        doc = np.searchsorted(self.bounds, windows, side="right") - 1
        return self.substring(windows, windows + self.width), self.doc_ids[doc], windows - self.bounds[doc]

    def keys(self, n_buckets: int) -> np.ndarray:
        return x.bucket_keys(self.substring(self.anchor, self.anchor + ANCHOR), n_buckets)


def _send_anchors(width: int, n_buckets: int):
    """The distinct anchors of a block and how many distinct contexts each has."""

    def send(table: pa.Table) -> pa.Table:
        contexts = _Contexts(table, width)
        pairs = np.unique(np.stack([contexts.keys(n_buckets), contexts.hashes], axis=1), axis=0)
        keys, counts = np.unique(pairs[:, 0], return_counts=True)
        parts = []
        for bucket, lo, hi in c.by_bucket((keys >> np.uint64(32)).astype(np.int64))[1]:
            low = (keys[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            parts.append((bucket, x.block_of(table), x.pack(low, np.minimum(counts[lo:hi], 65535).astype(np.uint16))))
        return x.rows(parts, x.TO_BUCKET)

    return send


def _find_repeated(hot: int):
    """Anchors with several contexts, back to their blocks; those with ``hot`` or more apart."""

    def find(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blocks = table.column("block").to_pylist()
        keys, counts = zip(*(x.unpack(b, np.uint32, np.uint16) for b in table.column("body").to_pylist()), strict=True)
        owner = np.repeat(np.arange(len(blocks)), [len(k) for k in keys])
        _, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, np.concatenate(counts))[back]
        parts = []
        for i, lo, hi in c.by_bucket(owner)[1]:
            some, many = (total[lo:hi] > 1) & (total[lo:hi] < hot), total[lo:hi] >= hot
            if some.any() or many.any():
                parts.append((blocks[i], bucket, x.pack(keys[i][some], keys[i][many])))
        return x.rows(parts, x.TO_BLOCK)

    return find


def _live(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys of anchors with several contexts and of hot ones, sorted."""
    found = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
    for bucket, body in zip(table.column("bucket").to_pylist(), table.column("body").to_pylist(), strict=True):
        for out, low in zip(found, x.unpack(body, np.uint32, np.uint32), strict=True):
            out.append(low.astype(np.uint64) | (np.uint64(bucket) << np.uint64(32)))
    return tuple(np.sort(np.concatenate(v)) for v in found)


_FIELDS = (np.uint32, np.uint64, np.int64, np.uint32, np.uint8, np.uint8, np.uint8)


def _send_contexts(width: int, n_buckets: int):
    def send(table: pa.Table, live: pa.Table) -> pa.Table:
        if not table.num_rows or not live.num_rows:
            return x.rows([], x.TO_BUCKET)
        contexts, block = _Contexts(table, width), x.block_of(table)
        keys = contexts.keys(n_buckets)
        some, many = _live(live)
        parts = _sent_windows(contexts, contexts.windows(c.contains(many, keys)), n_buckets, block)
        if len(many):
            # To the block itself, which has to know its hot anchors at the end.
            parts.append((2 * n_buckets + block, block, many.tobytes()))
        at = np.flatnonzero(c.contains(some, keys))
        order = np.lexsort((contexts.place[at], contexts.doc_ids[contexts.doc[at]], contexts.hashes[at]))
        ranked = contexts.hashes[at][order]
        at = at[order[np.concatenate([[True], ranked[1:] != ranked[:-1]])]] if len(at) else at
        order, cuts = c.by_bucket((keys[at] >> np.uint64(32)).astype(np.int64))
        at = at[order]
        for bucket, lo, hi in cuts:
            own = at[lo:hi]
            size = contexts.hi[own] - contexts.lo[own] + width
            body = x.pack(
                (keys[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32), contexts.hashes[own], contexts.doc_ids[contexts.doc[own]],
                contexts.place[own].astype(np.uint32), (size - width).astype(np.uint8),
                (contexts.anchor - contexts.lo)[own].astype(np.uint8), contexts.data[_ranges(contexts.lo[own], size)],
            )
            parts.append((bucket, block, body))
        return x.rows(parts, x.TO_BUCKET)

    return send


def _sent_windows(contexts: _Contexts, windows: np.ndarray, n_buckets: int, block: int) -> list[tuple[int, int, bytes]]:
    """Single strings of hot anchors; equal ones count once in a block and go to one bucket."""
    if not len(windows):
        return []
    hashes, doc_ids, place = contexts.window_names(windows)
    order = np.lexsort((place, doc_ids, hashes))
    order = order[np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])]
    bucket = c.spread(hashes[order], n_buckets)
    by, cuts = c.by_bucket(bucket)
    order = order[by]
    start = windows[order]
    check = contexts.substring(start, start + contexts.width // 2) >> np.uint64(32)
    return [
        (n_buckets + number, block, x.pack_places(hashes[order[lo:hi]], doc_ids[order[lo:hi]], check[lo:hi], place[order[lo:hi]]))
        for number, lo, hi in cuts
    ]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one range behind the other."""
    return np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


# The transform.


def repeated_prefixes(data: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, offset and class of every suffix of a collection that has ``width`` bytes.

    Suffixes of one class begin with the same ``width`` bytes. ``first`` bounds
    the texts in ``data``.
    """
    sizes = np.diff(first)
    n = len(sizes)
    symbol = np.zeros(256, np.uint8)
    used = np.unique(data)
    wide = len(used) > 255
    symbol = symbol.astype(np.uint16) if wide else symbol
    symbol[used] = np.arange(1, len(used) + 1)
    coded = symbol[data]
    # Entries in the order of suffixes: the byte in front, and bytes shared with the entry before.
    transform, shared = np.zeros(n, coded.dtype), np.zeros(n, np.uint8)
    texts, place = np.arange(n), np.arange(n)
    for column in range(1, int(sizes.max(initial=0)) + 1):
        go = sizes[texts] >= column
        texts, place = texts[go], place[go]
        put = coded[first[texts + 1] - column]
        transform[place] = put
        # Sorting by the byte in front takes every suffix to its place with that byte put before it.
        order = np.argsort(transform, kind="stable")
        ended = int(np.searchsorted(transform[order], 1))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[place]
        total = len(transform) + len(texts)
        target = n - ended + at
        before, after = order[at - 1], order[np.minimum(at + 1, len(order) - 1)]
        has_before = (at > ended) & (transform[before] == put)
        is_new = np.zeros(len(transform), bool)
        is_new[place] = True
        has_after = (at + 1 < len(order)) & (transform[after] == put) & ~is_new[after]
        common = np.zeros(len(texts), np.uint8)
        common[has_before] = _least(shared, before[has_before], place[has_before], width)
        fresh = np.zeros(total, bool)
        fresh[target] = True
        new_transform, new_shared = np.zeros(total, transform.dtype), np.empty(total, np.uint8)
        new_transform[~fresh], new_shared[~fresh] = transform, shared
        new_shared[target] = common
        new_shared[target[has_after] + 1] = _least(shared, place[has_after], after[has_after], width)
        transform, shared, place = new_transform, new_shared, target
    # Walk back through the finished transform to name its entries.
    order = np.argsort(transform, kind="stable")
    step = np.empty(len(order), np.int64)
    step[order] = np.arange(len(order))
    owner, offset = np.full(len(transform), -1, np.int64), np.zeros(len(transform), np.int64)
    texts, place = np.arange(n), np.arange(n)
    for column in range(1, int(sizes.max(initial=0)) + 1):
        go = sizes[texts] >= column
        texts, place = texts[go], step[place[go]]
        owner[place], offset[place] = texts, sizes[texts] - column
    kind = np.cumsum(shared < width)
    long = np.flatnonzero((owner >= 0) & (sizes[owner] - offset >= width))
    return owner[long], offset[long], kind[long]


def _least(shared: np.ndarray, above: np.ndarray, below: np.ndarray, width: int) -> np.ndarray:
    """One more than the least common prefix on the way from entry ``above`` down to ``below``, ``width`` at most."""
    if not len(above):
        return np.zeros(0, np.uint8)
    order = np.argsort(below, kind="stable")
    cuts = np.stack([above[order] + 1, below[order] + 1], axis=1).reshape(-1)
    found = np.minimum.reduceat(np.append(shared, np.uint8(255)), cuts)[::2]
    out = np.empty(len(above), np.uint8)
    out[order] = np.minimum(found, width - 1) + 1
    return out


def _trimmed(data, first, lead, own, size, group, width) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each context that another one of its anchor may share.

    Every window reaches half of what an anchor leaves to the left of it, or half
    to the right. A context whose half on one side nobody else has keeps the windows
    that do not reach that far.
    """
    substring, half = c.Substrings(data), (width - ANCHOR) // 2
    anchor, lo, hi = first[own] + lead, np.zeros(len(own), np.int64), size - width

    def alone(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        inside = (start >= first[own]) & (stop <= first[own] + size)
        names = c.joined(substring(np.where(inside, start, anchor), np.where(inside, stop, anchor)), group.astype(np.uint64), 4)
        _, back, times = np.unique(names, return_inverse=True, return_counts=True)
        return ~inside | (times[back] == 1)

    left, right = alone(anchor - half, anchor + ANCHOR), alone(anchor, anchor + ANCHOR + half)
    lo = np.where(left, np.maximum(lo, lead - (half - 1)), lo)
    hi = np.where(right, np.minimum(hi, lead - (width - ANCHOR - half + 1)), hi)
    return lo, hi


def _find_later(width: int, n_buckets: int):
    """Contexts, or strings of hot anchors, that have an equal one earlier, back to their blocks."""

    def find(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= 2 * n_buckets:
            return table.select(["block", "bucket", "body"])
        return x.find_later(table) if bucket >= n_buckets else find_contexts(table, bucket)

    def find_contexts(table: pa.Table, bucket: int) -> pa.Table:
        blocks = table.column("block").to_pylist()
        fields = list(zip(*(x.unpack(b, *_FIELDS) for b in table.column("body").to_pylist()), strict=True))
        owner = np.repeat(np.arange(len(blocks)), [len(k) for k in fields[0]])
        keys, hashes, doc_ids, place, extra, lead, data = (np.concatenate(f) for f in fields)
        size = extra.astype(np.int64) + width
        first = np.concatenate([[0], np.cumsum(size)])
        whole = x.later(doc_ids, place, hashes)
        # The first place of each context stands for it in the collection of its anchor.
        order = np.lexsort((place, doc_ids, hashes, keys))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (keys[order][1:] != keys[order][:-1])
        kinds = order[new]
        group = np.cumsum(np.concatenate([[True], keys[kinds][1:] != keys[kinds][:-1]])) - 1
        lo, hi = _trimmed(data, first, lead[kinds].astype(np.int64), kinds, size[kinds], group, width)
        # An anchor of one context is alone on both sides and has nothing left.
        some = lo <= hi
        kinds, group, lo, hi = kinds[some], group[some], lo[some], hi[some]
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
        part = np.repeat(begins, np.diff(np.append(begins, len(group)))) // COLLECTION
        bits = np.zeros((len(keys), width), bool)
        for _, a, b in c.by_bucket(part)[1]:
            own, lengths = kinds[a:b], (hi - lo)[a:b] + width
            body = data[_ranges(first[own] + lo[a:b], lengths)]
            text, offset, kind = repeated_prefixes(body, np.concatenate([[0], np.cumsum(lengths)]), width)
            offset = offset + lo[a:b][text]
            again = x.later(doc_ids[own[text]], place[own[text]] + offset, kind)
            bits[own[text[again]], offset[again]] = True
        partly = bits.any(axis=1) & ~whole
        parts = []
        for i, a, b in c.by_bucket(owner)[1]:
            all_of, those = whole[a:b], partly[a:b]
            if all_of.any() or those.any():
                packed = np.packbits(bits[a:b][those], axis=1).reshape(-1)
                parts.append((blocks[i], bucket, x.pack(hashes[a:b][all_of], hashes[a:b][those], packed)))
        return x.rows(parts, x.TO_BLOCK)

    return find


# The bytes that stay.


def _removed(contexts: _Contexts, answers: pa.Table, n_buckets: int) -> np.ndarray:
    """Windows that have an equal one earlier."""
    width = contexts.width
    whole = x.later(contexts.doc_ids[contexts.doc], contexts.place, contexts.hashes)
    hot, single, bodies = np.zeros(0, np.uint64), [np.zeros(0, np.uint64)], []
    for bucket, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist(), strict=True):
        if bucket >= 2 * n_buckets:
            hot = np.frombuffer(body, np.uint64)
        elif bucket >= n_buckets:
            single.append(np.frombuffer(body, np.uint64))
        else:
            bodies.append(x.unpack(body, np.uint64, np.uint64, np.uint8))
    out = []
    if len(hot):
        windows = contexts.windows(c.contains(hot, contexts.keys(n_buckets)))
        hashes, doc_ids, place = contexts.window_names(windows)
        out.append(windows[c.contains(np.sort(np.concatenate(single)), hashes) | x.later(doc_ids, place, hashes)])
    if bodies:
        whole |= c.contains(np.sort(np.concatenate([b[0] for b in bodies])), contexts.hashes)
        names, bits = np.concatenate([b[1] for b in bodies]), np.concatenate([b[2] for b in bodies])
        order = np.argsort(names)
        names, bits = names[order], bits.reshape(len(names), (width + 7) // 8)[order]
        some = np.flatnonzero(~whole & c.contains(names, contexts.hashes))
        rows, offsets = np.nonzero(np.unpackbits(bits[np.searchsorted(names, contexts.hashes[some])], axis=1, count=width))
        out.append(contexts.lo[some][rows] + offsets)
    return np.concatenate([contexts.windows(whole), *out])


def _finish(width: int, n_buckets: int, digest: bool):
    schema = _DIGEST if digest else _SPANS

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        contexts = _Contexts(table, width)
        gone = c.covered(_removed(contexts, answers, n_buckets), width, len(contexts.data))
        out = {name: [] for name in schema.names}
        for i, doc_id in enumerate(c.column(contexts.table, "doc_id").to_pylist()):
            part = slice(contexts.bounds[i], contexts.bounds[i + 1])
            mask, body = gone[part], contexts.data[part]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            row = [doc_id, len(body), int(mask.sum()), len(edges) // 2]
            kept = body[~mask].tobytes() if len(edges) else body.tobytes()
            row += [hashlib.sha256(kept).hexdigest()] if digest else [kept, [{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)]]
            for name, value in zip(out, row, strict=True):
                out[name].append(value)
        return pa.table(out, schema=schema)

    return finish


_COUNTS = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
_DIGEST = pa.schema([*_COUNTS, ("kept_sha256", pa.string())])
_SPANS = pa.schema(
    [*_COUNTS, ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
)


def remove_repeated_strings(docs: DataFrame, width: int = 100, digest: bool = False) -> DataFrame:
    """Each document of ``doc_id`` and ``text`` without the bytes of repeated strings.

    A byte goes if a string of ``width`` bytes covers it that also starts earlier
    (smaller id, or same id and earlier start); strings are of UTF-8 bytes, may
    overlap and are judged on the input. The result has ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans``, the ``kept`` bytes (which may break characters) and
    the removed ``spans``; with ``digest`` the SHA-256 of the kept bytes instead.

    A null text is empty; a text of fewer than ``width`` bytes stays. A null id
    counts as larger than every other. Rows that share an id count as one
    document: of equal strings the earlier start stays, and at equal starts both.
    Every row gives one row; other columns are ignored.
    """
    if not ANCHOR < width <= 250:
        raise ValueError(f"width must be over {ANCHOR} and 250 at most")
    c.ship(docs.sparkSession)
    size = c.text_bytes(docs)
    n_buckets = max(8, size // BUCKET_BYTES)
    of_block = c.blocked(docs, max(1, -(-size // BLOCK_BYTES))).groupBy("block")
    sent = of_block.applyInArrow(_send_anchors(width, n_buckets), x.SENT)
    live = sent.groupBy("bucket").applyInArrow(_find_repeated(HOT), x.BACK)
    contexts = of_block.cogroup(live.groupBy("block")).applyInArrow(_send_contexts(width, n_buckets), x.SENT)
    later = contexts.groupBy("bucket").applyInArrow(_find_later(width, n_buckets), x.BACK)
    counts = "doc_id long, n_bytes long, n_removed long, n_spans long, "
    result = counts + ("kept_sha256 string" if digest else "kept binary, spans array<struct<start:long,stop:long>>")
    return of_block.cogroup(later.groupBy("block")).applyInArrow(_finish(width, n_buckets, digest), result)
