"""Repeated runs of words, found by anchors at the places of a difference cover.

Every word place whose index modulo ``PERIOD`` lies in ``COVER`` starts an
anchor of ``width - PERIOD + 1`` words. For any two places there is a shift
below ``PERIOD`` that takes both onto the cover, so two equal windows share an
aligned anchor. A window none of whose anchors occurs again is ruled out; the
windows left are extended to their full width and the first of each kind stays.

Texts are cut into blocks of a few MB by a hash of the row. A block sends each
of its anchors once, as four bytes, so a passage that a third of all documents
hold costs one entry a block. The answer comes back by block. No task holds
more than a block or a bucket of hashes, and all are functions of the input
alone, so lost ones are computed anew.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelftrack.llm import common as c
from shelftrack.llm import exchange as x

PERIOD = 13
COVER = np.isin(np.arange(PERIOD), [0, 1, 3, 9])  # differences give every remainder
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_SPANS = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,stop:long>>"


class _Block:
    """Words of a block's texts in the order of the ids, with their hashes."""

    def __init__(self, table: pa.Table):
        self.table = c.by_id(table)
        self.doc_ids = c.ids(c.column(self.table, "doc_id"))
        data, bounds = c.flat(c.column(self.table, "text"))
        starts, ends, self.first = c.word_spans(data, bounds)
        self.words = c.span_hashes(data, starts, ends)
        self.sizes = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(self.words)) - self.first[self.doc]

    def runs(self, n: int) -> np.ndarray:
        """Where ``n`` words follow within the document."""
        return np.flatnonzero(self.place + n <= self.sizes[self.doc])

    def anchors(self, width: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Word index and 64-bit key of each anchor: its bucket above, four bytes of its hash below."""
        n = width - PERIOD + 1
        at = self.runs(n)
        at = at[COVER[self.place[at] % PERIOD]]
        hashes = c.run_hashes(self.words, n)[at] if len(at) else np.zeros(0, np.uint64)
        return at, x.bucket_keys(hashes, n_buckets)


def _send_anchors(width: int, n_buckets: int):
    def send(table: pa.Table) -> pa.Table:
        _, keys = _Block(table).anchors(width, n_buckets)
        return x.rows(x.sent_keys(keys, x.block_of(table)), x.TO_BUCKET)

    return send


def _send_windows(width: int, n_buckets: int):
    def send(table: pa.Table, live: pa.Table) -> pa.Table:
        if not table.num_rows or not live.num_rows:
            return x.rows([], x.TO_BUCKET)
        block = _Block(table)
        at, keys = block.anchors(width, n_buckets)
        places = np.zeros(len(block.words) + 1, np.int64)
        places[at[c.contains(x.returned_keys(live), keys)] + 1] = 1  # anchors met again
        met = np.cumsum(places)
        starts = block.runs(width)
        starts = starts[met[starts + PERIOD] > met[starts]]
        hashes, check = (c.run_hashes(block.words, width, salt)[starts] for salt in (0, 1))
        hashes, first = np.unique(hashes, return_index=True)
        starts, check = starts[first], (check[first] >> np.uint64(32)).astype(np.uint32)
        order, cuts = c.by_bucket(c.spread(hashes, n_buckets))
        hashes, check, starts = hashes[order], check[order], starts[order]
        doc_ids, place = block.doc_ids[block.doc[starts]], block.place[starts].astype(np.uint32)
        parts = []
        for bucket, lo, hi in cuts:
            body = x.pack_places(hashes[lo:hi], doc_ids[lo:hi], check[lo:hi], place[lo:hi])
            parts.append((bucket, x.block_of(table), body))
        return x.rows(parts, x.TO_BUCKET)

    return send


def _finish(width: int, spans: bool):
    def finish(table: pa.Table, later: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _SCHEMAS[spans].empty_table()
        block = _Block(table)
        starts = block.runs(width)
        gone = np.zeros(len(block.words), bool)
        if len(starts):
            hashes = c.run_hashes(block.words, width)[starts]
            known = x.returned(later, np.uint64)
            found = np.sort(np.concatenate([*known.values(), np.zeros(0, np.uint64)]))
            removed = c.contains(found, hashes) | x.later(block.doc_ids[block.doc[starts]], block.place[starts], hashes)
            gone = c.covered(starts[removed], width, len(block.words))
        out = {name: [] for name in _SCHEMAS[spans].names}
        texts = c.column(block.table, "text")
        for i, doc_id in enumerate(c.column(block.table, "doc_id").to_pylist()):
            words = (texts[i].as_py() or "").encode().split()
            mask = gone[block.first[i] : block.first[i + 1]]
            n_removed = int(mask.sum())
            kept = b" ".join(compress(words, ~mask) if n_removed else words)
            row = [doc_id, len(words), n_removed]
            if spans:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                runs = [{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)]
                row += [kept.decode(), runs]
            else:
                row.append(hashlib.sha256(kept).hexdigest())
            for name, value in zip(out, row, strict=True):
                out[name].append(value)
        return pa.table(out, schema=_SCHEMAS[spans])

    return finish


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
_TEXTS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ]
)
_SCHEMAS = {False: _DIGEST, True: _TEXTS}


def remove_repeated_passages(docs: DataFrame, width: int = 20, digest: bool = False) -> DataFrame:
    """Each document of ``doc_id`` and ``text`` without the words of repeated windows.

    A window is ``width`` consecutive words of a document; one whose words also
    start earlier (smaller id, or same id and earlier start) gives up all its
    words. Words are runs of bytes that are no ASCII white space, unchanged.
    The result has ``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` words
    joined by a space with the removed ``spans`` of word places; with ``digest``
    the SHA-256 of the kept words in their stead.

    A null or empty text has no words and stays. A null id counts as larger
    than every other. Rows that share an id count as one document: of equal
    windows the earlier start stays, and at equal starts both. Every row of the
    input gives one row; other columns are ignored.
    """
    if width < PERIOD:
        raise ValueError(f"width must be {PERIOD} at least")
    c.ship(docs.sparkSession)
    size = c.text_bytes(docs)
    n_buckets = max(8, size // BUCKET_BYTES)
    blocks = c.blocked(docs, max(1, -(-size // BLOCK_BYTES)))
    sent = blocks.groupBy("block").applyInArrow(_send_anchors(width, n_buckets), x.SENT)
    live = sent.groupBy("bucket").applyInArrow(x.find_repeated, x.BACK)
    windows = blocks.groupBy("block").cogroup(live.groupBy("block")).applyInArrow(_send_windows(width, n_buckets), x.SENT)
    later = windows.groupBy("bucket").applyInArrow(x.find_later, x.BACK)
    finished = blocks.groupBy("block").cogroup(later.groupBy("block"))
    return finished.applyInArrow(_finish(width, not digest), _RESULT if digest else _SPANS)
