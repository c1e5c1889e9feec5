"""Alignment of two tokenizers' tokens, with an identity map as the fast path.

A blank and a text are cut into tokens by a byte-level tokenizer (A) and a
piece tokenizer (B). Byte offsets at which tokens of both end cut them into groups; every A
token of a group is linked to every B token of it. Neither tokenizer joins a
character to a blank behind it, so no token and no group crosses such a place:
each distinct segment between two of them is aligned once.

A table made before the run holds for each A number the B number of the same
bytes. Links that it names, nearly all of those of one token with one, are
counted in vectors as long as A's vocabulary, one a task. Only other links enter the
shuffle of pairs: a block of documents sends each of its pairs once, with the
number of documents, to the pair's bucket and gets the total back.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm import exchange as x
from shelftrack.llm import segments as s

_PART = 4 << 20  # bytes of text of a block
_SEGMENTS = 400_000  # known segments of a worker
_BUCKET = 64 << 20  # bytes of text for each bucket of pairs
_JOINED = 1 << 16
_MARK = "▁".encode()
_WIDE = 4096  # links of a group beyond which equal ones are counted first


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of the bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _Bodies:
    """The bytes of every number."""

    def __init__(self, bodies: list[bytes]):
        self.size = np.array([len(b) for b in bodies], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(bodies), np.uint8)

    def join(self, numbers: np.ndarray) -> np.ndarray:
        return s.gather(self.first, self.size, self.pool, numbers)[0]


class Pair:
    """Both tokenizers, their bytes and the map of equal ones."""

    def __init__(self, model_a: str, model_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(model_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        char, vocabulary = _byte_of_char(), self.a.get_vocab(with_added_tokens=False)
        special = {t["content"]: t["id"] for t in json.loads(model_a).get("added_tokens", [])}
        bodies = [b""] * (max([*vocabulary.values(), *special.values(), 0]) + 1)
        for piece, i in vocabulary.items():
            bodies[i] = piece.encode() if i in special.values() else bytes(char[ch] for ch in piece)
        self.a_bytes, self.n_a = _Bodies(bodies), len(bodies)
        of_b, by_bytes = [], {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece holds a blank behind another character")
            of_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                # A piece goes before a byte, the smaller number before the larger.
                by_bytes.setdefault(of_b[-1], []).append((self.b.is_byte(i), i))
        self.b_bytes, self.n_b = _Bodies(of_b), len(of_b)
        same = [min(by_bytes[body])[1] if body in by_bytes else -1 for body in bodies]
        self.same = np.array([-1 if i in special.values() else b for i, b in enumerate(same)], np.int64)
        self.known = s.Known(_SEGMENTS)
        self.forget()

    def forget(self) -> None:
        self.counts = s.Ragged(np.int64)  # A tokens, B tokens, groups, links, or -1 four times
        self.links, self.times = s.Ragged(np.int64), s.Ragged(np.int32)
        self.texts: list[str] = []

    # Segments.

    def segments(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """All segments of some texts that begin with a blank, and each text's first one."""
        before = np.concatenate([np.zeros(3, np.uint8), data])
        one, two, three = before[2:-1], before[1:-2], before[:-3]
        # Characters that may be white space of some tokenizer do not end a segment.
        safe = np.where(one < 0x80, (one > 0x20) & (one != 0x7F), (two != 0xC2) & (three != 0xE1) & (three != 0xE2) & ~((three == 0xE3) & (two == 0x80)))
        cut = (data == 0x20) & safe
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(cut)
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
        return values, np.searchsorted(starts, bounds)

    def _add(self, found: list[bytes]) -> None:
        """Aligns segments, many in one text; those that could affect others each alone."""
        size = (np.cumsum([len(f) for f in found]) // _JOINED).tolist()
        for _, group in itertools.groupby(zip(found, size, strict=True), key=lambda pair: pair[1]):
            for alone, run in itertools.groupby((f for f, _ in group), key=lambda f: _MARK in f or not _ends_safe(f)):
                run = list(run)
                if alone or not self._align(run):
                    for segment in run:
                        if not self._align([segment]):
                            self._keep([""], np.full((1, 4), -1), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(1, np.int64))

    def _align(self, group: list[bytes]) -> bool:
        """Keeps group text, counts and links of every segment; not if tokens do not give the bytes."""
        body = b"".join(group)
        text = body.decode()
        a = np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        # A blank at the end of a text has none in front; the model puts one before other texts.
        b = np.array([self.b.piece_to_id("▁")] if text == " " else self.b.encode(text[1:]), np.int64)
        whole = np.frombuffer(body, np.uint8)
        if not np.array_equal(self.a_bytes.join(a), whole) or not np.array_equal(self.b_bytes.join(b), whole):
            return False
        a_end, b_end = np.cumsum(self.a_bytes.size[a]), np.cumsum(self.b_bytes.size[b])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        ends = np.cumsum([len(g) for g in group])
        last = np.searchsorted(common, ends)
        if not np.array_equal(common[np.minimum(last, len(common) - 1)], ends):
            return False
        a_first = np.concatenate([[0], np.searchsorted(a_end, common, "right")])
        b_first = np.concatenate([[0], np.searchsorted(b_end, common, "right")])
        first = np.concatenate([[0], last + 1])
        n_a, n_b = np.diff(a_first), np.diff(b_first)
        links, times, rows = self._links(a, b, a_first, b_first)
        own = (a_first[first[1:]] - a_first[first[:-1]], b_first[first[1:]] - b_first[first[:-1]], np.diff(first))
        counts = np.stack([*own, np.add.reduceat(n_a * n_b, first[:-1])], 1)
        a, b = a.tolist(), b.tolist()
        spans = zip(a_first.tolist(), n_a.tolist(), b_first.tolist(), n_b.tolist(), strict=False)
        texts = [f"{a[p]}|{b[q]}" if m == n == 1 else f"{','.join(map(str, a[p : p + m]))}|{','.join(map(str, b[q : q + n]))}" for p, m, q, n in spans]
        edges = first.tolist()
        self._keep([";".join(texts[lo:hi]) for lo, hi in zip(edges, edges[1:], strict=False)], counts, links, times, np.add.reduceat(rows, first[:-1]))
        return True

    def _links(self, a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of all groups with their times, and how many rows each group has."""
        n_a, n_b = np.diff(a_first), np.diff(b_first)
        rows = n_a * n_b
        if rows.max() <= _WIDE:
            of = np.repeat(np.arange(len(rows)), rows)
            turn = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
            links = a[a_first[of] + turn // n_b[of]] * self.n_b + b[b_first[of] + turn % n_b[of]]
            return links, np.ones(len(links), np.int32), rows
        links, times = [], []
        for p, m, q, n in zip(a_first.tolist(), n_a.tolist(), b_first.tolist(), n_b.tolist(), strict=False):
            (i, often_i), (j, often_j) = (np.unique(v, return_counts=True) for v in (a[p : p + m], b[q : q + n]))
            links.append((i[:, None] * self.n_b + j).ravel())
            times.append((often_i[:, None] * often_j).ravel())
        return np.concatenate(links), np.concatenate(times).astype(np.int32), np.array([len(x) for x in links])

    def _keep(self, texts: list[str], counts: np.ndarray, links: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> None:
        self.texts += texts
        self.counts.extend(counts.ravel(), np.full(len(counts), 4))
        self.links.extend(links, sizes)
        self.times.extend(times, sizes)

    # Documents.

    def align(self, texts: pa.Array):
        """Group texts, counts (a row each), and the distinct links with their times of every text."""
        given, bounds = c.flat(texts)
        # A blank in front of every text that is not empty.
        filled = np.diff(bounds) > 0
        shift = np.concatenate([[0], np.cumsum(filled)])
        data = np.full(len(given) + shift[-1], 0x20, np.uint8)
        data[np.arange(len(given)) + np.repeat(shift[1:], np.diff(bounds))] = given
        values, first = self.segments(data, bounds + shift)
        coded = values.dictionary_encode()
        rows = self.known.look_up(coded.dictionary, self.forget, self._add)[coded.indices.to_numpy()]
        doc = np.repeat(np.arange(len(filled)), np.diff(first))
        counts = self.counts.take(rows)[0].reshape(-1, 4)
        ok = filled & (np.bincount(doc, counts[:, 0] < 0, len(filled)) == 0)
        rows, doc, counts = rows[ok[doc]], doc[ok[doc]], counts[ok[doc]]
        totals = np.zeros((len(filled), 4), np.int64)
        np.add.at(totals, doc, counts)
        edges, codes, known = np.searchsorted(doc, np.arange(len(filled) + 1)).tolist(), rows.tolist(), self.texts
        groups = [";".join([known[k] for k in codes[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
        links, at = self.links.take(rows)
        times = self.times.take(rows)[0].astype(np.int64)
        owner = np.repeat(doc, np.diff(at))
        kind = owner * (self.n_a * self.n_b) + links
        order = np.argsort(kind)
        kind = kind[order]
        new = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(kind) else np.zeros(0, np.int64)
        times = np.add.reduceat(times[order], new) if len(new) else times
        return groups, totals, owner[order][new], links[order][new], times


def _ends_safe(segment: bytes) -> bool:
    one, two, three = segment[-1], segment[-2:-1], segment[-3:-2]
    if one < 0x80:
        return one > 0x20 and one != 0x7F
    return two != b"\xc2" and three not in (b"\xe1", b"\xe2") and not (three == b"\xe3" and two == b"\x80")


@functools.lru_cache(maxsize=2)
def _loaded(model_a: str, model_b: bytes) -> Pair:
    return Pair(model_a, model_b)


# Blocks: a few MB of text each, with the links of its documents.

_DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
_BLOCK = f"block long, docs array<struct<{_DOCS.replace(' long', ':bigint').replace(' string', ':string')}>>, body binary"


def _squeeze(*arrays: np.ndarray) -> bytes:
    raw = x.pack(*arrays)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _restore(body: bytes, *dtypes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)
    return x.unpack(raw, *dtypes)


def _align(model_a: str, model_b: bytes, digest: bool):
    def run(batches):
        pair, number = _loaded(model_a, model_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in s.parts(batch, _PART):
                groups, totals, owner, links, times = pair.align(part.column("text"))
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                edges = np.searchsorted(owner, np.arange(len(groups) + 1))
                body = _squeeze(edges, np.diff(links, prepend=0), times.astype(np.int32))
                columns = [part.column("doc_id"), *(pa.array(totals[:, i]) for i in range(4)), pa.array(groups, pa.string())]
                docs = pa.StructArray.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
                docs = pa.ListArray.from_arrays(pa.array([0, len(groups)], pa.int32()), docs)
                yield pa.RecordBatch.from_arrays([pa.array([number]), docs, pa.array([body], pa.binary())], ["block", "docs", "body"])
                number += 1

    return run


def _links(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edges, steps, times = _restore(body, np.int64, np.int64, np.int32)
    return edges, np.cumsum(steps), times


def _identities(same: np.ndarray, n_b: int):
    """For each A number, how many documents of a task hold it linked to its equal."""

    def run(batches):
        total = np.zeros(len(same), np.int64)
        for batch in batches:
            for body in batch.column("body").to_pylist():
                links = _links(body)[1]
                a = links // n_b
                total += np.bincount(a[same[a] == links % n_b], minlength=len(same))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["a", "n"])

    return run


def _send(same: np.ndarray, n_b: int, n_buckets: int):
    """Each other pair of a block with its number of documents to the pair's bucket."""

    def run(batches):
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                links = _links(body)[1]
                pairs, n = np.unique(links[same[links // n_b] != links % n_b], return_counts=True)
                bucket = c.spread(c.mix(pairs.astype(np.uint64)), n_buckets)
                order, cuts = c.by_bucket(bucket)
                pairs, n = pairs[order], n[order]
                rows = [(k, block, _squeeze(np.diff(pairs[lo:hi], prepend=0), n[lo:hi].astype(np.int32))) for k, lo, hi in cuts]
                columns = zip(*rows, strict=True) if rows else ([], [], [])
                kinds = (pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], ["bucket", "block", "body"])

    return run


def _totals(n_b: int):
    """Totals of a bucket's pairs, back to the blocks that hold them; the best of each A number to block -1."""

    def run(table: pa.Table) -> pa.Table:
        blocks, sent = table.column("block").to_pylist(), [_restore(b, np.int64, np.int32) for b in table.column("body").to_pylist()]
        pairs = [np.cumsum(steps) for steps, _ in sent]
        known, index = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.bincount(index, np.concatenate([n for _, n in sent]), len(known)).astype(np.int64)
        at, bodies = 0, []
        for own in pairs:
            bodies.append(_squeeze(np.diff(own, prepend=0), total[index[at : at + len(own)]]))
            at += len(own)
        first = np.flatnonzero(np.diff(known // n_b, prepend=-1))
        best = np.maximum.reduceat(total, first)
        bodies.append(_squeeze(known[first] // n_b, best))
        return pa.table({"block": pa.array([*blocks, -1], pa.int64()), "body": pa.array(bodies, pa.binary())})

    return run


def _bests(batches):
    for batch in batches:
        for body in batch.column("body").to_pylist():
            a, n = _restore(body, np.int64, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(n)], ["a", "n"])


_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def _finish(same: np.ndarray, n_b: int, identity: np.ndarray, best: np.ndarray):
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        answers = [_restore(b, np.int64, np.int64) for b in back.column("body").to_pylist()]
        pairs = np.concatenate([*(np.cumsum(steps) for steps, _ in answers), np.zeros(0, np.int64)])
        total = np.concatenate([*(n for _, n in answers), np.zeros(0, np.int64)])
        order = np.argsort(pairs)
        pairs, total = pairs[order], total[order]
        out = []
        for docs, body in zip(table.column("docs").combine_chunks(), table.column("body").to_pylist(), strict=True):
            edges, links, times = _links(body)
            a = links // n_b
            count = identity[a]
            other = np.flatnonzero(same[a] != links % n_b)
            count[other] = total[np.searchsorted(pairs, links[other])]
            owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            sums = np.zeros((2, len(edges) - 1), np.int64)
            np.add.at(sums[0], owner, times * (count == best[a]))
            np.add.at(sums[1], owner, times * count)
            fields = dict(zip(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"], docs.values.flatten(), strict=True))
            fields |= {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            out.append(pa.table([fields[name] for name in _RESULT], _RESULT))
        return pa.concat_tables(out)

    return run


def _vector(rows: DataFrame, n: int) -> np.ndarray:
    """At most a row for each A number, as a vector."""
    out = np.zeros(n, np.int64)
    for r in rows.collect():
        out[r.a] = r.n
    return out


def align(docs: DataFrame, model_a: str, model_b: str, digest: bool = False) -> DataFrame:
    """Aligned tokens of each document of ``doc_id`` and ``text`` by two tokenizers, with the counts of their links.

    ``model_a`` is the path of a byte-level tokenizer's file, ``model_b`` that of a
    merge-trained piece model with byte pieces that puts a blank in front; both
    are read on the driver. The result has ``doc_id``, ``n_a`` and ``n_b`` (tokens),
    ``n_groups``, ``n_links`` (pairs of an A and a B token of one group),
    ``n_best`` (links whose pair has the highest count of its A number, ties
    included), ``count_sum`` (sum of the links' counts) and ``groups``:
    ``a1,a2|b1;a3|b2,b3``, the numbers of both sides in order. The count of a pair is
    the number of documents that hold it linked. With ``digest`` ``groups`` is its
    SHA-256 in hex.

    A text that is null or empty, or that the tokens of one side do not give back
    byte for byte behind a blank (as with U+2581 in it), has no tokens: zeros and an
    empty ``groups``. Each row is a document of its own, also where ids are null or
    repeat; other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    c.ship(spark)
    texts = Path(model_a).read_text(encoding="utf-8"), Path(model_b).read_bytes()
    pair = Pair(*texts)
    same, n_a, n_b = pair.same, pair.n_a, pair.n_b
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_buckets = max(8, c.text_bytes(given) // _BUCKET)
    blocks = c.cut(given.mapInArrow(_align(*texts, digest), _BLOCK))
    light = blocks.select("block", "body")
    equal = light.select("body").mapInArrow(_identities(same, n_b), "a long, n long")
    identity = _vector(equal.groupBy("a").agg(F.sum("n").alias("n")), n_a)
    sent = light.mapInArrow(_send(same, n_b, n_buckets), "bucket int, block long, body binary")
    totals = c.cut(sent.groupBy("bucket").applyInArrow(_totals(n_b), "block long, body binary"))
    bests = totals.filter("block = -1").mapInArrow(_bests, "a long, n long")
    best = np.maximum(identity, _vector(bests.groupBy("a").agg(F.max("n").alias("n")), n_a))
    kinds = ", ".join(f"{name} {'string' if name == 'groups' else 'long'}" for name in _RESULT)
    back = totals.filter("block >= 0").groupBy("block")
    return blocks.groupBy("block").cogroup(back).applyInArrow(_finish(same, n_b, identity, best), kinds)
