"""SentencePiece encoding and decoding as shortest paths of a transducer.

Three machines are compiled from a model: the normaliser (a blank in front of a
text, blanks as the model's mark), the lexicon (a tree of pieces, composed with the
input level by level for all places at once) and a grammar over neighbouring pieces.
For a merge-trained vocabulary the grammar's weights are zero for two pieces that
the merges leave apart and infinite for two that they would join or cut
otherwise; characters outside the lexicon go through byte pieces. With these
weights the best path of each prefix is unique and ends in one piece, so the
tropical shortest path keeps a single predecessor per place. Whether two pieces may
stand together follows from the merge trees of both: going back in time along the
facing sides, no pair that once met may have had an earlier merge of its own.

Texts are cut where no piece reaches across, equal units are solved once and kept
by each worker.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm.language import _pieces

_MARK = "▁"
_KEPT_UNITS = 1 << 18


class Machine:
    """The compiled tables; plain arrays, so that tasks get them with the function."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces = pieces
        self.n = len(pieces)
        normal = {p: i for i, p in enumerate(pieces) if kinds[i] == "normal"}
        self.bytes = [next((i for i, p in enumerate(pieces) if kinds[i] == "byte" and p == f"<0x{b:02X}>"), None) for b in range(256)]
        if None in self.bytes or _MARK not in normal:
            raise ValueError("the model has no byte pieces or no piece for a blank")
        self.blank = normal[_MARK]
        order = sorted(normal.values(), key=lambda i: -scores[i])
        self.rank = np.full(self.n + 1, -1, np.int64)
        for place, i in enumerate(order):
            if len(pieces[i]) > 1:
                self.rank[i] = place
        self.score = {p: scores[i] for p, i in normal.items()}
        self.runs = {p: i for p, i in normal.items() if set(p) == {_MARK}}
        inner = {p: i for p, i in normal.items() if p not in self.runs or len(p) == 1}
        if any(_MARK in p[1:] for p in inner):
            raise ValueError("a piece holds a blank behind its start")
        self._trees(inner)
        self._lexicon({p: i for p, i in inner.items() if self.reachable[i]})

    def _trees(self, inner: dict[str, int]) -> None:
        """The last merge of each piece, and all pairs that merge."""
        self.left, self.right = np.full(self.n + 1, -1, np.int64), np.full(self.n + 1, -1, np.int64)
        self.reachable = np.zeros(self.n + 1, bool)
        pairs = {}
        for piece, i in inner.items():
            self.reachable[i] = len(piece) == 1
            for cut in range(1, len(piece)):
                a, b = inner.get(piece[:cut]), inner.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * (self.n + 1) + b] = i
        for piece, i in inner.items():
            if len(piece) > 1 and all(ch in inner for ch in piece):
                parts = [inner[ch] for ch in piece]
                last = None
                while len(parts) > 1:
                    found = [(self.rank[p], k, p) for k in range(len(parts) - 1) if (p := pairs.get(parts[k] * (self.n + 1) + parts[k + 1])) is not None]
                    if not found:
                        break
                    _, k, p = min(found)
                    last = parts[k], parts[k + 1]
                    parts[k : k + 2] = [p]
                if parts == [i]:
                    self.left[i], self.right[i] = last
                    self.reachable[i] = True
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_pieces = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def _lexicon(self, lexicon: dict[str, int]) -> None:
        """Characters, the tree of pieces and the neighbours that some piece holds."""
        chars = sorted({ch for p in lexicon for ch in p})
        self.n_chars = len(chars) + 1
        index = {ch: k + 1 for k, ch in enumerate(chars)}
        self.char_codes = np.array([ord(ch) for ch in chars])
        moves, ends, neighbours = {}, [-1], set()
        for piece, i in lexicon.items():
            node, keys = 0, [index[ch] for ch in piece]
            neighbours.update(a * self.n_chars + b for a, b in zip(keys, keys[1:], strict=False))
            for k in keys:
                step = node * self.n_chars + k
                if step not in moves:
                    moves[step] = len(ends)
                    ends.append(-1)
                node = moves[step]
            ends[node] = i
        self.move_keys = np.array(sorted(moves), np.int64)
        self.move_nodes = np.array([moves[k] for k in self.move_keys.tolist()], np.int64)
        self.ends = np.array(ends, np.int64)
        self.neighbours = np.array(sorted(neighbours), np.int64)


def load(path: str) -> Machine:
    """Compile the model at ``path``, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalize(" éﬁ  b ") != f"{_MARK * 2}éﬁ{_MARK * 2}b{_MARK}":
        raise ValueError("only models that change blanks and nothing else are supported")
    n = model.vocab_size()
    kinds = [
        "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"
        for i in range(n)
    ]
    return Machine([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], kinds)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of sorted keys, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], -1)


class Encoder:
    """Solves units of text and keeps the paths of those it has met."""

    def __init__(self, machine: Machine):
        m = self.m = machine
        self.char = np.zeros(0x110000, np.int32)
        self.char[m.char_codes] = np.arange(1, m.n_chars)
        self.joins = np.zeros(m.n_chars * m.n_chars, bool)
        self.joins[m.neighbours] = True
        self.pair_known, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.run_known: dict[int, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    # The grammar.

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of pieces the merges leave apart; characters outside the lexicon (``n``) always are."""
        wide = self.m.n + 1
        keys, back = np.unique(a * wide + b, return_inverse=True)
        fresh = keys[~c.contains(self.pair_known, keys)]
        if len(fresh):
            found = self._apart(fresh // wide, fresh % wide)
            if len(self.pair_known) > 4 * _KEPT_UNITS:
                self.pair_known, self.pair_fits, fresh = np.zeros(0, np.int64), np.zeros(0, bool), keys
                found = self._apart(fresh // wide, fresh % wide)
            every = np.concatenate([self.pair_known, fresh])
            order = np.argsort(every, kind="stable")
            self.pair_known, self.pair_fits = every[order], np.concatenate([self.pair_fits, found])[order]
        return self.pair_fits[np.searchsorted(self.pair_known, keys)][back]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        m, wide = self.m, self.m.n + 1
        result = np.ones(len(a), bool)
        todo = np.flatnonzero((a < m.n) & (b < m.n))
        a, b = a[todo], b[todo]
        until, strict = np.full(len(todo), np.iinfo(np.int64).max), np.ones(len(todo), bool)
        while len(todo):
            merged = _lookup(m.pair_keys, m.pair_pieces, a * wide + b)
            rank = np.where(merged >= 0, m.rank[merged], np.iinfo(np.int64).max)
            # A tie goes to the merge further left: to the pair itself against one inside b.
            early = (merged >= 0) & ((rank < until) | (~strict & (rank == until)))
            result[todo[early]] = False
            rank_a, rank_b = m.rank[a], m.rank[b]
            go = ~early & (np.maximum(rank_a, rank_b) >= 0)
            from_a = rank_a > rank_b
            until, strict = np.where(from_a, rank_a, rank_b)[go], from_a[go]
            a, b = np.where(from_a, m.right[a], a)[go], np.where(from_a, b, m.left[b])[go]
            todo = todo[go]
        return result

    # Composition and shortest path.

    def _paths(self, chars: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all units and their bounds; ``n`` stands for a character outside the lexicon."""
        m = self.m
        sizes = np.diff(first)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        stop = first[unit + 1]
        begin, node, length = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        starts, ends, pieces = [], [], []
        outside = chars == 0
        starts.append(np.flatnonzero(outside))
        ends.append(starts[0] + 1)
        pieces.append(np.full(len(starts[0]), m.n))
        while len(begin):
            inside = begin + length < stop[begin]
            begin, node = begin[inside], node[inside]
            node = _lookup(m.move_keys, m.move_nodes, node * m.n_chars + chars[begin + length])
            begin, node = begin[node >= 0], node[node >= 0]
            length += 1
            done = m.ends[node] >= 0
            starts.append(begin[done])
            ends.append(begin[done] + length)
            pieces.append(m.ends[node[done]])
        starts, ends, pieces = np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces)
        depth = ends - first[unit[starts]]
        order = np.argsort(depth, kind="stable")
        starts, ends, pieces, depth = starts[order], ends[order], pieces[order], depth[order]
        opening = starts == first[unit[starts]]
        last, before = np.full(len(chars) + 1, -1, np.int64), np.zeros(len(chars) + 1, np.int64)
        cuts = np.searchsorted(depth, np.arange(1, int(sizes.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            previous = last[starts[lo:hi] - 1]
            fits = opening[lo:hi].copy()
            check = np.flatnonzero(~fits & (previous >= 0))
            fits[check] = self.fits(previous[check], pieces[lo:hi][check])
            at = ends[lo:hi][fits] - 1
            last[at], before[at] = pieces[lo:hi][fits], starts[lo:hi][fits]
        # Back from the end of every unit, all units at once.
        place, out_unit, out_step, out_piece, step = first[1:] - 1, [], [], [], 0
        alive = np.arange(len(sizes))
        while len(alive):
            out_unit.append(alive)
            out_step.append(np.full(len(alive), step))
            out_piece.append(last[place])
            place = before[place] - 1
            keep = place >= first[alive]
            alive, place, step = alive[keep], place[keep], step + 1
        out_unit, out_step, out_piece = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (out_unit, out_step, out_piece))
        order = np.lexsort((-out_step, out_unit))
        return out_piece[order], np.searchsorted(out_unit[order], np.arange(len(sizes) + 1))

    def _learn(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Solve units and keep their piece numbers."""
        sizes = ends - starts
        first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(first[-1]) - np.repeat(first[:-1] - starts, sizes)
        pieces, bounds = self._paths(self.char[codes[at]].astype(np.int64), first)
        outside = pieces == self.m.n
        if outside.any():
            # A unit with such a character is that character alone.
            body, counts, source = [], np.ones(len(pieces), np.int64), np.repeat(np.arange(len(sizes)), np.diff(bounds))
            for k in np.flatnonzero(outside):
                raw = chr(codes[starts[source[k]]]).encode("utf-8", "surrogatepass")
                counts[k] = len(raw)
                body.append([self.m.bytes[b] for b in raw])
            place = np.concatenate([[0], np.cumsum(counts)])
            spread = np.empty(place[-1], np.int64)
            spread[place[:-1][~outside]] = pieces[~outside]
            for k, numbers in zip(np.flatnonzero(outside), body, strict=True):
                spread[place[k] : place[k + 1]] = numbers
            pieces, bounds = spread, place[bounds]
        every = np.concatenate([self.known, hashes])
        order = np.argsort(every, kind="stable")
        self.known = every[order]
        self.start = np.concatenate([self.start, bounds[:-1] + len(self.pool)])[order]
        self.size = np.concatenate([self.size, np.diff(bounds)])[order]
        self.pool = np.concatenate([self.pool, pieces.astype(np.int32)])

    def _run(self, n: int) -> list[int]:
        """Pieces of ``n`` blanks in a row, by the merges themselves: best score first, then further left."""
        if n not in self.run_known:
            scores, size, after, live = self.m.score, [1] * n, list(range(1, n + 1)), [True] * n
            prior = list(range(-1, n - 1))
            heap = []

            def offer(k: int) -> None:
                j = after[k]
                if j < n and (merged := _MARK * (size[k] + size[j])) in scores:
                    heapq.heappush(heap, (-scores[merged], k, size[k], size[j]))

            for k in range(n - 1):
                offer(k)
            while heap:
                _, k, a, b = heapq.heappop(heap)
                j = after[k]
                if not live[k] or j >= n or (size[k], size[j]) != (a, b):
                    continue
                size[k], live[j], after[k] = a + b, False, after[j]
                if after[k] < n:
                    prior[after[k]] = k
                offer(k)
                if prior[k] >= 0:
                    offer(prior[k])
            self.run_known[n] = [self.m.runs[_MARK * size[k]] for k in range(n) if live[k]]
        return self.run_known[n]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts and the bounds of each."""
        texts = [f" {t}".replace(_MARK, " ") if t else "" for t in texts]
        codes = np.frombuffer("".join(texts).replace(" ", _MARK).encode("utf-32-le", "surrogatepass"), "<u4")
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        if not len(codes):
            return np.zeros(0, np.int32), bounds
        chars = self.char[codes].astype(np.int64)
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.joins[chars[:-1] * self.m.n_chars + chars[1:]]
        cut[bounds[:-1][bounds[:-1] < len(codes)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(codes))
        hashes = c.span_hashes(codes.view(np.uint8), starts * 4, ends * 4)
        kinds, kept, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > _KEPT_UNITS:
            self._forget()
        fresh = ~c.contains(self.known, kinds)
        if fresh.any():
            self._learn(codes, starts[kept[fresh]], ends[kept[fresh]], kinds[fresh])
        at = np.searchsorted(self.known, kinds)[back]
        size, start = self.size[at], self.start[at]
        first = np.concatenate([[0], np.cumsum(size)])
        numbers = self.pool[np.arange(first[-1]) - np.repeat(first[:-1] - start, size)]
        return self._join_blanks(numbers, first[np.searchsorted(starts, bounds)])

    def _join_blanks(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blanks that stayed alone merge with each other last."""
        blank = numbers == self.m.blank
        follows = np.zeros(len(numbers), bool)
        follows[1:] = blank[1:] & blank[:-1]
        follows[bounds[:-1][bounds[:-1] < len(numbers)]] = False
        if not follows.any():
            return numbers, bounds
        opening = np.flatnonzero(blank & ~follows)
        length = np.diff(np.append(np.concatenate([[0], np.cumsum(follows)])[opening], follows.sum())) + 1
        numbers, keep = numbers.copy(), ~follows
        for at, n in zip(opening[length > 1].tolist(), length[length > 1].tolist(), strict=True):
            run = self._run(n)
            numbers[at : at + len(run)] = run
            keep[at : at + len(run)] = True
        return numbers[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


class Decoder:
    def __init__(self, machine: Machine):
        bodies = [p.replace(_MARK, " ").encode() for p in machine.pieces]
        for value, i in enumerate(machine.bytes):
            bodies[i] = bytes([value])
        self.size = np.array([len(b) for b in bodies])
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(bodies), np.uint8)

    def decode(self, numbers: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of piece numbers; the blank in front goes."""
        size = self.size[numbers]
        first = np.concatenate([[0], np.cumsum(size)])
        body = self.pool[np.arange(first[-1]) - np.repeat(first[:-1] - self.start[numbers], size)].tobytes()
        edges = first[bounds].tolist()
        texts = [body[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:], strict=False)]
        return [t.removeprefix(" ") for t in texts]


def _encode(machine: Machine):
    def run(batches):
        encoder, decoder = Encoder(machine), Decoder(machine)
        for batch in batches:
            for part in _pieces(batch):
                texts = part.column("text").fill_null("").to_pylist()
                numbers, bounds = encoder.encode(texts)
                decoded = decoder.decode(numbers, bounds)
                same = [a == b.replace(_MARK, " ") for a, b in zip(decoded, texts, strict=True)]
                tokens = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(numbers))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), tokens, pa.array(np.diff(bounds).astype(np.int64)), pa.array(same)],
                    ["doc_id", "tokens", "n_tokens", "round_trip"],
                )

    return run


def _decode(machine: Machine):
    def run(batches):
        decoder = Decoder(machine)
        for batch in batches:
            tokens = batch.column("tokens")
            bounds = tokens.offsets.to_numpy()
            numbers = tokens.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
            texts = pa.array(decoder.decode(numbers, bounds - bounds[0]), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``tokens``, ``n_tokens`` and ``round_trip`` of each document of ``doc_id`` and ``text``.

    ``model`` is the path of a merge-trained model with byte pieces, read on the
    driver. ``tokens`` are the numbers the model gives; ``round_trip`` tells that
    they decode to the text, the model's mark for a blank taken as one. A null or
    empty text has no tokens. Repeated rows and null ids are rows like any
    other; other columns are ignored.
    """
    c.ship(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(_encode(load(model)), "doc_id long, tokens array<int>, n_tokens long, round_trip boolean")


def decode(tokens: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of ``tokens``; null tokens give an empty text, unknown numbers an error."""
    c.ship(tokens.sparkSession)
    given = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("tokens", F.array().cast("array<int>")).alias("tokens"))
    return given.mapInArrow(_decode(load(model)), "doc_id long, text string")
