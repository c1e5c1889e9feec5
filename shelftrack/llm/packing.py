"""Documents packed into sequences of a fixed number of tokens, by sums of squares.

Texts become numbers and pieces of at most a sequence's length. Pieces are dealt
evenly to shards. A shard places its pieces from the longest to the shortest:
each goes where the sum over all residual gaps of the squared number of open
sequences with that gap becomes smallest, of equal places into the fuller
sequence; a new sequence is opened if no open one has room. Only the number of
open sequences of each gap is looked at, so a step costs the same however many
there are. Pieces that fill a sequence need no place.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm import segments as s

SHARD = 20_000  # pieces that one task places
_PART = 4 << 20
_JOINED = 1 << 16
_BETWEEN = "\x01"  # a pre-token of its own, of one token that no other text has
_WORDS = 800_000  # known words of a worker


class WordTokens:
    """Numbers of texts by a tokenizer that drops white space and never joins words."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        (self.between,) = self._plain([_BETWEEN])[0]
        self.known = s.Known(_WORDS)
        self.forget()

    def forget(self) -> None:
        self.store = s.Ragged(np.uint32)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[str]) -> None:
        """Encodes words in long texts, with a mark between them."""
        size = np.cumsum([len(w) for w in words]) // _JOINED
        for _, group in itertools.groupby(zip(words, size.tolist(), strict=True), key=lambda pair: pair[1]):
            group = [word for word, _ in group]
            if not any(_BETWEEN in word for word in group):
                numbers = np.array(self._plain([f" {_BETWEEN} ".join([*group, ""])])[0], np.uint32)
                marks = np.flatnonzero(numbers == self.between)
                if len(marks) == len(group):
                    self.store.extend(np.delete(numbers, marks), np.diff(marks, prepend=-1) - 1)
                    continue
            found = self._plain(group)
            flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32)
            self.store.extend(flat, np.array([len(f) for f in found], np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts, one behind the other, and the bounds of each."""
        words = pc.ascii_split_whitespace(_plainer(texts))
        distinct = words.flatten().dictionary_encode()
        rows = self.known.look_up(distinct.dictionary, self.forget, self._add)[distinct.indices.to_numpy()]
        numbers, bounds = self.store.take(rows)
        edges = words.offsets.to_numpy()
        return numbers, bounds[edges - edges[0]]


def _plainer(texts: pa.Array) -> pa.Array:
    """Texts of the same numbers with fewer distinct words: a blank before a mark that ends a word, ASCII in lower case.

    The tokenizer drops white space, lowers letters and cuts between a letter and a mark itself. Case
    stays if there is a combining mark, with which a lower letter may become another character.
    """
    data, bounds = c.flat(texts)
    one, two, behind = (np.concatenate([np.zeros(2, np.uint8), data, [0x20]])[k : k + len(data)] for k in (1, 0, 3))
    letter = ((one | 0x20) >= 0x61) & ((one | 0x20) <= 0x7A) | (two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7)
    marks = np.flatnonzero(_MARKS[data] & letter & c.SPACES[behind])
    inside = marks[~np.isin(marks, bounds)]
    shift = np.searchsorted(inside, bounds)
    data = np.insert(data, inside, 0x20)
    offsets = pa.py_buffer((bounds + shift).astype(np.int64))
    plain = pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(np.ascontiguousarray(data)))
    return plain if np.isin(data, (0xCC, 0xCD)).any() else pc.ascii_lower(plain)


_MARKS = np.isin(np.arange(256), list(b".,;:!?"))


@functools.lru_cache(maxsize=2)
def _loaded(model: str) -> WordTokens:
    return WordTokens(model)


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("tokens", pa.list_(pa.int32())),
    ]
)


def _cut_up(model: str, limit: int, end: int, keep: bool):
    def run(batches):
        words = _loaded(model)
        for batch in batches:
            for part in s.parts(batch, _PART):
                numbers, bounds = words.encode(part.column("text"))
                rows = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                size = np.diff(bounds) + 1
                first = np.concatenate([[0], np.cumsum(size)])
                whole = np.full(first[-1], end, "<u4")
                whole[np.arange(len(numbers)) + rows] = numbers
                n = -(-size // limit)
                doc = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * limit
                length = np.minimum(size[doc] - start, limit)
                lo = first[doc] + start
                crc = [zlib.crc32(whole[a:b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
                tokens = pa.nulls(len(doc), pa.list_(pa.int32()))
                if keep:
                    tokens = pa.ListArray.from_arrays(pa.array(np.append(lo, first[-1]).astype(np.int32)), pa.array(whole.view("<i4")))
                doc_ids = part.column("doc_id").take(pa.array(doc))
                arrays = [doc_ids, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), tokens]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PIECES)

    return run


def place(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, placed in the order given; each at most ``limit``."""
    open_, stacks = np.zeros(limit + 1, np.int64), {}
    sequence, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    nowhere = 1 << 60
    for i, length in enumerate(lengths.tolist()):
        # A gap of g becomes one of g - length: the sum of squares changes by 1 - 2 n(g) + 1 + 2 n(g - length).
        have = open_[length:]
        change = np.where(have > 0, 2 - 2 * have + 2 * open_[: limit + 1 - length], nowhere)
        change[0] -= have[0] > 0  # a full sequence is no open one
        left = int(np.argmin(change))
        gap = left + length
        if change[left] < nowhere:
            open_[gap] -= 1
            at = stacks[gap].pop()
        else:
            gap, at, used = limit, used, used + 1
            left = limit - length
        sequence[i], offset[i] = at, limit - gap
        if left:
            open_[left] += 1
            stacks.setdefault(left, []).append(at)
    return sequence, offset


def _place(limit: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        sequence, offset = place(table.column("length").to_numpy(), limit)
        shard = table.column("shard")[0].as_py()
        number = pa.array(sequence + (shard << 32))
        return table.drop_columns(["shard"]).append_column("sequence_id", number).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, tokenizer: str, limit: int = 4096, end: int = 1, keep: bool = False) -> DataFrame:
    """Pieces of the documents of ``doc_id`` and ``text``, packed into sequences of at most ``limit`` tokens.

    ``tokenizer`` is the path of a tokenizer's file, read on the driver, that
    drops white space and never joins words; a document is the numbers of its
    text, then ``end``. Only a longer document is cut, into pieces of ``limit`` tokens and a
    rest. The result has ``doc_id``, ``piece`` (from 0), ``start`` (tokens of the
    document before it), ``length``, ``ids_crc32`` (of the numbers as little-endian
    32-bit ones), ``sequence_id`` and ``offset``; with ``keep`` also ``tokens``.
    Pieces of a sequence follow one another from offset 0 without gaps.
    Sequences are never shared between shards of about ``SHARD`` pieces, which costs
    about one sequence a shard.

    A null text is empty: a document of ``end`` alone. Each row is a document of
    its own, also where ids are null or repeat; other columns are ignored. No rows
    give no pieces.
    """
    if limit < 1:
        raise ValueError("limit must be 1 at least")
    c.ship(docs.sparkSession)
    model = Path(tokenizer).read_text(encoding="utf-8")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, tokens array<int>"
    pieces = given.mapInArrow(_cut_up(model, limit, end, keep), kinds)
    # Rows lie fixed from here on, so their numbers do too.
    pieces = c.cut(pieces if keep else pieces.drop("tokens")).withColumn("row", F.monotonically_increasing_id())
    light = pieces.drop("tokens")
    whole = light.filter(F.col("length") == limit)
    short = light.filter(F.col("length") < limit)
    n_shards = max(1, -(-short.count() // SHARD))
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)))
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, row long, sequence_id long, offset long"
    placed = dealt.groupBy("shard").applyInArrow(_place(limit), columns)
    alone = whole.withColumn("sequence_id", -F.col("row") - 1).withColumn("offset", F.lit(0).cast("long"))
    placed = placed.unionByName(alone)
    if keep:
        placed = placed.join(pieces.select("row", "tokens"), "row")
    return placed.drop("row")
