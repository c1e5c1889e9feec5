"""Language of every word, by a linear-chain conditional random field.

Words are runs of letters. A word's score for a language sums weights of its
prefixes and suffixes, its letter n-grams and the word itself (the lexicon), all
hashed into one table; a matrix of weights scores the language of the next word.
Training maximizes the likelihood of word sequences spliced from runs of labelled
documents, so that switches are seen. Labelling runs forward and backward over
whole texts: sequences are cut into segments whose transfer matrices are
multiplied up, which is exact and keeps the arrays regular. A document's
language is the one with the largest mean posterior over its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelftrack.llm import common as c

TRAIN_ROWS = 250  # labelled documents per language that training sees at most
_RUNS, _RUN_WORDS, _SPLICED = 8, 25, 4
_TABLE = 1 << 17
_EPOCHS, _RATE, _DECAY = 30, 0.5, 1e-6
_SEGMENT = 128
_PIECE = 1 << 22
UNDETERMINED = "und"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _letter_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of letters and each text's first run."""
    return c.word_spans(np.where(_LETTER[data], data, 32).astype(np.uint8), bounds)


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and table slot of every feature of the given words, sorted by owner."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    sizes, words = ends - starts, np.arange(len(starts))
    owners, slots = [], []

    def add(owner, value, kind):
        owners.append(owner)
        hashed = c.mix(value * np.uint64(16) + np.uint64(kind))
        slots.append((hashed % np.uint64(_TABLE)).astype(np.int32))

    for n in (1, 2, 3, 4):
        long = sizes >= n
        add(words[long], eights[starts[long]] & _MASKS[n], n)
        add(words[long], eights[ends[long] - n] & _MASKS[n], 4 + n)
    for n in (2, 3):
        counts = np.maximum(sizes - n + 1, 0)
        owner = np.repeat(words, counts)
        at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        add(owner, eights[at] & _MASKS[n], 8 + n)
    add(words, c.span_hashes(data, starts, ends), 12)
    return np.concatenate(owners), np.concatenate(slots)


def _scores(weights: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Score of each word for each label; equal words are scored once."""
    hashes = c.span_hashes(data, starts, ends)
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    owner, slot = _features(data, starts[first], ends[first])
    out = np.empty((len(first), weights.shape[1]))
    for label in range(weights.shape[1]):
        out[:, label] = np.bincount(owner, weights[slot, label], len(first))
    return out[back]


def _step(alpha: np.ndarray, move: np.ndarray) -> np.ndarray:
    alpha = alpha @ move
    return alpha


def _scaled(x: np.ndarray) -> np.ndarray:
    axes = tuple(range(1, x.ndim))
    return x / x.max(axis=axes, keepdims=True)


def posteriors(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, segment: int = _SEGMENT) -> np.ndarray:
    """Posterior of each label for each word; ``first`` bounds the sequences."""
    n_labels = scores.shape[1]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    move = np.exp(transitions - transitions.max())
    sizes = np.diff(first)
    n_segments = -(-sizes // segment)
    doc = np.repeat(np.arange(len(sizes)), n_segments)
    ordinal = np.arange(len(doc)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
    begin = first[doc] + ordinal * segment
    length = np.minimum(first[doc + 1] - begin, segment)
    order = np.argsort(-length, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    begin, length, opening = begin[order], length[order], (ordinal == 0)[order]
    alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(segment)]  # longer than t

    # Transfer matrix of each segment: rows go in, columns come out.
    transfer = np.broadcast_to(np.eye(n_labels), (len(begin), n_labels, n_labels)).copy()
    for t in range(segment):
        if not (n := alive[t]):
            break
        moved = (transfer[:n].reshape(-1, n_labels) @ move).reshape(n, n_labels, n_labels)
        if t == 0:
            moved[opening[:n]] = transfer[:n][opening[:n]]
        transfer[:n] = _scaled(moved * emit[begin[:n] + t][:, None, :])

    # What enters each segment from the left and from the right.
    enter, leave = np.ones((len(begin), n_labels)), np.ones((len(begin), n_labels))
    offset = np.cumsum(n_segments) - n_segments
    for k in range(1, int(n_segments.max(initial=0))):
        docs = np.flatnonzero(n_segments > k)
        now, before = back[offset[docs] + k], back[offset[docs] + k - 1]
        enter[now] = _scaled(np.einsum("ij,ijk->ik", enter[before], transfer[before]))
        last = back[offset[docs] + n_segments[docs] - k]
        leave[back[offset[docs] + n_segments[docs] - k - 1]] = _scaled(np.einsum("ijk,ik->ij", transfer[last], leave[last]))

    result = np.empty_like(emit)
    alpha = enter
    for t in range(segment):
        if not (n := alive[t]):
            break
        moved = alpha[:n] @ move
        if t == 0:
            moved[opening[:n]] = 1.0
        alpha[:n] = _scaled(moved * emit[begin[:n] + t])
        result[begin[:n] + t] = alpha[:n]
    beta = leave
    for t in range(segment - 1, -1, -1):
        if n := alive[t]:
            at = begin[:n] + t
            result[at] *= beta[:n]
            beta[:n] = _scaled((beta[:n] * emit[at]) @ move.T)
    return result / result.sum(axis=1, keepdims=True)


# Training.


def _runs_of(text: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word runs from all over one text."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    starts, ends, _ = _letter_runs(data, np.array([0, len(data)]))
    places = np.unique(np.linspace(0, max(0, len(starts) - _RUN_WORDS), _RUNS).astype(int))
    return [(data, starts[p : p + _RUN_WORDS], ends[p : p + _RUN_WORDS]) for p in places if len(starts)]


def train(texts: list[str], labels: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels, feature weights and transition weights."""
    names = sorted(set(labels))
    rng = np.random.default_rng(11)
    pieces, tags = [], []
    for text, label in zip(texts, labels, strict=True):
        for data, starts, ends in _runs_of(text):
            pieces.append(b" ".join(data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)))
            tags.append(names.index(label))
    weights, transitions = np.zeros((_TABLE, len(names)), np.float32), np.zeros((len(names), len(names)))
    if not pieces:
        return names, weights, transitions
    # Rarer languages are drawn as often as frequent ones.
    tags = np.array(tags)
    share = 1 / np.bincount(tags, minlength=len(names))[tags]
    drawn = rng.choice(len(pieces), size=min(len(pieces), 8000) // _SPLICED * _SPLICED or _SPLICED, p=share / share.sum())
    body = [pieces[i] for i in drawn]
    data = np.frombuffer(b" ".join(body), np.uint8)
    starts, ends, _ = c.word_spans(data, np.array([0, len(data)]))
    sizes = np.array([piece.count(b" ") + 1 for piece in body])
    truth = np.repeat(tags[drawn], sizes)
    first = np.concatenate([[0], np.cumsum(sizes.reshape(-1, _SPLICED).sum(axis=1))])
    _, kept, back = np.unique(c.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    owner, slot = _features(data, starts[kept], ends[kept])
    n, n_labels = len(kept), len(names)
    inner = np.ones(len(truth), bool)
    inner[first[:-1]] = False
    pairs = np.flatnonzero(inner)
    gold = np.zeros((len(truth), n_labels))
    gold[np.arange(len(truth)), truth] = 1
    switched = np.zeros((n_labels, n_labels))
    np.add.at(switched, (truth[pairs - 1], truth[pairs]), 1)
    seen, seen_moves = np.full(weights.shape, 1e-8), np.full(transitions.shape, 1e-8)
    longest = int(np.diff(first).max())
    for _ in range(_EPOCHS):
        scores = np.stack([np.bincount(owner, weights[slot, k], n) for k in range(n_labels)], axis=1)[back]
        post = posteriors(scores, first, transitions, segment=longest)
        error = gold - post
        by_word = np.stack([np.bincount(back, error[:, k], n) for k in range(n_labels)], axis=1)
        slope = np.stack([np.bincount(slot, by_word[owner, k], _TABLE) for k in range(n_labels)], axis=1) - _DECAY * weights
        seen += slope**2
        weights += (_RATE * slope / np.sqrt(seen)).astype(np.float32)
        # Pair posteriors from the two word posteriors and the move, normalized.
        joint = post[pairs - 1][:, :, None] * np.exp(transitions) * post[pairs][:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        slope = switched - joint.sum(axis=0)
        seen_moves += slope**2
        transitions += 0.2 * slope / np.sqrt(seen_moves)
    return names, weights, transitions


def _sampled(docs: DataFrame, rows: int) -> tuple[list[str], list[str]]:
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = docs.select("doc_id", "lang").withColumn("i", F.row_number().over(order)).filter(F.col("i") <= rows)
    wanted = [r.doc_id for r in picked.select("doc_id").collect()]
    found = docs.filter(F.col("doc_id").isin(wanted)).select("text", "lang").collect() if wanted else []
    found.sort(key=lambda r: (r.lang, r.text))
    return [r.text for r in found], [r.lang for r in found]


# Labelling.


def _pieces(batch: pa.RecordBatch):
    """Parts of a batch of a few MB of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // _PIECE
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _label(names: list[str], weights: np.ndarray, transitions: np.ndarray, spans: bool, keep: bool):
    def run(batches):
        for batch in batches:
            for part in _pieces(batch):
                yield label(part)

    def label(part):
        data, bounds = c.flat(pc.utf8_lower(part.column("text").fill_null("")))
        starts, ends, first = _letter_runs(data, bounds)
        lettered = part.column("lettered").to_numpy(zero_copy_only=False)
        sizes = np.diff(first)
        known = (sizes > 0) & lettered.astype(bool) & bool(names)
        mean, best = np.zeros((len(sizes), max(1, len(names)))), np.zeros(0, np.int64)
        if known.any():
            post = posteriors(_scores(weights, data, starts, ends), first, transitions)
            total = np.concatenate([np.zeros((1, post.shape[1])), np.cumsum(post, axis=0)])
            mean[known] = (total[first[1:]] - total[first[:-1]])[known] / sizes[known][:, None]
            best = post.argmax(axis=1)
        top = mean.argmax(axis=1)
        tags = [names[t] if k else UNDETERMINED for t, k in zip(top, known, strict=True)]
        columns = [part.column("doc_id"), part.column("held_out"), pa.array(tags, pa.string()), pa.array(np.clip(mean.max(axis=1), 0, 1))]
        labels = ["doc_id", "held_out", "lang_pred", "score"]
        if spans:
            runs = []
            for i, k in enumerate(known):
                own = best[first[i] : first[i + 1]] if k else best[:0]
                cuts = np.flatnonzero(np.diff(own)) + 1
                edges = [0, *cuts.tolist(), len(own)] if len(own) else []
                runs.append([{"start": a, "stop": b, "lang": names[own[a]]} for a, b in zip(edges, edges[1:], strict=False)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))
            columns.append(pa.array(runs, kind))
            labels.append("spans")
        if keep:
            columns.append(part.column("row"))
            labels.append("row")
        return pa.RecordBatch.from_arrays(columns, labels)

    return run


def identify(docs: DataFrame, learn_from: DataFrame | None = None, rows: int = TRAIN_ROWS, spans: bool = False, keep: bool = False) -> DataFrame:
    """The language of each document of ``doc_id``, ``text`` with the labels in ``lang``.

    Weights are learnt from at most ``rows`` documents per language of
    ``learn_from`` (default: the same documents) whose ``lang`` is not null and
    whose ``crc32`` of the id as text leaves a remainder modulo 5; those without
    are ``held_out``. ``lang`` and the id are no inputs of a prediction. The
    result has ``doc_id``, ``held_out``, ``lang_pred`` and ``score``, the mean
    posterior of that language over the words; with ``spans`` also the runs of
    words of one language, by word number; with ``keep`` also the input's ``row``.

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text if no label was given. Ties take the smaller name. A null id is not
    held out. Repeated rows are predicted alike; other columns are ignored.
    """
    spark = docs.sparkSession
    c.ship(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    learn = (learn_from or docs).select("doc_id", "text", "lang")
    learn = learn.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & lettered & ~held_out)
    names, weights, transitions = train(*_sampled(learn, rows))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out")]
    given = docs.select(*columns, lettered.alias("lettered"), *([F.struct(*docs.columns).alias("row")] if keep else []))
    result = "doc_id long, held_out boolean, lang_pred string, score double"
    if spans:
        result += ", spans array<struct<start:long,stop:long,lang:string>>"
    if keep:
        result += f", row {given.schema['row'].dataType.simpleString()}"
    return given.mapInArrow(_label(names, weights, transitions, spans, keep), result)
