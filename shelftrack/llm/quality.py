"""Quality of texts, learnt from preferences between pairs (Bradley-Terry).

A text's score is linear in its features: mean weights of its words' identities
and shapes, both hashed, and a few proportions of the whole text. Of a pair of
labelled texts the better one wins with the logistic of the difference of
scores; descent on that loss over feature differences fits the weights. All
labelled texts are dealt out over groups that tasks fit on their own, and the mean of their weights is
the model. The quantile of the scores of all labelled texts that matches the share of poor ones becomes
the threshold, and a logistic curve through it turns scores into numbers from 0 to 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm.language import _pieces

TRAIN_ROWS = 1500  # labelled documents per label that a group holds, more or less
CUT = 0.7
_TABLE = 1 << 15
_ROUNDS, _RATE, _DECAY = 60, 0.3, 1e-4
_N_WHOLE = 10
_PRIOR_WORDS = 3  # of weight zero, so that few words say little
_LEAST = 200  # texts of the rarer label that a group has, if there are so many
_BINS, _FEW = 4096, 10_000  # ranges that a quantile is looked for in, and rows it is then read from

# Shapes: small and further letters as a, capitals as A, digits as 9, the rest as it is.
_SHAPE = np.arange(256).astype(np.uint8)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 57
_LOWER = np.arange(256).astype(np.uint8)
_LOWER[65:91] += 32


def _slots(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table slots of each word's identity and of its shape, in which repeats count once."""
    word = c.span_hashes(_LOWER[data], starts, ends)
    shape = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    form = c.span_hashes(shape[keep], place[starts], place[ends])
    half = np.uint64(_TABLE // 2)
    return (word % half).astype(np.int64), (form % half).astype(np.int64) + _TABLE // 2


def _whole(data: np.ndarray, bounds: np.ndarray, first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Proportions of each text, the share of words that repeat the one before among them; an empty one has zeros."""
    n_words, n_bytes = np.diff(first), np.diff(bounds)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(n_bytes, 1)

    shape = _SHAPE[data]
    letters, capitals, digits, lines = (share(shape == s) for s in (97, 65, 57, 10))
    spaces = share(c.SPACES[data])
    marks = np.where(n_bytes > 0, 1 - letters - capitals - digits - spaces, 0)
    mean = n_bytes / np.maximum(n_words, 1)
    again = np.zeros(len(word))
    again[1:] = word[1:] == word[:-1]
    again[first[:-1][first[:-1] < len(word)]] = 0
    again = np.minimum(_mean(again, first), 0.5) * 4
    return np.stack(
        [letters, capitals, digits, lines * 10, spaces, marks, np.minimum(mean, 50) / 50, again, again > 0.5, n_words == 0], axis=1
    ).astype(float)


def _features(part: pa.RecordBatch):
    data, bounds = c.flat(part.column("text"))
    starts, ends, first = c.word_spans(data, bounds)
    word, form = _slots(data, starts, ends)
    return word, form, first, _whole(data, bounds, first, word)


def _mean(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[first[1:]] - total[first[:-1]]) / (np.diff(first) + _PRIOR_WORDS)


class Model:
    """Weights, and the line from scores to numbers from 0 to 1."""

    def __init__(self, table: np.ndarray, whole: np.ndarray, threshold: float = 0.0, scale: float = 1.0):
        self.table, self.whole, self.threshold, self.scale = table, whole, threshold, scale

    def raw(self, part: pa.RecordBatch) -> np.ndarray:
        word, form, first, whole = _features(part)
        return _mean(self.table[word] + self.table[form], first) + whole @ self.whole

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        x = (raw - self.threshold) / self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def train(texts: list[str], good: np.ndarray, share_good: float) -> Model:
    """Fit on labelled texts; ``share_good`` is the share of good ones where they come from."""
    model, scores = _fit(pa.array(texts, pa.string()), good)
    if scores is None:
        model.threshold = 1.0 if not good.any() else -1.0
        return model
    rows = sorted((float(s), int(not g), int(g)) for s, g in zip(scores, good))
    weights = (1 - share_good) / (~good).sum(), share_good / good.sum()
    model.threshold = sum(_between(rows, weights, 1 - share_good + _SLIGHT)) / 2
    model.scale = float(np.median(np.abs(scores - model.threshold))) or 1.0
    return model


def _fit(texts: pa.Array, good: np.ndarray) -> tuple[Model, np.ndarray | None]:
    """A model of weights and the texts' scores; of one kind of label nothing is learnt."""
    model = Model(np.zeros(_TABLE), np.zeros(_N_WHOLE))
    if not good.any() or good.all():
        return model, None
    word, form, first, whole = _features(pa.RecordBatch.from_pydict({"text": texts}))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    key, times = np.unique(np.concatenate([doc * _TABLE + word, doc * _TABLE + form]), return_counts=True)
    doc, slot = key // _TABLE, key % _TABLE
    value = times / (np.diff(first) + _PRIOR_WORDS)[doc]
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    rng, n_pairs = np.random.default_rng(5), 4 * max(len(better), len(worse))
    seen, seen_whole = np.full(_TABLE, 1e-8), np.full(_N_WHOLE, 1e-8)
    scores = np.zeros(len(texts))
    for _ in range(_ROUNDS):
        scores = np.bincount(doc, value * model.table[slot], len(texts)) + whole @ model.whole
        a, b = rng.choice(better, n_pairs), rng.choice(worse, n_pairs)
        miss = 1 / (1 + np.exp(np.clip(scores[a] - scores[b], -50, 50))) / n_pairs
        pull = np.bincount(a, miss, len(texts)) - np.bincount(b, miss, len(texts))
        slope = np.bincount(slot, value * pull[doc], _TABLE) - _DECAY * model.table
        seen += slope**2
        model.table += _RATE * slope / np.sqrt(seen)
        slope = whole.T @ pull - _DECAY * model.whole
        seen_whole += slope**2
        model.whole += _RATE * slope / np.sqrt(seen_whole)
    return model, np.bincount(doc, value * model.table[slot], len(texts)) + whole @ model.whole


_SLIGHT = 1e-12


def _between(rows: list, weights: tuple[float, float], target: float, below: float = 0.0, last: float | None = None) -> tuple[float, float]:
    """The values of the first row up to which weights add up to ``target`` and of the row before it.

    ``rows`` are ascending values, each with its number of poor and of good rows; ``below`` is the weight
    of what lies before them and ``last`` its greatest value. The first row of all counts as the second.
    """
    for i, (x, poor, good) in enumerate(rows):
        if below + poor * weights[0] + good * weights[1] >= target or i == len(rows) - 1:
            if below + weights[0 if poor else 1] < target and poor + good > 1:
                return x, x
            if last is not None:
                return last, x
            return x, x if poor + good > 1 or i + 1 == len(rows) else rows[i + 1][0]
        below, last = below + poor * weights[0] + good * weights[1], x
    raise ValueError("no rows")


def _around(scored: DataFrame, x: Column, weights: tuple[float, float], target: float) -> tuple[float, float]:
    """What ``_between`` says of all rows of ``scored``: ranges of values are counted, and the one that holds the place is cut again, until few rows are left."""
    given = scored.select(x.alias("x"), "good")
    poor, good = F.count(F.when(~F.col("good"), 1)).alias("poor"), F.count(F.when(F.col("good"), 1)).alias("good")
    low, high, n = given.agg(F.min("x"), F.max("x"), F.count("*")).first()
    below, last = 0.0, None
    # A first range of one row may need the next value, so that one is never cut from the rest.
    while n > _FEW and high > low:
        place = F.least(F.floor((F.col("x") - low) / ((high - low) / _BINS)), F.lit(_BINS - 1))
        ranges = given.filter(F.col("x").between(low, high)).groupBy(place.alias("place")).agg(F.min("x").alias("low"), F.max("x").alias("high"), poor, good)
        ranges = sorted(ranges.collect(), key=lambda r: r.place)
        for i, r in enumerate(ranges):
            weight = r.poor * weights[0] + r.good * weights[1]
            if below + weight >= target or i == len(ranges) - 1:
                break
            below, last = below + weight, r.high
        low, high, n = r.low, r.high if last is not None or r.poor + r.good > 1 or i + 1 == len(ranges) else ranges[i + 1].low, r.poor + r.good
    rows = given.filter(F.col("x").between(low, high)).groupBy("x").agg(poor, good).collect()
    return _between(sorted((r.x, r.poor, r.good) for r in rows), weights, target, below, last)


def _score(model: Model):
    def run(batches):
        for batch in batches:
            for part in _pieces(batch):
                score = model.calibrated(model.raw(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    return run


def _marks(labels: DataFrame) -> tuple[DataFrame, float]:
    """The ids that may teach, each with whether its text is good, and the share of good ones."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = marks.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", (F.col("quality") == 1).alias("good"))
    counts = {r.good: r["count"] for r in marks.groupBy("good").count().collect()}
    return marks, counts.get(True, 0) / max(1, sum(counts.values()))


def _fit_group(group: pa.Table) -> pa.Table:
    """The weights of one group's model that are not zero, and a row that counts the model; none of a group with one label."""
    group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    good = group.column("good").to_numpy(zero_copy_only=False).astype(bool)
    model, scores = _fit(group.column("text").combine_chunks(), good)
    weights = np.concatenate([model.table, model.whole, [float(scores is not None)]])
    slots = np.flatnonzero(weights)
    return pa.table({"slot": pa.array(slots.astype(np.int32)), "weight": pa.array(weights[slots])})


def _raw(model: Model):
    def run(batches):
        for batch in batches:
            for part in _pieces(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.raw(part))], ["doc_id", "raw"])

    return run


def train_all(docs: DataFrame, marks: DataFrame, share_good: float, rows: int = TRAIN_ROWS) -> Model:
    """Fit on all rows of ``docs`` (``doc_id``, ``text``) that ``marks`` (``doc_id``, ``good``) has; ``share_good`` as in ``train``.

    They are dealt out by a hash of the id over groups of about ``rows`` of the more frequent label. Where that
    leaves a group with fewer than ``_LEAST`` of the other, its rows go to some further groups too, so that every
    group has pairs. Threshold and scale come from the scores of all rows.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = {r.good: r["count"] for r in texts.select("doc_id").join(marks, "doc_id").groupBy("good").count().collect()}
    n_good, n_poor = counts.get(True, 0), counts.get(False, 0)
    model = Model(np.zeros(_TABLE), np.zeros(_N_WHOLE), 1.0 if not n_good else -1.0)
    if not n_good or not n_poor:
        return model
    few, many = sorted((n_good, n_poor))
    n_groups = -(-many // rows)
    copies = max(1, min(n_groups, -(-_LEAST * n_groups // few)))
    own = F.pmod(F.xxhash64("doc_id"), F.lit(n_groups))
    last = F.when(F.col("good") == F.lit(n_good <= n_poor), copies - 1).otherwise(0)
    group = F.explode(F.transform(F.sequence(F.lit(0), last), lambda step: F.pmod(own + step, F.lit(n_groups)).cast("int")))
    # Merged whatever their size, so that neither side is ever sent through the driver.
    known = texts.join(marks.hint("merge"), "doc_id").withColumn("group", group)
    fitted = known.groupBy("group").applyInArrow(_fit_group, "slot int, weight double")
    sums = np.zeros(_TABLE + _N_WHOLE + 1)
    for r in fitted.groupBy("slot").agg(F.sum("weight").alias("weight")).collect():
        sums[r.slot] = r.weight
    n_models = max(1.0, sums[-1])
    model.table, model.whole = sums[:_TABLE] / n_models, sums[_TABLE:-1] / n_models
    # Every text is scored where it lies, as only ids and scores then need to meet the labels.
    scores = texts.mapInArrow(_raw(model), texts.select("doc_id").schema.add("raw", "double"))
    scored = scores.join(marks, "doc_id").select("good", "raw").persist(StorageLevel.DISK_ONLY)
    try:
        weights = (1 - share_good) / n_poor, share_good / n_good
        model.threshold = sum(_around(scored, F.col("raw"), weights, 1 - share_good + _SLIGHT)) / 2
        half = (n_good + n_poor) / 2 + 0.5
        before, middle = _around(scored, F.abs(F.col("raw") - model.threshold), (1.0, 1.0), half)
        model.scale = ((before + middle) / 2 if (n_good + n_poor) % 2 == 0 else middle) or 1.0
    finally:
        scored.unpersist()
    return model


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The quality of each document of ``doc_id`` and ``text``.

    Pairs are drawn within groups of about ``rows`` documents per label of ``labels``
    (``doc_id``, ``quality`` 0 or 1) whose ``crc32`` of the id as text is not 2
    modulo 4, of which every one is in a group; the others are ``held_out``. The result has ``doc_id``,
    ``held_out``, ``score`` from 0 to 1 and ``predicted``, 1 from the threshold up,
    which lies at ``CUT``.

    A null text counts as empty; an empty one has the score of its missing
    words. Labels that are null or other numbers teach nothing; of several
    labels for an id the lower counts. With one kind of label, or none, all
    texts get the same score, on the side of that label. A null id is not held
    out. Repeated rows are scored alike; other columns are ignored.
    """
    c.ship(docs.sparkSession)
    model = train_all(docs, *_marks(labels), rows)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return given.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
