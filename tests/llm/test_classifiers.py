"""Language, quality and mixing models: held-out accuracy, brute force, odd input."""

import itertools
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelftrack.llm import language, mixing, quality

TABLES = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not os.path.exists(TABLES), reason="no tables")


def table(spark, name):
    return spark.read.parquet(f"{TABLES}/{name}.parquet")


def brute_posteriors(scores, transitions):
    n, labels = scores.shape
    total = np.zeros((n, labels))
    for path in itertools.product(range(labels), repeat=n):
        weight = np.exp(sum(scores[i, k] for i, k in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        for i, k in enumerate(path):
            total[i, k] += weight
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("segment", [1, 2, 3, 128])
def test_forward_backward(segment):
    rng = np.random.default_rng(0)
    first = np.array([0, 5, 5, 6, 13])
    scores, transitions = rng.normal(0, 2, (13, 3)), rng.normal(0, 1, (3, 3))
    got = language.posteriors(scores, first, transitions, segment)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            assert np.allclose(got[a:b], brute_posteriors(scores[a:b], transitions))


@needs_tables
def test_language_held_out(spark):
    docs = table(spark, "documents")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


@needs_tables
def test_switched_language(spark):
    docs = table(spark, "documents")
    picked = {r.lang: r.text for r in docs.filter("n_chars > 2000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    parts = [" ".join(picked[name].split()[:40]) for name in ("en", "de", "fr")]
    mixed = spark.createDataFrame([(1, " ".join(parts), None)], "doc_id long, text string, lang string")
    row = language.identify(mixed, docs, spans=True).first()
    longest = sorted(row.spans, key=lambda s: s.start - s.stop)[:3]
    assert [s.lang for s in sorted(longest)] == ["en", "de", "fr"] and min(s.stop - s.start for s in longest) > 20


def test_language_edges(spark):
    schema = "doc_id long, text string, lang string, held_out int, score string, row int"
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "de"), (4, "", None), (6, "12 !? \n", "en")]
    rows += [(7, "THE DOG", None), (7, "THE DOG", None), (None, "die katze", "de"), (8, "the " * 50000, "en"), (9, "x" * 300000, None)]
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], schema)
    for found in (language.identify(df), language.identify(df, keep=True), language.identify(df, spans=True)):
        got = found.collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (3, 4, 6)} == {3: "und", 4: "und", 6: "und"}
        assert {r.lang_pred for r in got if r.doc_id == 7} == {"en"}
    assert language.identify(df, keep=True).select("row.*").columns == df.columns
    assert language.identify(df.limit(0)).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


@needs_tables
def test_quality_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    found = quality.score_quality(docs, labels)
    assert found.count() == docs.count()
    rows = [r for r in found.join(labels, "doc_id").collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_quality_pairs():
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["kind", "words", "here"], 30)) for _ in range(40)]
    bad = [" ".join(rng.choice(["kind", "words", "here", "WIN!!"], 30)) for _ in range(40)]
    model = quality.train(good + bad, np.arange(80) < 40, 0.5)
    import pyarrow as pa

    score = model.calibrated(model.raw(pa.RecordBatch.from_pydict({"text": pa.array(good + bad, pa.string())})))
    assert (score[:40] >= quality.CUT).mean() > 0.95 and (score[40:] < quality.CUT).mean() > 0.95


def test_quality_learns_from_every_label(spark, monkeypatch):
    """Ten times as many labelled texts as a group holds: each text's own word has a weight, threshold and scale are those of all."""
    monkeypatch.setattr(quality, "_FEW", 10)
    monkeypatch.setattr(quality, "_BINS", 4)
    monkeypatch.setattr(quality, "_LEAST", 15)
    texts = [(i, f"own{i} " + ("fine words here" if i % 3 else "bad 9 9 9"), bool(i % 3)) for i in range(300)]
    known = spark.createDataFrame(texts, "doc_id long, text string, good boolean")
    model = quality.train_all(known.select("doc_id", "text"), known.select("doc_id", "good"), 2 / 3, rows=20)
    slots, _, _, _ = quality._features(pa.RecordBatch.from_pydict({"text": [f"own{i}" for i in range(300)]}))
    assert (model.table[slots] != 0).all()
    raw = model.raw(pa.RecordBatch.from_pydict({"text": [t for _, t, _ in texts]}))
    assert model.threshold == pytest.approx(np.sort(raw)[99:101].mean()) and model.scale == pytest.approx(np.median(np.abs(raw - model.threshold)))


def test_quality_edges(spark):
    rows = [(1, "good words here", 9), (2, "BAD!! BAD!!", 9), (3, None, 9), (4, "", None), (4, "", None), (None, "x", 1), (5, "long " * 100000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, None), (2, 0, None), (3, None, 1), (4, 7, 0), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality.score_quality(df.limit(0), labels).count() == 0
    assert {r.predicted for r in quality.score_quality(df, labels.limit(0)).collect()} == {0}
    only = labels.filter("quality = 1")
    assert {r.predicted for r in quality.score_quality(df, only).collect()} == {1}


def brute_rates(tokens, shares, targets, steps):
    rate, present = np.ones(len(tokens)), (tokens[:, None] * shares).sum(axis=0)
    for _ in range(steps):
        reached = ((rate * tokens)[:, None] * shares).sum(axis=0)
        rate = np.maximum(0, rate - shares @ ((reached - targets) / present))
    return rate


def test_rates(spark):
    rng = np.random.default_rng(2)
    tokens, shares = rng.integers(1, 500, 200), rng.dirichlet([0.3, 0.3, 0.3], 200)
    df = spark.createDataFrame([(i, int(t), s.tolist()) for i, (t, s) in enumerate(zip(tokens, shares, strict=True))], "i int, mix_tokens long, mix_posteriors array<double>")
    present = (tokens[:, None] * shares).sum(axis=0)
    targets = present.sum() * np.array([0.6, 0.35, 0.05])
    rate, steps = mixing.fit_rates(df, targets.tolist())
    got = np.array([r.rate for r in df.select("i", rate.alias("rate")).orderBy("i").collect()])
    assert np.allclose(got, brute_rates(tokens.astype(float), shares, targets, len(steps)))
    reached = ((got * tokens)[:, None] * shares).sum(axis=0)
    assert np.abs(reached - targets).max() < 0.01 * present.sum() and (got >= 0).all()


@needs_tables
def test_mixture(spark):
    docs, labels = table(spark, "documents"), mixing.label_domains(table(spark, "labels"))
    mixed = mixing.mix(docs, labels, {"good": 0.96, "poor": 0.03, "toxic": 0.01}, keeping="good")
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = mixed.collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.domain for r in labels.collect()}
    best = {r.doc_id: sorted(["good", "poor", "toxic"])[int(np.argmax(r.mix_posteriors))] for r in rows}
    shared = [i for i in best if i in known]
    assert np.mean([best[i] == known[i] for i in shared]) > 0.85
    total = sum(r.mix_tokens * r.mix_posteriors[0] for r in rows)
    assert sum(r.mix_rate * r.mix_tokens * r.mix_posteriors[0] for r in rows) == pytest.approx(total, rel=0.02)


def test_mixture_edges(spark):
    rows = [(1, "a b c", 1), (2, "x y z", 2), (3, None, 3), (None, "", 4), (None, "a b", 4), (2, "x y z", 2), (4, "w " * 100000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    labels = spark.createDataFrame([(1, "p"), (2, "q"), (None, "p"), (3, None), (9, "zzz"), (2, "q")], "doc_id long, domain string")
    mixed = mixing.mix(df, labels, {"p": 1, "q": 1})
    got = mixed.collect()
    assert len(got) == len(rows) and all(r.mix_rate >= 0 and r.mix_copies >= 0 and sum(r.mix_posteriors) == pytest.approx(1) for r in got)
    assert [r.mix_tokens for r in got if r.doc_id == 3] == [0]
    assert mixing.mix(df.limit(0), labels, {"p": 1, "q": 1}).count() == 0
    assert {tuple(r.mix_posteriors) for r in mixing.mix(df, labels.limit(0), {"p": 1, "q": 3}).collect()} == {(0.5, 0.5)}
