"""The pipeline stage by stage, and every registered query against its SQL."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from shelftrack.llm import queries as registered
from shelftrack.llm.mixing import label_domains, mix
from shelftrack.llm.queries import MIX

TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no tables")


@pytest.mark.parametrize("name", list(registered.ORACLES))
def test_query(spark, name):
    database = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = registered.QUERIES[name](spark, str(TABLES))
    result = database.execute(registered.ORACLES[name])
    order = [d[0] for d in result.description]
    assert sorted(map(tuple, df.select(*order).collect())) == sorted(result.fetchall())


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_whole_table(spark, name):
    df = registered.QUERIES[name](spark, str(TABLES))
    table = "embeddings" if "vec_id" in df.columns else "documents"
    rows = spark.read.parquet(f"{TABLES}/{table}.parquet")
    if "conv_id" in df.columns:
        rows = spark.read.parquet(f"{TABLES}/conversations.parquet").select("conv_id").distinct()
        assert sorted(r.conv_id for r in df.select("conv_id").collect()) == sorted(r.conv_id for r in rows.collect())
    elif "piece" in df.columns:
        assert sorted(r.doc_id for r in df.filter("piece = 0").collect()) == sorted(r.doc_id for r in rows.collect())
    elif table == "documents":
        assert sorted(r.doc_id for r in df.select("doc_id").collect()) == sorted(r.doc_id for r in rows.select("doc_id").collect())
    else:
        assert df.count() == 20 * rows.filter("vec_id % 20 = 0").count()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    kinds = {r.doc_id: r for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    columns, before = docs.columns, None
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, str(TABLES)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and after
        if name != "SentencePiece":
            assert docs.columns == columns
        if name == "line dedup":
            lines = [line for r in after.values() for line in r.text.split("\n") if line.strip()]
            assert len(lines) == len(set(lines))
            assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)
            assert all(i in after for i, r in before.items() if r.text.split("\n")[0].strip() and i == min(before))
        if name == "source mixing":
            gone = [i for i in set(before) - set(after) if i in kinds]
            assert sum(kinds[i].quality == 1 and kinds[i].toxic == 0 for i in gone) <= 0.05 * len(kinds)
    assert set(after) == set(before) and all(r.round_trip for r in after.values())


def test_mixing_meets_targets(spark):
    """Domains that hold less than their target are raised by copies."""
    docs, labels = (spark.read.parquet(f"{TABLES}/{name}.parquet") for name in ("documents", "labels"))
    domains = label_domains(labels)
    rare = docs.join(domains.filter("domain <> 'good'"), "doc_id", "left_semi").orderBy("doc_id").limit(6)
    docs = docs.join(domains.filter("domain = 'good'"), "doc_id", "left_semi").unionByName(rare).checkpoint()
    rated = {r.doc_id: r for r in mix(docs, domains, MIX, keeping="good").collect()}
    kept = Counter(r.doc_id for r in corpus_pipeline.source_mixing(spark, docs, str(TABLES)).collect())
    assert kept == Counter({i: r.mix_copies for i, r in rated.items() if r.mix_copies}) and max(kept.values()) > 1
    names, good = sorted(MIX), sum(r.mix_tokens * r.mix_posteriors[0] for r in rated.values())
    for i, name in enumerate(names):
        reached = sum(n * rated[d].mix_tokens * rated[d].mix_posteriors[i] for d, n in kept.items())
        assert reached == pytest.approx(good * MIX[name] / MIX["good"], rel=0.05 if name == "good" else 0.3), name


def test_run(spark):
    found = corpus_pipeline.run(spark, str(TABLES))
    assert found.count() > 0 and found.columns == ["doc_id", "tokens", "n_tokens", "round_trip"]


def test_stages_take_empty_and_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int"
    rows = [(1, "the cat sat on the mat and slept", "en", "a", 32, 1), (None, None, None, None, None, 1), (2, "", "en", "a", 0, 1)]
    rows += [(3, "the cat sat on the mat and slept", "en", "a", 32, 1), (None, "no id at all in this row of words", "en", "b", 33, 2)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs, wanted = df, None
        for name, stage in corpus_pipeline.STAGES:
            if name == "source mixing":
                domains = label_domains(spark.read.parquet(f"{TABLES}/labels.parquet"))
                wanted = Counter({r.doc_id: r.mix_copies for r in mix(docs, domains, MIX, keeping="good").collect()})
            docs = stage(spark, docs, str(TABLES))
            if name != "SentencePiece":
                assert docs.columns == df.columns
            if name == "SimHash near-dedup":
                assert sorted(r.doc_id or 0 for r in docs.collect()) == ([0, 1] if df.count() else [])
        # Each document comes as often as it has copies.
        assert Counter(r.doc_id for r in docs.collect()) == +wanted
