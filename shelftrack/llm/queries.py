"""The operators of this subpackage over their whole tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm import vectors as v
from shelftrack.llm.alignment import align
from shelftrack.llm.collision_search import nearest_products
from shelftrack.llm.conversations import damage, repair
from shelftrack.llm.knn_join import top_products
from shelftrack.llm.language import identify
from shelftrack.llm.line_dedup import remove_repeated_lines
from shelftrack.llm.mixing import label_domains, mix
from shelftrack.llm.packing import pack
from shelftrack.llm.quality import score_quality
from shelftrack.llm.sentencepiece_fst import encode
from shelftrack.llm.simhash import near_duplicates
from shelftrack.llm.substring_dedup import remove_repeated_passages
from shelftrack.llm.suffix_dedup import remove_repeated_strings

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query(
    "op1_exact_topk",
    """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.vector, d.vector)::BIGINT AS score
        FROM whole q JOIN whole d ON q.vec_id <> d.vec_id
        WHERE q.vec_id % 20 = 0
    )
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
    FROM scored
    QUALIFY rank <= 20
    """,
)
def op1(spark, sf):
    rows = c.read(spark, sf, "embeddings").filter(v.finite("embedding"))
    whole = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("vector"))
    return top_products(whole.filter(F.col("vec_id") % 20 == 0), whole, 20)


# Where the public tokenizers lie; the files are read, never copied.
TOKENIZERS = os.environ.get("SHELFTRACK_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = os.environ.get("SHELFTRACK_TOKENIZER", f"{TOKENIZERS}/piece_bpe_32k.model")


@query("op2_sentencepiece")
def op2(spark, sf):
    return encode(c.read(spark, sf, "documents"), TOKENIZER)


@query("op3_simhash_dedup")
def op3(spark, sf):
    return near_duplicates(c.read(spark, sf, "documents"), shingle=3, max_bits=2)


@query("op4_suffix_array_dedup")
def op4(spark, sf):
    return remove_repeated_strings(c.read(spark, sf, "documents"), width=100, digest=True)


@query("op5_language_id")
def op5(spark, sf):
    return identify(c.read(spark, sf, "documents"))


@query("op6_collision_search")
def op6(spark, sf):
    rows = c.read(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return nearest_products(rows.filter(F.col("vec_id") % 20 == 0), rows, 20)


@query("op7_substring_dedup")
def op7(spark, sf):
    return remove_repeated_passages(c.read(spark, sf, "documents"), width=20, digest=True)


@query("op8_line_dedup")
def op8(spark, sf):
    return remove_repeated_lines(c.read(spark, sf, "documents"), max_edits=2, near_bytes=24, digest=True)


MIX = {"good": 0.96, "poor": 0.03, "toxic": 0.01}


@query("op9_source_mixing")
def op9(spark, sf):
    labels = label_domains(c.read(spark, sf, "labels"))
    mixed = mix(c.read(spark, sf, "documents").select("doc_id", "text"), labels, MIX, keeping="good")
    shares = [F.col("mix_posteriors")[i].alias(f"p_{name}") for i, name in enumerate(sorted(MIX))]
    return mixed.select(
        "doc_id", F.col("mix_tokens").alias("n_tokens"), *shares, F.col("mix_rate").alias("rate"), F.col("mix_copies").alias("copies")
    )


@query("op10_quality")
def op10(spark, sf):
    return score_quality(c.read(spark, sf, "documents"), c.read(spark, sf, "labels"))


@query("op11_token_alignment")
def op11(spark, sf):
    aligned = align(c.read(spark, sf, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", TOKENIZER, digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


@query("op12_conversation_repair")
def op12(spark, sf):
    return repair(damage(c.read(spark, sf, "conversations")), "times", digest=True)


@query("op13_sequence_packing")
def op13(spark, sf):
    return pack(c.read(spark, sf, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", limit=4096, end=1)
