"""From ``documents`` to token numbers, in five stages.

Each stage is ``(name, function)``; a function takes the session, the documents
its predecessor kept and the folder of tables, and returns the documents it keeps
with the columns of ``documents`` (the last: the tokens). ``run`` writes every
stage's result as Parquet to the shared folder and reads it again as the next
one's input, so that a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrack.llm import common as c
from shelftrack.llm.language import UNDETERMINED, identify
from shelftrack.llm.line_dedup import remove_repeated_lines
from shelftrack.llm.mixing import label_domains, mix
from shelftrack.llm.queries import MIX, TOKENIZER
from shelftrack.llm.sentencepiece_fst import encode
from shelftrack.llm.simhash import near_duplicates

LEAST_SCORE = 0.4  # mean posterior of a document's language below which it is rejected


def _same_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Documents whose id and text are among the chosen."""
    kept = chosen.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("kept_hash"))
    return docs.join(kept, same, "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without letters or with a low mean posterior go."""
    found = identify(docs, keep=True)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated and nearly repeated lines; one left with no word goes."""
    found = remove_repeated_lines(docs, max_edits=2, near_bytes=24, keep=True)
    found = found.filter((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    text, n_chars = F.col("kept").alias("text"), F.length("kept").cast("long").alias("n_chars")
    new = {"text": text, "n_chars": F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(n_chars).alias("n_chars")}
    return found.select(*(new.get(name, F.col(f"row.{name}")) for name in docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every near-duplicate group.

    Documents without an id stay if none of their group has one.
    """
    marked = near_duplicates(docs, shingle=3, max_bits=2)
    return _same_rows(docs, marked.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at their fitted rates, as many rows each as it has copies; the good domain keeps its tokens."""
    mixed = mix(docs, label_domains(c.read(spark, sf_dir, "labels")), MIX, keeping="good")
    # Rows of one id and text are rated alike.
    copies = mixed.filter(F.col("mix_copies") > 0).groupBy("doc_id", "text_hash").agg(F.max("mix_copies").alias("mix_copies"))
    copies = copies.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "mix_copies")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("kept_hash"))
    repeated = docs.join(copies, same).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return repeated.select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of every document, with the check that they decode to its text."""
    return encode(docs, TOKENIZER)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("source mixing", source_mixing),
    ("SentencePiece", sentencepiece),
]

# Classifiers, edit distances and components are not for one SQL statement; a
# test runs the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    folder = f"{c.shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = c.read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir.rstrip("/")).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
