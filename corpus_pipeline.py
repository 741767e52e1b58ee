"""Cleaning pipeline over ``documents``: language ID, exact dedup, near dedup,
benchmark decontamination, BPE encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, decontaminate, exact_dedup, language_id, near_dedup
from riskframe.llm.queries import BYTE_VOCABULARY, vocabulary
from riskframe.llm.store import free_name, table
from riskframe.sources.tables import read_table


LEAST_LETTERS = 64      # shorter texts are not judged by their cosine
FLOOR_QUANTILE, FLOOR_SHARE = 0.001, 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter (null, empty, digits) and texts in no learned
    language: at least ``LEAST_LETTERS`` letters, and a cosine to the nearest
    prototype below the floor.  The floor is a quarter of the cosine that 0.1 % of all
    training rows of that length stay below, so clean texts are far above it.
    If no language was learned, every text with a letter stays.  The rows stay
    as they are; prototypes and floor come from the training fold."""
    training = ~language_id.held_out(F.col("doc_id")) & F.col("lang").isNotNull()
    model = language_id.train(docs.where(training).select("text", "lang"))
    name, score, size = (free_name(docs, c) for c in ("_predicted", "_score", "_letters"))
    letters = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"\P{L}+", ""))
    told = table(language_id.predict(docs, model, lang_col=name, score_col=score).withColumn(size, letters), "language-scores")
    if not model.names:
        return told.where(F.col(size) > 0).select(*docs.columns)
    judged = F.col(size) >= LEAST_LETTERS
    floor = told.where(training & judged).agg(F.percentile_approx(score, FLOOR_QUANTILE, 10_000)).first()[0]
    known = ~judged | (F.col(score) >= FLOOR_SHARE * (floor or 0.0))
    return told.where((F.col(name) != language_id.UNDETERMINED) & known).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the longest original of every group of equal texts."""
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every component of near copies."""
    kept = near_dedup.near_dedup(docs).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(table(kept, "kept-ids"), F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a ten-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again."""
    path = vocabulary(BYTE_VOCABULARY)
    coded = bpe.encode(docs, path, bpe.build_lexicon(docs, path), out_col="token_ids", decoded_col="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark),
    ("bpe", encoding),
]

# Languages, near copies and token ids are no SQL; tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
