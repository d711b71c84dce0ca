"""The training-data pipeline over the table documents.

Each stage takes (spark, docs, sf_dir) and returns the documents that it leaves, with all their columns; the
last returns tokens. What a stage returns is written as Parquet in the shared folder and read again before
the next. doc_id names a document: rows that repeat it share its decisions, and rows without one pass the
stages that compare documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm.bpe import encode_digests
from wattloom.llm.exact_dedup import exact_dedup
from wattloom.llm.mixing import mix
from wattloom.llm.near_dedup import near_dedup
from wattloom.llm.quality_rules import learn, quality
from wattloom.llm.queries import CLEAN_GROWTH, DOMAIN_WEIGHTS, bad_quality, domain_of_label, ranks, table
from wattloom.sources.tables import stage

_DOC = "__document"

# A document that is clean with this probability stays at least once, whatever its rate and draw.
SURELY_CLEAN = 0.5


def _without(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` but for those that the decisions do not keep. The list grows with the corpus: a merge at every size."""
    dropped = decisions.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped.hint("merge"), docs["doc_id"] == F.col("__dropped"), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet no base rule and no rule of the learned decision list."""
    rules = learn(docs, table(spark, sf_dir, "labels"), bad_quality())
    judged = quality(docs.select(F.struct("*").alias(_DOC), F.col("text").alias("text")), rules)
    return judged.where("kept").select(f"{_DOC}.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text the one with the largest doc_id."""
    return _without(docs, exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8 or more) the one with the smallest doc_id."""
    return _without(docs, near_dedup(docs))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mixture's rates give it; documents with none go."""
    rated = mix(docs, table(spark, sf_dir, "labels"), domain_of_label(), DOMAIN_WEIGHTS, "clean", CLEAN_GROWTH)
    copies = F.greatest(F.col("copies"), F.when(F.col("p_clean") >= SURELY_CLEAN, 1).otherwise(0))
    decided = rated.groupBy(F.col("doc_id").alias("__rated")).agg(F.max(copies).alias("__copies"))
    joined = docs.join(decided.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__rated")))
    repeated = joined.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(*(docs[c] for c in docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return encode_digests(docs, ranks(), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("bpe", tokenize),
]

# Learning and MinHash have no SQL form; tests/llm/test_pipeline.py compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
