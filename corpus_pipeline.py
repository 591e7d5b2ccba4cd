"""The training-data pipeline: documents to clean, deduplicated, decontaminated, tokenized rows.

Each stage works on all that its predecessor kept. ``run`` writes each stage's rows
to the shared folder (``spark.checkpoint.dir``) and rereads them, so a lost executor
costs the running stage's tasks only. Once a stage's rows are written, its own tables and the rows
of the stage before are removed; the rows that the last stage reads stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagdiff.llm import decontaminate, exact_dedup, language_id, queries, simhash
from bagdiff.llm.common import materialize, remove, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: null, empty or letterless texts; these alone if none is learned."""
    model = language_id.fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.with_language(docs, model, into="__language")
    return found.filter(found["__language.lang_pred"] != language_id.UNKNOWN).select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, with the smallest id, of each group of equal texts."""
    return exact_dedup.one_of_each(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, with the smallest id, of each near-duplicate component."""
    return simhash.one_of_each(docs, shingle=queries.SHINGLE, distance=queries.DISTANCE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a window of words with a benchmark item."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode each document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return queries.tokenized(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe", token_stage),
]

#: Language ID and SimHash cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with written() as tables:
            docs = materialize(stage(spark, docs, sf_dir), name)
        remove(spark, before + tables[:-1])
        before = tables[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
