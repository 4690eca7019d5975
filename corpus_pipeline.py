"""Corpus pipeline over ``documents``: toxicity, near duplicates, contamination, mix, token ids.

Every stage gets what its predecessor kept, written as Parquet and read again, and decides on all of it.
The first four return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from plaudit.session import ship_package
from plaudit.sources.adapter import table
from plaudit.storage import materialise, work_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    ship_package(spark)
    found = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return found.filter(F.col("predicted") == 0).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near copies."""
    ship_package(spark)
    return jaccard_join.keep_one_each(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("spans") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source's documents as often as its target share asks for."""
    return mixing.repeat_documents(mixing.plan_mix(docs), docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in id order, written and read back: position, length and checksum."""
    ship_package(spark)
    path = work_path(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, path)


STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", reject_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_ids),
]

#: SQL cannot express training, the schedule's hashes or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every result but the last is a written table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
