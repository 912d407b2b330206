"""From raw documents to sharded training data: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import stage, table
from tidemark.llm.decontam import remove_contaminated
from tidemark.llm.langid import keep_languages, learn_languages
from tidemark.llm.neardup import drop_near_duplicates
from tidemark.llm.queries import mixed, tokenizer_path
from tidemark.llm.sharding import shard_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the languages learnt from the labelled ones; those without letters go."""
    return keep_languages(docs, learn_languages(docs, tokenizer_path("piece_bpe_32k.model")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal and nearly equal texts."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens are shared among sources, languages and kinds of content as wanted."""
    return mixed(docs).filter("__sampled").select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document: its shard and slot."""
    return shard_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]
#: No SQL: language scores and weighted samples have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
