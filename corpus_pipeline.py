"""A corpus pipeline: each stage works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxlake.llm import bpe_table, language_id, mixing, ngram_join, private_data
from boxlake.llm.common import stored, table
from boxlake.llm.queries import digests, language_model


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language, or whose words are in doubt, go. The model learns from the documents at hand; without labels it judges none."""
    return language_id.keep_identified(docs, language_model(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.keep_first_of_groups(docs, ngram_join.Rule(5, 80))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return private_data.mask_private_data(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the weights of their sources; one taken in two epochs appears twice."""
    return mixing.mix(docs).drop("mix_epoch") if "mix_epoch" not in docs.columns else mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return digests(bpe_table.encode_and_decode(docs))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("private", private), ("mixture", mixture), ("tokens", tokens)]

#: Learned languages, near copies and ids are beyond SQL; tests/llm/test_pipeline.py holds the stages together against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
