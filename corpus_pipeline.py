"""The corpus pipeline over ``documents``: language, near duplicates, benchmark leaks, source mix, token files.

``STAGES`` are applied in order; each gets what its predecessor kept and returns the columns of
``documents``, the last one the places of the documents in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language, mixing, simhash, tiling
from tidemark.llm.common import prepared, stored, table
from tidemark.llm.queries import token_places

#: A text is rejected if it is further than this from the nearest language; clean texts score 0.4 and more.
LEAST_SCORE = 0.25


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language of the corpus; profiles are learnt from its labelled documents."""
    prepared(spark)
    return language.only_known(docs, language.learn(docs), LEAST_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every component of near copies: three-word fingerprints, three bits at most."""
    prepared(spark)
    return simhash.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold no benchmark item."""
    return tiling.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: left out, once or twice."""
    prepared(spark)
    return mixing.mixed_rows(docs, mixing.mix(docs, keep=stored))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row for each document in them."""
    prepared(spark)
    return token_places(docs)


STAGES = [
    ("language", known_languages),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mix", to_target_weights),
    ("tokens", token_files),
]

#: SQL cannot express profiles, fingerprints, tilings or tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage keeps is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
