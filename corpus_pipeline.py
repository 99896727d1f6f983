"""From raw documents to token ids: filtering, deduplication, decontamination, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``documents``; the last returns the encoding of each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbline.llm import decontaminate, forest_join, merge_replay, site_lines, toxicity
from ebbline.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels calls toxic go. The model learns from the texts of ``docs``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that more than a tenth of a source's documents hold are cut from their texts. No document goes."""
    return site_lines.drop_boilerplate(docs, "source")


def keep_first_of_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle similarity of 0.8 or more, the one with the smallest id stays."""
    return forest_join.keep_first(docs)


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's tokens: number, digest of the ids, digest of the bytes that they decode to."""
    return merge_replay.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", keep_first_of_class),
    ("decontamination", drop_leaking),
    ("byte_bpe", encode),
]

#: The first stage fits a model, which SQL cannot express; tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
