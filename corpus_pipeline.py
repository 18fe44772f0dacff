"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next.

Rows that fail a stage are gone from all later ones; ids, languages and sources stay what they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm import bpe, lines, mixing, simhash, toxicity
from txflow.llm.common import table, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic; the chain learns from the labelled ones among them."""
    chain = toxicity.learn(docs, toxicity.marks(table(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, chain)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are taken out of the texts, and ``n_chars`` follows.

    A NULL text keeps its ``n_chars``.
    """
    cleaned = lines.dedup_lines(docs, counts=False)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their mixing rate says; small languages are raised, and every document stays."""
    return mixing.mix_up(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of both decodings, a row for each document and copy."""
    return bpe.encode_decode(docs, bpe.public_path())


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

# Classifiers, fingerprints and token ids are beyond SQL; tests hold each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
