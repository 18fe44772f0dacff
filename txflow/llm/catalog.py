"""The queries over whole tables, one for each operator, and the SQL that some must equal."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from txflow.llm import bpe, imatch, licenses, lines, lm, merkle, mixing, packing, quality, simhash, toxicity, warc, whitening
from txflow.llm.common import table
from txflow.sources.storage import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all documents, their edited texts and their successors."""
    return imatch.compare_edited(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence scan over all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of all documents."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), bpe.public_path())


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LM scores of all documents."""
    return lm.score(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and mixing rates of all documents."""
    return mixing.op5_mixing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC archives in the shared folder, read back."""
    return warc.op7_warc(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over all documents."""
    return quality.op8_quality(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over all documents."""
    return lines.op9_line_dedup(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity chain over all documents."""
    return toxicity.op10_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.op11_packing(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened by their first 16 components."""
    return whitening.op12_whitening(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents, each proved against a copy some of whose texts were changed."""
    return merkle.op13_merkle(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_imatch,
    op2_licenses,
    op3_bpe,
    op4_lm,
    op5_mixing,
    op6_simhash,
    op7_warc,
    op8_quality,
    op9_line_dedup,
    op10_toxicity,
    op11_packing,
    op12_whitening,
    op13_merkle,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in OPERATORS} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_licenses": licenses.SQL,
        "op7_warc": warc.SQL,
        "op8_quality": quality.SQL,
        "op9_line_dedup": lines.SQL,
        "op13_merkle": merkle.SQL,
    }
