"""Corpus pipeline: quality rules, line dedup, near duplicates, mixing, packing.

Each stage works on what its predecessor kept.  All but the last return the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpanel.llm.common import shared_dir, table
from plantpanel.llm.jaccard_join import one_of_each_group
from plantpanel.llm.line_dedup import dedup_passages
from plantpanel.llm.mixing import WORD, take_mix
from plantpanel.llm.packing import pack_documents
from plantpanel.llm.quality import keep_good


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, unchanged.

    Null, empty and short texts go; repeated rows fare alike; an empty table
    stays empty; other columns stay whatever their names.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages of lines that an earlier one has.

    A document without a word, such as a copy of which nothing is left, goes
    (null texts too: the mix could take nothing from them).  Rows with a null
    id lose nothing; ``n_chars``, if there, follows the text; other columns
    stay; an empty table stays empty.
    """
    left = dedup_passages(docs, with_counters=False).where(F.col("text").rlike(WORD))
    return _measured(left, docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, unchanged: the one with the smallest id.

    Texts without a word are in no group and stay, as do rows with a null id
    whose group has no id.
    """
    return one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and with as many of their words, as the mix takes them.

    Texts without a word are not taken; a null source is a source of its own.
    """
    return _measured(take_mix(docs), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; a null text has its end token only."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the trained stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
