"""Corpus pipeline: quality, exact copies, near copies, mixture, tokens.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)``, works on every row its predecessor kept and returns a DataFrame.
``run`` applies them to ``documents``, writing each result to the shared
folder as Parquet and reading it again before the next stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoal.llm import bpe, exact_dedup, mixing, ngram_join, quality
from shoal.llm.common import shared_dir, table


#: No source is used more than one and a half times as often as another;
#: every document is used at least once.
MIX = {"repeat": 1.5, "cover": True}


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within that of trusted text."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-gram similarity the least id stays."""
    return ngram_join.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mixture uses it."""
    return mixing.mixed(docs, **MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every row left."""
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", good_text),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("temperature_mixing", mixture),
    ("byte_bpe", tokens),
]

#: Language-model scores and near copies are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
