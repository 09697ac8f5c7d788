"""Registered queries of the operators, one per operator.

Each takes ``(spark, sf_dir)``, applies its operator with production
parameters to its whole table and derives the digest columns of the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm import ann, bpe, chat, license, mixing, ngram_join, pii, quality, runs, sharding, toxicity, trie
from shoal.llm import exact_dedup as dedup
from shoal.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


@register("op6_exact_dedup")
def op6(spark: SparkSession, d: str) -> DataFrame:
    """Equal texts of ``documents`` by block naming; one row per document."""
    return dedup.exact_dedup(table(spark, d, "documents"))


VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("op10_byte_bpe")
def op10(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every text of ``documents`` and the texts decoded back."""
    return bpe.token_digests(table(spark, d, "documents"), VOCABULARY, public_tokenizers.PATTERN)


#: Names of the output shards; a power of two splits evenly over writers.
SHARDS = [f"shard-{k:03d}" for k in range(256)]


@register("op1_sharding")
def op1(spark: SparkSession, d: str) -> DataFrame:
    """Shard of every row of ``documents``."""
    return sharding.assign(table(spark, d, "documents"), SHARDS)


@register("op3_chat_format")
def op3(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation, and -7 whose texts hold control strings, folded
    from its log, rendered and read back."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.segments(chat.fold(chat.log_of(rows.unionByName(extra)))))


@register("op7_pii_skip_chain")
def op7(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    return pii.find(table(spark, d, "documents"))


@register("op5_license_scan")
def op5(spark: SparkSession, d: str) -> DataFrame:
    """Licences of every text of ``documents``."""
    return license.scan(table(spark, d, "documents"))


#: Of the mixture query: nine tenths and a half of the largest entropy.
MIX_ENTROPY = 0.95


@register("op8_temperature_mixing")
def op8(spark: SparkSession, d: str) -> DataFrame:
    """How often a mixture of as many tokens as ``documents`` has uses each
    of its rows, and the weight of the row's source."""
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    m = mixing.mixture(docs, entropy=MIX_ENTROPY)
    return (mixing.counted(docs, m)
            .select("doc_id", "source", F.col("__block").alias("block"),
                    F.round("__weight", 6).alias("weight"), F.col("__copies").alias("copies")))


@register("op9_quality_kneser_ney")
def op9(spark: SparkSession, d: str) -> DataFrame:
    """Perplexity of every text of ``documents`` and whether it is kept."""
    return quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@register("op2_kmeans_tree_ann")
def op2(spark: SparkSession, d: str) -> DataFrame:
    """Ten nearest vectors of every hundredth of ``embeddings``."""
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op4_ngram_jaccard_join")
def op4(spark: SparkSession, d: str) -> DataFrame:
    """Groups and number of links of every row of ``documents``."""
    return ngram_join.join(table(spark, d, "documents")).drop("text_key")


@register("op12_runs")
def op12(spark: SparkSession, d: str) -> DataFrame:
    """Runs of words in every text of ``documents``, one text in ten made
    periodic, and the texts without the repetitions."""
    return runs.digests(runs.detect(runs.repeat_words(table(spark, d, "documents"))))


@register("op13_prefix_trie")
def op13(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of the trie of ``conversations``, each beginning with turns of
    its block of five."""
    return trie.nodes(trie.share_heads(trie.paths_of(table(spark, d, "conversations"))))


@register("op11_toxicity_cnn")
def op11(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of every text of ``documents``."""
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))
