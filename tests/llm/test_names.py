"""Columns of the user that have the operators' internal names."""

import pytest
from pyspark.sql import functions as F

from shoal.llm import exact_dedup, mixing, ngram_join, quality, sharding
from tests.llm import cases

NAMES = ["__of", "__id", "__key", "__n", "__src", "__digest", "__weight", "__block", "__copies", "__times", "__more", "__pass",
         "__th", "__lang", "__slot"]


def odd(spark):
    docs = cases.docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in NAMES})


def values(df, cols):
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, ngram_join.drop_near_copies])
def test_copies(spark, drop):
    docs = odd(spark)
    out = drop(docs)
    assert out.columns == docs.columns
    assert values(out, ["doc_id", "text"]) == values(drop(docs.drop(*NAMES)), ["doc_id", "text"])
    assert set(values(out, docs.columns)) <= set(values(docs, docs.columns))


def test_mixture(spark):
    docs = odd(spark)
    out = mixing.mixed(docs, repeat=1.5, cover=True)
    assert out.columns == docs.columns
    assert values(out, ["doc_id", "text"]) == values(mixing.mixed(docs.drop(*NAMES), repeat=1.5, cover=True), ["doc_id", "text"])
    assert set(values(out, docs.columns)) <= set(values(docs, docs.columns))


def test_quality(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(1, 15)], "doc_id long, quality int, toxic int")
    out = quality.keep_good(docs, labels)
    assert values(out, ["doc_id", "text"]) == values(quality.keep_good(docs.drop(*NAMES), labels), ["doc_id", "text"])
    assert out.columns == docs.columns


def test_shards(spark, tmp_path):
    docs = odd(spark)
    sharding.write_shards(docs, str(tmp_path / "s"), ["a", "b"], files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.columns == [*docs.columns, "__shard"] and values(back, docs.columns) == values(docs, docs.columns)
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("__shard", F.lit(1)), str(tmp_path / "t"), ["a"])
