import re
from collections import Counter

import corpus_pipeline as C
import public_tokenizers
import pytest

from tests.harness import compare, duck
from shoal.llm import bpe
from shoal.llm.catalog import REGISTRY
from shoal.llm.oracle import SQL
from tests.llm import cases

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    res = compare(spark, name, SF, REGISTRY[name], SQL[name], duck(SF))
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(SQL)))
def test_queries_return_every_row(spark, name):
    out = REGISTRY[name](spark, SF)
    table = "embeddings" if name.startswith("op2") else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert out.count() == (n // 100 * 10 if table == "embeddings" else n)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY) == list(range(1, 14))


def test_stages_over_the_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs
        if k < len(C.STAGES) - 1:
            assert docs.columns == before.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r.doc_id for r in seen["quality_classifier"].collect()}
    assert sum(i in good for i, q in labels.items() if q) >= 0.97 * sum(labels.values())
    assert sum(i not in good for i, q in labels.items() if not q) >= 0.8 * (len(labels) - sum(labels.values()))
    low = Counter(cases.lowered(r.text) for r in seen["exact_dedup"].collect())
    assert max(low.values()) == 1 and set(low) == {cases.lowered(r.text) for r in seen["quality_classifier"].collect()}

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    left = [shingles(r.text) for r in seen["ngram_jaccard_join"].collect()]
    assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(left) for b in left[:i])
    mix = Counter(r.doc_id for r in seen["temperature_mixing"].collect())
    assert set(mix) == {r.doc_id for r in seen["ngram_jaccard_join"].collect()} and max(mix.values()) <= 2
    codec = bpe.Codec(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    text = {r.doc_id: r.text for r in seen["temperature_mixing"].collect()}
    for r in seen["byte_bpe"].collect():
        assert r.n_tokens == len(codec.encode(text[r.doc_id])) // 4
    assert Counter(r.doc_id for r in C.run(spark, SF).collect()) == mix


def test_stages_with_awkward_rows_and_none(spark, tmp_path):
    for sub, data in (("odd", cases.rows()), ("none", [])):
        folder = str(tmp_path / sub)
        cases.docs(spark, data).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(k, 1, 0) for k in range(1, 15)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        n = C.run(spark, folder).count()
        assert n == 0 if sub == "none" else n > 5
