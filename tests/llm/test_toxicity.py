import random
import zlib

import numpy as np
import pytest

from shoal.llm import toxicity
from shoal.llm.catalog import REGISTRY
from tests.llm import cases

SF = "/root/testdata/sf0.1"


@pytest.fixture
def short(monkeypatch):
    """Small networks, in this process."""
    monkeypatch.setattr(toxicity, "BUCKETS", 1 << 10)


def slow_scores(net, texts):
    out = []
    for t in texts:
        ws = [*toxicity.words(t), *[None] * max(toxicity.WIDTHS)]
        emb = [np.zeros(toxicity.DIMS) if w is None else net.table[toxicity.picked([w])[0]].sum(axis=0) for w in ws]
        tops = []
        for w in toxicity.WIDTHS:
            f = getattr(net, f"filters{w}")
            tops += [max(sum(emb[i + k] @ f[k][:, j] for k in range(w)) for i in range(len(ws) - w + 1))
                     for j in range(toxicity.FILTERS)]
        z = np.maximum(np.array(tops) + net.shift, 0) @ net.weight + net.bias[0]
        out.append(1 / (1 + np.exp(-z)))
    return out


def test_scores_are_the_networks(short):
    net = toxicity.Network(shift=np.linspace(-0.1, 0.1, 24), bias=np.array([0.3]))
    texts = ["", "a", "one two", "One two three", cases.prose(1, 50), "漢字 🙂 x", " \n"]
    for one, many in zip(slow_scores(net, texts), net.scores(texts)):
        assert abs(one - many) < 1e-5
    assert np.allclose(net.scores(texts[::-1])[::-1], net.scores(texts), atol=1e-6)   # no text touches another
    again = toxicity.Network.unpacked(net.packed())
    assert (again.scores(texts) == net.scores(texts)).all()


def test_gradients(short, monkeypatch):
    """One step of plain descent goes where finite differences say."""
    monkeypatch.setattr(toxicity, "DROP", 0.0)
    monkeypatch.setattr(toxicity, "DECAY", 0.0)
    texts, y = [cases.prose(k, 9) for k in range(6)], np.array([1, 0, 1, 0, 1, 0])

    def loss(net):
        p = net.scores(texts)
        return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))

    net = toxicity.Network()
    before, want = loss(net), {}
    for name, at in (("weight", (2,)), ("shift", (9,)), ("bias", (0,)), ("filters2", (1, 3, 2)), ("filters3", (2, 0, 5))):
        value, h = getattr(net, name), 1e-2
        value[at] += h
        up = loss(net)
        value[at] -= 2 * h
        want[name, at] = (up - loss(net)) / (2 * h)
        value[at] += h
    # Adagrad's first step is the rate times the gradient's sign
    moved = toxicity.train(texts, y, 1, 1)
    for (name, at), g in want.items():
        if abs(g) > 1e-3:
            assert np.sign(getattr(net, name)[at] - getattr(moved, name)[at]) == np.sign(g), name
    assert loss(toxicity.train(texts, y, 30, 30)) < before / 2


def test_thresholds_by_language(spark):
    rows = [("en", k % 2 == 0, 0.62 if k % 2 == 0 else 0.58) for k in range(60)]
    rows += [("fr", k % 2 == 0, 0.32 if k % 2 == 0 else 0.28) for k in range(60)] + [("xx", True, 0.9), (None, False, 0.1)]
    got = {(r.everywhere, r.lang): r.threshold for r in toxicity.thresholds(
        spark.createDataFrame(rows, "lang string, toxic boolean, score double")).collect()}
    assert set(got) == {(False, "en"), (False, "fr"), (True, None)}
    assert abs(got[False, "en"] - 0.6) < 2e-3 and abs(got[False, "fr"] - 0.3) < 2e-3


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in REGISTRY["op11_toxicity_cnn"](spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
               and 0 <= r.score <= 1 for r in got.values())
    test = [(got[i], t) for i, t in labels.items() if got[i].held_out]
    toxic, clean = ([r for r, t in test if t == k] for k in (1, 0))
    assert len(toxic) > 80
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = cases.docs(spark)
    labels = [(k, 1, k % 2) for k in range(1, 15)]
    turned = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted(map(str, toxicity.classify(docs, spark.createDataFrame(x, schema), epochs=1, steps=5).collect())) for x in (labels, turned))
    assert a == b


def test_awkward_rows_and_none(spark):
    schema = "doc_id long, quality int, toxic int, name string, h long, lang string"
    labels = spark.createDataFrame([(k, 1, (k // 2) % 2, "x", 1, "y") for k in [*range(1, 15), 1, 1]] +
                                   [(None, 1, 1, "x", 1, "y"), (3, 1, None, "x", 1, "y")], schema)
    out = toxicity.classify(cases.docs(spark), labels, epochs=1, steps=5)
    assert out.count() == len(cases.rows())
    assert out.filter("doc_id is null").select("held_out").distinct().collect() == [(True,)]
    assert out.filter("score is null or predicted is null or threshold is null").isEmpty()
    one = {r.score for r in out.filter("doc_id in (5, 6, 7)").collect()}
    assert len(one) == 1    # texts without words
    assert toxicity.classify(cases.empty(spark), labels).count() == 0
    none = toxicity.classify(cases.docs(spark), labels.limit(0))
    assert none.count() == len(cases.rows()) and none.filter("score > 0 or predicted > 0 or flagged").isEmpty()
