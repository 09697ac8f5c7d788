import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shoal.llm import runs
from shoal.llm.catalog import REGISTRY
from tests.llm import cases


def slow_lyndon(word):
    """A suffix's longest Lyndon prefix ends before the next smaller suffix."""
    n = len(word)
    return [next((j for j in range(i + 1, n) if word[j:] < word[i:]), n) - i for i in range(n)]


def slow_runs(word, least=6, exponent=4):
    n, found = len(word), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and word[j] == word[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, exponent * q):
                if not any(all(word[k] == word[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng):
    kind = rng.random()
    n = rng.randint(0, 60)
    if kind < 0.4:
        return [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
    word = []
    while len(word) < n:
        root = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        word += root * rng.randint(1, 6) + root[:rng.randint(0, len(root))]
    return word


def test_lyndon_lengths_by_grouping():
    rng = random.Random(1)
    for _ in range(1500):
        word = some_words(rng)
        kinds = sorted(set(word))
        ranks = [kinds.index(w) for w in word]
        assert runs.lyndon_lengths(ranks, len(kinds)) == slow_lyndon(ranks)


@pytest.mark.parametrize("least,exponent", [(6, 4), (3, 3), (1, 5)])
def test_runs(least, exponent):
    rng = random.Random(2)
    for _ in range(1000):
        word = some_words(rng)
        assert runs.find(np.array(word, dtype=np.int64), least, exponent) == slow_runs(word, least, exponent), word


def test_runs_of_long_texts():
    one = np.zeros(200_000, dtype=np.int64)
    assert runs.find(one) == [(0, 200_000, 1)]
    rng = random.Random(3)
    root = [rng.randrange(50_000) for _ in range(20_000)]
    assert runs.find(np.array([-1, *root * 4, *root[:5]], dtype=np.int64)) == [(1, 80_005, 20_000)]
    a, b = [0], [0, 1]  # Fibonacci words have no fourth powers but many repetitions
    while len(b) < 30_000:
        a, b = b, b + a
    assert runs.find(np.array(b, dtype=np.int64)) == []


def expected(doc_id, text):
    w = runs.words(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = slow_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, t, *rest) for i, t, *rest in cases.rows() if len(t or "") < 2000]
    for k in range(100, 260):
        words = some_words(rng)
        gap = rng.choice([" ", "\n", " \t", "\x0b", "\x0c\r"])
        rows.append((k, gap.join(f"w{x}" for x in words) or None, "en", "a", 0, *cases.EXTRA))
    rows += [(300, "a a a a \x1f \x85 " * 8, "en", "a", 0, *cases.EXTRA), (301, "x " * 7, "en", "a", 0, *cases.EXTRA)]
    cases.docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op12_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert order(got.collect()) == order(expected(r[0], r[1]) for r in rows)


def test_awkward_rows_and_none(spark):
    out = runs.detect(cases.docs(spark))
    assert out.count() == len(cases.rows())
    assert {r.collapsed for r in out.filter("doc_id in (5, 6, 7)").collect()} == {""}
    assert runs.digests(runs.detect(cases.empty(spark))).count() == 0
    assert runs.repeat_words(cases.empty(spark)).count() == 0


def test_whole_texts_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in REGISTRY["op12_runs"](spark, "/root/testdata/sf0.001").collect()}
    rows = [r for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 6000]
    assert len(got) == docs.count() and len(rows) > 100
    for r in rows:
        assert tuple(got[r.doc_id]) == expected(r.doc_id, r.text)
