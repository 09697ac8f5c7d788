import random
from collections import Counter
from math import comb

import numpy as np
import pytest

from shoal.llm import ngram_join as N
from tests.llm import cases


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """All pairs; equal texts are linked even without words."""
    n = len(rows)
    sets = [shingles(r[1]) for r in rows]
    linked = [[a != b and ((rows[a][1] or "") == (rows[b][1] or "")
                           or bool(sets[a]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9)
               for b in range(n)] for a in range(n)]
    group = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                if linked[a][b] and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    out = []
    for a in range(n):
        ids = [rows[b][0] for b in range(n) if group[b] == group[a] and rows[b][0] is not None]
        same = [rows[b][0] for b in range(n) if (rows[b][1] or "") == (rows[a][1] or "") and rows[b][0] is not None]
        out.append((rows[a][0], min(ids, default=None), min(same, default=None), sum(linked[a])))
    return Counter(out)


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
    return " ".join(words)


def near_rows():
    rng, rows, i = random.Random(11), [], 200
    for g in range(12):
        base = cases.prose(300 + g, rng.choice([30, 80, 150])).split()
        for _ in range(rng.randint(1, 8)):
            rows.append((i, edited(rng, base, rng.randint(0, 4)), "en", "a", 1, *cases.EXTRA))
            i += 1
    return rows


def got(df):
    return Counter(tuple(r)[:4] for r in df.select("doc_id", "class_id", "rep_id", "n_links").collect())


@pytest.mark.parametrize("block", [512, 3])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)  # small blocks: neighbourhoods over many tasks
    rows = cases.rows() + near_rows()
    assert got(N.join(cases.docs(spark, rows))) == brute(rows)


def test_large_group_of_different_near_copies(spark):
    rng = random.Random(5)
    base = cases.prose(77, 150).split()
    rows = [(k, edited(rng, base, rng.randint(0, 6)), "en", "a", 1, *cases.EXTRA) for k in range(150)]
    assert got(N.join(cases.docs(spark, rows))) == brute(rows)


def test_short_and_wordless_texts(spark):
    texts = ["a b", "A  B", "a b c", "", " ", "\n", "a b", "x", None]
    rows = [(k, t, "en", "a", 1, *cases.EXTRA) for k, t in enumerate(texts)]
    assert got(N.join(cases.docs(spark, rows))) == brute(rows)


def test_drop_keeps_one_of_each_group(spark):
    rows = cases.rows() + near_rows()
    df = cases.docs(spark, rows)
    out = N.drop_near_copies(df)
    assert out.columns == df.columns
    have = Counter((r.doc_id, r.text or "") for r in out.collect())
    assert max(have.values()) == 1
    kept = Counter(r[0] for r in out.select("doc_id").collect())
    assert {i for i in kept if i is not None} == {c for (_, c, _, _) in brute(rows) if c is not None}


def test_empty(spark):
    assert N.join(cases.empty(spark)).count() == 0 and N.drop_near_copies(cases.empty(spark)).count() == 0


def test_posterior_table():
    """Against numerical integration of the posterior."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    for n in (24, 72):
        least = N.least_matches()[n]
        for m in (least - 1, least):
            density = grid ** m * (1 - grid) ** (n - m) * (n + 1) * comb(n, m)
            reach = density[grid >= 0.8].sum() / 20_000
            assert (reach >= N.TOLERANCE) == (m >= least)


def test_signatures_estimate_similarity():
    a = cases.prose(1, 400).split()
    b = a[:300] + cases.prose(2, 100).split()
    true = len(shingles(" ".join(a)) & shingles(" ".join(b))) / len(shingles(" ".join(a)) | shingles(" ".join(b)))
    assert abs((N.signature(a) == N.signature(b)).mean() - true) < 0.12
    assert len(set(N.bands(N.signature(a)).tolist())) == N.BANDS


def test_blocks_bounded_by_text(spark, monkeypatch):
    """Few long texts are dealt into blocks too; the rows stay the same."""
    monkeypatch.setattr(N, "OCTETS", 2_000)
    rows = cases.rows() + near_rows()
    assert got(N.join(cases.docs(spark, rows))) == brute(rows)
