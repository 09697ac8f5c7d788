import hashlib
from collections import Counter, defaultdict

import pytest

from shoal.llm import exact_dedup as E
from tests.llm import cases


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[cases.lowered(r[1])].append(r[0])
    out = []
    for r in rows:
        t = cases.lowered(r[1])
        ids = [i for i in groups[t] if i is not None]
        keep = max(ids) if ids else None
        out.append((r[0], keep, len(groups[t]), r[0] == keep, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


# Narrow hashes force contents that share a hash; small blocks force rounds.
@pytest.mark.parametrize("block_bytes,hash_bits", [(8192, 64), (64, 64), (7, 3), (1000, 0)])
def test_equals_brute_force(spark, block_bytes, hash_bits):
    got = E.exact_dedup(cases.docs(spark), block_bytes=block_bytes, hash_bits=hash_bits).collect()
    assert Counter(map(tuple, got)) == brute(cases.rows())


def test_prefix_and_odd_blocks_are_told_apart(spark):
    texts = ["ab", "abab", "ababab", "abababab", "ababababab", "abababa", "", "abab"]
    rows = [(i, t, "en", "a", 1, *cases.EXTRA) for i, t in enumerate(texts)]
    got = E.exact_dedup(cases.docs(spark, rows), block_bytes=2).collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_empty_table(spark):
    out = E.exact_dedup(cases.empty(spark))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0
    assert E.drop_copies(cases.empty(spark)).count() == 0


def test_drop_copies_keeps_columns_and_one_row(spark):
    df = cases.docs(spark)
    out = E.drop_copies(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, cases.lowered(r.text)) for r in out.collect())
    want = Counter({(r[0], r[4]): 1 for r in []})
    for (i, keep, n, kept, sha), _ in brute(cases.rows()).items():
        if kept:
            want[(i, next(cases.lowered(r[1]) for r in cases.rows()
                          if r[0] == i and hashlib.sha256(cases.lowered(r[1]).encode()).hexdigest() == sha))] = 1
    assert got == want
