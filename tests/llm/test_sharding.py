from collections import Counter

import pytest

from shoal.llm import sharding as S
from tests.llm import cases

NAMES = [f"s{k}" for k in range(7)]


def brute(shards, slots):
    """Turns one by one over whole preference lists."""
    prefs = []
    for s in shards:
        offset, step = S._numbers(s, slots)
        prefs.append([(offset + j * step) % slots for j in range(slots)])
    owner = {}
    while len(owner) < slots:
        for i in sorted(range(len(shards)), key=lambda i: shards[i]):
            if len(owner) < slots:
                owner[next(p for p in prefs[i] if p not in owner)] = i
    return [owner[k] for k in range(slots)]


@pytest.mark.parametrize("slots", [7, 13, 101])
def test_table_equals_brute_force(slots):
    assert S.fill_table(NAMES, slots) == brute(NAMES, slots)


def test_balance_weights_and_small_disruption():
    table = S.fill_table(NAMES, 4099)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert [NAMES[k] for k in table] == [NAMES[::-1][k] for k in S.fill_table(NAMES[::-1], 4099)]
    fewer = S.fill_table(NAMES[:-1], 4099)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.1 * 4099
    heavy = Counter(S.fill_table(NAMES, 4099, [3, 1, 1, 1, 1, 1, 1]))
    assert abs(heavy[0] - 3 * heavy[1]) <= 9


def test_bad_arguments():
    for args in ((NAMES, 100), ([], 7), (["a", "a"], 7), (NAMES, 5)):
        with pytest.raises(ValueError):
            S.fill_table(*args)


def test_assign(spark):
    out = S.assign(cases.docs(spark), NAMES, 101).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in cases.rows())
    table = S.fill_table(NAMES, 101)
    assert all(r.shard == NAMES[table[r.slot]] for r in out)
    by_id = {}
    for r in out:
        if r.doc_id is not None:
            assert by_id.setdefault(r.doc_id, r.slot) == r.slot
    assert len({r.slot for r in out if r.doc_id is None}) == 2  # by text
    assert S.assign(cases.empty(spark), NAMES, 101).count() == 0


def test_write_shards(spark, tmp_path):
    df = cases.docs(spark)
    S.write_shards(df, str(tmp_path / "out"), NAMES, 2, 101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count() and set(back.columns) == {*df.columns, "__shard"}
    want = Counter(r.shard for r in S.assign(df, NAMES, 101).collect())
    assert Counter(r["__shard"] for r in back.collect()) == want
