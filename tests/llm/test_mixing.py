import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from shoal.llm import mixing as M
from tests.llm import cases


def rows(n=400):
    out = []
    for k in range(n):
        src = "hot" if k % 3 else f"s{k % 7}"
        out.append((k, cases.prose(k, 5 + k % 40), "en", src, 1, *cases.EXTRA))
    return out + cases.rows()


def brute(data, n_blocks, a=None, entropy=None, repeat=None, cover=False, seed=1):
    """The whole rule over plain lists."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    each, of = defaultdict(int), []
    for r in data:
        src = "" if r[3] is None else "=" + r[3]
        dig = md5(f"{seed}/" + (str(r[0]) if r[0] is not None else "text " + md5(r[1] or "")))
        each[src, dig] += len(re.findall(M.TOKEN, r[1] or ""))
        of.append((src, dig))
    totals = defaultdict(int)
    for (src, _), n in each.items():
        totals[src] += n
    total = sum(totals.values())
    p = {s: n / total for s, n in totals.items() if n}

    def fits(a):
        w = {s: x ** a for s, x in p.items()}
        z = sum(w.values())
        if entropy is not None:
            return -sum(x / z * math.log(x / z) for x in w.values()) >= entropy * math.log(len(p))
        ratio = [w[s] / p[s] for s in p]
        return (max(ratio) / min(ratio) if cover else max(ratio) / z) <= repeat

    lo, hi = 0.0, 1.0
    for _ in range(M.HALVINGS):
        mid = (lo + hi) / 2
        if fits(mid) == (entropy is not None):
            lo = mid
        else:
            hi = mid
    a = (1.0 if fits(1.0) else lo) if entropy is not None else hi
    w = {s: x ** a for s, x in p.items()}
    z, low = sum(w.values()), min(w[s] / p[s] for s in p)
    copies = {}
    for src, n in totals.items():
        if not n:
            copies.update({k: 1 for k in each if k[0] == src})
            continue
        goal = math.floor((n * w[src] / p[src] / low if cover else total * w[src] / z) + 0.5)
        goal = max(goal, n) if cover else goal
        passes, rest = divmod(goal, n)
        blocks = defaultdict(list)
        for (s, dig), t in each.items():
            if s == src:
                blocks[int(dig[:8], 16) % n_blocks].append((dig, t))
        for b in sorted(blocks, key=lambda b: (md5(f"{seed}/{src}/{b}"), b)):
            size = sum(t for _, t in blocks[b])
            left, full, over = rest, 0 < rest >= size, False
            for dig, t in sorted(blocks[b]):
                left -= t
                over = over or left < 0
                copies[src, dig] = passes + (full or rest > 0 and not over)
            rest -= size if full else rest
            if not full:
                rest = -1
    return a, [copies[k] for k in of]


@pytest.mark.parametrize("target", [{"entropy": 0.9}, {"entropy": 0.2}, {"repeat": 2.0}, {"repeat": 1.5, "cover": True}])
def test_equals_brute_force(spark, target):
    data = rows()
    df = cases.docs(spark, data)
    m = M.mixture(df, block_tokens=300, **target)
    a, want = brute(data, m.n_blocks, **target)
    assert abs(m.exponent - a) < 1e-7
    out = M.counted(df, m)
    assert out.columns == [*df.columns, "__weight", "__block", "__copies"]
    got = Counter((r.doc_id, r.text, r["__copies"]) for r in out.collect())
    assert got == Counter((r[0], r[1], c) for r, c in zip(data, want))


def test_target_is_met(spark):
    data = rows()
    df = cases.docs(spark, data)
    m = M.mixture(df, entropy=0.9, block_tokens=300)
    weights = [r.weight for r in m.sources.collect() if r.weight > 0]
    assert abs(sum(weights) - 1) < 1e-9
    assert abs(-sum(w * math.log(w) for w in weights) / math.log(len(weights)) - 0.9) < 1e-6
    spent, size = defaultdict(int), defaultdict(int)
    for r in M.counted(df, m).collect():
        n = len(re.findall(M.TOKEN, r.text or ""))
        spent[r.source] += n * r["__copies"]
        size[r.source] = max(size[r.source], n)
    goals = {r.src[1:] if r.src else None: r.goal for r in m.sources.collect()}
    for s, goal in goals.items():  # short by less than a document
        assert goal - size[s] < spent[s] <= goal or goal == 0


def test_cover_uses_every_row(spark):
    df = cases.docs(spark, rows())
    out = M.mixed(df, repeat=1.5, cover=True, block_tokens=300)
    assert out.columns == df.columns
    have, want = Counter((r.doc_id, r.text) for r in out.collect()), Counter((r.doc_id, r.text) for r in df.collect())
    assert all(want[k] <= have[k] <= 2 * want[k] for k in want)


def test_same_in_every_run(spark):
    df = cases.docs(spark, rows(60))
    a, b = (Counter(map(tuple, M.mixed(df.repartition(n), entropy=0.9).select("doc_id", "text").collect())) for n in (1, 5))
    assert a == b


def test_one_source_empty_and_bad_targets(spark):
    one = [(k, "a b c", "en", "only", 1, *cases.EXTRA) for k in range(5)]
    assert M.mixed(cases.docs(spark, one), entropy=0.9).count() == 5
    assert M.mixed(cases.empty(spark), entropy=0.9).count() == 0
    assert M.mixed(cases.docs(spark, [(1, None, "en", "s", 1, *cases.EXTRA)]), repeat=2.0).count() == 1
    with pytest.raises(ValueError):
        M.mixture(cases.empty(spark))
