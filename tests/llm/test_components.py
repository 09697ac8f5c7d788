import random

import pytest

from shoal.llm.components import components


def brute(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def path(n):
    return [(k, k + 1) for k in range(n)]


GRAPHS = {
    "path": path(64), "path from the far end": [(b, a) for a, b in path(33)],
    "stars": [(k % 5, k) for k in range(5, 60)], "star of great hub": [(1000, k) for k in range(30)],
    "shuffled path": [(a, b) for perm in [random.Random(2).sample(range(80), 80)] for a, b in zip(perm, perm[1:])],
    "random": [(random.Random(k).randrange(60), random.Random(k + 1000).randrange(60)) for k in range(45)],
    "repeated": [(1, 2), (2, 1), (1, 2), (3, 2)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = [(a, b) for a, b in GRAPHS[name]]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: x for n, x in brute([e for e in edges if e[0] != e[1]]).items()}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
