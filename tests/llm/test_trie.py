import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shoal.llm import trie
from shoal.llm.catalog import REGISTRY

SCHEMA = "conv_id long, turn long, role string, text string, name string, key string, n long, of int, up long"
EXTRA = ("x", "y", 1, 2, 3)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def name(role, text):
    data = f"{len(role.encode())}:{role}{text}".encode()
    return hashlib.sha256(data).digest()[:16]


def conversations(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = convs.get(c - int(np.fmod(c, 5)), [])
        out[c] = head[:h] + turns[h:]
    return out


def expected(convs):
    at = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            at[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for p in at:
        if p:
            children[p[:-1]].add(p)

    def below(p):
        yield p
        for q in children[p]:
            yield from below(q)

    rows = []
    for p, members in at.items():
        sub = list(below(p))
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(p)))
        rows.append((min(members), len(p), min(at[p[:-1]]) if p else None, len(members), len(children[p]),
                     sum(not children[q] for q in sub),
                     sum((len(at[q]) - 1) * len(q[-1][1].encode()) for q in sub if q),
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def some_rows(seed, n=120):
    rng, rows = random.Random(seed), []
    texts = ["a", "b", "c", "é", "", None, "long " * 30]
    for c in range(n):
        if rng.random() < 0.3:
            turns = [("user", "a"), ("assistant", "b"), ("user", "c")][:rng.randint(0, 3)]   # many copies
        else:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(rng.randint(1, 9))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(7, 1, "user", "a"), (7, None, "user", "zz"), (7, None, "user", "zz"), (None, 0, "user", "a"), (-3, 0, None, None)]
    rows += [(2 ** 60 + 1, k, "user", f"t{k}") for k in range(300)]
    return rows


@pytest.mark.parametrize("shards,block", [(1, 1 << 18), (3, 20), (16, 1), (5, 100)])
def test_nodes_in_shards_and_blocks(spark, shards, block):
    rows = some_rows(shards)
    convs = conversations(rows)
    paths = trie.paths_of(frame(spark, rows))
    assert got(trie.nodes(paths, shards, block)) == expected(convs)


def test_query_against_brute_force(spark, tmp_path):
    rows = some_rows(9, 300)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(REGISTRY["op13_prefix_trie"](spark, str(tmp_path))) == expected(rebuilt(conversations(rows)))


def test_none(spark):
    paths = trie.share_heads(trie.paths_of(frame(spark, [])))
    assert got(trie.nodes(paths)) == []


def test_turnless_conversation_is_in_the_root(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "a")]
    assert got(trie.nodes(trie.share_heads(trie.paths_of(frame(spark, rows))))) == expected({c: []})


def test_double_array_holds_exactly_its_paths():
    rng = random.Random(5)
    for _ in range(8):
        m = rng.choice([2, 5, 400])
        paths = {tuple(rng.randint(1, m) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 300))}
        paths = sorted(paths)
        codes = np.array([c for p in paths for c in p], dtype=np.int64)
        packed = trie.pack(codes, np.array([len(p) for p in paths]))
        prefixes = {p[:k] for p in paths for k in range(len(p) + 1)}
        slots = {(): 0}
        for p in sorted(prefixes, key=len):
            if p:
                slots[p] = int(packed.step(np.array([slots[p[:-1]]]), np.array([p[-1]]))[0])
        assert -1 not in slots.values() and len(set(slots.values())) == len(prefixes)
        assert (packed.check >= 0).sum() == len(prefixes)
        for p in prefixes:
            for c in range(1, m + 2):
                to = packed.step(np.array([slots[p]]), np.array([c]))[0]
                assert (to >= 0) == (p + (c,) in prefixes)


def test_ids_of_a_hot_key(spark):
    rows = [(b"a", c) for c in range(40_000)] + [(b"b", 5), (b"c", -1), (b"c", 11), (b"c", 9)]
    df = spark.createDataFrame(rows, "key binary, conv_id long")
    want = {b"a": range(40_000), b"b": [5], b"c": [-1, 9, 11]}
    for shards in (1, 7):
        found = {bytes(r.key): r.ends for r in trie.id_digests(df, shards).collect()}
        assert found == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items()}
