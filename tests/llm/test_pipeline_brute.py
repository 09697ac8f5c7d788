"""The pipeline's rows against the stages written once more over plain lists."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from functools import cache

import corpus_pipeline as C
import numpy as np
import public_tokenizers
import tiktoken

from shoal.llm import bpe
from shoal.llm import mixing as M
from shoal.llm import quality as Q
from tests.llm import cases
from tests.llm.test_mixing import brute as mixture
from tests.llm.test_quality import brute_model

LABELS = "doc_id long, quality int, toxic int"


def fixture():
    """Two languages (one with 200 trusted documents and more), junk, exact
    copies in other case, near copies in chains, empty and null texts."""
    rng, rows, labels = random.Random(8), [], []

    def add(text, lang, source, quality=None):
        rows.append((len(rows) + 1, text, lang, source, None if text is None else len(text), *cases.EXTRA))
        if quality is not None:
            labels.append((len(rows), quality, 0))

    for k in range(300):
        add(cases.prose(k, rng.randint(30, 60)), "en" if k % 6 else "de", "hot" if k % 3 else f"s{k % 4}", 1 if k % 7 else None)
    for k in range(20):
        add(" ".join(w.upper() + "&!"[k % 2] * 3 for w in cases.prose(900 + k, 40).split()), "en", "hot", 0 if k % 2 else None)
    for k in range(12):  # groups of copies
        for j in range(1 + k % 4):
            add(rows[5 * k][1].upper() if j % 2 else rows[5 * k][1], "en", f"s{j}")
    for k in range(10):  # each a few words further from the first
        words = rows[100 + k][1].split()
        for j in range(1, 4):
            words = words[:-1] + [f"tail{j}"] if j < 3 else ["head", *words[1:]]
            add(" ".join(words), "en", "s2")
    add(None, "en", "hot")
    add("", None, None)
    add(" \n", "de", "s1")
    add("one word", "fr", None)
    return rows, labels


def scores(rows, trusted, fold):
    """Held-out score of every text with words, by the recursive definition."""
    two, spelt = [Counter(), Counter()], []
    for f in (0, 1):
        texts = [r[1] or "" for r in rows if r[0] in trusted and fold[r[0]] == f]
        for t in texts:
            s = [""] + Q._WORD.findall(t)
            two[f].update(zip(s, s[1:]))
        spelt.append(brute_model(texts))
    one = [Counter(g[1] for g in t) for t in two]

    def discounts(counts):
        c = Counter(n for t in counts for n in t.values())
        y = c[1] / (c[1] + 2 * c[2])
        return [0, *(min(max(x, 0.05), j - 0.05) for j, x in enumerate(
            [1 - 2 * y * c[2] / c[1], 2 - 3 * y * c[3] / c[2], 3 - 4 * y * c[4] / c[3] if c[3] else 2.0], 1))]

    d1, d2 = discounts(one), discounts(two)
    total = [sum(o.values()) for o in one]
    rest = [sum(d1[min(n, 3)] for n in o.values()) / t for o, t in zip(one, total)]
    after = [defaultdict(list), defaultdict(list)]
    for f in (0, 1):
        for (a, _), n in two[f].items():
            after[f][a].append(n)

    @cache
    def low(f, w):
        s = [0, 0, *Q.symbols(f" {w} ").tolist()]
        spelling = math.prod(spelt[f](tuple(s[i - Q.ORDER + 1:i + 1])) for i in range(Q.ORDER - 1, len(s)))
        return (one[f][w] - d1[min(one[f][w], 3)]) / total[f] + rest[f] * spelling

    def bits(f, a, b):
        follow, n = after[f].get(a), two[f][a, b]
        if not follow:
            return -math.log2(low(f, b))
        return -math.log2((n - d2[min(n, 3)]) / sum(follow) + sum(d2[min(x, 3)] for x in follow) / sum(follow) * low(f, b))

    out = {}
    for r in rows:
        s = [""] + Q._WORD.findall(r[1] or "")
        each = [bits(1 - fold[r[0]], a, b) for a, b in zip(s, s[1:])]
        if each:
            out[r[0]] = np.mean(each) - Q.MARGIN * np.std(each) / len(each) ** 0.5
    return out


def good(rows, labels, fold):
    """Rows whose score is within the limit of their language."""
    trusted = {i for i, q, _ in labels if q == 1}
    score = scores(rows, trusted, fold)
    bins = defaultdict(list)
    for r in rows:
        if r[0] in trusted and r[0] in score:
            bins[r[2]].append(math.floor(score[r[0]] / Q.BIN))

    def quantile(values):
        return sorted(values)[math.ceil(len(values) * Q.QUANTILE) - 1]

    means = {g: sum(b) / len(b) + 0.5 for g, b in bins.items() if len(b) >= Q.MIN_TRUSTED}
    tail = (quantile([math.floor(x + 0.5 - means[g]) for g in means for x in bins[g]]) + 1) * Q.BIN
    every = (quantile([x for b in bins.values() for x in b]) + 1) * Q.BIN
    limit = {g: (quantile(bins[g]) + 1) * Q.BIN if len(bins[g]) >= 200 else m * Q.BIN + tail for g, m in means.items()}
    return [r for r in rows if r[0] not in score or score[r[0]] <= limit.get(r[2], every)]


def without_copies(rows):
    last = {}
    for r in rows:
        last[cases.lowered(r[1])] = max(r[0], last.get(cases.lowered(r[1]), r[0]))
    return [r for r in rows if last[cases.lowered(r[1])] == r[0]]


def without_near_copies(rows):
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [r for i, r in enumerate(rows) if root(i) == i]  # rows are in order of their ids


def test_rows_equal_brute_force(spark, tmp_path):
    rows, labels = fixture()
    df = cases.docs(spark, rows)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    fold = {r.doc_id: r.fold for r in df.select("doc_id", Q.fold_of(Q.text_of("text")).alias("fold")).collect()}

    first = good(rows, labels, fold)
    second = without_copies(first)
    third = without_near_copies(second)
    tokens = sum(len(re.findall(M.TOKEN, r[1] or "")) for r in third)
    blocks = min(max(-(-tokens // M.BLOCK_TOKENS), M.MIN_BLOCKS), M.MAX_BLOCKS)
    _, copies = mixture(third, blocks, **C.MIX)
    assert len(rows) > len(first) > len(second) > len(third) and max(copies) > 1  # every stage has work

    codec = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = Counter()
    for r, n in zip(third, copies):
        ids = codec.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
             hashlib.sha256((r[1] or "").encode()).hexdigest()] += n
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in C.run(spark, str(tmp_path)).collect())
    assert {k[0] for k in got} == {k[0] for k in want}
    assert got == want
