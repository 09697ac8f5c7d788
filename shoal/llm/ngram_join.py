"""Similarity join on word five-grams with Bayesian candidate pruning.

Two texts are linked when the Jaccard similarity of their sets of ``WORDS``
consecutive words (lower case, split at white space; a shorter text is one
shingle) is at least ``THRESHOLD``.

1.  Equal texts are one *class*; everything below works on classes.
2.  Each class gets ``BANDS * ROWS`` MinHash values; bands are hashed to
    buckets.  A pair at the threshold misses all buckets with probability
    (1 - t**6)**40 < 1e-5, nearer pairs far less.
3.  Inside a bucket every class is tied to the bucket's least class only, so
    ties grow with the number of classes, whatever the size of a bucket.
    Connected ties form neighbourhoods, which hold every pair that shares a
    bucket.
4.  In a neighbourhood pairs are compared ``STEP`` MinHash values at a time;
    with a uniform prior the posterior of the similarity after m matches of n
    is Beta(m + 1, n - m + 1), and a pair is dropped as soon as the posterior
    probability of reaching the threshold falls below ``TOLERANCE``.  The
    rest is verified exactly on the shingle sets (word tuples, not hashes).
    Small neighbourhoods share a task; a large one is dealt into blocks of
    ``BLOCK`` classes or ``OCTETS`` of text and compared block by block, one task per pair of
    blocks.  Pairs are never rows: a task returns, per class, the number of
    linked documents and the root of a spanning forest of its links.
5.  Connected links are the groups.

Texts without a word are linked to equal texts only.  Null text is the empty
text; repeated rows are documents of one class; a class without an id has a
null representative.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import cut, keep_once, resident, ship, strings, text_of
from shoal.llm.components import components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 6
STEP, TOLERANCE = 24, 1e-6
BLOCK, GATHER = 512, 256
OCTETS = 16 << 20
_WORD_CACHE = 1 << 18
_LANES = 4096

_RNG = np.random.default_rng(20240229)
_MULT = (_RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_FLIP = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _P2
    return h ^ (h >> np.uint64(29))


def signature(words: list[str]) -> np.ndarray:
    """MinHash values (uint32) of the shingles of at least one word."""
    hashes = resident("word hashes", _Hashes)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(WORDS, len(w))
    h = w[:len(w) - span + 1].copy()
    for k in range(1, span):
        h *= _P1
        h += w[k:len(w) - span + 1 + k]
    x = (_mixed(h) >> np.uint64(32)).astype(np.uint32)
    best = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), _LANES):
        lanes = x[at:at + _LANES][None, :] ^ _FLIP[:, None]
        lanes *= _MULT[:, None]
        np.minimum(best, lanes.min(axis=1), out=best)
    return best


def bands(sig: np.ndarray) -> np.ndarray:
    """Bucket (int64) of every band; bands do not share buckets."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _P2
    for k in range(ROWS):
        h = _mixed((h ^ rows[:, k]) * _P1)
    return h.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n values compared: the fewest matches at which a pair stays.

    P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = {}
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        upto, m = 0.0, -1
        while upto < tolerance:
            m += 1
            upto += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


_LEAST = least_matches()


def survivors(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks of signatures that pruning leaves (the
    upper triangle where the blocks are the same)."""
    matches = np.zeros((len(a), len(b)), dtype=np.int16)
    for k in range(STEP):
        matches += a[:, k][:, None] == b[:, k][None, :]
    ok = matches >= _LEAST[STEP]
    if same:
        ok &= np.tri(len(a), len(b), -1, dtype=bool).T
    i, j = np.nonzero(ok)
    m = matches[i, j].astype(np.int64)
    for n in range(2 * STEP, BANDS * ROWS + 1, STEP):
        if not len(i):
            break
        m += (a[i, n - STEP:n] == b[j, n - STEP:n]).sum(axis=1)
        keep = m >= _LEAST[n]
        i, j, m = i[keep], j[keep], m[keep]
    return i, j


def shingle_sets(texts: list[list[str]]) -> list[np.ndarray]:
    """Exact shingle numbers, common to all given texts."""
    number: dict[str, int] = {}
    rows, ends = [], [0]
    for words in texts:
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32)
        if len(ids) < WORDS:
            ids = np.concatenate([ids, np.full(WORDS - len(ids), -1, dtype=np.int32)])
        rows.append(np.lib.stride_tricks.sliding_window_view(ids, WORDS))
        ends.append(ends[-1] + len(rows[-1]))
    every = np.ascontiguousarray(np.concatenate(rows))
    _, ids = np.unique(every.view(np.dtype((np.void, 4 * WORDS))).ravel(), return_inverse=True)
    return [np.unique(ids[s:e]) for s, e in zip(ends, ends[1:])]


def linked(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which index pairs (sorted by i) reach the threshold exactly."""
    out = np.zeros(len(i), dtype=bool)
    size = np.array([len(s) for s in sets])
    mark = np.zeros(max((int(s[-1]) for s in sets), default=0) + 1, dtype=bool)
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else []
    for s, e in zip(starts, [*starts[1:], len(i)]):
        one = sets[i[s]]
        mark[one] = True
        for at in range(s, e, 256):  # bounded gather
            others = j[at:min(at + 256, e)]
            ends = np.cumsum(size[others])
            hits = np.concatenate([[0], np.cumsum(mark[np.concatenate([sets[o] for o in others])])])
            common = hits[ends] - hits[ends - size[others]]
            out[at:at + len(others)] = common >= threshold * (len(one) + size[others] - common) - 1e-9
        mark[one] = False
    return out


def _compare(part: pd.DataFrame, first: int, second: int) -> pd.DataFrame:
    """Links of one neighbourhood, or of two blocks of a large one: per class
    the linked documents and the least class it is connected to here."""
    part = part.sort_values("node")
    node, weight = part["node"].to_numpy(), part["size"].to_numpy()
    words = [words_of(t) for t in part["text"]]
    sigs = np.stack([signature(w) for w in words])
    left = np.flatnonzero(part["block"].to_numpy() == first)
    right = left if first == second else np.flatnonzero(part["block"].to_numpy() == second)
    links, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
    if len(left) and len(right):
        i, j = survivors(sigs[left], sigs[right], first == second)
        i, j = left[i], right[j]
        if len(i):
            used = np.unique(np.concatenate([i, j]))
            sets: list = [np.zeros(1, dtype=np.int64)] * len(node)
            for k, s in zip(used, shingle_sets([words[k] for k in used])):
                sets[k] = s
            ok = linked(sets, i, j)
            i, j = i[ok], j[ok]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            while True:  # least index among connected ones
                low = np.minimum(root[i], root[j])
                new = root.copy()
                np.minimum.at(new, i, low)
                np.minimum.at(new, j, low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
    return pd.DataFrame({"node": node, "links": links, "root": node[root]})


def _key(text: Column) -> Column:
    return F.sha2(text, 256)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id`` (least id of its
    group), ``rep_id`` (least id with the same text), ``n_links`` (other rows
    at or above the threshold, equal texts included), ``text_key``."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    base = base.select("doc_id", _key(F.col("text")).alias("key"), "text")
    octets = F.octet_length("text").cast("long").alias("octets")

    def sign(batches):
        for b in batches:
            out = []
            for t in strings(b.column(2)):
                words = words_of(t)
                out.append(bands(signature(words)) if words else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64())), b.column(3)],
                                             ["doc_id", "key", "bands", "octets"])

    signed = base.select("*", octets).mapInArrow(sign, "doc_id long, key string, bands array<long>, octets long")
    rows = signed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"),
                                     F.any_value("bands").alias("bands"), F.max("octets").alias("octets"))
    classes = cut(rows.withColumn("node", F.monotonically_increasing_id()))

    places = classes.select(F.explode("bands").alias("bucket"), "node")
    full = places.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    ties = places.join(full, "bucket").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    near = components(ties).join(classes.select("node", "key", "rep", "size", "octets"), "node")
    sizes = near.groupBy("label").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("octets") / OCTETS), F.lit(1))
                                      .cast("int").alias("blocks"))
    needed = cut(near.join(sizes, "label"))
    n, held = needed.filter("blocks = 1").agg(F.count(F.lit(1)), F.coalesce(F.sum("octets"), F.lit(0))).first()
    gathers = max(1, n // GATHER, -(-held // OCTETS))
    texts = (base.join(needed, (base["key"] == needed["key"]) & base["doc_id"].eqNullSafe(needed["rep"]))
             .groupBy("node", "label", "size", "blocks").agg(F.any_value("text").alias("text")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (texts.withColumn("block", own)
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
             .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("label"), F.lit(gathers))).otherwise(F.col("label"))))

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = [_compare(g, key[2], key[3]).assign(large=key[1] > 1) for _, g in part.groupby("label")]
        return pd.concat(out)[["node", "links", "root", "large"]]

    found = cut(dealt.groupBy("task", "blocks", "first", "second")
                .applyInPandas(compare, "node long, links long, root long, large boolean"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = found.filter("not large").select("node", F.col("root").alias("label"))
    wide = found.filter("large and root <> node").select(F.col("node").alias("a"), F.col("root").alias("b"))
    if not wide.isEmpty():
        groups = groups.unionByName(components(wide))
    named = (classes.drop("bands", "octets").join(links, "node", "left").join(groups, "node", "left")
             .withColumn("label", F.coalesce("label", "node")).withColumn("links", F.coalesce("links", F.lit(0).cast("long"))))
    named = cut(named)
    least = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    result = named.join(least, "label").select("key", "rep", "size", "links", "class_id")
    return (base.select("doc_id", "key").join(result, "key")
            .select("doc_id", "class_id", F.col("rep").alias("rep_id"),
                    (F.col("links") + F.col("size") - 1).alias("n_links"), F.col("key").alias("text_key")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, the one with the least id (of
    rows without any id in their group, one per text)."""
    marks = cut(join(docs, id_col, text_col))
    keep = marks.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", F.col("text_key").alias("key"))
    return keep_once(docs, keep, id_col, _key(text_of(text_col)))
