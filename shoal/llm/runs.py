"""Periodic run detection by Baier grouping.

A run is a maximal stretch of words with smallest period q.  The longest
Lyndon word that starts at a position, under the order of the words or under
its inverse, is a root of every run the position opens a root of; phase one
of Baier's suffix sorter groups the suffixes of a text by just that word, so
its group lengths are the Lyndon array, with no suffix array behind it.
Roots that are repeated at once are extended to both sides by longest common
extensions (whole words are compared, stretch by stretch of doubling size),
and a root inside a run already found with its length is passed over.

Only runs of at least ``max(LEAST, EXPONENT * q)`` words are asked for, and
``stretches`` leaves out beforehand what no such run can hold: inside one,
past the first q words, every word occurred at most q words before.  What is
left is a superset of all runs, and extension reads the whole text.

A text is one row and one task's work, in memory linear in its words; nothing
is shuffled.  Words are compared whole, by their number in the text, so
nothing rests on hashes.

Words are runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  Null texts are empty and have no runs; a row
with a null id is never rebuilt; repeated rows stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import evict, ship, strings, text_of

LEAST, EXPONENT = 6, 4

_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Run = tuple[int, int, int]  # start, length, period


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def lyndon_lengths(word: list[int], n_words: int) -> list[int]:
    """Length of the longest Lyndon word starting at each position, by
    phase one of Baier's sorter.  ``word`` holds ranks below ``n_words``.

    Suffixes stand in groups, in ascending order of a common prefix.  Groups
    are taken from the last to the first; for each of a group's suffixes the
    nearest suffix before it of a lower group is sought, and those found move
    behind the rest of their own group, the more often found the farther:
    their prefix is lengthened by that of the group that found them.  When a
    group is taken its prefix is final."""
    n = len(word)
    counts = [0] * (n_words + 1)
    for w in word:
        counts[w + 1] += 1
    for w in range(n_words):
        counts[w + 1] += counts[w]
    group = [counts[w] for w in word]        # of a suffix: first place of its group
    fill, order, place = counts[:], [0] * n, [0] * n
    for i, w in enumerate(word):
        at = fill[w]
        order[at], place[i], fill[w] = i, at, at + 1
    size = [0] * n                           # of a group, at its first place
    for w in range(n_words):
        if counts[w + 1] > counts[w]:
            size[counts[w]] = counts[w + 1] - counts[w]
    length = [1] * n                         # of a group's prefix, at its first place
    lower = [-1] * n                         # nearest suffix before of a lower group
    out = [0] * n
    end = n
    while end:
        first = group[order[end - 1]]
        own = length[first]
        found: dict[int, int] = {}
        # ascending positions, so that a suffix of this very group has its pointer
        for i in (sorted(order[first:end]) if end - first > 1 else (order[first],)):
            out[i] = own
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        end = first
        if not found:
            continue
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in found.items():
            moved.setdefault((times, group[j]), []).append(j)
        for times, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            some = moved[times, old]
            if len(some) == size[old]:       # the whole rest of the group
                length[old] += times * own
                continue
            size[old] -= len(some)
            border = old + size[old]
            for j in some:
                group[j] = border
            behind = [i for i in order[border:border + len(some)] if group[i] != border]
            for i, j in zip(behind, [j for j in some if place[j] < border]):
                a, b = place[j], place[i]
                order[a], order[b], place[i], place[j] = i, j, a, b
            size[border], length[border] = len(some), length[old] + times * own
    return out


def stretches(number: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int]]:
    """(start, end) of disjoint stretches; every run lies inside one.

    Past its first q words, a run of period q is a stretch of at least
    (exponent - 1) * q words that each occurred at most q words before.  So
    words farther from their last occurrence than the length of their
    stretch allows part it, until none does."""
    n = len(number)
    by_word = np.argsort(number, kind="stable")
    again = np.flatnonzero(number[by_word[1:]] == number[by_word[:-1]])
    back = np.full(n, n + 1, dtype=np.int64)
    back[by_word[again + 1]] = by_word[again + 1] - by_word[again]
    inside = back <= n
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
        start, end = edge[::2], edge[1::2]
        size = end - start
        if not len(size):
            return []
        limit = np.where(size >= max(least - 1, exponent - 1), size // (exponent - 1), 0)
        of = np.repeat(limit, size)
        at = np.flatnonzero(inside)
        out = at[back[at] > of]
        if not len(out):
            break
        inside[out] = False
    merged: list[tuple[int, int]] = []
    for a, b, q in zip(start.tolist(), end.tolist(), limit.tolist()):
        a = max(a - q, 0)
        if merged and a <= merged[-1][1]:
            a = min(a, merged[-1][0])
            merged.pop()
        merged.append((a, b))
    return merged


def _ahead(number: np.ndarray, i: int, j: int) -> int:
    """Length of the longest common extension of two positions, i < j."""
    n, t, step = len(number), 0, 16
    while j + t < n:
        k = min(step, n - j - t)
        differ = number[i + t:i + t + k] != number[j + t:j + t + k]
        at = int(differ.argmax())
        if differ[at]:
            return t + at
        t, step = t + k, 2 * step
    return t


def find(number: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """Every run of at least ``max(least, exponent * period)`` words of a
    text given as word numbers, by start and period; exponent 3 at least."""
    assert exponent >= 3, "a run must repeat its root wherever it begins"
    n, found, flipped = len(number), set(), number[::-1]
    for a, b in stretches(number, least, exponent):
        kinds, rank = np.unique(number[a:b], return_inverse=True)
        for ranks in (rank, len(kinds) - 1 - rank):
            root = np.array(lyndon_lengths(ranks.tolist(), len(kinds)), dtype=np.int64)
            second = np.arange(b - a) + root
            at = np.flatnonzero(second < b - a)
            at = at[root[second[at]] == root[at]]
            seen: dict[int, tuple[int, int]] = {}
            for i, q in zip((at + a).tolist(), root[at].tolist()):
                if q in seen and seen[q][0] <= i and i + 2 * q <= seen[q][1]:
                    continue
                start = i - _ahead(flipped, n - i - q, n - i)
                end = i + q + _ahead(number, i, i + q)
                seen[q] = (start, end)
                if end - start >= max(least, exponent * q):
                    found.add((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbers(some: list[str]) -> np.ndarray:
    """The words by number of first occurrence."""
    known: dict[str, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in some], dtype=np.int64)


def collapsed(some: list[str], found: list[Run]) -> str:
    """The words less those any run holds after its first period."""
    if found:
        keep = np.ones(len(some), dtype=bool)
        for start, length, period in found:
            keep[start + period:start + length] = False
        some = [some[k] for k in np.flatnonzero(keep)]
    return " ".join(some)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
           exponent: int = EXPONENT) -> DataFrame:
    """``doc_id, runs, collapsed``, one row per input row: the runs (word
    number of the start, length and period in words) by start and period, and
    the text without the repetitions, its words joined by one space."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()
        for b in batches:
            for at in range(0, len(b), 256):
                some = b.slice(at, 256)
                runs, texts = [], []
                for text in strings(some.column(1)):
                    ws = words(text)
                    found = find(numbers(ws), least, exponent) if len(ws) >= least else []
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    texts.append(collapsed(ws, found))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(runs, _RUNS), pa.array(texts, pa.string())],
                                                 ["doc_id", "runs", "collapsed"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"))


def repeat_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: every tenth text by the CRC h of its id, of n > 0
    words, has each word i >= a replaced by its word a + (i - a) % p, where
    g = h div 10, a = g % n and p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), h.alias("h"))
    picked = F.col("h").isNotNull() & (F.col("h") % 10 == 0)
    w = F.when(picked, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    planted = (taken.withColumn("w", w).withColumn("g", F.expr("h div 10"))
               .withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
               .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)")))
    made = F.expr("array_join(transform(w, (x, i) -> if(i >= a, w[cast(a + (i - a) % p as int)], x)), ' ')")
    return planted.select("doc_id", F.when(picked & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Of ``detect``'s rows: ``doc_id, n_runs, start, length, period,
    exponent_milli`` (of the run of greatest exponent, the first of several),
    ``runs_sha256, collapsed_sha256``."""
    best = F.expr("aggregate(runs, cast(null as struct<start:long,length:long,period:long>), (b, r) -> "
                  "if(b is null or r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
