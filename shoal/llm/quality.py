"""Quality classifier: interpolated modified Kneser-Ney over words.

A document is a sequence of words (runs of letters and digits, and runs of
other marks).  Its model is a word bigram model, interpolated with the word
unigrams and these with a spelling model, so that an unknown word costs what
its letters cost.  All counts of all trusted texts are tables sharded by
hashed n-gram and grow with the text; no table of words is gathered or
broadcast.  Documents are dealt into chunks.  The distinct bigrams and words of
a chunk are sent to their shards, which answer with their counts, and the
chunk's documents are summed from these.  Keys travel as sorted arrays, the
counts stay in their buckets, and chunks are scored in several jobs, so that
only a part of all bigrams is on disk at a time.

The spelling model is of order ``ORDER`` over ``SYMBOLS`` hashed characters
(code point modulo SYMBOLS - 1, so that neighbours in any script differ).  It
has at most SYMBOLS**ORDER entries and is broadcast.

Every score is held out: texts fall into two folds by their hash, and a text is
scored by the counts of the other fold, trusted or not.  The fold is the
lowest bit of every key.  A fold whose other has no trusted text has
no scores.

A document's score is the mean of -log2 p(word | word before), the logarithm
of its perplexity, less ``MARGIN`` standard errors of that mean, so that a
short text is not condemned by a few odd words.  A document is rejected when
its score exceeds the ``QUANTILE`` of the trusted documents of its language.
A language with fewer than 1 / (1 - quantile) of them would be judged by its
largest trusted score; its limit is its mean and the quantile of the distances
of trusted documents, of all languages, from their language's mean.  Languages
with fewer than ``MIN_TRUSTED`` take the quantile of all languages together.
Quantiles come from histograms with a bin width of 0.001 bits: exact to a bin,
and no language is one task's work.

Null texts and texts without words have no perplexity and are kept; null
languages are a language of their own; a document labelled more than once is
trusted only if all its labels say so; without any trusted document nothing is
rejected.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import cut, evict, resident, shared_dir, ship, small, strings, sweep, text_of, unused
from shoal.session import remove

ORDER, SYMBOLS = 4, 64
QUANTILE, MARGIN, MIN_TRUSTED = 0.995, 2.0, 20
BIN = 0.001
CHUNK = 1 << 21
#: Octets of text for a task that counts, a shard of counts and a chunk scored at once; jobs in which trusted texts are picked, and texts scored.
TASK_TEXT, SHARD_TEXT, CHUNK_TEXT, PICKS, ROUNDS = 64 << 20, 16 << 20, 6 << 20, 4, 12

_WORD = re.compile(r"\w+|[^\w\s]+")
_START = np.uint64(0x243F6A8885A308D3)


def symbols(text: str) -> np.ndarray:
    """Hashed characters; 0 marks a text's start."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return (codes % (SYMBOLS - 1) + 1).astype(np.int32)


def grams(text: str) -> np.ndarray:
    """Number of the n-gram that ends at each character."""
    s = np.concatenate([np.zeros(ORDER - 1, dtype=np.int32), symbols(text)])
    n = len(s) - ORDER + 1
    out = np.zeros(n, dtype=np.int32)
    for k in range(ORDER):
        out = out * SYMBOLS + s[k:k + n]
    return out


def _pieces(texts):
    """Texts' n-gram numbers, gathered to arrays of about CHUNK."""
    held, size = [], 0
    for t in texts:
        g = grams(t)
        held.append(g)
        size += len(g)
        if size >= CHUNK:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose every label is quality 1.  Toxicity is another judgement:
    well-written toxic text is not low quality, so it neither leaves the
    trusted set nor is aimed at."""
    return (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).filter("q = 1").select("doc_id"))


def count_grams(texts: DataFrame) -> DataFrame:
    """``gram, n`` over all rows of ``texts`` (one column ``text``)."""
    def run(batches):
        evict()
        for b in batches:
            for g in _pieces(strings(b.column(0))):
                found, n = np.unique(g, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["gram", "n"])

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, start=1))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    found = {r.n: r.k for r in counts.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    return _discounts_of(*(found.get(k, 0) for k in (1, 2, 3, 4)))


def _order(counts: DataFrame) -> DataFrame:
    """``gram, alpha, gamma`` of one order: the discounted share of the
    n-gram in its context, and the mass its context leaves to the lower
    order."""
    d1, d2, d3 = _discounts(counts)
    discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    kept = counts.select("gram", "n", F.expr(f"gram div {SYMBOLS}").alias("context"), discount.alias("d"))
    contexts = kept.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
    return (kept.join(contexts, "context")
            .select("gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("alpha"),
                    (F.col("held") / F.col("total")).alias("gamma")))


def train(texts: DataFrame) -> list | None:
    """Tables of every order, highest first, as (gram, alpha, gamma) arrays;
    at most SYMBOLS**order rows each."""
    counts = cut(count_grams(texts))
    if counts.isEmpty():
        return None
    model = []
    for k in range(ORDER, 0, -1):
        rows = _order(counts).toPandas()
        model.append((rows["gram"].to_numpy(np.int32), rows["alpha"].to_numpy(np.float32), rows["gamma"].to_numpy(np.float32)))
        if k > 1:  # lower orders count the distinct symbols before
            counts = cut(counts.groupBy(F.expr(f"gram % {SYMBOLS ** (k - 1)}").alias("gram"))
                         .agg(F.count(F.lit(1)).alias("n")))
    return model


def bits_table(model: list) -> np.ndarray:
    """-log2 p of every n-gram number."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS, dtype=np.float32)
    for k, (gram, alpha, gamma) in enumerate(reversed(model), start=1):
        contexts = SYMBOLS ** (k - 1)
        left = np.ones(contexts, dtype=np.float32)
        left[gram // SYMBOLS] = gamma
        lower = p.reshape(-1, SYMBOLS)  # by the context without its first symbol
        if k == 1:
            p = left[0] * lower[0]
        else:
            p = (left.reshape(SYMBOLS, -1)[:, :, None] * lower[None, :, :]).reshape(-1)
        p[gram] += alpha
    np.maximum(p, 1e-12, out=p)
    np.log2(p, out=p)
    return np.negative(p, out=p)


def spelling_bits(words: list[str], table: np.ndarray) -> np.ndarray:
    """Bits of each word and the space after it.  It starts after a space
    whose own past is unknown, so the model backs off to the word's part."""
    length = np.array([len(w) for w in words]) + 1
    s = symbols("".join(f"\0\0 {w} " for w in words))
    ends = np.cumsum(length + 3)
    for k in (0, 1):
        s[ends - length - 3 + k] = 0
    s = np.concatenate([np.zeros(ORDER - 1, dtype=np.int32), s])
    n = len(s) - ORDER + 1
    number = np.zeros(n, dtype=np.int32)
    for k in range(ORDER):
        number = number * SYMBOLS + s[k:k + n]
    upto = np.concatenate([[0.0], np.cumsum(table[number], dtype=np.float64)])
    return upto[ends] - upto[ends - length]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _keys(h: np.ndarray, fold: np.ndarray) -> np.ndarray:
    return ((_mixed(h) & ~np.uint64(1)) | fold)


def pair_keys(c: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Key of each bigram, from those of its context and its word."""
    return (_mixed(_mixed(c) + np.uint64(3) * w) & ~np.uint64(1)) | (w & np.uint64(1))


def bigrams(texts: list[str], folds: list[int]) -> tuple:
    """Distinct bigrams and words of the texts, each in its text's fold: the
    texts' numbers of words, the bigram of every word in a row, the bigrams' keys,
    ascending, with the numbers of their contexts and words, the words' keys,
    ascending, and their spellings (None for the start)."""
    found = [_WORD.findall(t) for t in texts]
    length = np.array([len(f) for f in found], dtype=np.int64)
    words = np.array([w for f in found for w in f], dtype=object)
    code, spelling = pd.factorize(words)
    size = 2 * (len(spelling) + 1)
    hashed = np.append(pd.util.hash_array(spelling, categorize=False) if len(spelling) else np.zeros(0, np.uint64), _START)
    keys = _keys(np.repeat(hashed, 2), np.tile(np.arange(2, dtype=np.uint64), len(hashed)))
    fold = np.repeat(np.array(folds, dtype=np.int64), length)
    w = 2 * code.astype(np.int64) + fold
    c, starts = np.roll(w, 1), (np.cumsum(length) - length)[length > 0]
    c[starts] = size - 2 + fold[starts]
    which, pair = pd.factorize(c * size + w)
    c, w = pair // size, pair % size
    g = pair_keys(keys[c], keys[w])
    order = np.argsort(g)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    which, c, w = number[which], c[order], w[order]
    used = np.zeros(size, dtype=bool)
    used[c] = used[w] = True
    at = np.flatnonzero(used)
    at = at[np.argsort(keys[at])]
    number = np.empty(size, dtype=np.int64)
    number[at] = np.arange(len(at))
    return length, which, g[order], number[c], number[w], keys[at], np.append(spelling, None)[at // 2]


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as their count and then byte by byte, highest first, so
    that what sorted or small ones share compresses."""
    planes = np.asarray(x).astype(">u8").view(np.uint8).reshape(-1, 8).T
    used = (int(np.max(x)).bit_length() + 7) // 8 if len(x) else 0
    return np.int64(len(x)).tobytes() + planes[8 - used:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    planes = np.frombuffer(data, np.uint8, offset=8).reshape(-1, n) if n else np.zeros((0, 0), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, 8 - len(planes):] = planes.T
    return out.view(">u8").reshape(-1).astype(np.uint64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key, by ranges: sorted keys have sorted shards."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _dealt(keys: np.ndarray, shards: int):
    """Shards of sorted keys, each with its stretch."""
    found, first = np.unique(shard_of(keys, shards), return_index=True)
    return zip(found.tolist(), np.split(np.arange(len(keys)), first[1:])) if len(keys) else ()


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple:
    """Distinct keys, where each is first found, and its summed counts."""
    found, first, back = np.unique(keys, return_index=True, return_inverse=True)
    return found, first, *(np.bincount(back, weights=n, minlength=len(found)).astype(np.uint64) for n in counts)


_COUNTS = ["t", "n1", "n2", "more", "cont"]
_MODEL = f"home long, shard long, kind int, keys binary, {', '.join(f'{c} binary' for c in _COUNTS)}, stats array<long>"
_STATE, _PAIRS, _PARTS, _WORDS = -1, 0, 1, 2
_SCORED = "doc_id long, th long, lang string, n_symbols long, bits double, score double"


def _gathered(batch: pa.RecordBatch):
    """Texts and folds of a batch, as many as have about CHUNK_TEXT characters."""
    texts, folds, size = [], [], 0
    for t, f in zip(strings(batch.column(0)), strings(batch.column(1))):
        texts.append(t)
        folds.append(f)
        size += len(t)
        if size >= CHUNK_TEXT:
            yield texts, folds
            texts, folds, size = [], [], 0
    if texts:
        yield texts, folds


def _stats(n: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4, and 3 or more, and the sum."""
    return [*(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n >= 3).sum()), int(n.sum())]


def _model_schema() -> pa.Schema:
    return pa.schema([("home", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()),
                      *((c, pa.binary()) for c in _COUNTS), ("stats", pa.list_(pa.int64()))])


def count_words(texts: DataFrame, shards: int) -> DataFrame:
    """Bigrams of all rows of ``texts`` (``text, fold``), counted: a row per
    shard with the keys and counts of its bigrams, and for every shard that
    words belong to, what these add to them as contexts and as words."""
    sent = pa.schema([("home", pa.int64()), *((x, pa.binary()) for x in ("c", "w", "ci", "wi", "n"))])

    def merged(held):
        g, c, w, n = (np.concatenate(x) for x in zip(*held))
        g, first, n = _summed(g, n)
        return g, c[first], w[first], n

    def blobs(g, c, w, n):
        for home, at in _dealt(g, shards):
            at = at[np.lexsort((w[at], c[at]))]
            (cs, ci), (ws, wi) = (np.unique(x[at], return_inverse=True) for x in (c, w))
            yield pa.Table.from_pylist([{"home": home, "c": packed(cs), "w": packed(ws), "ci": packed(ci), "wi": packed(wi),
                           "n": packed(n[at])}], schema=sent).to_batches()[0]

    def count(batches):
        evict()
        held, size = [], 0
        for b in batches:
            for texts, folds in _gathered(b):
                _, which, g, c, w, h, _ = bigrams(texts, folds)
                held.append((g, h[c], h[w], np.bincount(which, minlength=len(g))))
                size += len(g)
                if size >= CHUNK:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size >= CHUNK * 3 // 4:
                        yield from blobs(*held[0])
                        held, size = [], 0
        if size:
            yield from blobs(*merged(held))

    def add(key, rows):
        found = [[unpacked(x) for x in r.values()] for r in rows.select(["c", "w", "ci", "wi", "n"]).to_pylist()]
        c, w = (np.concatenate([r[k][r[k + 2].astype(np.int64)] for r in found]) for k in (0, 1))
        g, first, n = _summed(pair_keys(c, w), np.concatenate([r[4] for r in found]))
        c, w, home = c[first], w[first], key[0].as_py()
        out = [{"home": home, "shard": home, "kind": _PAIRS, "keys": packed(g), "t": packed(n), "stats": _stats(n)}]
        h, back = np.unique(np.concatenate([c, w]), return_inverse=True)
        after, before = back[:len(c)], back[len(c):]
        parts = [np.bincount(after, weights=x, minlength=len(h)) for x in (n, n == 1, n == 2, n >= 3)]
        parts.append(np.bincount(before, minlength=len(h)))
        for shard, at in _dealt(h, shards):
            out.append({"home": home, "shard": shard, "kind": _PARTS, "keys": packed(h[at]),
                        **{x: packed(v[at]) for x, v in zip(_COUNTS, parts)}})
        return pa.Table.from_pylist(out, schema=_model_schema())

    return (texts.mapInArrow(count, "home long, c binary, w binary, ci binary, wi binary, n binary")
            .repartition(shards, "home").groupBy("home").applyInArrow(add, _MODEL))


def _add_parts(parts: DataFrame, shards: int) -> DataFrame:
    """Counts of words, each in its shard."""
    def add(key, rows):
        found = [[unpacked(x) for x in r.values()] for r in rows.select(["keys", *_COUNTS]).to_pylist()]
        h, _, *n = _summed(*(np.concatenate(x) for x in zip(*found)))
        stats = [x for f in (0, 1) for x in _stats(n[4][(h & np.uint64(1)) == f])]
        return pa.Table.from_pylist([{"home": key[0].as_py(), "shard": key[0].as_py(), "kind": _WORDS, "keys": packed(h),
                                      **{x: packed(v) for x, v in zip(_COUNTS, n)}, "stats": stats}], schema=_model_schema())

    return (parts.select(F.col("shard").alias("home"), "keys", *_COUNTS).repartition(shards, "home")
            .groupBy("home").applyInArrow(add, _MODEL))


def train_words(texts: DataFrame, shards: int, name: str, path: str) -> tuple:
    """Writes table ``name`` at ``path``, bucketed by ``home``: bigrams and
    words with their counts.  Returns the discounts of both orders, and by fold
    the sum of the words' counts and the mass left to spellings."""
    spark = texts.sparkSession

    def store(df: DataFrame) -> None:
        (df.write.mode("append").option("compression", "zstd").option("path", path).partitionBy("kind")
         .bucketBy(shards, "home").format("parquet").saveAsTable(name))
        sweep(spark)

    store(count_words(texts, shards))
    store(_add_parts(spark.table(name).filter(f"kind = {_PARTS}"), shards))
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (kind = {_PARTS})")
    remove(spark, f"{path}/kind={_PARTS}")

    def stats(kind: int, size: int) -> list[int]:
        one = spark.table(name).filter(f"kind = {kind}")
        return [x or 0 for x in one.agg(*(F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(size))).first()]

    two, one = stats(_PAIRS, 6), stats(_WORDS, 12)
    d2, d1 = _discounts_of(*two[:4]), _discounts_of(*(one[k] + one[k + 6] for k in range(4)))
    folds = one[:6], one[6:]
    return (d2, d1, [f[5] for f in folds],
            [(d1[0] * f[0] + d1[1] * f[1] + d1[2] * f[4]) / f[5] if f[5] else 0.0 for f in folds])


def _off(n: np.ndarray, d: tuple) -> np.ndarray:
    return np.choose(np.minimum(n, 3).astype(np.int64), (0.0, *d))


_ASKED = "home long, chunk long, kind int, keys binary, state array<binary>"


def _ask(texts: DataFrame, models, key: str, shards: int) -> DataFrame:
    """Of each chunk of texts the distinct bigrams and words, asked of their
    shards, and its state: the rows, their bigrams, and the spellings' bits."""
    schema = pa.schema([("home", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()),
                        ("state", pa.list_(pa.binary()))])

    def ask(name, rows):
        bits = resident(key, lambda: [m and bits_table(m) for m in models.value])
        chunk, folds = name[0].as_py(), rows["fold"].to_pylist()
        texts = [t if bits[f] is not None else "" for t, f in zip(strings(rows["text"]), folds)]
        length, which, g, c, w, h, words = bigrams(texts, folds)
        spelled = np.zeros(len(h))
        for f in (0, 1):
            some = np.flatnonzero((words != None) & ((h & np.uint64(1)) == f))  # noqa: E711
            if len(some):
                spelled[some] = spelling_bits(words[some].tolist(), bits[f])
        own = rows.select(["doc_id", "th", "lang", "n_symbols", "fold"])
        kept = pa.BufferOutputStream()
        with pa.ipc.new_stream(kept, own.schema) as out:
            out.write_table(own)
        state = [kept.getvalue().to_pybytes(), packed(length), packed(which), packed(w), packed(c), spelled.tobytes()]
        out = [{"home": chunk % shards, "chunk": chunk, "kind": _STATE, "state": state}]
        for kind, keys in ((_PAIRS, g), (_WORDS, h)):
            out += [{"home": s, "chunk": chunk, "kind": kind, "keys": packed(keys[k])} for s, k in _dealt(keys, shards)]
        return pa.Table.from_pylist(out, schema=schema)

    return texts.groupBy("chunk").applyInArrow(ask, "home long, chunk long, kind int, keys binary, state array<binary>")


def _answer(model: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """Counts of the keys asked of each shard, in their order; states pass."""
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()),
                        *((c, pa.binary()) for c in _COUNTS), ("state", pa.list_(pa.binary()))])

    def answer(name, known, asked):
        held = {r["kind"]: (unpacked(r["keys"]), {c: unpacked(r[c]) for c in _COUNTS if r[c] is not None})
                for r in known.to_pylist()}
        out = []
        for r in asked.to_pylist():
            row = {"chunk": r["chunk"], "shard": name[0].as_py(), "kind": r["kind"], "state": r["state"]}
            if r["kind"] != _STATE:
                keys = unpacked(r["keys"])
                have, counts = held.get(r["kind"], (keys[:0], {}))
                at = np.searchsorted(have, keys)
                at[at == len(have)] = 0
                hit = have[at] == keys if len(have) else np.zeros(len(keys), dtype=bool)
                row |= {c: packed(np.where(hit, counts[c][at], 0) if len(have) else np.zeros(len(keys), dtype=np.uint64))
                        for c in (_COUNTS[:1] if r["kind"] == _PAIRS else _COUNTS)}
            out.append(row)
        return pa.Table.from_pylist(out, schema=schema)

    columns = ", ".join(f"{c} binary" for c in _COUNTS)
    return (model.select("home", "kind", "keys", *_COUNTS).groupBy("home")
            .cogroup(asked.repartition(shards, "home").groupBy("home"))
            .applyInArrow(answer, f"chunk long, shard long, kind int, {columns}, state array<binary>"))


def _sum_up(answers: DataFrame, learnt: tuple) -> DataFrame:
    """Scores of the rows of each chunk, from its state and its answers."""
    d2, d1, total, rest = learnt

    def sum_up(name, table):
        rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["shard"]))
        state = rows[0]["state"]
        own = pa.ipc.open_stream(state[0]).read_all()
        length, which, w, c = (unpacked(x).astype(np.int64) for x in state[1:5])
        spelled = np.frombuffer(state[5])

        def counts(kind, column):
            found = [unpacked(r[column]) for r in rows if r["kind"] == kind]
            return np.concatenate(found).astype(np.float64) if found else np.zeros(0)

        n, (t, n1, n2, more, cont) = counts(_PAIRS, "t"), (counts(_WORDS, c) for c in _COUNTS)
        doc = np.repeat(np.arange(len(length)), length)
        fold = np.zeros(len(t), dtype=np.int64)  # of either word of a bigram it is its text's
        fold[w[which]] = own["fold"].to_numpy()[doc]
        low = (cont - _off(cont, d1)) / np.maximum(total, 1)[fold] + np.array(rest)[fold] * np.exp2(-spelled)
        left = np.where(t > 0, (d2[0] * n1 + d2[1] * n2 + d2[2] * more) / np.maximum(t, 1), 1.0)
        p = np.where(n > 0, (n - _off(n, d2)) / np.maximum(t, 1)[c], 0.0) + left[c] * low[w]
        b = -np.log2(np.maximum(p, 1e-300))[which]
        some = (length > 0) & (np.array(total)[own["fold"].to_numpy()] > 0)
        size = np.maximum(length, 1)
        bits, squares = (np.bincount(doc, weights=x, minlength=len(length)) / size for x in (b, b * b))
        score = bits - MARGIN * np.sqrt(np.maximum(squares - bits * bits, 0.0) / size)
        return pa.table([*own.select(["doc_id", "th", "lang", "n_symbols"]).columns,
                         *(pa.array(x, mask=~some) for x in (bits, score))],
                        names=["doc_id", "th", "lang", "n_symbols", "bits", "score"])

    return answers.groupBy("chunk").applyInArrow(sum_up, _SCORED)


def fold_of(text):
    """Fold of a text: copies share it."""
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def score(docs: DataFrame, models: list, learnt: tuple, name: str, shards: int, octets: int, path: str, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, th, lang, n_symbols, bits, score``, one row per input row,
    stored at ``path``; ``th`` is the text's hash.  A text is scored by the other
    fold's counts, which are in table ``name``.

    Texts are dealt into chunks.  A chunk asks each shard once for what it needs
    of it, whatever number of its texts do.  Chunks are scored in ``ROUNDS`` jobs,
    each of which leaves only scores on disk."""
    spark = docs.sparkSession
    text, tables, key = text_of(text_col), spark.sparkContext.broadcast(models), uuid.uuid4().hex
    chunks = max(1, math.ceil(octets / CHUNK_TEXT))
    rounds = min(ROUNDS, chunks)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"),
                        F.col(lang_col).cast("string").alias("lang"), F.length(text).cast("long").alias("n_symbols"),
                        (1 - fold_of(text)).alias("fold"), text.alias("text"))
    keyed = keyed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(chunks)))
    model = spark.table(name).filter(F.col("kind").isin(_PAIRS, _WORDS))
    for k in range(rounds):
        some = keyed.filter(F.col("chunk") % rounds == k).repartition(math.ceil(chunks / rounds), "chunk")
        _sum_up(_answer(model, _ask(some, tables, key, shards), shards), learnt).write.mode("append").parquet(path)
        sweep(spark)
    return spark.read.schema(_SCORED).parquet(path)


def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``lang, threshold`` from trusted documents' scores, and one row with
    ``everywhere`` true for all languages together."""
    bins = (scored.filter("score is not null").select("lang", F.floor(F.col("score") / BIN).alias("bin"))
            .groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n")))
    enough = math.ceil(1 / (1 - quantile) - 1e-9)
    centre = (bins.groupBy("lang").agg(F.sum("n").alias("total"), (F.sum(F.expr("n * (bin + 0.5)")) / F.sum("n")).alias("mean"))
              .filter(f"total >= {MIN_TRUSTED}").select(F.col("lang").alias("__lang"), "total", "mean"))
    away = (bins.join(centre, F.col("lang").eqNullSafe(F.col("__lang")))
            .groupBy(F.floor(F.col("bin") + 0.5 - F.col("mean")).alias("bin")).agg(F.sum("n").alias("n")))
    none = F.lit(None).cast("string").alias("lang")
    both = (bins.select(F.lit("own").alias("kind"), "lang", "bin", "n")
            .unionByName(bins.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit("all").alias("kind"), none, "bin", "n"))
            .unionByName(away.select(F.lit("away").alias("kind"), none, "bin", "n")))
    group = Window.partitionBy("kind", "lang")
    found = cut(both.withColumn("upto", F.sum("n").over(group.orderBy("bin")))
                .withColumn("total", F.sum("n").over(group))
                .filter(F.col("upto") >= F.ceil(F.col("total") * quantile))
                .groupBy("kind", "lang", "total").agg(((F.min("bin") + 1) * BIN).alias("threshold")))
    tail = found.filter("kind = 'away'").select(F.col("threshold").alias("tail"))
    few = (centre.filter(f"total < {enough}").crossJoin(F.broadcast(tail))
           .select(F.lit(False).alias("everywhere"), F.col("__lang").alias("lang"),
                   (F.col("mean") * BIN + F.col("tail")).alias("threshold")))
    return (found.filter(f"kind = 'all' or kind = 'own' and total >= {enough}")
            .select((F.col("kind") == "all").alias("everywhere"), "lang", "threshold").unionByName(few))


def _fitted(docs: DataFrame, labels: DataFrame, quantile: float, id_col: str, text_col: str, lang_col: str):
    """Scores of all rows, thresholds by language and overall; None without
    trusted text.

    Trusted texts are picked by a sort-merge join at every size: the table of
    ids grows with the labels, and a plan that broadcasts it would only hold
    for a small corpus.  They are read three times, so they are stored; the join
    is made in ``PICKS`` jobs, each of which leaves only these on disk."""
    spark = docs.sparkSession
    ship(spark)
    ids = cut(trusted_ids(labels))
    base, name = f"{shared_dir(spark).rstrip('/')}/quality-{uuid.uuid4().hex}", f"shoal_words_{uuid.uuid4().hex}"
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    octets = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PICKS))
    for k in range(PICKS):
        (own.filter(part == k).join(ids.filter(part == k).hint("merge"), "doc_id", "left_semi")
         .select("text", fold_of(F.col("text")).alias("fold"))
         .write.mode("append").option("compression", "zstd").parquet(f"{base}/trusted"))
        sweep(spark)
    texts = spark.read.schema("text string, fold int").parquet(f"{base}/trusted")
    try:
        models = [train(texts.filter(F.col("fold") == k).select("text")) for k in (0, 1)]
        if models == [None, None]:
            return None
        shards = max(1, math.ceil(octets / SHARD_TEXT))
        tasks = max(8, math.ceil(octets / TASK_TEXT))  # larger ones send a bigram less often
        learnt = train_words(texts.coalesce(tasks), shards, name, f"{base}/words")
        remove(spark, f"{base}/trusted")
        scored = score(docs, models, learnt, name, shards, octets, f"{base}/scores", id_col, text_col, lang_col)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, f"{base}/words")
        remove(spark, f"{base}/trusted")
    borders = cut(thresholds(scored.join(ids, "doc_id", "left_semi"), quantile))
    overall = borders.filter("everywhere").first()
    overall = F.lit(overall.threshold if overall else None).cast("double")
    own = borders.filter("not everywhere").select(F.col("lang").alias("__lang"), F.col("threshold").alias("__own"))
    return (scored.join(small(own), F.col("lang").eqNullSafe(F.col("__lang")), "left")
            .withColumn("threshold", F.coalesce("__own", overall))
            .withColumn("kept", F.col("score").isNull() | F.col("threshold").isNull() | (F.col("score") <= F.col("threshold"))))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: ``doc_id, lang, n_symbols, perplexity, score,
    threshold, kept``."""
    fitted = _fitted(docs, labels, quantile, id_col, text_col, lang_col)
    if fitted is None:
        nothing = F.lit(None).cast("double")
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                           F.length(text_of(text_col)).cast("long").alias("n_symbols"), nothing.alias("perplexity"),
                           nothing.alias("score"), nothing.alias("threshold"), F.lit(True).alias("kept"))
    return fitted.select("doc_id", "lang", "n_symbols", F.pow(F.lit(2.0), "bits").alias("perplexity"), "score",
                         "threshold", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, id_col: str = "doc_id",
              text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, all columns."""
    fitted = _fitted(docs, labels, quantile, id_col, text_col, lang_col)
    if fitted is None:
        return docs
    lang = F.col(f"`{lang_col}`").cast("string")
    own_id, own_th, own_lang = unused(docs, "__id", "__th", "__lang")
    out = cut(fitted.filter("not kept").select(F.col("doc_id").alias(own_id), F.col("th").alias(own_th),
                                               F.col("lang").alias(own_lang)).distinct())
    same = (F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own_id)) & lang.eqNullSafe(F.col(own_lang))
            & (F.xxhash64(text_of(text_col)) == F.col(own_th)))
    return docs.join(small(out), same, "left_anti")
