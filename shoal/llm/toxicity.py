"""Toxicity: convolutional text classifier over hashed word embeddings.

A text is its lower-cased words.  A word's embedding is the sum of rows of one
table of ``BUCKETS`` rows: two by hashes of the word, so that words share both
by a rare accident only, and one for its first 3 and its first 4 letters, which
its other forms share.  Filters of ``WIDTHS`` words slide over the text, each
keeps its maximum over the whole text (texts are padded, so the empty text has
one too), and a logistic layer turns the maxima into a score.

The network is trained in numpy by Adagrad in one Spark task, on at most
``SAMPLE`` toxic and as many other documents: those of the least hash of their
id, whole texts, one for each id (the least).  At each step half the words are left
out, so that no single one carries a verdict.  The weights, 4 MB whatever the
corpus holds, are broadcast; scoring is one pass over all texts, without a
shuffle, in memory linear in ``CHUNK`` characters or the longest text.

Only rows whose CRC of the id, mod 5, is not 0 are learnt from.  Of those one in
five, by another hash, takes no part in training: their scores give each
language the threshold of best F1 (``flagged``).  A language with fewer than
``MIN_TOXIC`` toxic rows among them takes that of all languages together; where
those are too few it is 0.5.  A language never enters a score, so ``predicted``
(score of 0.5 or more) is the same rule for all.

Null texts are empty, null languages a language of their own; null labels are no
labels; a document labelled more than once is toxic if any label says so; the CRC
of a null id is that of the empty text, 0, so such rows are held out.  Repeated
rows stay.  Without both kinds of labels every score is 0.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import cut, resident, ship, small, strings, text_of

BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 17, 8, 8, (1, 2, 3)
STEMS = (3, 4)
SAMPLE, EPOCHS, BATCH, DROP = 4000, 8, 32, 0.5
RATE, DECAY, STEPS, SEED = 0.1, 1e-5, 1000, 7
MIN_TOXIC, BINS, CHUNK = 20, 1000, 1 << 20

_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def picked(some: list[str]) -> np.ndarray:
    """The rows of each word: two by hashes of it, one by each beginning."""
    h = pd.util.hash_array(np.array(some, dtype=object))
    hashes = [h, h >> np.uint64(40)]
    hashes += [pd.util.hash_array(np.array([f"{n}^{w[:n]}" for w in some], dtype=object)) for n in STEMS]
    return np.stack([x % np.uint64(BUCKETS) for x in hashes], axis=1).astype(np.int32)


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words in a row as numbers into their distinct words, the
    two buckets of each of those, and the number of words of each text.  Number
    0 is no word (padding)."""
    found = [words(t) for t in texts]
    size = np.array([len(f) for f in found], dtype=np.int64)
    flat = np.array([w for f in found for w in f], dtype=object)
    number, kinds = pd.factorize(flat)
    return number.astype(np.int32) + 1, picked(["", *kinds]), size


class Network:
    """Weights: ``table`` (bucket, dim), per width ``filters`` (word of the
    window, dim, filter), ``shift`` and ``weight`` of each maximum, ``bias``."""

    NAMES = ("table", "shift", "weight", "bias", *(f"filters{w}" for w in WIDTHS))

    def __init__(self, **given: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        maxima = FILTERS * len(WIDTHS)
        own = {"table": rng.normal(0, 0.05, (BUCKETS, DIMS)), "shift": np.zeros(maxima), "bias": np.zeros(1),
               "weight": rng.normal(0, 0.3, maxima)}
        own |= {f"filters{w}": rng.normal(0, 0.5, (w, DIMS, FILTERS)) for w in WIDTHS}
        for k in self.NAMES:
            setattr(self, k, np.asarray(given.get(k, own[k]), dtype=np.float32))

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.NAMES})
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Network:
        return cls(**np.load(io.BytesIO(data)))

    def maxima(self, flat: np.ndarray, rows: np.ndarray, size: np.ndarray, where: bool = False):
        """Each text's maximum of every filter (and the windows' first words),
        the laid out words and their embeddings."""
        pad = max(WIDTHS)
        span = size + pad
        end = np.cumsum(span)
        start = end - span
        row = np.zeros(int(end[-1]), dtype=np.int32)
        at = np.arange(len(flat)) + np.repeat(pad * np.arange(len(size)), size)
        row[at] = flat
        emb = self.table[rows].sum(axis=1)
        emb[0] = 0
        tops, places = [], []
        for w in WIDTHS:
            f = getattr(self, f"filters{w}")
            conv = (emb @ f[0])[row]
            for k in range(1, w):
                conv[:-k] += (emb @ f[k])[row[k:]]
                conv[end - k] = -np.inf        # windows over a text's end
            top = np.maximum.reduceat(conv, start, axis=0)
            tops.append(top)
            if where:
                hit = np.where(conv == np.repeat(top, span, axis=0), np.arange(len(row))[:, None], len(row))
                places.append(np.minimum.reduceat(hit, start, axis=0))
        return np.concatenate(tops, axis=1), places, row, emb

    def logits(self, flat: np.ndarray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        tops = self.maxima(flat, rows, size)[0]
        return np.maximum(tops + self.shift, 0) @ self.weight + self.bias[0]

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-self.logits(*buckets(texts)).astype(np.float64)))


def train(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS, steps: int = STEPS) -> Network:
    """A network fitted to the texts by Adagrad, ``BATCH`` at a time, in at
    least so many epochs and steps."""
    net, rng = Network(), np.random.default_rng(SEED)
    flat, rows, size = buckets(texts)
    begin = np.cumsum(size) - size
    y = np.asarray(toxic, dtype=np.float32)
    past = {k: np.full(getattr(net, k).shape, 1e-6, dtype=np.float32) for k in net.NAMES}

    def step(name: str, grad: np.ndarray, at=slice(None)) -> None:
        value, sums = getattr(net, name), past[name]
        sums[at] += grad * grad
        value[at] -= RATE * grad / np.sqrt(sums[at])

    parts = max(1, -(-len(texts) // BATCH))
    for _ in range(max(epochs, -(-steps // parts))):
        for some in np.array_split(rng.permutation(len(texts)), parts):
            own = np.concatenate([flat[begin[k]:begin[k] + size[k]] for k in some])
            own[rng.random(len(own)) < DROP] = 0
            kinds, own = np.unique(np.append(own, 0), return_inverse=True)   # 0 first: padding
            tops, places, row, emb = net.maxima(own[:-1].astype(np.int32), rows[kinds], size[some], where=True)
            act = np.maximum(tops + net.shift, 0)
            p = 1 / (1 + np.exp(-(act @ net.weight + net.bias[0])))
            err = (p - y[some]) / len(some)
            d_top = np.where(act > 0, err[:, None] * net.weight, 0)
            d_emb = np.zeros_like(emb)
            for n, w in enumerate(WIDTHS):
                f = getattr(net, f"filters{w}")
                d_f, g = np.zeros_like(f), d_top[:, n * FILTERS:(n + 1) * FILTERS]
                for k in range(w):
                    word = row[places[n] + k]                                # text, filter
                    d_f[k] = np.einsum("tf,tfd->df", g, emb[word])
                    np.add.at(d_emb, word, g[:, :, None] * f[k].T[None])
                step(f"filters{w}", d_f)
            step("weight", act.T @ err + DECAY * net.weight)
            step("shift", d_top.sum(axis=0))
            step("bias", np.array([err.sum()], dtype=np.float32))
            d_emb[0] = 0
            used = np.flatnonzero(np.abs(d_emb).sum(axis=1))
            at = rows[kinds[used]].reshape(-1)
            both, back = np.unique(at, return_inverse=True)
            d_table = np.zeros((len(both), DIMS), dtype=np.float32)
            np.add.at(d_table, back, np.repeat(d_emb[used], rows.shape[1], axis=0))
            step("table", d_table, both)
    return net


def remainder(id_col: str = "doc_id") -> Column:
    """CRC of the id as text, mod 5; 0 is held out."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 5


def _trained(id_col: str = "doc_id") -> Column:
    """Of the rows learnt from: not the fifth that calibrates."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(5)) != 0


def learnt(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labelled ids to learn from."""
    return (labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
            .filter(remainder() != 0).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS, steps: int = STEPS) -> bytes | None:
    """Weights of a network trained on ``docs`` (``doc_id, text``); None where
    one kind of label is missing."""
    ship(docs.sparkSession)
    present = docs.select("doc_id").distinct()
    ids = learnt(labels).filter(_trained()).join(present, "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id", F.lit(1)))
    picked_ids = [ids.filter(F.col("toxic") == k).orderBy("h", "doc_id").limit(sample) for k in (True, False)]
    chosen = cut(picked_ids[0].unionByName(picked_ids[1]).drop("h"))
    if chosen.select("toxic").distinct().count() < 2:
        return None
    texts = (docs.join(F.broadcast(chosen), "doc_id")  # two samples at most
             .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        if rows:
            net = train([t for _, _, t in rows], np.array([k for _, k, _ in rows]), epochs, steps)
            yield pa.RecordBatch.from_arrays([pa.array([net.packed()], pa.binary())], ["weights"])

    return bytes(texts.select("doc_id", "toxic", "text").repartition(1).mapInArrow(run, "weights binary").first()[0])


def _pieces(column: pa.Array) -> Iterator[list[str]]:
    """The texts, some at a time: up to CHUNK characters or one text."""
    held, size = [], 0
    for t in strings(column, 64):
        if held and size + len(t) > CHUNK:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def score(docs: DataFrame, weights: bytes) -> DataFrame:
    """``doc_id, text, ...`` with ``score`` in place of the text."""
    given, key = docs.sparkSession.sparkContext.broadcast(weights), uuid.uuid4().hex
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{c} {dict(docs.dtypes)[c]}" for c in kept) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = resident(key, lambda: Network.unpacked(given.value))
        for b in batches:
            found = [net.scores(some) for some in _pieces(b.column(0))]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.concatenate([np.zeros(0), *found]))], [*kept, "score"])

    return docs.select("text", *kept).mapInArrow(run, schema)


def thresholds(scored: DataFrame, least: int = MIN_TOXIC) -> DataFrame:
    """``lang, threshold`` of best F1 from ``lang, toxic, score``, halfway
    between the scores on its two sides; the row with ``everywhere`` is that of
    all languages.  Scores count by bins of a thousandth."""
    bins = (scored.select("lang", F.floor(F.col("score") * BINS).alias("bin"), F.col("toxic").cast("long").alias("toxic"))
            .groupBy("lang", "bin").agg(F.sum("toxic").alias("tp"), F.count(F.lit(1)).alias("n")))
    both = (bins.withColumn("everywhere", F.lit(False))
            .unionByName(bins.groupBy("bin").agg(F.sum("tp").alias("tp"), F.sum("n").alias("n"))
                         .select(F.lit(None).cast("string").alias("lang"), "bin", "tp", "n", F.lit(True).alias("everywhere"))))
    group = Window.partitionBy("everywhere", "lang")
    down = group.orderBy(F.desc("bin"))
    f1 = (both.withColumn("upto", F.sum("tp").over(down)).withColumn("taken", F.sum("n").over(down))
          .withColumn("all", F.sum("tp").over(group)).withColumn("under", F.coalesce(F.lead("bin").over(down), F.lit(-1)))
          .filter(F.col("all") >= least)
          .select("everywhere", "lang", "bin", ((F.col("bin") + F.col("under") + 1) / (2 * BINS)).alias("threshold"),
                  (2 * F.col("upto") / (F.col("all") + F.col("taken"))).alias("f1")))
    return (f1.groupBy("everywhere", "lang").agg(F.max_by("threshold", F.struct("f1", "bin")).alias("threshold"))
            .select("everywhere", "lang", "threshold"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample: int = SAMPLE, epochs: int = EPOCHS, steps: int = STEPS) -> DataFrame:
    """One row per input row: ``doc_id, lang, held_out, score, predicted,
    threshold, flagged``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       text_of(text_col).alias("text"))
    weights = fit(rows.select("doc_id", "text"), labels, sample, epochs, steps)
    if weights is None:
        marked = rows.select("doc_id", "lang", F.lit(0.0).alias("score")).withColumn("threshold", F.lit(0.5))
    else:
        aside = learnt(labels).filter(~_trained()).hint("merge")  # grows with the labels
        borders = cut(thresholds(score(rows.join(aside, "doc_id"), weights)))
        overall = borders.filter("everywhere").first()
        own = borders.filter("not everywhere").select(F.col("lang").alias("of"), F.col("threshold").alias("own"))
        marked = (score(rows, weights).join(small(own), F.col("lang").eqNullSafe(F.col("of")), "left")
                  .withColumn("threshold", F.coalesce("own", F.lit(overall.threshold if overall else 0.5))))
    return marked.select("doc_id", "lang", (remainder() == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold",
                         (F.col("score") >= F.col("threshold")).alias("flagged"))
