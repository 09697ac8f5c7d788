"""Nearest neighbours with a hierarchical k-means tree, best bin first.

Fit.  The tree is grown on the driver from at most ``SAMPLE`` vectors (those
with the smallest hashes of their ids, at most ``SAMPLE_FLOATS`` numbers): each
node splits its vectors by k-means into ``BRANCH`` children until a node holds
``LEAF`` of them or cannot be split.  Tree and sample are bounded; both are
parameters.

Calibration.  ``PROBES`` vectors of the sample are looked up in the sample by
brute force and by full best-bin-first traversal; the number of leaves to
visit is widened until the share of true neighbours in visited leaves reaches
``RECALL``.  In the whole table neighbours are nearer than in the sample, so
the sample's figure is on the safe side.

Index.  Every valid vector goes down the tree to its leaf.  Queries traverse
the tree with a priority queue (nearest unopened centre first) and visit as
many leaves as calibrated, and further ones until those hold enough
candidates, so small tables give all they have.

Search.  Neighbouring leaves are gathered to shards of about ``BLOCK`` vectors.
A larger leaf is a shard of its own, dealt into blocks by a hash of the id, so
a leaf that holds a third of all vectors (copies of one vector, say) is many
tasks' work and none is capped.  The queries that ask for a block are dealt
into chunks of about ``CHUNK`` by their own number there, so a block is sent as
often as ``CHUNK`` queries ask for it, and not at all if none does.  In each (shard, block, chunk) a query is compared with the vectors of the
leaves it visits, in double precision on the original vectors, and gets its
best ``k``; the best of these by (distance, id) are the result.

Vectors take no part if their id is null, or they are null, zero, of another
length than most, or hold null or non-finite components.  Of rows that share
an id the least vector counts.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import cut, ship, small

SAMPLE, SAMPLE_FLOATS = 20_000, 1 << 23
BRANCH, LEAF, ITERATIONS = 8, 40, 12
PROBES, RECALL = 256, 0.98
BLOCK, CHUNK = 4096, 2048


@dataclass
class Tree:
    """Node n is a leaf if ``leaf[n] >= 0``; else its children are given."""
    centres: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    n_leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append(None)
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def freeze(self) -> "Tree":
        self.below = {n: np.stack([self.centres[c] for c in kids]) for n, kids in enumerate(self.children) if kids}
        return self


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]


def _split(x: np.ndarray, rng: np.random.Generator) -> np.ndarray | None:
    """Cluster of each row, or None if the rows cannot be told apart."""
    first = x[rng.integers(len(x))]
    centres = [first]
    near = ((x - first) ** 2).sum(1)
    for _ in range(BRANCH - 1):  # spread the first centres out
        if near.sum() <= 1e-12:
            break
        pick = x[rng.choice(len(x), p=near / near.sum())]
        centres.append(pick)
        near = np.minimum(near, ((x - pick) ** 2).sum(1))
    if len(centres) < 2:
        return None
    centres = np.stack(centres)
    label = np.zeros(len(x), dtype=int)
    for _ in range(ITERATIONS):
        new = _squares(x, centres).argmin(1)
        if (new == label).all() and _:
            break
        label = new
        for k in np.unique(label):
            centres[k] = x[label == k].mean(0)
    return label if len(np.unique(label)) > 1 else None


def grow(x: np.ndarray, seed: int = 7) -> Tree:
    tree, rng = Tree(), np.random.default_rng(seed)
    todo = [(tree.add(x.mean(0)), np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        label = _split(x[rows], rng) if len(rows) > LEAF else None
        if label is None:
            tree.leaf[node] = tree.n_leaves
            tree.n_leaves += 1
            continue
        kids = []
        for k in np.unique(label):
            part = rows[label == k]
            kids.append(tree.add(x[part].mean(0)))
            todo.append((kids[-1], part))
        tree.children[node] = kids
    return tree.freeze()


def descend(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of every row."""
    out = np.empty(len(x), dtype=np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if tree.leaf[node] >= 0:
            out[rows] = tree.leaf[node]
            continue
        near = _squares(x[rows], tree.below[node]).argmin(1)
        for k, child in enumerate(tree.children[node]):
            if len(part := rows[near == k]):
                todo.append((child, part))
    return out


def best_bins(tree: Tree, q: np.ndarray):
    """Leaves in the order a best-bin-first search opens them."""
    queue, tie = [(0.0, 0, 0)], 0
    while queue:
        _, _, node = heapq.heappop(queue)
        while tree.leaf[node] < 0:
            away = ((tree.below[node] - q) ** 2).sum(1)
            kids = tree.children[node]
            best = int(away.argmin())
            for k, child in enumerate(kids):
                if k != best:
                    tie += 1
                    heapq.heappush(queue, (float(away[k]), tie, child))
            node = kids[best]
        yield tree.leaf[node]


def calibrate(tree: Tree, x: np.ndarray, k: int, recall: float = RECALL, seed: int = 11) -> int:
    """Leaf visits at which the sample's neighbours are found."""
    probes = np.random.default_rng(seed).permutation(len(x))[:PROBES]
    leaf, rank_of = descend(tree, x), []
    for i in probes:
        away = ((x - x[i]) ** 2).sum(1)
        away[i] = np.inf
        true = np.argsort(away, kind="stable")[:min(k, len(x) - 1)]
        turn = {b: r for r, b in enumerate(best_bins(tree, x[i]), start=1)}
        rank_of += [turn[leaf[j]] for j in true]
    if not rank_of:
        return 1
    ranks, visits = np.array(rank_of), 1
    while (ranks <= visits).mean() < recall:
        visits += 1
    return visits


def gather(counts: dict[int, int], most: int = BLOCK) -> dict[int, tuple[int, int]]:
    """Leaf to (shard, blocks of the shard); leaf numbers of neighbours in
    the tree are close."""
    out, shard, held = {}, 0, 0
    for leaf, n in sorted(counts.items()):
        if held and held + n > most:
            shard, held = shard + 1, 0
        out[leaf] = (shard, -(-n // most))
        held += n
    return out


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, vec`` of the rows that take part, one per id."""
    v = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
         .filter("vec_id is not null and vec is not null")
         .filter(F.expr("forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
                        "and exists(vec, x -> x != 0)")))
    lengths = v.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return (v.filter(F.size("vec") == (lengths.d if lengths else 0))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every valid row that satisfies
    ``is_query`` (a condition on ``vec_id``) the ``k`` nearest other rows
    found, by Euclidean distance, ties to the smaller id."""
    spark = vectors.sparkSession
    ship(spark)
    points = cut(valid(vectors, id_col, vec_col))
    schema = "query_id long, rank int, vec_id long, score double"
    some = points.first()
    if some is None:
        return spark.createDataFrame([], schema)
    size = max(min(SAMPLE, SAMPLE_FLOATS // len(some.vec)), 2)
    sample = _matrix(points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("vec").toPandas()["vec"])
    tree = grow(sample)
    visits = calibrate(tree, sample, k, recall)
    shared = spark.sparkContext.broadcast(tree)

    def to_leaf(batches):
        for b in batches:
            if len(b):
                yield b.assign(leaf=descend(shared.value, _matrix(b["vec"])))

    placed = cut(points.mapInPandas(to_leaf, "vec_id long, vec array<double>, leaf int"))
    counts = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most n_leaves
    shards = gather(counts)
    queries = points.filter(is_query)
    plan = spark.sparkContext.broadcast((visits, counts, shards))

    def to_bins(batches):
        visits, counts, shards = plan.value
        names = ["query_id", "q", "shard", "block", "leaves"]
        for b in batches:
            out = []
            for i, vec in zip(b["vec_id"], b["vec"]):
                seen, wanted = 0, {}
                q = np.asarray(vec, dtype=np.float64)
                for opened, leaf in enumerate(best_bins(shared.value, q), start=1):
                    if leaf in counts:
                        seen += counts[leaf]
                        wanted.setdefault(shards[leaf], []).append(leaf)
                    if opened >= visits and seen > k:
                        break
                out += [(i, vec, shard, block, leaves) for (shard, blocks), leaves in wanted.items()
                        for block in range(blocks)]
                if len(out) >= 5_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    asked = cut(queries.repartition(spark.sparkContext.defaultParallelism, "vec_id")
                .mapInPandas(to_bins, "query_id long, q array<double>, shard int, block int, leaves array<int>"))
    at = ["shard", "block"]
    chunks = small(cut(asked.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))))
    asked = asked.join(chunks, at).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
    sizes = spark.createDataFrame([(leaf, *at) for leaf, at in sorted(shards.items())],
                                  "leaf int, shard int, blocks int")  # at most n_leaves
    dealt = (placed.join(F.broadcast(sizes), "leaf")
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
             .join(chunks, at).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("vec_id", "vec", "leaf", "shard", "block", "chunk"))

    def nearest(key: tuple, p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(p) and len(q):
            p = p.sort_values("leaf")
            x, ids, leaf = _matrix(p["vec"]), p["vec_id"].to_numpy(), p["leaf"].to_numpy()
            start = dict(zip(*np.unique(leaf, return_index=True)))
            stop = {b: s + n for b, s, n in zip(*np.unique(leaf, return_index=True, return_counts=True))}
            for i, vec, leaves in zip(q["query_id"], q["q"], q["leaves"]):
                rows = [np.arange(start[b], stop[b]) for b in leaves if b in start]
                rows = np.concatenate(rows) if rows else np.zeros(0, dtype=int)
                rows = rows[ids[rows] != i]
                away = np.sqrt(((x[rows] - np.asarray(vec, dtype=np.float64)) ** 2).sum(1))
                if len(rows) > k:  # all at the k-th distance stay for the tie rule
                    near = away <= np.partition(away, k - 1)[k - 1]
                    rows, away = rows[near], away[near]
                best = np.lexsort((ids[rows], away))[:k]
                out += [(i, ids[rows[j]], away[j]) for j in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    where = [*at, "chunk"]
    found = (dealt.groupBy(*where).cogroup(asked.groupBy(*where))
             .applyInPandas(nearest, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def recall_of(found: DataFrame, truth: DataFrame) -> float:
    """Share of ``truth`` (query_id, vec_id) that ``found`` has."""
    want = truth.select("query_id", "vec_id").distinct()
    return want.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count() / max(want.count(), 1)
