"""Prefix trie of conversations, by double arrays per prefix shard.

A turn is named by 128 bits of the SHA-256 of its role and text, so texts stay
where they are read.  Equal conversations become one path with a count, their
ids hashed beside it.  Distinct paths are sorted and dealt to shards by range:
a shard holds whole subtrees, and only the nodes on the border between two
shards, prefixes that the last path of one and the first of the next have in
common, are in several.  A prefix that a third of all conversations share is
cut at deeper turns like any other, so no shard is larger for it.

A task numbers the turns of a shard's paths densely and packs them, block by
block of about ``BLOCK`` turns, into BASE and CHECK: the child by turn t of the
node in slot s is in slot BASE[s] + t, and CHECK there is s.  Walking all paths
through the arrays at once gives each node its members; adding up from the
deepest slots gives the figures of subtrees.  Nodes within a block are
finished there.  Those on a border come out as partial figures under a digest of
their path and are merged over all shards; a node counts as a child, and its
bytes as kept once, only in the first block that has it, which a block knows by
the number of turns its first path shares with the path before.

A conversation is one row of 24 bytes a turn.  Turns are ordered by turn number
(null first) and then by name; repeated rows are turns of their own.  Null
roles and texts are empty.  Rows with a null conv_id are in no conversation and
left out.  Without conversations there is no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import cut, evict, ship, small

BLOCK = 1 << 18           # turns of a double array
SHARD = 1 << 16           # paths of a shard, about
PIECE = 1 << 14           # ids hashed at once

_NODES = ("key binary, up_key binary, conv_id long, depth long, up long, n_convs long, n_children long, n_leaves long, "
          "saved long, ends string")


def paths_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``conv_id, names, sizes``: the turns of each conversation in order, by
    name, and the UTF-8 bytes of their texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    name = F.expr("substring(unhex(sha2(concat(octet_length(role), ':', role, text), 256)), 1, 16)")
    turns = (rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                         role.alias("role"), text.alias("text"))
             .filter("conv_id is not null")
             .select("conv_id", F.struct(F.col("turn").isNotNull().alias("known"), "turn", name.alias("name"),
                                         F.octet_length("text").cast("long").alias("size")).alias("t")))
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.name").alias("names"), F.col("t.size").alias("sizes"))


def share_heads(paths: DataFrame) -> DataFrame:
    """The paths with conversation c beginning with the first h turns of
    conversation c - c % 5, then its own after its first h; h = CRC of c, mod 9."""
    most = 8
    heads = (paths.filter("conv_id % 5 = 0")
             .select(F.col("conv_id").alias("of"), F.slice("names", 1, most).alias("head"),
                     F.slice("sizes", 1, most).alias("head_sizes")))
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 9
    joined = paths.withColumn("of", F.expr("conv_id - conv_id % 5")).withColumn("h", h.cast("int")).join(heads, "of", "left")

    def rebuilt(own: str, head: str) -> str:
        return (f"concat(slice(coalesce({head}, slice({own}, 1, 0)), 1, h), "
                f"slice({own}, h + 1, greatest(size({own}) - h, 0)))")

    return joined.select("conv_id", F.expr(rebuilt("names", "head")).alias("names"),
                         F.expr(rebuilt("sizes", "head_sizes")).alias("sizes"))


def _groups(column: pa.Array) -> np.ndarray:
    """Starts of the stretches of equal values, and the end."""
    n = len(column)
    if n < 2:
        return np.arange(n + 1)
    differ = pa.compute.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(differ) + 1, [n]])


def id_digests(members: DataFrame, shards: int) -> DataFrame:
    """``key, ends``: SHA-256 of the decimal ids of each ``key``, ascending,
    joined by commas, from ``key, conv_id``.

    Ids are sorted and written out in ranges, so those of a key that holds a
    third of them are several tasks' work; only the hashing of finished
    pieces of text goes on in one."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            ids, edges = b.column(1).to_numpy(), _groups(b.column(0))
            cuts = [k for a, z in zip(edges, edges[1:]) for k in range(a, z, PIECE)]
            texts = [",".join(map(str, ids[a:z].tolist())) for a, z in zip(cuts, [*cuts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cuts)), pa.array(ids[cuts]), pa.array(texts, pa.string())],
                                             ["key", "first", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, h = None, None
        for b in batches:
            keys, ends = [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key != last:
                    if last is not None:
                        keys.append(last)
                        ends.append(h.hexdigest())
                    last, h = key, hashlib.sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], ["key", "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends"])

    written = (members.select("key", "conv_id").repartitionByRange(shards, "key", "conv_id")
               .sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, text string"))
    return (written.repartition("key").sortWithinPartitions("key", "first").select("key", "text")
            .mapInArrow(hashed, "key binary, ends string"))


class DoubleArray:
    """BASE and CHECK over turns numbered from 1; slot 0 is the root."""

    def __init__(self) -> None:
        self.base = np.zeros(1024, dtype=np.int64)
        self.check = np.full(1024, -1, dtype=np.int64)
        self.check[0] = 0
        self.front = 1            # no free slot before

    def _room(self, top: int) -> None:
        if top >= len(self.check):
            more = max(top + 1, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _free(self, n: int) -> np.ndarray:
        """The first n free slots."""
        width = 2 * n + 1024
        while True:
            self._room(self.front + width)
            free = np.flatnonzero(self.check[self.front:self.front + width] < 0)
            if len(free) >= n:
                self.front += int(free[0])
                return free[:n] + (self.front - int(free[0]))
            width *= 2

    def _fit(self, codes: np.ndarray) -> int:
        """The least base at which all of a node's children find free slots."""
        span, at, width = int(codes[-1] - codes[0]), self.front, 256
        while True:
            self._room(at + width + span)
            free = np.flatnonzero(self.check[at:at + width] < 0) + at
            if at == self.front:
                self.front = int(free[0]) if len(free) else at + width
            fits = (self.check[free[:, None] + (codes - codes[0])] < 0).all(axis=1)
            if fits.any():
                return int(free[fits.argmax()] - codes[0])
            at, width = at + width, min(2 * width, max(256, (1 << 20) // len(codes)))

    def add(self, slot: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots of the children by ``code`` of the nodes in ``slot``: pairs
        sorted by slot and code, no pair twice, no node given children twice."""
        start = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        size = np.diff(np.append(start, len(slot)))
        for k in np.argsort(-size, kind="stable"):
            if size[k] == 1:
                break
            codes = code[start[k]:start[k] + size[k]]
            base = self._fit(codes)
            self.base[slot[start[k]]] = base
            self.check[base + codes] = slot[start[k]]
        alone = start[size == 1]
        if len(alone):
            free = self._free(len(alone))
            self.base[slot[alone]] = free - code[alone]
            self.check[free] = slot[alone]
        return self.base[slot] + code

    def step(self, slot: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children by ``code``; -1 where there is none."""
        to = self.base[slot] + code
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == slot), to, -1)


def pack(codes: np.ndarray, length: np.ndarray) -> DoubleArray:
    """The double array of paths, given one after the other in ``codes``."""
    trie, offset = DoubleArray(), np.cumsum(length) - length
    most = int(codes.max()) + 1 if len(codes) else 1
    path, slot, d = np.arange(len(length)), np.zeros(len(length), dtype=np.int64), 0
    while True:
        on = length[path] > d
        path, slot = path[on], slot[on]
        if not len(path):
            return trie
        pair, back = np.unique(slot * most + codes[offset[path] + d], return_inverse=True)
        slot, d = trie.add(pair // most, pair % most)[back], d + 1


def shared_turns(a: list, b: list) -> int:
    """Number of turns two paths have in common at their start."""
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _chain(names: list[bytes], upto: int) -> list[bytes]:
    """Digests of a path's prefixes of 0 to ``upto`` turns."""
    h, out = hashlib.sha256(), []
    for k in range(upto + 1):
        out.append(h.digest()[:16])
        if k < upto:
            h.update(names[k])
    return out


def block_nodes(rows: list[tuple], before: int, after: int) -> pa.RecordBatch:
    """Nodes of a block of sorted paths ``(names, sizes, n, conv_id, ends)``.
    Its first path has ``before`` turns in common with the path before it, its
    last one ``after`` with the next (-1: there is none)."""
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(x, len(known) + 1) for r in rows for x in r[0]], dtype=np.int64)
    length = np.array([len(r[0]) for r in rows], dtype=np.int64)
    sizes = np.array([x for r in rows for x in r[1]], dtype=np.int64)
    count, conv = (np.array([r[k] for r in rows], dtype=np.int64) for k in (2, 3))
    trie = pack(codes, length)
    places, offset = len(trie.check), np.cumsum(length) - length
    n, depth, size = (np.zeros(places, dtype=np.int64) for _ in range(3))
    least = np.full(places, np.iinfo(np.int64).max)
    # walk all paths at once
    path, slot, d, levels = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), 0, []
    end = np.zeros(len(rows), dtype=np.int64)
    while len(path):
        np.add.at(n, slot, count[path])
        np.minimum.at(least, slot, conv[path])
        levels.append(np.unique(slot))
        depth[levels[-1]], end[path] = d, slot
        on = length[path] > d
        path, slot = path[on], slot[on]
        at = offset[path] + d
        slot, d = trie.step(slot, codes[at]), d + 1
        size[slot] = sizes[at]
    # nodes on the borders
    first, last = (np.zeros(1 + max(k, 0), dtype=np.int64) for k in (before, after))
    for spine, at in ((first, offset[0]), (last, offset[-1])):
        for k in range(1, len(spine)):
            spine[k] = trie.step(spine[k - 1:k], codes[at + k - 1:at + k])[0]
    border = {}
    for spine, names, upto in ((first, rows[0][0], before), (last, rows[-1][0], after)):
        if upto >= 0:
            border.update(zip(spine.tolist(), _chain(names, upto)))
    new = np.ones(places, dtype=bool)
    new[first[:before + 1]] = False
    new[0] = False                          # the root is nobody's child and has no bytes
    # add up from the deepest slots
    children, leaves = (np.zeros(places, dtype=np.int64) for _ in range(2))
    saved = n * size - np.where(new, size, 0)
    for level in reversed(levels[1:]):
        np.add.at(children, trie.check[level], new[level].astype(np.int64))
    has = np.zeros(places, dtype=bool)
    for level in levels[1:]:
        has[trie.check[level]] = True
    everywhere = np.concatenate(levels)
    leaves[everywhere] = ~has[everywhere]
    if after >= length[-1]:                 # the next path goes on from the last
        leaves[end[-1]] = 0
    for level in reversed(levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    ends = dict(zip(end.tolist(), (r[4] for r in rows)))
    slots, up = everywhere.tolist(), trie.check[everywhere]
    up_key = [border.get(u) if s else None for s, u in zip(slots, up.tolist())]
    up_conv = [None if s == 0 or k else c for s, k, c in zip(slots, up_key, least[up].tolist())]
    long = [pa.array(x[everywhere]) for x in (least, depth)]
    rest = [pa.array(x[everywhere]) for x in (n, children, leaves, saved)]
    return pa.RecordBatch.from_arrays(
        [pa.array([border.get(s) for s in slots], pa.binary()), pa.array(up_key, pa.binary()), *long, pa.array(up_conv, pa.int64()),
         *rest, pa.array([ends.get(s) for s in slots], pa.string())],
        ["key", "up_key", "conv_id", "depth", "up", "n_convs", "n_children", "n_leaves", "saved", "ends"])


def _walk(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a shard: its sorted paths, block by block."""
    evict()
    rows, turns, before, after = [], 0, -1, -1
    for b in batches:
        for at in range(0, len(b), 1024):
            for r in zip(*(c.to_pylist() for c in b.slice(at, 1024).columns)):
                if not rows:
                    before, after = r[5], r[6]
                elif turns >= block:
                    common = shared_turns(rows[-1][0], r[0])
                    yield block_nodes(rows, before, common)
                    rows, turns, before = [], 0, common
                rows.append(r[:5])
                turns += len(r[0])
    if rows:
        yield block_nodes(rows, before, after)


def nodes(paths: DataFrame, shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """Every node of the trie of ``conv_id, names, sizes``: ``conv_id`` (least
    member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.  ``shards`` is by default one for ``SHARD``
    paths, and not less than the shuffle partitions."""
    spark = paths.sparkSession
    ship(spark)
    whole = F.expr("substring(unhex(sha2(array_join(transform(names, x -> hex(x)), ''), 256)), 1, 16)")
    keyed = cut(paths.select("conv_id", "names", "sizes", whole.alias("key")))
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keyed.count() // SHARD))
    distinct = keyed.groupBy("key").agg(F.first("names").alias("names"), F.first("sizes").alias("sizes"),
                                        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    ordered = cut(distinct.join(id_digests(keyed, shards), "key").select("names", "sizes", "n", "conv_id", "ends")
                  .repartitionByRange(shards, "names").sortWithinPartitions("names")
                  .withColumn("shard", F.spark_partition_id()))
    # one row a shard: what its first and last path share with their neighbours
    ranges = ordered.groupBy("shard").agg(F.min("names").alias("a"), F.max("names").alias("z"))
    near = Window.orderBy("shard")
    same = "coalesce(array_position(zip_with({}, {}, (x, y) -> coalesce(x = y, false)), false) - 1, -1)"
    borders = (ranges.withColumn("p", F.lag("z").over(near)).withColumn("s", F.lead("a").over(near))
               .select("shard", F.expr(same.format("p", "a")).alias("before"), F.expr(same.format("z", "s")).alias("after")))
    found = cut(ordered.join(F.broadcast(borders), "shard")
                .select("names", "sizes", "n", "conv_id", "ends", "before", "after")
                .mapInArrow(lambda batches: _walk(batches, block), _NODES))
    merged = cut(found.filter("key is not null").groupBy("key", "up_key", "depth")
                 .agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
                      F.max("ends").alias("ends")))
    above = merged.select(F.col("key").alias("up_key"), F.col("conv_id").alias("merged_up"))
    inner = found.filter("key is null")
    below = inner.filter("up_key is not null").drop("up").unionByName(merged.filter("depth > 0").select(
        *[c for c in inner.columns if c != "up"]))
    told = below.join(small(above), "up_key").withColumnRenamed("merged_up", "up")
    root = merged.filter("depth = 0").withColumn("up", F.lit(None).cast("long"))
    columns = inner.columns
    return (inner.filter("up_key is null").unionByName(told.select(*columns)).unionByName(root.select(*columns))
            .select("conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
