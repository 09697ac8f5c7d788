"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes.  The distinct blocks
are sorted and each gets an integer name by its place; then adjacent pairs
of names are named the same way, round after round, until every document is
left with one name.  Two documents share number of bytes, number of blocks
and final name exactly when their normalised texts are equal: names stand
for contents one to one, no hash is trusted.

Blocks sort by (xxhash64, content).  The hash only routes: a block whose
hash belongs to one content gets the name of the hash, and contents that
share a hash are told apart by their order, so the contents travel through
one shuffle only (the one that makes them distinct, with map-side combine,
so a block that fills a third of the table is one row per map task).  All
later steps move integers.  Names are looked up by equi-joins whose skewed
keys adaptive execution splits.

The number of rounds is the logarithm of the longest text over the block
size; only documents with more than one name left take part in a round.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import cut, keep_once, lower_ascii, text_of

BLOCK_BYTES = 8192


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(doc, sha, n_bytes, pos, block): every block of every row; a text
    without bytes has one empty block."""
    body = docs.select(F.col(id_col).alias("doc"),
                       F.encode(lower_ascii(text_of(text_col)), "UTF-8").alias("body"))
    last = F.expr(f"cast(greatest(ceil(octet_length(body) / {block_bytes}) - 1, 0) as int)")
    cutting = F.expr(f"transform(sequence(0, last), i -> substring(body, i * {block_bytes} + 1, {block_bytes}))")
    return (body.withColumn("last", last)
            .select("doc", F.sha2("body", 256).alias("sha"),
                    F.octet_length("body").cast("long").alias("n_bytes"),
                    F.posexplode(cutting).alias("pos", "block")))


def _route(block, hash_bits: int):
    h = F.xxhash64(block)
    return h if hash_bits >= 64 else F.pmod(h, F.lit(1 << hash_bits))


def _sorted_names(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct ``keys`` in sorted order with an increasing integer ``name``.

    Range partitions sorted inside give a global order; the position id
    grows along it.  The cut freezes the names."""
    ranked = (keys.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("name", F.monotonically_increasing_id()))
    return cut(ranked)


def _name_blocks(blocks: DataFrame, hash_bits: int) -> DataFrame:
    """Round 0: (doc, sha, n_bytes, pos, name, copies)."""
    routed = blocks.withColumn("h", _route(F.col("block"), hash_bits))
    places = cut(routed.groupBy("doc", "sha", "n_bytes", "pos", "h").agg(F.count(F.lit(1)).alias("copies")))
    per_hash = cut(routed.select("h", "block").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("contents")))
    shared = per_hash.filter("contents > 1").select("h")
    keys = per_hash.filter("contents = 1").select("h", F.lit(0).cast("int").alias("sub"))
    told = places.withColumn("sub", F.lit(0).cast("int"))
    if not shared.isEmpty():
        # several contents under one hash: order them by content
        among = routed.join(shared, "h", "left_semi")
        order = (among.select("h", "block").distinct()
                 .withColumn("sub", F.row_number().over(Window.partitionBy("h").orderBy("block"))))
        keys = keys.unionByName(order.select("h", "sub"))
        subs = (among.join(order, ["h", "block"])
                .groupBy("doc", "sha", "n_bytes", "pos", "h", "sub")
                .agg(F.count(F.lit(1)).alias("copies")))
        told = (told.join(shared, "h", "left_anti").select(*told.columns)
                .unionByName(subs.select(*told.columns)))
    names = _sorted_names(keys, ["h", "sub"])
    return cut(told.join(names, ["h", "sub"]).select("doc", "sha", "n_bytes", "pos", "name", "copies"))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per distinct (id, text): ``doc, sha, n_bytes, n_blocks, name, copies``.

    (``n_bytes``, ``n_blocks``, ``name``) is the identity of the normalised
    text; ``copies`` counts repeated rows.  ``hash_bits`` narrows the routing
    hash (tests force collisions with it).
    """
    level = _name_blocks(_blocks(docs, id_col, text_col, block_bytes), hash_bits)
    level = level.withColumn("n_blocks", F.expr(f"cast(greatest(ceil(n_bytes / {block_bytes}), 1) as long)"))
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    done = [level.filter("n_blocks = 1").drop("pos")]
    level, width = level.filter("n_blocks > 1"), 1
    while width < longest:
        pairs = (level.groupBy("doc", "sha", "n_bytes", "n_blocks", "copies",
                               F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max(F.when(F.expr("pos % 2 = 0"), F.col("name"))).alias("left"),
                      F.max(F.when(F.expr("pos % 2 = 1"), F.col("name"))).alias("right"))
                 .withColumn("right", F.coalesce("right", F.lit(-1))))
        pairs = cut(pairs)
        names = _sorted_names(pairs.select("left", "right").distinct(), ["left", "right"])
        level = cut(pairs.join(names, ["left", "right"])
                    .select("doc", "sha", "n_bytes", "pos", "name", "copies", "n_blocks"))
        width *= 2
        done.append(level.filter(F.col("n_blocks") <= width).drop("pos"))
        level = level.filter(F.col("n_blocks") > width)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """Groups of documents with equal texts (A-Z lower-cased, null = empty).

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  The row with the largest id stays.  Repeated rows (same
    id, same text) count in ``group_size`` and carry the same decision.  A
    null id never beats an id; when all ids of a group are null, ``keep_id``
    is null and its rows are marked kept.
    """
    ids = cut(identities(docs, id_col, text_col, block_bytes, hash_bits))
    key = ["n_bytes", "n_blocks", "name"]
    groups = ids.groupBy(*key).agg(F.max("doc").alias("keep_id"),
                                   F.sum("copies").alias("group_size"))
    return (ids.join(groups, key)
            .withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(F.col("doc").alias("doc_id"), "keep_id", "group_size",
                    F.col("doc").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the
    largest id (of a group without ids, one row)."""
    marked = cut(exact_dedup(docs, id_col, text_col))
    keep = marked.filter("kept").select("doc_id", F.col("text_sha256").alias("key"))
    return keep_once(docs, keep, id_col, F.sha2(F.encode(lower_ascii(text_of(text_col)), "UTF-8"), 256))
