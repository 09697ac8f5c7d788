"""Mixing sources to target weights by temperature, realised in whole blocks.

Weights.  Sources weigh in proportion to their token share to the power
``a``: 1 keeps the corpus as it is, 0 makes all sources equal.  ``a`` is
found by bisection, either as the largest that reaches an entropy (a fraction
of the logarithm of the number of sources) or as the smallest at which no
source is repeated more than a limit.  Each Spark job over the table of
source totals tests the 15 inner points of 16 intervals, which is four
halvings at once; sums come back, sources do not.

Budget.  ``budget`` tokens (default: as many as the corpus has) are split by
the weights; with ``cover`` the budget is the least at which every document
is used at least once.  A source whose budget is q times its tokens is passed
floor(q) times in full and the rest of the budget is filled with blocks.

Blocks.  A block holds the documents of a source whose digests begin with the
same bits, about ``block_tokens`` tokens of the corpus; blocks are taken in
the order of a seeded digest.  The block in which the budget ends is the only
one that is ordered document by document (again by digest), and a document
that would overrun the budget ends the pass.  So a large source is never
sorted as a whole; sums per block do.

Tokens are runs of characters other than space, tab, line and page breaks.
Null text has none.  Null sources form a source of their own.  A source
without tokens costs nothing and is passed once.  Documents without id are
dealt by their text.  Rows repeated with id and text are taken or left
together.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import cut, small, text_of, unused

BLOCK_TOKENS = 1 << 20
MIN_BLOCKS, MAX_BLOCKS = 16, 1 << 20
HALVINGS = 28
#: Columns that ``counted`` adds or needs for a while.
RESERVED = ("__src", "__digest", "__weight", "__block", "__copies", "__times", "__more", "__pass")
TOKEN = "[^ \\t\\n\\r\\f]+"


@dataclass
class Mixture:
    exponent: float
    sources: DataFrame    #: src, n_tokens, weight, goal, passes, rest
    blocks: DataFrame     #: src, block, taken (whole block in the last pass)
    border: DataFrame     #: src, digest: documents taken from border blocks
    n_blocks: int


def _source(source_col: str) -> Column:
    """Null apart from every string."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))


def _digest(id_col: str, text_col: str, seed: int) -> Column:
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(text_of(text_col))))
    return F.md5(F.concat(F.lit(f"{seed}/"), key))


def _block(digest: Column, n_blocks: int) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n_blocks


def _exponent(shares: DataFrame, entropy: float | None, repeat: float | None, cover: bool) -> float:
    """Bisect the exponent; ``shares``: one column ``p`` > 0 per source."""
    n = shares.count()
    if n < 2:
        return 1.0
    goal = None if entropy is None else entropy * math.log(n)

    def fits(z: float, zlog: float, low: float, high: float) -> bool:
        if goal is not None:  # entropy of the normalised powers
            return math.log(z) - zlog / z >= goal
        return (high / low if cover else high / z) <= repeat

    lo, hi = 0.0, 1.0
    for _ in range(HALVINGS // 4):
        points = [lo + (hi - lo) * k / 16 for k in range(1, 16)]
        grid = shares.withColumn("a", F.explode(F.array(*map(F.lit, points))))
        power = F.pow("p", F.col("a"))
        found = (grid.groupBy("a").agg(
            F.sum(power).alias("z"), F.sum(power * F.col("a") * F.log("p")).alias("zlog"),
            F.min(power / F.col("p")).alias("low"), F.max(power / F.col("p")).alias("high")).collect())
        ok = {r.a: fits(r.z, r.zlog, r.low, r.high) for r in found}
        if goal is not None:  # holds below the border: keep the largest that fits
            good = [lo, *(a for a in points if ok[a])]
            lo, hi = good[-1], min([a for a in points if not ok[a]], default=hi)
        else:  # holds above the border: keep the smallest that fits
            bad = [a for a in points if not ok[a]]
            lo, hi = max(bad, default=lo), min([a for a in points if ok[a]], default=hi)
    if goal is not None:
        natural = shares.agg(F.sum(-F.col("p") * F.log("p"))).first()[0]
        return 1.0 if natural >= goal else lo
    return hi


def mixture(docs: DataFrame, entropy: float | None = None, repeat: float | None = None,
            budget: int | None = None, cover: bool = False, seed: int = 1,
            block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> Mixture:
    """Weights, budgets and block decisions for ``docs``."""
    if (entropy is None) == (repeat is None):
        raise ValueError("give a target entropy or a repetition limit")
    digest = _digest(id_col, text_col, seed)
    each = cut(docs.select(_source(source_col).alias("src"), digest.alias("digest"),
                           F.regexp_count(text_of(text_col), F.lit(TOKEN)).cast("long").alias("n"))
               .groupBy("src", "digest").agg(F.sum("n").alias("n")))
    totals = cut(each.groupBy("src").agg(F.sum("n").alias("n_tokens")))
    total = totals.agg(F.sum("n_tokens")).first()[0] or 0
    n_blocks = min(max(-(-total // block_tokens), MIN_BLOCKS), MAX_BLOCKS)
    shares = totals.filter("n_tokens > 0").select("src", "n_tokens", (F.col("n_tokens") / F.lit(max(total, 1))).alias("p"))
    a = _exponent(shares.select("p"), entropy, repeat, cover)
    power = F.pow("p", F.lit(a))
    z, low = shares.agg(F.sum(power), F.min(power / F.col("p"))).first()
    if cover and low:
        spend = F.col("n_tokens") * (power / F.col("p")) / F.lit(low)
    else:
        spend = F.lit(float(total if budget is None else budget)) * power / F.lit(z or 1.0)
    goal = F.floor(spend + 0.5).cast("long")
    if cover:  # rounding must not take a document away
        goal = F.greatest(goal, F.col("n_tokens"))
    sources = cut(totals.join(shares.select("src", (power / F.lit(z or 1.0)).alias("weight"), goal.alias("goal")), "src", "left")
                  .select("src", "n_tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                          F.coalesce("goal", F.lit(0).cast("long")).alias("goal"))
                  .withColumn("passes", F.expr("if(n_tokens = 0, 1L, goal div n_tokens)"))
                  .withColumn("rest", F.expr("if(n_tokens = 0, 0L, goal % n_tokens)")))
    block = _block(F.col("digest"), n_blocks)
    sums = each.withColumn("block", block).groupBy("src", "block").agg(F.sum("n").alias("n"))
    order = F.md5(F.concat(F.lit(f"{seed}/"), F.col("src"), F.lit("/"), F.col("block").cast("string")))
    turn = Window.partitionBy("src").orderBy(order, "block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = cut(sums.withColumn("upto", F.sum("n").over(turn)).join(sources.select("src", "rest"), "src")
                 .select("src", "block", ((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0)).alias("taken"),
                         (F.col("rest") - F.col("upto") + F.col("n")).alias("left"),
                         ((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest"))).alias("border")))
    inside = (each.withColumn("block", block)
              .join(blocks.filter("border").select("src", "block", "left"), ["src", "block"]))
    upto = F.sum("n").over(Window.partitionBy("src", "block").orderBy("digest")
                           .rowsBetween(Window.unboundedPreceding, 0))
    border = cut(inside.withColumn("upto", upto).filter("upto <= left").select("src", "digest"))
    return Mixture(a, sources, blocks.select("src", "block", "taken"), border, n_blocks)


def counted(docs: DataFrame, m: Mixture, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> DataFrame:
    """``docs``, all columns and rows, with ``__weight`` of the source,
    ``__block`` and ``__copies``, how often the mixture uses the row."""
    keyed = (docs.withColumn("__src", _source(source_col)).withColumn("__digest", _digest(id_col, text_col, seed))
             .withColumn("__block", _block(F.col("__digest"), m.n_blocks)))
    per_block = small(cut(m.blocks.join(m.sources, "src")
                          .select(F.col("src").alias("__src"), F.col("block").alias("__block"),
                                  F.col("weight").alias("__weight"),
                                  (F.col("passes") + F.col("taken").cast("long")).alias("__times"))))
    border = small(m.border.select(F.col("src").alias("__src"), F.col("digest").alias("__digest"),
                                   F.lit(1).cast("long").alias("__more")))
    return (keyed.join(per_block, ["__src", "__block"]).join(border, ["__src", "__digest"], "left")
            .withColumn("__copies", F.col("__times") + F.coalesce("__more", F.lit(0).cast("long")))
            .drop("__times", "__more", "__src", "__digest")
            .select(*docs.columns, "__weight", "__block", "__copies"))


def mixed(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", **target) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is used,
    columns unchanged."""
    inside = {c: n for c, n in zip(RESERVED, unused(docs, *RESERVED)) if c in docs.columns}
    named = docs.withColumnsRenamed(inside)  # counted's own names are free then
    cols = [inside.get(c, c) for c in (id_col, text_col, source_col)]
    m = mixture(named, seed=seed, id_col=cols[0], text_col=cols[1], source_col=cols[2], **target)
    return (counted(named, m, seed, *cols).filter("__copies > 0")
            .withColumn("__pass", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*named.columns)
            .withColumnsRenamed({n: c for c, n in inside.items()}))
