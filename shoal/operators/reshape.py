"""Set operations and reshaping."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.functions.exprs import canonical
from shoal.functions.schema import FISH_COLS, SURVEY_COLS
from shoal.operators.joins import join

_NUMERIC_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _widest(types: list[T.DataType]) -> T.DataType:
    if all(type(t) in _NUMERIC_ORDER for t in types):
        return max(types, key=lambda t: _NUMERIC_ORDER.index(type(t)))
    return types[0]


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bind rows by column name, null-filling absent columns; numeric
    columns that differ between inputs are widened first (int -> double)."""
    dfs = list(dfs)
    seen: dict[str, list[T.DataType]] = {}
    for df in dfs:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    target = {name: _widest(types) for name, types in seen.items()}
    aligned = [df.select(*[F.col(f"`{f.name}`").cast(target[f.name]).alias(f.name)
                           if f.dataType != target[f.name] else F.col(f"`{f.name}`")
                           for f in df.schema.fields]) for df in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def same_set(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row with the number of keys only in ``a`` and only in ``b``;
    both zero means the id sets are equal.  One full outer join of the
    distinct keys, counted in one aggregation."""
    ka = a.select(*on).distinct().withColumn("_in_a", F.lit(True))
    kb = b.select(*on).distinct().withColumn("_in_b", F.lit(True))
    return join(ka, kb, on, "full").agg(
        F.count_if(F.col("_in_b").isNull()).alias("only_left"),
        F.count_if(F.col("_in_a").isNull()).alias("only_right"))


def fingerprint(df: DataFrame, on: Sequence[str], by: Sequence[str] = (), distinct: bool = False) -> DataFrame:
    """An order-free digest of the keys ``on``, per group ``by``:
    ``n`` keys, the sum of one hash of each and the xor of another, 60 bits
    each from MD5 (the same on every engine).  It merges map-side, so where
    keys are unique (the samples of a survey table) no id is shuffled or
    gathered; ``distinct`` removes repeated ones first, by a shuffle.  Nulls are
    keys of their own."""
    keys = df.select(*by, *on).distinct() if distinct else df
    part = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in on]
    h = F.md5(F.concat_ws("\x1f", *part).cast("binary"))
    half = lambda at: F.conv(F.substring(h, at, 15), 16, 10).cast("long")
    whole = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(half(1).cast("decimal(20,0)")).alias("sum"),
                                  F.bit_xor(half(17)).alias("xor"))
    digest = F.concat_ws("-", "n", F.coalesce(F.col("sum").cast("string"), F.lit("0")),
                         F.coalesce(F.col("xor").cast("string"), F.lit("0")))
    return whole.select(*by, "n", digest.alias("fingerprint"))


def same_fingerprint(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fingerprints of two tables side by side, per group: ``n_left, n_right,
    same``; a group that one of them lacks is not the same."""
    left, right = (x.select(*by, F.col("n").alias(f"n_{side}"), F.col("fingerprint").alias(f"_{side}"))
                   for x, side in ((a, "left"), (b, "right")))
    return (join(left, right, list(by), "full")
            .select(*by, "n_left", "n_right", F.coalesce(F.col("_left") == F.col("_right"), F.lit(False)).alias("same")))


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "source",
            value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(cols), name, value)


def split_cols(df: DataFrame, col: str, into: Sequence[str], sep: str,
               cast: str | None = "double") -> DataFrame:
    """R2: split one text column into several typed columns."""
    parts = F.split(F.col(col), sep)
    out = df
    for i, name in enumerate(into, start=1):
        v = F.trim(F.try_element_at(parts, F.lit(i)))
        out = out.withColumn(name, v.try_cast(cast) if cast else v)
    return out


def normalise(datasets: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Split wide survey datasets into the survey and fish tables.

    Each dataset keeps the known columns it has (P2), distinct (A23); the
    pieces are bound by name and reordered to the contract (U1).
    """
    survey = union_by_name([canonical(d, SURVEY_COLS).distinct() for d in datasets])
    survey = canonical(survey, SURVEY_COLS)
    fish = union_by_name([canonical(d, FISH_COLS).distinct() for d in datasets])
    return survey, canonical(fish, FISH_COLS)


def sorted_unique(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """O2: sorted distinct values as one array (bounded domains only)."""
    return df.agg(F.sort_array(F.collect_set(col)).alias(out or col))


def ordered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O1: multi-key sort, nulls last as R sorts."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])
