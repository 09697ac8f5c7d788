"""Grouped mutates.

Whole-partition totals are aggregates joined back by key (partial
aggregation, AQE skew-split joins) rather than unbounded windows, so a hot
key is never gathered into one task.  Ordered windows are used only where the
partition is small by construction (after pre-aggregation, or within one
sample).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.functions.nulls import col_of, strict_sum, sum0
from shoal.operators.joins import join


def total_over(df: DataFrame, keys: Sequence[str], value: str, out: str,
               strict: bool = False, where: Column | None = None) -> DataFrame:
    """Attach the partition total of ``value`` (optionally only rows
    matching ``where``) to every row."""
    v = F.col(value) if where is None else F.when(where, F.col(value))
    agg = strict_sum(v) if strict else sum0(v)
    t = df.groupBy(*keys).agg(agg.alias(out))
    return join(df, t, keys, "left")


def sample_has_catch(df: DataFrame, keys: Sequence[str], value: str,
                     out: str = "FishCaught") -> DataFrame:
    """Flag samples with any positive catch."""
    t = df.groupBy(*keys).agg((sum0(value) > 0).alias(out))
    return join(df, t, keys, "left")


def numbered(df: DataFrame, order: Sequence[str | Column], partition: Sequence[str],
             out: str = "n") -> DataFrame:
    """Row number within a partition (never a global window, N12).
    ``order`` must be a total order inside the partition for stable ids."""
    w = Window.partitionBy(*partition).orderBy(*[col_of(c) for c in order])
    return df.withColumn(out, F.row_number().over(w))


def daily_running_sum(df: DataFrame, partition: Sequence[str], date: str, value: str,
                      out: str = "cumulative") -> DataFrame:
    """Running sum by date within a partition.  Rows are first
    pre-aggregated to one per (partition, date), so a window partition holds
    at most one row per day, however many rows the source has."""
    daily = df.groupBy(*partition, date).agg(F.sum(value).alias(value))
    w = (Window.partitionBy(*partition).orderBy(date)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn(out, F.sum(value).over(w))


def count_over(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Attach the partition row count."""
    t = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return join(df, t, keys, "left")


def first_per_group(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` per group, as an aggregate
    (``min_by`` of the row struct: partial aggregation, no sort)."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
