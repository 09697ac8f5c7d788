"""Two-level layout of a catch export: sample attributes apart from catch rows.

An export repeats some twenty sample columns on every fish row.  ``split``
leaves a catch row its own columns and two 64-bit keys, of the attribute row and
of the sample, so merging duplicates and expanding counts shuffle and compare
narrow rows; ``attach`` joins the attributes back last.  A key is a hash, and
both are checked: should two attribute rows, or two sample ids, share one, the
job stops.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.session import as_is

ROW, SAMPLE = "_row", "_sample"


def _only(col: str | Column, what: str) -> Column:
    """The one value of ``col`` in a group; an error where there are two."""
    return F.when(F.min(col).eqNullSafe(F.max(col)), F.min(col)).otherwise(
        F.raise_error(F.lit(f"two {what} share a 64-bit key")))


def split(df: DataFrame, catch_cols: Sequence[str], sample: str = "SampleID",
          hashed: Callable[..., Column] = F.xxhash64,
          keep: Callable[[DataFrame], DataFrame] = as_is) -> tuple[DataFrame, DataFrame]:
    """``(catch, attributes)``: rows of ``_row, _sample`` and ``catch_cols``,
    and one row for each ``_row`` with the other columns.  ``keep`` gets the
    attribute rows, which are read twice."""
    attributes = [c for c in df.columns if c not in catch_cols]
    keyed = df.withColumn(ROW, hashed(*[F.col(c) for c in attributes])).withColumn(SAMPLE, hashed(F.col(sample)))
    rows = keep(keyed.groupBy(ROW).agg(F.min(SAMPLE).alias(SAMPLE), _only(F.struct(*attributes), "attribute rows").alias("_a"))
                .select(ROW, SAMPLE, *[F.col(f"_a.{c}").alias(c) for c in attributes]))
    ids = rows.groupBy(SAMPLE).agg(_only(sample, "samples").alias(sample))
    return keyed.select(ROW, SAMPLE, *catch_cols), rows.drop(sample).join(ids, SAMPLE).drop(SAMPLE)


def attach(catch: DataFrame, attributes: DataFrame) -> DataFrame:
    """The catch rows with their attributes again, without the keys."""
    return catch.join(attributes, ROW).drop(ROW, SAMPLE)
