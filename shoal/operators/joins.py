"""Join operators.

All joins are equi-joins on declared keys.  Broadcasting is size-checked by
Spark itself: a lookup read from storage is broadcast when its file size is
under ``spark.sql.autoBroadcastJoinThreshold``, and a derived one when its
materialised size is under AQE's threshold; anything larger stays a
sort-merge join, with skewed partitions split by AQE.  Nothing is hinted and
nothing is counted while a plan is built.  Keys that may be null are matched
null-safely, as dplyr does.
"""

from __future__ import annotations

import heapq
from functools import reduce
from typing import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shoal.functions.nulls import quoted

_SEMI_ANTI = {"left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"}
_KEEP_RIGHT_KEY = {"right", "right_outer", "rightouter", "full", "outer",
                   "full_outer", "fullouter"}


def join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
         null_safe: bool = True) -> DataFrame:
    """Join on same-named keys, returning one copy of each key column.

    With ``null_safe`` null keys match each other (dplyr semantics, N1).
    Outer joins coalesce the key columns so unmatched rows keep their keys.
    Non-key columns must not collide (rename first, P3).
    """
    on = list(on)
    if not null_safe:
        return left.join(right, on=on, how=how)
    lq, rq = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"_l.{quoted(k)}").eqNullSafe(F.col(f"_r.{quoted(k)}")) for k in on])
    out = lq.join(rq, cond, how)
    if how.lower() in _SEMI_ANTI:
        return out
    if how.lower() in _KEEP_RIGHT_KEY:
        keys = [F.coalesce(F.col(f"_l.{quoted(k)}"), F.col(f"_r.{quoted(k)}")).alias(k) for k in on]
    else:
        keys = [F.col(f"_l.{quoted(k)}").alias(k) for k in on]
    rest = ([F.col(f"_l.{quoted(c)}") for c in left.columns if c not in on]
            + [F.col(f"_r.{quoted(c)}") for c in right.columns if c not in on])
    return out.select(*keys, *rest)


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Left join a lookup table (J2, J3).  The planner broadcasts it when its
    size is under the broadcast thresholds."""
    return join(df, table, on, how)


def unique_keys(table: DataFrame, key: str) -> DataFrame:
    """Codes that map to more than one row (N18); empty when the lookup is safe."""
    return (table.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def to_taxa(df: DataFrame, species: DataFrame, code_col: str, species_code_col: str,
            taxa_col: str = "Taxa", exclude_pattern: str | None = None,
            distinct: bool = False) -> DataFrame:
    """Decode a survey's organism code to a taxon through the crosswalk.

    The crosswalk is restricted to rows with a code in this survey's column
    (F13) and, optionally, taxa not matching ``exclude_pattern`` (the salvage
    run drops "Age" classes).  Left join: unknown codes keep a null taxon.
    """
    xw = species.select(F.col(species_code_col).alias(code_col), F.col(taxa_col))
    xw = xw.filter(F.col(code_col).isNotNull())
    if exclude_pattern:
        xw = xw.filter(~F.coalesce(F.col(taxa_col).rlike(exclude_pattern), F.lit(False)))
    if distinct:
        xw = xw.distinct()
    return lookup(df, xw, [code_col])


def decode(df: DataFrame, table: DataFrame, code_col: str, table_code_col: str,
           label_col: str, out_col: str) -> DataFrame:
    """Replace a code by its label from a code table (left, null-safe)."""
    t = table.select(F.col(table_code_col).alias(code_col), F.col(label_col).alias(out_col))
    return lookup(df, t, [code_col])


def assemble(tables: Sequence[tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """Fold a chain of (table, join keys, how) into one sample table.

    The first entry's keys and join type are ignored.
    """
    out = tables[0][0]
    for table, keys, how in tables[1:]:
        out = join(out, table, keys, how)
    return out


def calibrate(df: DataFrame, corrections: DataFrame, year_col: str, serial_col: str,
              k_col: str = "kFactor", out_col: str = "kFactor_final") -> DataFrame:
    """Meter calibration on (year, serial), falling back to the serial's
    mean factor over all years; duplicate calibration rows are removed first."""
    corr = corrections.select(year_col, serial_col, k_col).distinct()
    by_year = corr.select(year_col, serial_col, F.col(k_col).alias("_k_year"))
    by_serial = corr.groupBy(serial_col).agg(F.avg(k_col).alias("_k_avg"))  # A12 mean per meter
    out = join(df, by_year, [year_col, serial_col], "left")
    out = join(out, by_serial, [serial_col], "left")
    return (out.withColumn(out_col, F.coalesce("_k_year", "_k_avg"))
            .drop("_k_year", "_k_avg"))


def full_outer_chain(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Full outer joins along a key chain (sample -> building -> catch...).

    Entry i > 0 joins on its keys with everything accumulated so far; key
    columns are coalesced so rows from either side keep them.
    """
    out = tables[0][0]
    for table, keys in tables[1:]:
        out = join(out, table, keys, "full")
    return out


def retain_samples(samples: DataFrame, catch: DataFrame, on: Sequence[str]) -> DataFrame:
    """Sample table left join catch, so empty samples stay as one row."""
    return join(samples, catch, on, "left")


def semi(df: DataFrame, kept: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key survives in ``kept``."""
    return join(df, kept.select(*on).distinct(), on, "left_semi")


def anti(df: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not already present (null-safe)."""
    return join(df, present.select(*on), on, "left_anti")


def attach(df: DataFrame, attrs: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Attach sample attributes (or the survey row) by key."""
    return join(df, attrs, on, how)


def sweep_size_groups(lengths: DataFrame, ranges: DataFrame, on: Sequence[str], length_col: str,
                      min_col: str = "Min_length", max_col: str = "Max_length", group_col: str = "SizeGroup") -> DataFrame:
    """``on, length_col, group_col``: the smallest group whose range strictly
    contains the length, one row for each of ``lengths`` (``on, length_col``)
    that has one.

    Range starts and lengths of a key are dealt together and sorted by
    position; one pass keeps the ranges begun in a heap by group and drops
    those that ended, so a length costs no more with ten thousand ranges
    on its key than with ten, and no pair of a length and a range is ever a
    row.  The pass streams: it holds the open ranges of one key.
    """
    keys = [F.col(quoted(k)).alias(f"_k{n}") for n, k in enumerate(on)]
    kinds = [lengths.schema[k].dataType.simpleString() for k in on]
    out_type = dict(ranges.dtypes)[group_col]
    far = F.lit(float("inf"))
    at = lengths.filter(F.col(length_col).isNotNull()).select(
        *keys, F.col(length_col).cast("double").alias("_at"), F.lit(0).alias("_starts"), F.lit(None).cast("double").alias("_hi"),
        F.lit(None).cast("long").alias("_g"))
    starts = ranges.select(
        *keys, F.coalesce(F.col(min_col).cast("double"), -far).alias("_at"), F.lit(1).alias("_starts"),
        F.coalesce(F.col(max_col).cast("double"), far).alias("_hi"), F.col(group_col).cast("long").alias("_g"))
    names = [f"_k{n}" for n in range(len(on))]
    # at one position lengths come first: a range begins behind its start
    dealt = at.unionByName(starts).repartition(*names).sortWithinPartitions(*names, "_at", "_starts")
    schema = ", ".join(f"{n} {kind}" for n, kind in zip(names, kinds)) + ", _at double, _g long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_ranges = None, []
        for b in batches:
            found = []
            for *k, x, is_start, hi, g in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    key, open_ranges = k, []
                if is_start:
                    heapq.heappush(open_ranges, (g, hi))
                    continue
                while open_ranges and not open_ranges[0][1] > x:
                    heapq.heappop(open_ranges)
                if open_ranges:
                    found.append((*k, x, open_ranges[0][0]))
            yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], field.type) for n, field in enumerate(arrow)],
                                             schema=arrow)

    swept = dealt.mapInArrow(sweep, schema)
    length_type = lengths.schema[length_col].dataType
    return swept.select(*[F.col(n).alias(k) for n, k in zip(names, on)], F.col("_at").cast(length_type).alias(length_col),
                        F.col("_g").cast(out_type).alias(group_col))


def assign_size_groups(measured: DataFrame, ranges: DataFrame, on: Sequence[str],
                       length_col: str, min_col: str = "Min_length",
                       max_col: str = "Max_length", group_col: str = "SizeGroup",
                       default_group: int = 1) -> DataFrame:
    """Give measured fish the size group of a commented range.

    ``ranges`` holds (keys, min, max, group); open ends are null.  Each
    measured row takes the smallest group whose range strictly contains its
    length (``min < length < max``), else ``default_group``.

    The distinct lengths of a key meet its ranges in one ordered pass
    (``sweep_size_groups``) and are joined back by key and length.
    """
    lengths = measured.select(*on, length_col).distinct()
    found = sweep_size_groups(lengths, ranges, on, length_col, min_col, max_col, group_col).withColumnRenamed(group_col, "_g")
    out = join(measured, found, [*on, length_col], "left")
    return out.withColumn(group_col, F.coalesce("_g", F.lit(default_group))).drop("_g").select(
        *measured.columns, group_col)


def size_bounds(comments: DataFrame, bounds: DataFrame, on: Sequence[str],
                min_col: str = "Min_length", max_col: str = "Max_length",
                bound_min: str = "Min", bound_max: str = "Max") -> DataFrame:
    """Fill missing min/max lengths from a life-stage size table."""
    b = bounds.select(*on, F.col(bound_min).alias("_bmin"), F.col(bound_max).alias("_bmax"))
    out = lookup(comments, b, on)
    return (out.withColumn(min_col, F.coalesce(F.col(min_col), F.col("_bmin")))
            .withColumn(max_col, F.coalesce(F.col(max_col), F.col("_bmax")))
            .drop("_bmin", "_bmax"))


def compare(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join of two summaries on their keys."""
    return join(a, b, on, "full")


def apply_patches(df: DataFrame, patches: DataFrame, keys: Sequence[str],
                  columns: Iterable[str], mode: str = "set") -> DataFrame:
    """Record-level corrections held in a patch table.

    ``patches`` has the key columns plus one column per corrected field.
    ``mode='set'`` replaces the value where the patch gives one, ``'add'``
    increments it, ``'drop'`` removes matching rows.
    """
    keys = list(keys)
    if mode == "drop":
        return join(df, patches.select(*keys), keys, "left_anti")
    cols = list(columns)
    p = patches.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in cols])
    out = lookup(df, p, keys)
    for c in cols:
        pc = F.col(f"_p_{c}")
        new = F.coalesce(pc, F.col(c)) if mode == "set" else F.col(c) + F.coalesce(pc, F.lit(0))
        out = out.withColumn(c, new)
    return out.drop(*[f"_p_{c}" for c in cols])


def exclude(df: DataFrame, windows: DataFrame, on: Sequence[str], date_col: str,
            start_col: str = "start", end_col: str = "end",
            conditions: Column | None = None) -> DataFrame:
    """drop rows falling in an exclusion window of their station.

    ``windows`` holds (keys, start, end); a day list is a window with
    start = end.  A window with further columns named like columns of ``df``
    plus ``_is`` (say ``Count_is``) drops only rows that have that value
    there (a null asks for nothing).  ``conditions`` restricts which rows may
    be dropped by any window (null counts as false).  An anti-join on the
    keys with the range as a further condition: rows are never multiplied
    and the windows of a key are never gathered.
    """
    asked = [c for c in windows.columns if c.endswith("_is") and c[:-3] in df.columns]
    w = windows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)], F.col(start_col).alias("_s"),
                       F.col(end_col).alias("_e"), *[F.col(c).alias(f"_{c}") for c in asked])
    hit = F.col(date_col).between(F.col("_s"), F.col("_e"))
    for i, k in enumerate(on):
        hit = hit & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    for c in asked:
        hit = hit & (F.col(f"_{c}").isNull() | (F.col(c[:-3]) == F.col(f"_{c}")))
    if conditions is not None:
        hit = hit & conditions
    return df.join(w, hit, "left_anti")
