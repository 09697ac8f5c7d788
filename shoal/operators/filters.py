"""Row filters and predicates.

All are ``filter`` over built-in expressions so Catalyst pushes them into the
scan where the columns come straight from storage.  Null handling follows R:
``filter(NA)`` drops the row (N3); ``%in%`` and ``grepl`` never yield NA.
"""

from __future__ import annotations

from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions.nulls import col_of, in_list, r_grepl
from shoal.operators.joins import join


def keep_methods(df: DataFrame, col: str, methods: Iterable[Any]) -> DataFrame:
    """gear/method whitelist."""
    return df.filter(in_list(col, methods))


def drop_conditions(df: DataFrame, col: str, codes: Iterable[Any] = (3, 4, 9)) -> DataFrame:
    """drop listed gear conditions, keeping rows with no condition."""
    c = F.col(col)
    return df.filter(c.isNull() | ~c.isin(list(codes)))


def valid_tows(df: DataFrame, col: str = "Tow_status") -> DataFrame:
    """valid tows only."""
    return df.filter(F.col(col) == "Valid")


def measured_only(df: DataFrame, length: str = "Length", keep_null: bool = False) -> DataFrame:
    """remove unmeasured (length 0) rows; ``keep_null`` keeps null lengths
    (``Length != 0 | is.na(Length)``), otherwise nulls drop too (N3)."""
    cond = F.col(length) != 0
    return df.filter(cond | F.col(length).isNull() if keep_null else cond)


def positive_catch(df: DataFrame, col: str = "Catch") -> DataFrame:
    """positive, known catch only."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) > 0))


def no_sampling(notes: str | Column, patterns: Sequence[str]) -> Column:
    """The case-insensitive "no sampling happened" test on a notes column."""
    return r_grepl(notes, "|".join(patterns), ignore_case=True)


def drop_no_sampling(df: DataFrame, notes: str, patterns: Sequence[str], count: str = "Count",
                     method: str = "Method", normal: str = "Normal count") -> DataFrame:
    """drop rows whose notes say no sampling happened, that have a zero
    count and the normal method (null comparisons keep the row)."""
    cond = (no_sampling(notes, patterns) & (F.col(count) == 0) & (F.col(method) == normal))
    return df.filter(~F.coalesce(cond, F.lit(False)))


def drop_totals(df: DataFrame, sample: str, code: str, total_codes: Iterable[Any] = (98, 99),
                excluded_codes: Iterable[Any] = (), drop_excluded_rows: bool = True) -> DataFrame:
    """F8: pseudo-organism total rows are removed unless they are the only
    organism code of their sample.  Samples holding an excluded organism
    lose their total rows too, and with ``drop_excluded_rows`` the excluded
    organism's own rows are removed (the two lists are parameters, D6).

    "Only" counts distinct organism codes per sample, so a sample holding
    two total codes loses both.  Null sample ids form one group, as R's
    ``%in%`` matches NA to NA.
    """
    total_codes, excluded_codes = list(total_codes), list(excluded_codes)
    per_sample = (df.select(sample, code).distinct()
                  .groupBy(sample).agg(F.count(F.lit(1)).alias("_n"),
                                       F.max(in_list(code, excluded_codes).cast("int")).alias("_x")))
    flagged = per_sample.filter((F.col("_n") != 1) | (F.col("_x") == 1)).select(sample)
    tot = in_list(code, total_codes)
    kept_totals = join(df.filter(tot), flagged, [sample], "left_anti")
    out = df.filter(~tot).unionByName(kept_totals)
    if drop_excluded_rows and excluded_codes:
        out = out.filter(~in_list(code, excluded_codes))
    return out


def drop_spurious_no_fish(df: DataFrame, sample: str, count: str, marker: Column) -> DataFrame:
    """drop empty-net marker rows of samples that did catch fish."""
    has = (df.groupBy(sample).agg(F.coalesce(F.sum(count), F.lit(0.0)).alias("_valid")))
    j = join(df, has, [sample], "left")
    return j.filter(~((F.col("_valid") > 0) & F.coalesce(marker, F.lit(False)))).drop("_valid")


def not_null(df: DataFrame, col: str) -> DataFrame:
    """drop rows whose key column is null (unmatched/undated)."""
    return df.filter(F.col(col).isNotNull())


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``drop_na``."""
    return df.dropna(subset=list(cols) if cols else None)


def slice_filter(df: DataFrame, sources: Sequence[str] | None = None,
                 months: Sequence[int] | None = None,
                 years: tuple[int, int] | None = None, date: str = "Date",
                 source: str = "Source") -> DataFrame:
    """user slice; a dimension left as None (all selected) adds no filter."""
    if sources is not None:
        df = df.filter(F.col(source).isin(list(sources)))
    if months is not None and len(set(months)) < 12:
        df = df.filter(F.month(date).isin(list(months)))
    if years is not None:
        df = df.filter(F.year(date).between(years[0], years[1]))
    return df


def length_window(df: DataFrame, bounds: dict[str, tuple[float, float]], default: tuple[float, float],
                  source: str = "Source", length: str = "Length") -> DataFrame:
    """per-source length window (standard vs fork length); null kept."""
    lo, hi = None, None
    for src, (a, b) in bounds.items():
        cond = F.col(source) == src
        lo = F.when(cond, F.lit(a)) if lo is None else lo.when(cond, F.lit(a))
        hi = F.when(cond, F.lit(b)) if hi is None else hi.when(cond, F.lit(b))
    lo = F.lit(default[0]) if lo is None else lo.otherwise(F.lit(default[0]))
    hi = F.lit(default[1]) if hi is None else hi.otherwise(F.lit(default[1]))
    L = F.col(length)
    return df.filter(L.isNull() | ((L >= lo) & (L <= hi)))


def size_cutoff(df: DataFrame, mm: float, length: str = "Length") -> DataFrame:
    """F16: remove fish shorter than ``mm``; unknown lengths stay."""
    return df.filter(F.col(length).isNull() | (F.col(length) >= mm))


def date_range(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """inclusive date range."""
    return df.filter(F.col(date).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def drop_partial_lengths(df: DataFrame, key: str, freq: str, flag: str, caught: str) -> DataFrame:
    """within a catch whose fish were caught, when exactly one row has a
    missing/zero length frequency (and no flag), drop that row - its fish
    are already spread over the measured siblings."""
    f = F.col(freq)
    unmeasured = (f.isNull() | (f == 0)) & F.col(flag).isNull()
    per = (df.groupBy(key)
           .agg(F.count_if(F.coalesce(unmeasured, F.lit(False))).alias("_nas")))
    j = join(df, per, [key], "left")
    gate = F.col(key).isNotNull() & F.coalesce(F.col(caught) == F.lit(True), F.lit(False))
    j = j.withColumn("_nas", F.when(gate, F.col("_nas")).otherwise(F.lit(0)))
    return j.filter(~((F.col("_nas") == 1) & (f.isNull() | (f == 0)))).drop("_nas")


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """remove rows matching a condition; rows where it is null go too
    (R's ``filter(!cond)`` with NA drops, N3)."""
    return df.filter(~cond)


def keep_taxa(df: DataFrame, taxa: Iterable[str], col: str = "Taxa") -> DataFrame:
    """restrict the taxon dimension before zero-fill."""
    return df.filter(col_of(col).isin(list(taxa)))
