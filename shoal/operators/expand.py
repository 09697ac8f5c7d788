"""Length-frequency count expansion.

Surveys measure a subsample of each catch; the measured lengths are scaled up
to the total catch: ``Count = freq / total_measured * total_catch``.  Each
survey does it with its own twist; every variant is here, named after what
it does.

Plan at scale: partition totals are computed with ``groupBy`` (map-side
partial aggregation, so a hot key is combined before the shuffle) and joined
back on the same keys.  With AQE the join of a skewed key is split over
several tasks; a window would instead pull the whole group into one task.
Catch, totals and lengths are all hash-partitioned on the same keys, so the
join back does not shuffle again.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions.nulls import r_ifelse, strict_sum, sum0
from shoal.functions.schema import NO_FISH, UNKNOWN_LENGTH
from shoal.operators.joins import join
from shoal.session import as_is

def null_double() -> Column:
    return F.lit(None).cast("double")


def length_frequency(df: DataFrame, keys: Sequence[str], length: str,
                     freq: str | None = None, out: str = "LengthFrequency",
                     strict: bool = True) -> DataFrame:
    """A1: roll up to one row per (keys, length): sum of ``freq`` (strict by
    default, as R's ``sum``), or the row count when each row is one fish."""
    agg = (F.count(F.lit(1)).cast("double") if freq is None
           else (strict_sum(freq) if strict else sum0(freq)))
    return df.groupBy(*keys, length).agg(agg.alias(out))


def totals(df: DataFrame, keys: Sequence[str], value: str, out: str,
           strict: bool = False, where: Column | None = None) -> DataFrame:
    """W1 as an aggregate: one row per key with the (conditional) total."""
    v = F.col(value) if where is None else F.when(where, F.col(value))
    agg = strict_sum(v) if strict else sum0(v)
    if where is not None and strict:
        # R: sum(x[which(cond)]) - strict over the selected rows only
        sel = F.coalesce(where, F.lit(False))
        agg = F.when(F.count_if(sel) == F.count_if(sel & F.col(value).isNotNull()),
                     F.coalesce(F.sum(F.when(sel, F.col(value))), F.lit(0.0)))
    return df.groupBy(*keys).agg(agg.alias(out))


def expand_counts(catch: DataFrame, lengths: DataFrame, keys: Sequence[str],
                  catch_col: str = "Catch", length: str = "Length",
                  freq: str = "Frequency", out: str = "Count",
                  unmeasured: str = "length", drop_null: bool = True) -> DataFrame:
    """Catch left join measured lengths, then
    ``Count = freq / total_measured * catch``; a catch with no measured
    length keeps its catch as the count.

    Length rows with length 0 (unmeasured) or null are not measured and are
    removed before the roll-up (A1, strict sum).  ``unmeasured='length'``
    tests the joined length for null (FMWT, SLS), ``'total'`` tests the
    measured total (SKT).  Rows with a null result are dropped
    (``drop_null``).  Output: catch columns + length, freq, TotalMeasured, out.
    """
    keys = list(keys)
    measured = lengths.filter(F.col(length) != 0)
    measured = length_frequency(measured, keys, length, freq, out=freq)
    tot = totals(measured, keys, freq, "TotalMeasured")
    m = join(measured, tot, keys, "inner")
    j = join(catch, m, keys, "left")
    test = F.col(length).isNull() if unmeasured == "length" else F.col("TotalMeasured").isNull()
    expanded = F.try_divide(F.col(freq), F.col("TotalMeasured")) * F.col(catch_col)
    j = j.withColumn(out, F.when(test, F.col(catch_col)).otherwise(expanded))
    return j.filter(F.col(out).isNotNull()) if drop_null else j


def expand_volumetric(catch: DataFrame, lengths: DataFrame, keys: Sequence[str],
                      freq: str = "Frequency", plus: str = "PlusCount",
                      caught: str = "QtsCaught", subsampled: str = "QtsSubsampled",
                      out: str = "Count") -> DataFrame:
    """A3 (Bay Study): total catch = (measured + plus count) x caught volume /
    subsampled volume; every length row is kept (right join), rows whose
    catch side is missing get a null count.

    Keys with a null measured total or null plus count lose the catch side;
    catch rows with no measured fish vanish.  A zero subsampled volume gives
    null (R gives Inf).
    """
    keys = list(keys)
    tot = totals(lengths, keys, freq, "TotalMeasured", strict=True)
    c = catch.filter(F.col(plus).isNotNull())
    tc = join(c, tot.filter(F.col("TotalMeasured").isNotNull()), keys, "inner")
    tc = tc.select(*keys, ((F.col("TotalMeasured") + F.col(plus))
                           * F.try_divide(F.col(caught), F.col(subsampled))).alias("TotalCatch"),
                   "TotalMeasured")
    j = join(lengths, tc, keys, "left")
    return (j.withColumn(out, F.try_divide(F.col(freq), F.col("TotalMeasured")) * F.col("TotalCatch"))
            .drop("TotalMeasured", "TotalCatch"))


def expand_raise_catch(catch: DataFrame, lengths: DataFrame, keys: Sequence[str],
                       catch_col: str = "Catch", length: str = "Length",
                       freq: str | None = None, out: str = "Count") -> DataFrame:
    """A6 (20mm, STN): when more fish were measured than the catch says, the
    measured number becomes the catch; a positive catch with no measured
    length keeps its catch as the count and is flagged "Unknown length".

    ``freq=None`` counts one fish per length row.  Output adds
    LengthFrequency, TotalMeasured, CatchNew, ``out`` and Length_NA_flag.
    """
    keys = list(keys)
    measured = length_frequency(lengths.filter(F.col(length).isNotNull()), keys, length,
                                freq, out="LengthFrequency")
    j = join(catch, measured, keys, "left")
    tot = totals(measured, keys, "LengthFrequency", "TotalMeasured")
    j = join(j, tot, keys, "left").withColumn(
        "TotalMeasured", F.coalesce(F.col("TotalMeasured"), F.lit(0.0)))
    catch_new = r_ifelse(F.col("TotalMeasured") > F.col(catch_col),
                         F.col("TotalMeasured"), F.col(catch_col))
    expanded = F.try_divide(F.col("LengthFrequency"), F.col("TotalMeasured")) * F.col("CatchNew")
    unknown = F.col(catch_col).isNotNull() & expanded.isNull()
    return (j.withColumn("CatchNew", catch_new)
            .withColumn(out, F.when(unknown, F.col(catch_col)).otherwise(expanded))
            .withColumn("Length_NA_flag", F.when(unknown, F.lit(UNKNOWN_LENGTH))))


def expand_plus_count_group(df: DataFrame, keys: Sequence[str], length: str = "Length",
                            count: str = "Count", empty_code: tuple[str, str] | None = None,
                            drop_zero_counts: bool = False,
                            keep: Callable[[DataFrame], DataFrame] = as_is) -> DataFrame:
    """A7 (EDSM, DJFMP): within (sample, organism, group) the measured total
    is the count of rows with a nonzero length and the catch is all rows;
    ``Count = count / measured * total``.  Groups where nothing was measured
    (R's x/0 = Inf) keep the total, lose the zero length and are flagged
    "Unknown length"; remaining zero-length rows are dropped (R's 0/0 = NaN
    is not infinite, so those rows drop too).

    ``empty_code=(column, code)`` marks the empty-net record, whose count and
    length become null (EDSM); ``drop_zero_counts`` removes zero counts.
    Duplicated rows are merged (strict sum) first; ``keep`` gets the result,
    which is read twice.
    """
    keys = list(keys)
    L, C = F.col(length), F.col(count)
    if empty_code is not None:
        df = df.withColumn(count, F.when(F.col(empty_code[0]) == empty_code[1], null_double())
                           .otherwise(C))
    df = keep(merge_duplicates(df, count))
    # one aggregation gives both totals: measured (strict over rows with a
    # nonzero length, R's sum(x[which(cond)])) and the whole catch (strict)
    sel = F.coalesce(L != 0, F.lit(False))
    measured = F.when(F.count_if(sel) == F.count_if(sel & C.isNotNull()),
                      F.coalesce(F.sum(F.when(sel, C)), F.lit(0.0)))
    agg = df.groupBy(*keys).agg(measured.alias("_measured"), strict_sum(count).alias("_total"))
    j = join(df, agg, keys, "left")
    inf = F.coalesce((F.col("_measured") == 0) & (C > 0), F.lit(False))
    ratio = F.try_divide(C, F.col("_measured")) * F.col("_total")
    new_length = F.when(inf & (L == 0), null_double()).otherwise(L)
    if empty_code is not None:
        new_length = F.when(F.col(empty_code[0]) == empty_code[1], null_double()).otherwise(new_length)
    j = (j.withColumn(length, new_length)
         .withColumn("Length_NA_flag", F.when(inf, F.lit(UNKNOWN_LENGTH))
                     .when(F.col(length).isNull(), F.lit(NO_FISH)))
         .withColumn(count, F.when(inf, F.col("_total")).otherwise(ratio))
         .filter((F.col(length) != 0) | F.col(length).isNull()))
    if drop_zero_counts:
        j = j.filter((F.col(count) != 0) | F.col(count).isNull())
    return j.drop("_measured", "_total")


def expand_size_groups(df: DataFrame, keys: Sequence[str], length: str = "Length",
                       count: str = "Count") -> DataFrame:
    """A9 (Suisun): expansion within (sample, taxon, size group).  Length 0 is
    an unmeasured fish in the same table: the measured total excludes those
    rows, the total catch includes them.  A group with measured fish keeps
    only its measured (and null-length) rows, scaled; a group with nothing
    measured keeps its rows with a null length, flagged "Unknown length",
    and unscaled counts."""
    keys = list(keys)
    L = F.col(length)
    is_measured = (L != 0) | L.isNull()
    # one aggregation: measured total (null when the group has no measured
    # row) and total catch
    agg = df.groupBy(*keys).agg(
        F.when(F.count_if(is_measured) > 0, sum0(F.when(is_measured, F.col(count)))).alias("TotalMeasured"),
        sum0(count).alias("TotalCatch"))
    j = join(df, agg, keys, "left")
    has_measured = F.col("TotalMeasured").isNotNull()
    kept = j.filter(F.coalesce(is_measured, F.lit(False)) | ~has_measured)
    kept = (kept.withColumn("Length_NA_flag", F.when(~has_measured, F.lit(UNKNOWN_LENGTH)))
            .withColumn(length, F.when(~has_measured, null_double()).otherwise(L)))
    scale = F.col("TotalMeasured").isNull() | (F.col("TotalMeasured") == 0)
    return (kept.withColumn(count, F.when(scale, F.col(count))
                            .otherwise(F.try_divide(F.col(count), F.col("TotalMeasured"))
                                       * F.col("TotalCatch")))
            .drop("TotalMeasured", "TotalCatch"))


def expand_time(df: DataFrame, count: str = "Count", measured: str = "TotalMeasured",
                freq: str = "LengthFrequency", minutes: str = "MinutesPumping",
                sample_minutes: str = "SampleTimeLength", study: str = "StudyRowID",
                caught: str = "FishCaught", station: str = "Station",
                organism: str = "OrganismCode", totals_codes: Sequence[int] = (98, 99),
                imputed: Column | None = None, imputed_minutes: float = 20.0,
                out: str = "Count") -> DataFrame:
    """A10 (Salvage): raise the catch to the measured number, expand by
    length frequency, then by time: normal counts (study "0000") scale by
    pumping minutes / sampled minutes, second flushes ("9999") stay, special
    studies ("8888") and pseudo-organism totals are 0; missing or zero
    minutes, or no station, with no fish caught give 0.  ``imputed`` marks
    samples whose sampled minutes are imputed as ``imputed_minutes``."""
    tm, c = F.col(measured), F.col(count)
    count1 = F.when(tm.isNotNull() & (F.coalesce(tm > c, F.lit(False)) | c.isNull()), tm).otherwise(c)
    df = df.withColumn("Count1", count1)
    c1 = F.col("Count1")
    expanded = F.when(tm.isNotNull() & (tm != 0) & F.coalesce(c1 >= tm, F.lit(False)),
                      F.try_divide(F.col(freq), tm) * c1).otherwise(c1)
    df = df.withColumn("ExpandedCount", expanded)
    e, mp, stl = F.col("ExpandedCount"), F.col(minutes), F.col(sample_minutes)
    not_caught = F.coalesce(F.col(caught) != F.lit(True), F.lit(False))
    no_time = mp.isNull() | (mp == 0) | (stl == 0) | stl.isNull()
    rule = F.when(F.lit(False), F.lit(None))
    if imputed is not None:
        rule = rule.when(F.coalesce(imputed, F.lit(False)), e * (mp / F.lit(imputed_minutes)))
    rule = (rule.when(no_time & not_caught, F.lit(0.0))
            .when(F.col(station).isNull() & not_caught, F.lit(0.0))
            .when(F.col(study) == "0000", e * F.try_divide(mp, stl))
            .when(F.col(study) == "9999", e)
            .when(F.col(study) == "8888", F.lit(0.0))
            .when(F.col(organism).isin(list(totals_codes)), F.lit(0.0))
            .otherwise(F.lit(0.0)))
    return df.withColumn(out, rule)


def merge_duplicates(df: DataFrame, value: str = "Count") -> DataFrame:
    """Group by every other column and sum ``value`` (strict, N6).

    Grouping includes nulls as values (N15), like ``group_by(across(-Count))``.
    """
    others = [c for c in df.columns if c != value]
    return df.groupBy(*others).agg(strict_sum(value).alias(value)).select(*df.columns)
