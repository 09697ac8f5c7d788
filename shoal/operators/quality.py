"""Data-quality rules (Q1-Q17): the reference's dataset assertions as a
Spark rule engine.

Row rules are boolean "violation" expressions evaluated together in one
aggregation pass (``count_if`` per rule, partial aggregation) and returned as
``(rule, violations)`` rows.  Key rules are group-bys and anti joins.
Nothing is collected; callers decide whether a non-zero count fails a job.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.functions.nulls import in_list
from shoal.functions.schema import LAT_RANGE, LENGTH_FLAGS, LON_RANGE, METHODS, NO_FISH, TIDES, \
    UNKNOWN_LENGTH
from shoal.operators.joins import join
from shoal.sources.io import ROWS, once


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Count violations of each rule in one pass; null conditions count as
    no violation (R's ``filter`` drops NA)."""
    names = list(rules)
    counts = df.agg(*[F.count_if(F.coalesce(rules[n], F.lit(False))).alias(n) for n in names])
    return counts.unpivot([], names, "rule", "violations")


def dataset_rules(columns: Sequence[str], types: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Q1-Q10 for whichever canonical columns the dataset has; Q2 (dates and
    times are of a date or time type, and every date reads year-month-day)
    needs their ``types``."""
    c = set(columns)
    col = F.col
    flag = col("Length_NA_flag") if "Length_NA_flag" in c else None
    no_fish = F.coalesce(flag == NO_FISH, F.lit(False)) if flag is not None else None
    unknown = F.coalesce(flag == UNKNOWN_LENGTH, F.lit(False)) if flag is not None else None
    r: dict[str, Column] = {}
    if "Latitude" in c:  # Q1
        r["q1_latitude_box"] = col("Latitude").isNotNull() & ~(
            (col("Latitude") < LAT_RANGE[1]) & (col("Latitude") > LAT_RANGE[0]))
    if "Longitude" in c:
        r["q1_longitude_box"] = col("Longitude").isNotNull() & ~(
            (col("Longitude") < LON_RANGE[1]) & (col("Longitude") > LON_RANGE[0]))
    if types and "Date" in c:  # Q2
        r["q2_date_type"] = F.lit(not types["Date"].startswith(("date", "timestamp")))
        r["q2_date_format"] = ~F.coalesce(col("Date").cast("string").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.lit(False))
    if types and "Datetime" in c:
        r["q2_datetime_type"] = F.lit(not types["Datetime"].startswith("timestamp"))
    if "Tide" in c:  # Q3
        r["q3_tide_domain"] = col("Tide").isNotNull() & ~in_list("Tide", TIDES)
    if "Method" in c:
        r["q3_method_domain"] = ~in_list("Method", METHODS)
    if flag is not None:
        r["q3_flag_domain"] = flag.isNotNull() & ~in_list("Length_NA_flag", LENGTH_FLAGS)
    if flag is not None and {"Length", "Count", "Taxa"} <= c:
        L, C, T = col("Length"), col("Count"), col("Taxa")
        empty = L.isNull() & (C == 0)
        r["q4_empty_not_flagged"] = empty & ~no_fish
        r["q4_flagged_not_empty"] = no_fish & ~F.coalesce(empty, F.lit(False))
        r["q4_flagged_with_taxon"] = no_fish & T.isNotNull()
        r["q4_null_taxon_not_flagged"] = T.isNull() & flag.isNotNull() & ~no_fish
        r["q5_unknown_not_flagged"] = L.isNull() & (C > 0) & ~unknown
        r["q5_flagged_not_unknown"] = unknown & ~F.coalesce(L.isNull() & (C > 0), F.lit(False))
        r["q6_unflagged_missing"] = flag.isNull() & (C.isNull() | T.isNull())
        r["q6_count_without_taxon"] = (C > 0) & T.isNull()
        r["q7_zero_not_flagged"] = (C == 0) & ~no_fish
        r["q7_flagged_not_zero"] = no_fish & ~F.coalesce(C == 0, F.lit(False))
        r["q7_null_count"] = C.isNull()
    if "Tow_volume" in c:  # Q8
        r["q8_negative_volume"] = col("Tow_volume") < 0
        if "Source" in c:
            r["q8_zero_volume"] = (col("Tow_volume") == 0) & (col("Source") != "Salvage")
    if "Tow_area" in c:
        r["q8_negative_area"] = col("Tow_area") < 0
        r["q8_zero_area"] = col("Tow_area") == 0
    if "Datetime" in c and "Source" in c:  # Q9
        r["q9_midnight"] = ((col("Source") != "Salvage") & (F.hour("Datetime") == 0)
                            & (F.minute("Datetime") == 0))
    for s in ("Sal_surf", "Sal_bot"):  # Q10
        if s in c:
            r[f"q10_{s.lower()}_negative"] = col(s) < 0
            r[f"q10_{s.lower()}_high"] = col(s) > 40
    if "Temp_surf" in c:
        r["q10_temp_negative"] = col("Temp_surf") < 0
        r["q10_temp_high"] = col("Temp_surf") > 40
    return r


def quality_report(df: DataFrame) -> DataFrame:
    """Q1-Q10 over a dataset: one (rule, violations) row per applicable rule."""
    return check(df, dataset_rules(df.columns, dict(df.dtypes)))


def check_by_source(df: DataFrame, rules: Mapping[str, Column], source: str = "Source",
                    sample: str = "SampleID") -> DataFrame:
    """The same rules per source, with samples to look at: (rule, source,
    violations, first and last offending sample).  One pass; a row takes part
    once per rule it breaks, and the aggregate is partial."""
    broken = F.filter(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]),
                      lambda x: x.isNotNull())
    return (df.select(source, sample, F.explode(broken).alias("rule")).groupBy("rule", source)
            .agg(F.count(F.lit(1)).alias("violations"), F.min(sample).alias("first_sample"), F.max(sample).alias("last_sample")))


def broken_samples(df: DataFrame, rules: Mapping[str, Column], k: int = 5, source: str = "Source",
                   sample: str = "SampleID") -> DataFrame:
    """The same with up to ``k`` samples of each rule and source: (rule, source,
    violations, samples, keys), ``keys`` being the least sample ids in order.

    Counts are exact.  The rows a rule breaks on are first counted per sample,
    which combines map-side and spreads a hot rule over its samples; the least
    ``k`` are then picked by a row number below a limit, for which Spark keeps
    ``k`` rows a rule and task before it shuffles (``WindowGroupLimit``).  Both
    read the same exchange, so the dataset is scanned once.  A null sample
    counts and has no key."""
    broken = F.filter(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]),
                      lambda x: x.isNotNull())
    per_sample = (df.select(source, sample, F.explode(broken).alias("rule")).groupBy("rule", source, sample)
                  .agg(F.count(F.lit(1)).alias("n")))
    totals = per_sample.groupBy("rule", source).agg(F.sum("n").alias("violations"), F.count(F.lit(1)).alias("samples"))
    # by "n" too, so that both sides need the same columns and share the exchange
    least = Window.partitionBy("rule", source).orderBy(F.col(sample).asc_nulls_last(), "n")
    keys = (per_sample.withColumn("_k", F.row_number().over(least)).filter(F.col("_k") <= k)
            .groupBy("rule", source).agg(F.array_sort(F.collect_list(sample)).alias("keys")))
    return join(totals, keys, ["rule", source], "inner")


def domain_rules(domains: Mapping[str, Sequence]) -> dict[str, Column]:
    """Q11: values outside a column's list (nulls too)."""
    return {f"domain_{c}": ~F.coalesce(in_list(c, list(values)), F.lit(False)) for c, values in domains.items()}


def format_rules(patterns: Mapping[str, str]) -> dict[str, Column]:
    """Q11: texts that do not match a column's pattern (nulls too)."""
    return {f"format_{c}": ~F.coalesce(F.col(c).rlike(p), F.lit(False)) for c, p in patterns.items()}


def range_rules(bounds: Mapping[str, tuple[float | None, float | None]]) -> dict[str, Column]:
    """Q11/Q17: per-column value ranges (None = open end); nulls pass."""
    r = {}
    for name, (lo, hi) in bounds.items():
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(name) < lo)
        if hi is not None:
            cond = cond | (F.col(name) > hi)
        r[f"range_{name}"] = cond
    return r


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q12: keys occurring more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q12: keys of ``expected`` absent from ``actual`` (all samples kept)."""
    return join(expected.select(*keys).distinct(), actual.select(*keys), keys, "left_anti")


def incomplete_samples(fish: DataFrame, group: str = "Source", sample: str = "SampleID",
                       taxon: str = "Taxa") -> DataFrame:
    """Q12: samples lacking some taxon of their group after zero-fill:
    (group, sample, taxa present, taxa in group) where the counts differ."""
    per_sample = fish.groupBy(group, sample).agg(F.count_distinct(taxon).alias("taxa_present"))
    per_group = fish.groupBy(group).agg(F.count_distinct(taxon).alias("taxa_in_group"))
    return (join(per_sample, per_group, [group], "inner")
            .filter(F.col("taxa_present") != F.col("taxa_in_group")))


def integrity(survey: DataFrame, fish: DataFrame, filled: DataFrame, keep: Callable[[DataFrame], DataFrame],
              source: str = "Source", sample: str = "SampleID", taxon: str = "Taxa", length: str = "Length") -> DataFrame:
    """Q12, Q14 of an integrated pair as (check, value) rows: duplicated sample
    ids, duplicated fish keys, samples lost by the zero-fill, samples without
    every taxon of their source, fish rows removed as duplicates.

    The filled table is read twice, for its keys and for one row a sample
    with its taxa, which ``keep`` gets and the other checks read."""
    per_sample = keep(filled.groupBy(source, sample).agg(F.collect_set(taxon).alias("_taxa")))
    every = per_sample.select(source, F.explode("_taxa").alias("_t")).groupBy(source).agg(F.count_distinct("_t").alias("_all"))
    lacking = join(per_sample.select(source, F.size("_taxa").alias("_has")), every, [source], "inner").filter("_has <> _all")
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("check"), "value")
    counted = once(fish).agg((F.sum(ROWS) - F.count(F.lit(1))).alias("value"))
    parts = [n(duplicate_keys(survey, [sample]), "duplicate_sample_ids"),
             n(duplicate_keys(filled, [sample, taxon, length]), "duplicate_fish_keys"),
             n(missing_keys(survey, per_sample, [sample]), "samples_lost"),
             n(lacking, "incomplete_samples"),
             counted.select(F.lit("rows_removed_by_distinct").alias("check"), F.coalesce("value", F.lit(0)).alias("value"))]
    return reduce(DataFrame.unionByName, parts)


def golden_bounds(df: DataFrame, bounds: DataFrame, taxon: str = "Taxa",
                  value: str = "Count") -> DataFrame:
    """Q13: taxa whose row count or total falls below its recorded minimum.
    ``bounds`` holds (taxon, min_rows, min_sum)."""
    got = df.groupBy(taxon).agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"))
    j = join(bounds, got, [taxon], "left")
    return j.filter((F.coalesce(F.col("rows"), F.lit(0)) < F.col("min_rows"))
                    | (F.coalesce(F.col("total"), F.lit(0.0)) < F.col("min_sum")))


def row_loss(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q14: rows lost by a step, as a one-row frame (rows_before, rows_after,
    lost) - computed with two counting aggregates, not on the driver."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return (b.unionByName(a, allowMissingColumns=True)
            .agg(F.max("rows_before").alias("rows_before"), F.max("rows_after").alias("rows_after"))
            .withColumn("lost", F.col("rows_before") - F.col("rows_after")))


def assert_row_loss(before: DataFrame, after: DataFrame, expected: int, tolerance: int = 0) -> int:
    """Q14 as a guard inside a job: raise unless ``expected`` +- tolerance
    rows were removed (one job)."""
    lost = row_loss(before, after).first()["lost"]
    if abs(lost - expected) > tolerance:
        raise ValueError(f"step removed {lost} rows, expected {expected} (+-{tolerance})")
    return lost


def crosswalk_duplicates(species: DataFrame, code_cols: Sequence[str]) -> DataFrame:
    """Q15: codes appearing more than once, checked per code column."""
    parts = [species.filter(F.col(c).isNotNull())
             .groupBy(F.col(c).cast("string").alias("code"))
             .agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1)
             .select(F.lit(c).alias("code_column"), "code", "n") for c in code_cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unknown_codes(df: DataFrame, species: DataFrame, code_col: str, species_code_col: str,
                  allowed: Sequence[str] = ()) -> DataFrame:
    """Q15: codes in the data with no crosswalk entry (new species), except
    the allowed markers such as the empty-net code."""
    known = species.select(F.col(species_code_col).alias(code_col)).filter(F.col(code_col).isNotNull())
    codes = df.select(code_col).filter(F.col(code_col).isNotNull()).distinct()
    if allowed:
        codes = codes.filter(~F.col(code_col).isin(list(allowed)))
    return join(codes, known, [code_col], "left_anti")


def measured_exceeds_catch(df: DataFrame, measured: str = "TotalMeasured",
                           catch: str = "Catch") -> DataFrame:
    """Q16: rows where more fish were measured than caught."""
    return df.filter(F.col(measured) > F.col(catch))
