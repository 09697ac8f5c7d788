"""Summaries, slicing and reconciliation.

Every summary is a ``groupBy``/``agg`` (partial aggregation before the
shuffle); nothing is collected to the driver - row counts and size
estimates are returned as one-row DataFrames.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.functions.exprs import diff_cols
from shoal.functions.nulls import sum0
from shoal.operators.filters import length_window, slice_filter
from shoal.operators.joins import join, lookup
from shoal.operators.windows import daily_running_sum

# Spreadsheet row limit and CSV bytes-per-row estimate.
SPREADSHEET_ROWS = 1_048_576
MIB_PER_ROW = 0.00025


def mean_by(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Mean per key (several depths per sample, k-factors per meter);
    nulls are skipped, an all-null group is null."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out or value))


def taxon_totals(fish: DataFrame, taxon: str = "Taxa", value: str = "Count") -> DataFrame:
    """Total per taxon, positives only (ascending order is presentation)."""
    return (fish.groupBy(taxon).agg(sum0(value).alias(value))
            .filter(F.col(value) > 0))


def yearly_catch(df: DataFrame, year: str = "Year", taxon: str = "Taxa",
                 value: str = "Count") -> DataFrame:
    """Total per (year, taxon)."""
    return df.groupBy(year, taxon).agg(sum0(value).alias(value))


def sum_over_lengths(fish: DataFrame, sample: str = "SampleID", taxon: str = "Taxa",
                     value: str = "Count") -> DataFrame:
    """Counts summed over lengths per (sample, taxon), nulls ignored."""
    return fish.groupBy(sample, taxon).agg(sum0(value).alias(value))


def coverage(survey: DataFrame, lat: str = "Latitude", lon: str = "Longitude",
             date: str = "Date") -> DataFrame:
    """Bounding box and date range (one row)."""
    return survey.agg(F.min(lat).alias("south"), F.max(lat).alias("north"),
                      F.min(lon).alias("west"), F.max(lon).alias("east"),
                      F.min(date).alias("begin"), F.max(date).alias("end"))


def profile(df: DataFrame, source: str = "Source", sample: str = "SampleID",
            taxon: str = "Taxa", length: str = "Length", value: str = "Count") -> DataFrame:
    """Per-source profile: rows, zero counts, positive lengths, null
    lengths, distinct samples and taxa (counts plus sorted distinct lists)."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(value) == 0).alias("zero_counts"),
        F.count_if(F.col(length) > 0).alias("positive_lengths"),
        F.count_if(F.col(length).isNull()).alias("null_lengths"),
        F.count_distinct(sample).alias("samples"),
        F.count_distinct(taxon).alias("taxa"),
        F.sort_array(F.collect_set(taxon)).alias("taxa_list"),
    )


def dimensions(survey: DataFrame, fish: DataFrame, date: str = "Date",
               source: str = "Source", taxon: str = "Taxa",
               length: str = "Length") -> DataFrame:
    """The slice dimensions as (dimension, value) rows: the distinct
    sources and taxa (nulls dropped, as R's ``sort`` does), the year range
    and the largest positive length.  One aggregation per table; the
    distinct lists are bounded by their domains (sources, the taxon
    crosswalk), not by the data volume."""
    s = survey.agg(F.collect_set(source).alias("v"), F.min(F.year(date)).alias("lo"),
                   F.max(F.year(date)).alias("hi"))
    f = fish.agg(F.collect_set(taxon).alias("v"),
                 F.max(F.when(F.col(length) > 0, F.col(length))).alias("mx"))
    entry = lambda name, value: F.struct(F.lit(name).alias("dimension"), value.cast("string").alias("value"))
    s_rows = s.select(F.explode(F.concat(
        F.transform("v", lambda x: entry("source", x)),
        F.array(entry("year_min", F.col("lo")), entry("year_max", F.col("hi"))))).alias("e"))
    f_rows = f.select(F.explode(F.concat(
        F.transform("v", lambda x: entry("taxon", x)),
        F.array(entry("length_max", F.col("mx"))))).alias("e"))
    return s_rows.unionByName(f_rows).select("e.dimension", "e.value")


def extract_profile(df: DataFrame) -> DataFrame:
    """Row count, whether it fits a spreadsheet, estimated CSV size."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        (F.col("rows") <= SPREADSHEET_ROWS).alias("fits_spreadsheet"),
        (F.col("rows") * F.lit(MIB_PER_ROW * 1048576)).alias("bytes_estimate"))


def numeric_checksum(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column sums, to audit that a transform kept the totals."""
    return df.agg(*[F.sum(c).alias(c) for c in cols])


def slice_query(survey: DataFrame, fish: DataFrame, sources=None, months=None, years=None,
                taxa=None, bounds: dict | None = None, default_bounds=None,
                aggregate: bool = False, sample: str = "SampleID") -> DataFrame:
    """K14 (F14, F15, A15, J14): filter samples, filter fish (taxa and, when
    aggregating, per-source length windows), sum over lengths, then join
    survey-left so samples without a selected fish stay.

    The per-source window needs the source on the fish side; it comes from
    a semi-joined projection of the filtered survey (no id in-list)."""
    s = slice_filter(survey, sources, months, years)
    f = fish
    if taxa is not None:
        f = f.filter(F.col("Taxa").isin(list(taxa)))
    if aggregate:
        src = s.select(sample, "Source")
        f = join(f, src, [sample], "inner")
        f = length_window(f, bounds or {}, default_bounds or (float("-inf"), float("inf")))
        f = sum_over_lengths(f.drop("Source"))
    return join(s, f, [sample], "left")


def summarise_by(df: DataFrame, keys: Sequence[str], volume: str, value: str,
                 volume_out: str = "Acrefeet", value_out: str = "Salvage") -> DataFrame:
    """Sums of volume and count per key (nulls ignored)."""
    return df.groupBy(*keys).agg(sum0(volume).alias(volume_out), sum0(value).alias(value_out))


def daily_total(df: DataFrame, keys: Sequence[str], value: str,
                out: str = "dailySalvage") -> DataFrame:
    """The per-(date, facility) total attached to each row."""
    t = df.groupBy(*keys).agg(sum0(value).alias(out))
    return join(df, t, keys, "left")


def reconcile(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], ours_col: str,
              theirs_col: str) -> DataFrame:
    """K15 (J16, P38): full outer compare of two summaries with difference
    and proportional difference."""
    j = join(ours, theirs, keys, "full")
    d, p = diff_cols(ours_col, theirs_col)
    return j.withColumn("difference", d).withColumn("prop_difference", p)


def explain_differences(compared: DataFrame, known: DataFrame, keys: Sequence[str], known_col: str,
                        difference: str = "difference", tolerance: float = 1e-6) -> DataFrame:
    """``compared`` with the listed differences (``keys, known_col``, several
    rows a key add up): ``known`` and ``status``, one of ``equal``, ``known``
    (the whole difference is listed), ``changed`` (another one is), ``new``, and
    ``gone`` (one is listed, there is none any more).  A key that one side
    lacks has no difference to compare and is ``new`` unless listed."""
    listed = known.groupBy(*keys).agg(F.sum(known_col).alias("known"))
    j = join(compared, listed, keys, "full")
    d, k = F.col(difference), F.col("known")
    none, near = F.abs(d) <= tolerance, F.abs(d - k) <= tolerance
    status = (F.when(k.isNull(), F.when(F.coalesce(none, F.lit(False)), "equal").otherwise("new"))
              .when(F.coalesce(near, F.lit(False)), "known")
              .when(d.isNull() | none, "gone").otherwise("changed"))
    return j.withColumn("status", status)


def cumulative_compare(df: DataFrame, partition: Sequence[str], date: str,
                       value_cols: Sequence[str], name: str = "series",
                       value: str = "value") -> DataFrame:
    """K15 (R1, W4): unpivot the compared columns, then the running sum by
    date within each (partition, series)."""
    long = df.unpivot([*partition, date], list(value_cols), name, value)
    return daily_running_sum(long, [*partition, name], date, value, out="cumulative")


def convert_length(df: DataFrame, equations: DataFrame, sources: Sequence[str] = ("Suisun",),
                   source: str = "Source", taxon: str = "Taxa",
                   length: str = "Length") -> DataFrame:
    """Standard -> fork length, ``Intercept + Slope * SL`` by species,
    for the standard-length surveys; unmatched species keep their length."""
    eq = equations.select(F.col("Species").alias(taxon), "Intercept", "Slope")
    j = lookup(df, eq, [taxon])
    applies = F.col(source).isin(list(sources)) & F.col("Slope").isNotNull()
    return (j.withColumn(length, F.when(applies, F.col("Intercept") + F.col("Slope") * F.col(length))
                         .otherwise(F.col(length)))
            .drop("Intercept", "Slope"))


# Salmon loss constants (pump bay widths, screen efficiency,
# survival, release and second-flush factors).
BAY_WIDTHS = [21, 21, 43, 43, 21]
OTHER_FACILITY_WIDTH = 84
SMALL_FISH_MM = 101
EFFICIENCY_SMALL = (0.630, 0.0494)
EFFICIENCY_LARGE = (0.568, 0.0579)
SURVIVAL = {"SWP": 0.25, "CVP": 0.85}
RELEASE_SMALL = 0.98
FLUSH_FACTOR = {"SWP": 4.33, "CVP": 0.569}


def salmon_loss(df: DataFrame, facility: str = "Facility", pumps: Sequence[str] = (
        "BayPump1", "BayPump2", "BayPump3", "BayPump4", "BayPump5"),
        flow: str = "PrimaryFlow", depth: str = "PrimaryDepth", length: str = "Length",
        count: str = "Count", method: str = "Method") -> DataFrame:
    """Encounter, entrainment, release and loss per salvaged salmon row.

    Louver width comes from the pump-bay flags at one facility, a constant
    at the other; screen efficiency depends on length; loss is
    entrainment - release for normal counts and a fixed factor of the count
    for second flushes.
    """
    width = sum((F.when(F.col(p), F.lit(w)).otherwise(F.lit(0))
                 for p, w in zip(pumps, BAY_WIDTHS)), F.lit(0))
    total_width = F.when(F.col(facility) == "SWP", width).otherwise(F.lit(OTHER_FACILITY_WIDTH))
    velocity = F.try_divide(F.col(flow), F.col(depth) * total_width)
    small = F.col(length) < SMALL_FISH_MM
    eff = F.when(small, EFFICIENCY_SMALL[0] + EFFICIENCY_SMALL[1] * velocity) \
        .otherwise(EFFICIENCY_LARGE[0] + EFFICIENCY_LARGE[1] * velocity)
    encounter = F.try_divide(F.col(count), eff)
    entrain = F.when(F.col(facility) == "SWP", encounter / SURVIVAL["SWP"]) \
        .otherwise(encounter / SURVIVAL["CVP"])
    release = F.when(small, F.col(count) * RELEASE_SMALL).otherwise(F.col(count))
    loss = (F.when(F.col(method) == "0000", entrain - release)
            .when((F.col(facility) == "SWP") & (F.col(method) == "9999"), F.col(count) * FLUSH_FACTOR["SWP"])
            .when((F.col(facility) == "CVP") & (F.col(method) == "9999"), F.col(count) * FLUSH_FACTOR["CVP"]))
    return (df.withColumn("TotalWidth", total_width).withColumn("Encounter", encounter)
            .withColumn("Entrain", entrain).withColumn("Release", release)
            .withColumn("Loss", loss))
