"""Registered queries: each operator family run on the driver's tables.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the
equivalent DuckDB SQL lives in :mod:`shoal.plans.oracle`.  Doubles are
rounded to 6 places and counts cast to bigint so results hash equally on
both engines (parallel sums reorder floating-point additions).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from threading import Lock
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.functions import exprs, salinity
from shoal.operators import analyze, expand, fill, filters, joins, quality, reshape, windows
from shoal.plans import roles, surveys
from shoal.plans.integrate import build_species, crosswalk_changes, integrate, organism_names, publication, refresh_species
from shoal.session import Stored, checkpoint_dir, freeing, materialise, stored_bytes
from shoal.sources.io import Registry, load_lookup, load_tables, once, publish, read_typed_csv, scan_union, typed, \
    write_csv, write_integrated
from shoal.sources.sparse import SparseStore, table_name, write_bucketed, write_sparse
from shoal.sources.versions import Versions, replace_sources

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def q6(c) -> F.Column:
    """Round half up to 6 places with plain IEEE steps (multiply, add,
    floor, divide), which every engine evaluates bit-identically; used where
    values with short decimal expansions make exact ties common, on which
    engines' ``round`` implementations disagree."""
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * 1000000.0 + 0.5) / 1000000.0


@register("zero_fill")
def q_zero_fill(spark: SparkSession, d: str) -> DataFrame:
    """Z1 + F10 (+U1): the integrate step's fish table."""
    out = fill.integrate_fish(roles.fish(spark, d))
    return out.select("SampleID", "Taxa", "Length", "Count", "Notes_catch")


# -- expansion family -----------------------------------------------------------

@register("expand_counts")
def q_expand_counts(spark: SparkSession, d: str) -> DataFrame:
    """A1 + A2 (+W1 as aggregate-and-join): catch left join measured lengths."""
    out = expand.expand_counts(roles.catch(spark, d), roles.lengths(spark, d),
                               ["SampleID", "Taxa"])
    return out.select("SampleID", "Taxa", "Length", r6("Count").alias("Count"))


@register("expand_overflow")
def q_expand_overflow(spark: SparkSession, d: str) -> DataFrame:
    """Catch raised to the measured number; unmeasured catch keeps its count."""
    ln = roles.lines(spark, d)
    catch = (ln.groupBy("SampleID", "Taxa")
             .agg(F.count_if(F.col("discount") >= 0.05).cast("double").alias("Catch")))
    lengths = ln.select("SampleID", "Taxa",
                        F.when(F.col("Length") == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("Length")).alias("Length"))
    out = expand.expand_raise_catch(catch, lengths, ["SampleID", "Taxa"])
    return out.select("SampleID", "Taxa", "Length", r6("Count").alias("Count"), "CatchNew",
                      "Length_NA_flag")


@register("plus_count_group")
def q_plus_count_group(spark: SparkSession, d: str) -> DataFrame:
    """Expansion within (sample, organism, group) with the zero-measured branch."""
    rows = roles.lines(spark, d).select(
        "SampleID", "Taxa", F.col("returnflag").alias("Grp"), "Length",
        F.round(F.col("tax") * 100).alias("Count"))
    out = expand.expand_plus_count_group(rows, ["SampleID", "Taxa", "Grp"])
    return out.select("SampleID", "Taxa", "Grp", "Length", r6("Count").alias("Count"),
                      "Length_NA_flag")


@register("size_group_expand")
def q_size_group_expand(spark: SparkSession, d: str) -> DataFrame:
    """J8 + A9: unmeasured fish define a "< length" size range; measured fish
    inside it join its size group; expansion runs per size group."""
    rows = roles.lines(spark, d).select(
        "SampleID", "Taxa", "Length", "quantity",
        F.when(F.col("discount") >= 0.05, F.lit(2.0)).otherwise(F.lit(1.0)).alias("Count"))
    unmeasured = windows.numbered(rows.filter(F.col("Length") == 0), ["quantity", "Count"],
                                  ["SampleID", "Taxa"], out="SizeGroup")
    unmeasured = unmeasured.withColumn("SizeGroup", F.col("SizeGroup") + 1)
    ranges = unmeasured.select("SampleID", "Taxa", F.lit(None).cast("double").alias("Min_length"),
                               F.col("quantity").alias("Max_length"), "SizeGroup")
    measured = joins.assign_size_groups(rows.filter(F.col("Length") != 0), ranges,
                                        ["SampleID", "Taxa"], "Length")
    grouped = measured.unionByName(unmeasured)
    out = expand.expand_size_groups(grouped.drop("quantity"), ["SampleID", "Taxa", "SizeGroup"])
    return out.select("SampleID", "Taxa", "SizeGroup", "Length", r6("Count").alias("Count"),
                      "Length_NA_flag")


@register("time_expand")
def q_time_expand(spark: SparkSession, d: str) -> DataFrame:
    """A10: raise to measured, expand by length frequency, then by pumping time."""
    ln = roles.lines(spark, d)
    tm = ln.groupBy("SampleID", "Taxa").agg(
        F.count_if(F.col("Length") != 0).cast("double").alias("TotalMeasured"))
    rows = joins.join(joins.join(ln, roles.catch(spark, d), ["SampleID", "Taxa"], "inner"),
                      tm, ["SampleID", "Taxa"], "inner").select(
        "SampleID", "Taxa", "Length", F.col("Catch").alias("Count"), "TotalMeasured",
        F.when(F.col("Length") != 0, F.lit(1.0)).alias("LengthFrequency"),
        F.col("quantity").alias("MinutesPumping"),
        F.when(F.col("tax") == 0, F.lit(0.0)).otherwise(F.lit(10.0)).alias("SampleTimeLength"),
        F.when(F.col("returnflag") == "A", F.lit("0000"))
         .when(F.col("returnflag") == "N", F.lit("9999")).otherwise(F.lit("8888")).alias("StudyRowID"),
        (F.col("discount") > 0).alias("FishCaught"),
        F.col("SampleID").alias("Station"),
        F.col("linenumber").alias("OrganismCode"))
    out = expand.expand_time(rows)
    return out.select("SampleID", "Taxa", "Length", r6("Count1").alias("Count1"),
                      r6("ExpandedCount").alias("ExpandedCount"), r6("Count").alias("Count"))


@register("volumetric_expand")
def q_volumetric_expand(spark: SparkSession, d: str) -> DataFrame:
    """A3: total catch from measured + plus count scaled by volumes."""
    ln = roles.lines(spark, d)
    lengths = ln.filter(F.col("Length") != 0).select("SampleID", "Taxa", "Length", "Frequency")
    catch = ln.groupBy("SampleID", "Taxa").agg(
        F.when(F.min("discount") == 0, F.lit(None).cast("double"))
         .otherwise(F.count_if(F.col("Length") == 0).cast("double")).alias("PlusCount"),
        F.sum("quantity").alias("QtsCaught"),
        F.sum(F.when(F.col("Length") == 0, F.lit(0.0)).otherwise(F.col("quantity"))).alias("QtsSubsampled"))
    out = expand.expand_volumetric(catch, lengths, ["SampleID", "Taxa"])
    return out.select("SampleID", "Taxa", "Length", "Frequency", r6("Count").alias("Count"))


@register("merge_duplicates")
def q_merge_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """A11 + N6: group by every other column, strict sum of Count."""
    f = roles.fish(spark, d).select("Source", "SampleID", "Taxa", "Length", "Count")
    out = expand.merge_duplicates(f, "Count")
    return out.withColumn("Count", r6("Count"))


@register("no_catch_retention")
def q_no_catch_retention(spark: SparkSession, d: str) -> DataFrame:
    """J7 + P25 + P26: samples left join expanded catch; empty samples become
    one "No fish caught" row with count 0."""
    ex = expand.expand_counts(roles.catch(spark, d), roles.lengths(spark, d),
                              ["SampleID", "Taxa"]).select("SampleID", "Taxa", "Length", "Count")
    s = roles.samples(spark, d).select("SampleID", "Source")
    out = joins.retain_samples(s, ex, ["SampleID"])
    out = out.withColumn("Length_NA_flag", exprs.length_flag("Length", "Count"))
    out = out.withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
    return out.select("SampleID", "Source", "Taxa", "Length", r6("Count").alias("Count"),
                      "Length_NA_flag")


@register("null_safe_lookup")
def q_null_safe_lookup(spark: SparkSession, d: str) -> DataFrame:
    """J1 + J2 + N1: crosswalk code -> taxon, then a code table whose null
    code decodes null codes (dplyr matches NA to NA)."""
    li = roles.read(spark, d, "lineitem").select(
        "l_partkey", F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.col("l_returnflag")).alias("code"))
    species = roles.read(spark, d, "part").select("p_partkey", F.col("p_brand").alias("Taxa"))
    t = joins.to_taxa(li, species, "l_partkey", "p_partkey")
    codes = li.select("code").distinct().withColumn(
        "label", F.coalesce(F.concat(F.lit("flag "), F.col("code")), F.lit("missing")))
    dec = joins.decode(t, codes, "code", "code", "label", "label")
    return dec.groupBy("code", "label", "Taxa").agg(F.count(F.lit(1)).alias("n"))


@register("full_outer_chain")
def q_full_outer_chain(spark: SparkSession, d: str) -> DataFrame:
    """Sample -> tow -> catch chain of full outer joins, keys coalesced.
    All rows take part; pending samples and late tows have keys of their own
    (negative), which the other tables do not know."""
    ln = roles.lines(spark, d)
    a = roles.samples(spark, d).select(
        F.when(F.col("Source") == "P", -F.col("SampleID")).otherwise(F.col("SampleID")).alias("SampleID"), "Source")
    b = ln.select("SampleID", F.when(F.col("linenumber") > 4, -F.col("linenumber"))
                  .otherwise(F.col("linenumber")).alias("Tow"), "quantity")
    c = ln.select("SampleID", F.when(F.col("discount") < 0.03, F.col("linenumber") + 100)
                  .otherwise(F.col("linenumber")).alias("Tow"), "Taxa", "price")
    out = joins.full_outer_chain([(a, []), (b, ["SampleID"]), (c, ["SampleID", "Tow"])])
    return out.select("SampleID", "Source", "Tow", "quantity", "Taxa", "price")


@register("calibration_fallback")
def q_calibration_fallback(spark: SparkSession, d: str) -> DataFrame:
    """J5 + A12 + P14: meter k-factor by (year, serial) else the serial's
    mean, then tow volume.  The corrections of a meter's later years are
    filed one year late, so those tows take the mean."""
    li = roles.read(spark, d, "lineitem")
    sup = roles.read(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    corr = (li.join(sup, li.l_suppkey == sup.s_suppkey)
            .groupBy((F.year("l_shipdate") + F.when(F.col("s_nationkey") % 2 == 0, 20).otherwise(0)).alias("Year"),
                     F.col("s_nationkey").alias("Serial"))
            .agg(F.avg("l_discount").alias("kFactor")))
    o = roles.read(spark, d, "orders")
    c = roles.read(spark, d, "customer").select("c_custkey", "c_nationkey")
    tows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("SampleID"), F.year("o_orderdate").alias("Year"),
        F.col("c_nationkey").alias("Serial"), (F.col("o_totalprice") / 1000).alias("MeterCheck"))
    out = joins.calibrate(tows, corr, "Year", "Serial")
    out = out.withColumn("Tow_volume", exprs.tow_volume("MeterCheck", F.col("kFactor_final"), 1.51))
    return out.select("SampleID", r6("kFactor_final").alias("kFactor_final"),
                      r6("Tow_volume").alias("Tow_volume"))


# -- filters ----------------------------------------------------------------------

# Patterns that do occur in the driver's document text (license lines,
# e-mail addresses, phone-like numbers), to exercise the same filter.
NOTE_HIT_PATTERNS = [r"licen[cs]e", r"@", r"\d{3}-\d{4}"]


def _doc_samples(spark: SparkSession, d: str) -> DataFrame:
    docs = roles.read(spark, d, "documents").select("doc_id", "text", "lang")
    lab = roles.read(spark, d, "labels").select("doc_id", "quality")
    j = joins.join(docs, lab, ["doc_id"], "left", null_safe=False)
    return j.select(
        F.col("doc_id").alias("SampleID"), F.col("text").alias("Notes_tow"),
        F.col("quality").cast("double").alias("Count"),
        F.when(F.col("lang") == "en", F.lit("Normal count")).otherwise(F.lit("Second flush")).alias("Method"))


@register("notes_regex")
def q_notes_regex(spark: SparkSession, d: str) -> DataFrame:
    """drop no-sampling notes with zero count under the normal method."""
    out = filters.drop_no_sampling(_doc_samples(spark, d), "Notes_tow", surveys.NO_SAMPLING_PATTERNS)
    return out.select("SampleID", "Count", "Method")


@register("notes_regex_hits")
def q_notes_regex_hits(spark: SparkSession, d: str) -> DataFrame:
    """F6 with patterns present in the text (whole documents are scanned)."""
    out = filters.drop_no_sampling(_doc_samples(spark, d), "Notes_tow", NOTE_HIT_PATTERNS)
    return out.select("SampleID", "Count", "Method")


@register("drop_spurious_no_fish")
def q_drop_spurious_no_fish(spark: SparkSession, d: str) -> DataFrame:
    """F9 + W2: empty-net markers (the UnID brand) vanish from samples with fish."""
    rows = roles.lines(spark, d).select("SampleID", "Taxa", "Length",
                                        (F.col("linenumber") - 1).cast("double").alias("Count"))
    return filters.drop_spurious_no_fish(rows, "SampleID", "Count", F.col("Taxa") == "UnID")


@register("drop_totals")
def q_drop_totals(spark: SparkSession, d: str) -> DataFrame:
    """F8: pseudo-organism totals (codes 6, 7) kept only as a sample's sole
    code; samples with the excluded organism (5) lose them, as does 5 itself."""
    rows = roles.read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("SampleID"), F.col("l_linenumber").alias("OrganismCode"),
        F.col("l_quantity").alias("quantity"))
    return filters.drop_totals(rows, "SampleID", "OrganismCode", (6, 7), (5,))


@register("exclusion_windows")
def q_exclusion_windows(spark: SparkSession, d: str) -> DataFrame:
    """per-station exclusion windows and listed days (from the data)."""
    s = joins.join(roles.samples(spark, d), roles.stations(spark, d), ["custkey"], "inner",
                   null_safe=False).select("SampleID", "Source", "Station", "Date")
    first = s.groupBy("Station").agg(F.min("Date").alias("start")).withColumn(
        "end", F.date_add("start", 30))
    last = s.groupBy("Station").agg(F.max("Date").alias("start")).withColumn("end", F.col("start"))
    out = joins.exclude(s, first.unionByName(last), ["Station"], "Date",
                        conditions=F.col("Source") == "F")
    return out.select("SampleID", "Source", "Station", "Date")


@register("patch_table")
def q_patch_table(spark: SparkSession, d: str) -> DataFrame:
    """Record corrections from a patch table (set mode)."""
    li = roles.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_quantity", "l_discount")
    patches = li.filter(F.col("l_discount") == 0.1).select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") * 2).alias("l_quantity"))
    out = joins.apply_patches(li, patches, ["l_orderkey", "l_linenumber", "l_partkey"],
                              ["l_quantity"], "set")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@register("partial_lengths")
def q_partial_lengths(spark: SparkSession, d: str) -> DataFrame:
    """a catch with exactly one unmeasured row loses that row."""
    rows = roles.lines(spark, d).select(
        "SampleID", "Taxa", "Length",
        F.when(F.col("Length") == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0)).alias("LengthFrequency"),
        F.lit(None).cast("string").alias("Length_NA_flag"),
        (F.col("discount") > 0.02).alias("FishCaught"))
    rows = rows.withColumn("CatchKey", F.concat_ws(" ", F.col("SampleID").cast("string"), "Taxa"))
    out = filters.drop_partial_lengths(rows, "CatchKey", "LengthFrequency", "Length_NA_flag",
                                       "FishCaught")
    return out.select("SampleID", "Taxa", "Length", "LengthFrequency")


# -- row-level derivations ----------------------------------------------------------

@register("salinity")
def q_salinity(spark: SparkSession, d: str) -> DataFrame:
    """P10 + P11: conductivity (uS/cm = price / 2) -> PSS-78 salinity at 25 C."""
    li = roles.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    ec_ms = exprs.convert(F.col("l_extendedprice") / 2, "us_cm", "ms_cm")
    out = salinity.with_salinity(li, ec_ms, "Sal_surf", 25.0)
    out = out.withColumn("Sal_clamped", salinity.clamp_salinity(F.col("Sal_surf")))
    return out.select("l_orderkey", "l_linenumber", r6("Sal_surf").alias("Sal_surf"),
                      r6("Sal_clamped").alias("Sal_clamped"))


@register("dms_units")
def q_dms_units(spark: SparkSession, d: str) -> DataFrame:
    """P7 + P9: station coordinates from deg/min/sec; unit conversions."""
    c = roles.read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = roles.read(spark, d, "nation").select("n_nationkey", "n_regionkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    secs = F.abs(F.col("c_acctbal")) / 200
    return j.select(
        F.col("c_custkey").alias("custkey"),
        r6(exprs.dms_to_decimal(F.lit(37) + F.col("n_regionkey"), F.col("c_nationkey"), secs)).alias("Latitude"),
        r6(exprs.dms_to_decimal(F.lit(121), F.col("c_nationkey"), secs, west=True)).alias("Longitude"),
        r6(exprs.convert("c_acctbal", "ft", "m")).alias("Depth"),
        r6(exprs.convert("c_acctbal", "F", "C")).alias("Temp_surf"),
        r6(exprs.convert("c_acctbal", "m", "cm")).alias("Secchi"),
        r6(exprs.convert("c_acctbal", "acre_ft", "m3")).alias("Tow_volume"),
        r6(exprs.convert("c_acctbal", "nmi", "m")).alias("Distance"))


@register("meter_effort")
def q_meter_effort(spark: SparkSession, d: str) -> DataFrame:
    """P13 + P14 + P16 + P17: meter rollover, tow volume, default and
    invalidated effort."""
    li = roles.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                                 "l_quantity", "l_returnflag", "l_tax")
    delta = exprs.meter_delta(F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    vol = exprs.tow_volume(delta, 0.026873027, 13.95)
    start = F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice"))
    dflt = exprs.default_effort(vol, 735.0, missing_when=start.isNull(),
                                suspect=F.col("l_linenumber") == 7)
    debris = F.when(F.col("l_returnflag") == "R", F.lit("Y")).when(F.col("l_returnflag") == "A", F.lit("N"))
    return li.select("l_orderkey", "l_linenumber", r6(delta).alias("Meter_total"),
                     r6(vol).alias("Tow_volume"), r6(dflt).alias("Tow_volume_default"),
                     r6(exprs.invalidate_effort(vol, debris, zero_is_null=True)).alias("Tow_volume_valid"))


@register("compose_datetime")
def q_compose_datetime(spark: SparkSession, d: str) -> DataFrame:
    """P18 + P19 + P36: local datetime from ship date + a clock time, with
    the midnight rule and the spring-forward gap repair."""
    li = roles.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                              "l_shipdate")
    hh = F.lpad((F.col("l_quantity").cast("int") % 24).cast("string"), 2, "0")
    mm = F.lpad(((F.col("l_linenumber") - 1) * 7).cast("string"), 2, "0")
    clock = F.concat_ws(":", hh, mm, F.lit("00"))
    staged = (li.withColumn("dt", exprs.compose_datetime(F.to_date("l_shipdate"), clock,
                                                         midnight_is_null=True))
              .withColumn("fixed", exprs.fix_dst_gap(F.col("dt"))))
    fixed = F.col("fixed")
    # NTZ -> text without passing through the session time zone
    return staged.select("l_orderkey", "l_linenumber",
                         F.col("dt").cast("string").alias("Datetime"),
                         fixed.cast("string").alias("Datetime_fixed"),
                         F.year(fixed).alias("year"), F.month(fixed).alias("month"),
                         F.hour(fixed).alias("hour"), F.minute(fixed).alias("minute"))


@register("codes_labels")
def q_codes_labels(spark: SparkSession, d: str) -> DataFrame:
    """P4 + P5 + P6 + P23 + P24 + P27 + P28: decode codes, classify by regex,
    build and strip life-stage labels, pad station codes."""
    p = roles.read(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")
    stage = (F.when(F.col("p_size") < 10, F.lit("Age-0"))
             .when(F.col("p_size") < 20, F.lit("Juvenile")))
    label = exprs.taxa_label("p_name", stage)
    return p.select(
        "p_partkey",
        exprs.tide("p_size").alias("Tide"),
        exprs.tow_status("p_size").alias("Tow_status"),
        exprs.classify("p_type", [("^ECO", "Economy"), ("^(SMALL|MEDIUM)", "Sized")]).alias("Class"),
        label.alias("Taxa_label"),
        exprs.strip_lifestage(label).alias("Taxa"),
        exprs.pad_station("p_size", 3).alias("Station"),
        F.upper("p_name").alias("Name_upper"))


@register("sample_ids")
def q_sample_ids(spark: SparkSession, d: str) -> DataFrame:
    """P21 + P22 + W3: natural-key ids (nulls spelled NA) and ids numbered
    within (station, year) by a total order (a station's year is small, and a
    hot source is spread over its stations)."""
    o = roles.read(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey",
        F.when(F.col("o_orderpriority").startswith("5"), F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("priority"))
    o = o.withColumn("year", F.year("o_orderdate"))
    n = windows.numbered(o, ["o_orderdate", "o_orderkey"], ["o_custkey", "year"])
    return n.select("o_orderkey",
                    exprs.sample_id("o_orderstatus", "o_orderkey", "priority").alias("SampleID"),
                    exprs.sample_id("o_custkey", "year", "n").alias("NumberedID"))


@register("facility_station")
def q_facility_station(spark: SparkSession, d: str) -> DataFrame:
    """Facility from the sample method (1 SWP, 2 CVP, else the lookup's
    label), station label with the CVP repair, facility extracted back."""
    o = roles.read(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "O", F.lit(2))
        .alias("method"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit(None).cast("string"))
        .otherwise(F.substring("o_orderpriority", 3, 20)).alias("location"),
        F.when(F.col("o_orderpriority").startswith("2"), F.lit("SWP")).alias("fallback"))
    st = exprs.facility_station("method", "location", "fallback")
    return o.select("o_orderkey", st.alias("Station"), exprs.extract_facility(st).alias("Facility"))


@register("size_comments")
def q_size_comments(spark: SparkSession, d: str) -> DataFrame:
    """Parse size/life-stage hints from whole note texts."""
    docs = roles.read(spark, d, "documents").select("doc_id", "text")
    p = exprs.parse_size_comment("text")
    return docs.select("doc_id", p["min_length"].alias("min_length"),
                       p["approx_length"].alias("approx_length"),
                       p["max_length"].alias("max_length"), p["number"].alias("number"),
                       p["lifestage"].alias("lifestage"), p["ignore"].alias("ignore"))


# -- integrate, slice, summaries ----------------------------------------------------

def _survey_fish(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return reshape.normalise([roles.dataset(spark, d)])


@register("normalise_survey")
def q_normalise_survey(spark: SparkSession, d: str) -> DataFrame:
    """R4 + P2 + A23: the survey table (known columns, contract order, distinct)."""
    survey, _ = _survey_fish(spark, d)
    return survey.withColumn("Sal_surf", r6("Sal_surf")).withColumn(
        "Temp_surf", r6("Temp_surf")).withColumn("Tow_volume", r6("Tow_volume")).withColumn(
        "Latitude", r6("Latitude")).withColumn("Longitude", r6("Longitude"))


@register("normalise_fish")
def q_normalise_fish(spark: SparkSession, d: str) -> DataFrame:
    """R4 + A23: the fish table (Source, SampleID, Taxa, Length, Count), distinct."""
    _, fish_t = _survey_fish(spark, d)
    return fish_t.withColumn("Count", r6("Count"))


@register("measured_lengths")
def q_measured_lengths(spark: SparkSession, d: str) -> DataFrame:
    """K11 (F4, J11, P23, A1): measured fish of the samples that survived;
    pending samples are known by another id and do not."""
    kept = roles.dataset(spark, d).withColumn("SampleID", F.when(F.col("Source") == "P", -F.col("SampleID"))
                                              .otherwise(F.col("SampleID")))
    ln = filters.measured_only(roles.lengths(spark, d))
    ln = joins.semi(ln, kept, ["SampleID"]).withColumn("Taxa", exprs.strip_lifestage("Taxa"))
    return expand.length_frequency(ln, ["SampleID", "Taxa"], "Length", "Frequency", out="Count")


@register("slice_aggregate")
def q_slice_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """K14 (F14, F15, A15, J14): sources x months x years slice, per-source
    length windows, counts summed over lengths, survey-left join."""
    survey, fish_t = _survey_fish(spark, d)
    out = analyze.slice_query(survey.select("Source", "SampleID", "Date"), fish_t.drop("Source"),
                              sources=["F", "O"], months=[1, 2, 3, 4, 5, 6], years=(1996, 2000),
                              bounds={"O": (10.0, 40.0)}, default_bounds=(5.0, 45.0),
                              aggregate=True)
    return out.select("SampleID", "Source", "Date", "Taxa", r6("Count").alias("Count"))


@register("yearly_catch")
def q_yearly_catch(spark: SparkSession, d: str) -> DataFrame:
    """Total count per (year, taxon)."""
    ds = roles.dataset(spark, d).withColumn("Year", F.year("Date"))
    return analyze.yearly_catch(ds).withColumn("Count", r6("Count"))


@register("taxon_totals")
def q_taxon_totals(spark: SparkSession, d: str) -> DataFrame:
    """Total per taxon, positives only."""
    _, fish_t = _survey_fish(spark, d)
    return analyze.taxon_totals(fish_t).withColumn("Count", r6("Count"))


@register("length_window")
def q_length_window(spark: SparkSession, d: str) -> DataFrame:
    """F15 + F16: per-source length windows, unknown lengths kept; size cutoff."""
    _, fish_t = _survey_fish(spark, d)
    w = filters.length_window(fish_t, {"F": (10.0, 30.0), "O": (20.0, 45.0)}, (0.0, 50.0))
    return filters.size_cutoff(w, 3.0).withColumn("Count", r6("Count"))


@register("convert_length")
def q_convert_length(spark: SparkSession, d: str) -> DataFrame:
    """Fork length from standard length by per-species equations."""
    eq = (roles.lines(spark, d).groupBy(F.col("Taxa").alias("Species"))
          .agg((F.avg("tax") * 10).alias("Intercept"), (1 + F.avg("discount")).alias("Slope")))
    ds = roles.dataset(spark, d).select("Source", "SampleID", "Taxa", "Length")
    out = analyze.convert_length(ds, eq, sources=["O"])
    return out.select("Source", "SampleID", "Taxa", r6("Length").alias("Length"))


@register("coverage")
def q_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Bounding box and date range of the survey table."""
    c = analyze.coverage(roles.dataset(spark, d))
    return c.select(r6("south").alias("south"), r6("north").alias("north"), r6("west").alias("west"),
                    r6("east").alias("east"), "begin", "end")


@register("profile")
def q_profile(spark: SparkSession, d: str) -> DataFrame:
    """Per-source profile (rows, zeros, lengths, samples, taxa)."""
    p = analyze.profile(roles.dataset(spark, d))
    return p.withColumn("taxa_list", F.array_join("taxa_list", ","))


@register("dimensions")
def q_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """Slice dimensions: sources, taxa, year range, longest fish."""
    survey, fish_t = _survey_fish(spark, d)
    return analyze.dimensions(survey, fish_t)


def _website(spark: SparkSession, d: str) -> DataFrame:
    """An outside daily series to reconcile with: per (date, source, taxon)
    quantities straight from the line table, one source under another name."""
    ln = joins.join(roles.lines(spark, d), roles.samples(spark, d).select("SampleID", "Source", "Date"),
                    ["SampleID"], "inner", null_safe=False)
    return (ln.withColumn("Source", F.when(F.col("Source") == "P", "Pending").otherwise(F.col("Source")))
            .groupBy("Date", "Source", "Taxa").agg((F.sum("quantity") / 10).alias("Salvage_web")))


@register("reconcile")
def q_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """K15 (A19, J16, P38): our totals vs an outside series per (taxon, source)."""
    ours = analyze.summarise_by(roles.dataset(spark, d),
                                ["Taxa", "Source"], "Tow_volume", "Count", "Volume_db", "Salvage_db")
    theirs = _website(spark, d).groupBy("Taxa", "Source").agg(F.sum("Salvage_web").alias("Salvage_web"))
    out = analyze.reconcile(ours.drop("Volume_db"), theirs, ["Taxa", "Source"], "Salvage_db", "Salvage_web")
    return out.select("Taxa", "Source", r6("Salvage_db").alias("Salvage_db"),
                      r6("Salvage_web").alias("Salvage_web"), r6("difference").alias("difference"),
                      r6("prop_difference").alias("prop_difference"))


@register("reconcile_known")
def q_reconcile_known(spark: SparkSession, d: str) -> DataFrame:
    """K15 with the list of known differences: which are explained, which new,
    which are listed and no longer there."""
    ln = roles.lines(spark, d)
    ours = ln.groupBy("Taxa", "returnflag").agg(F.sum("quantity").alias("ours"))
    theirs = ln.filter("linenumber <> 4").groupBy("Taxa", "returnflag").agg(F.sum("quantity").alias("theirs"))
    some = F.col("returnflag") != "R"
    known = (ln.filter("linenumber = 4").groupBy("Taxa", "returnflag").agg(F.sum("quantity").alias("amount")).filter(some)
             .withColumn("amount", F.when(F.col("returnflag") == "A", F.col("amount") + 1.0).otherwise(F.col("amount")))
             .unionByName(ln.select("Taxa").distinct().select("Taxa", F.lit("X").alias("returnflag"), F.lit(2.0).alias("amount"))))
    compared = analyze.reconcile(ours, theirs, ["Taxa", "returnflag"], "ours", "theirs")
    out = analyze.explain_differences(compared, known, ["Taxa", "returnflag"], "amount")
    return out.select("Taxa", "returnflag", "ours", "theirs", "difference", "known", "status")


@register("cumulative")
def q_cumulative(spark: SparkSession, d: str) -> DataFrame:
    """K15 (R1 + W4): daily totals of both series unpivoted, running sums by date."""
    ours = (roles.dataset(spark, d).groupBy("Date", "Source")
            .agg(F.sum("Count").alias("Salvage_db")))
    theirs = _website(spark, d).groupBy("Date", "Source").agg(F.sum("Salvage_web").alias("Salvage_web"))
    both = joins.compare(ours, theirs, ["Date", "Source"])
    out = analyze.cumulative_compare(both, ["Source"], "Date", ["Salvage_db", "Salvage_web"])
    return out.select("Source", "Date", "series", r6("value").alias("value"),
                      r6("cumulative").alias("cumulative"))


@register("daily_total")
def q_daily_total(spark: SparkSession, d: str) -> DataFrame:
    """Per (date, source) total attached to each row."""
    ds = roles.dataset(spark, d).select("Date", "Source", "SampleID", "Taxa", "Length", "Count")
    out = analyze.daily_total(ds, ["Date", "Source"], "Count")
    return out.select("Date", "Source", "SampleID", "Taxa", "Length", r6("Count").alias("Count"),
                      r6("dailySalvage").alias("dailySalvage"))


@register("domain_fill")
def q_domain_fill(spark: SparkSession, d: str) -> DataFrame:
    """Z3: complete every taxon of the domain per (date, source), marking
    original rows."""
    ds = roles.dataset(spark, d).select("Date", "Source", "Taxa", "Count")
    levels = roles.lines(spark, d).select("Taxa")
    out = fill.domain_fill(ds, ["Date", "Source"], "Taxa", levels, "Count")
    return out.select("Date", "Source", "Taxa", r6("Count").alias("Count"), "originalData")


@register("quality_report")
def q_quality_report(spark: SparkSession, d: str) -> DataFrame:
    """Q1-Q10: one pass of violation counts over the dataset."""
    return quality.quality_report(roles.dataset(spark, d))


@register("quality_by_source")
def q_quality_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Q1-Q10 per source with the first and last offending sample."""
    ds = roles.dataset(spark, d)
    return quality.check_by_source(ds, quality.dataset_rules(ds.columns, dict(ds.dtypes)))


@register("stn_checks")
def q_stn_checks(spark: SparkSession, d: str) -> DataFrame:
    """Q2 + Q11 on the published STN dataset: station list, survey and depth
    ranges, id format, source, date and time types."""
    ds = surveys.stn(*stn_tables(spark, d)).dataset
    rules = {**quality.domain_rules({"Source": ["STN"], "Station": [str(k) for k in range(20)]}),
             **quality.format_rules({"SampleID": "^STN [0-9]+"}),
             **quality.range_rules({"Survey": (1, 6), "Depth": (0.0, 30.0)}),
             **{k: v for k, v in quality.dataset_rules(ds.columns, dict(ds.dtypes)).items() if k.startswith("q2")}}
    return quality.check(ds, rules)


@register("range_checks")
def q_range_checks(spark: SparkSession, d: str) -> DataFrame:
    """Q11 + Q17: per-column value ranges."""
    rules = quality.range_rules({"Length": (1.0, 45.0), "Survey": (1, 6), "Tow_volume": (None, 4000.0),
                                 "Temp_surf": (0.0, 20.0)})
    return quality.check(roles.dataset(spark, d), rules)


@register("crosswalk_duplicates")
def q_crosswalk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Q15: codes duplicated within a crosswalk column, checked per column."""
    return quality.crosswalk_duplicates(roles.read(spark, d, "part"), ["p_size", "p_brand", "p_type"])


@register("unknown_codes")
def q_unknown_codes(spark: SparkSession, d: str) -> DataFrame:
    """Q15: codes used in the data that the lookup does not know (the lookup
    files one region's codes under others)."""
    nat = roles.read(spark, d, "nation").withColumn(
        "n_nationkey", F.when(F.col("n_regionkey") == 0, F.col("n_nationkey") + 1000).otherwise(F.col("n_nationkey")))
    return quality.unknown_codes(roles.read(spark, d, "customer"), nat, "c_nationkey", "n_nationkey")


@register("salmon_loss")
def q_salmon_loss(spark: SparkSession, d: str) -> DataFrame:
    """Encounter, entrainment, release and loss per salvaged row."""
    ln = joins.join(roles.lines(spark, d), roles.samples(spark, d).select("SampleID", "Source"),
                    ["SampleID"], "inner", null_safe=False)
    rows = ln.select(
        "SampleID", "linenumber",
        F.when(F.col("Source") == "F", F.lit("SWP")).otherwise(F.lit("CVP")).alias("Facility"),
        *[(F.col("linenumber") >= i).alias(f"BayPump{i}") for i in range(1, 6)],
        (F.col("price") / 100).alias("PrimaryFlow"), (F.col("quantity") / 10).alias("PrimaryDepth"),
        (F.col("quantity") * 3).alias("Length"), F.col("linenumber").cast("double").alias("Count"),
        F.when(F.col("returnflag") == "N", F.lit("0000")).otherwise(F.lit("9999")).alias("Method"))
    out = analyze.salmon_loss(rows)
    return out.select("SampleID", "linenumber", "Facility", "TotalWidth",
                      *[r6(c).alias(c) for c in ("Encounter", "Entrain", "Release", "Loss")])


@register("extract_profile")
def q_extract_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, spreadsheet fit and CSV size estimate of a slice."""
    p = analyze.extract_profile(roles.dataset(spark, d))
    return p.withColumn("bytes_estimate", r6("bytes_estimate"))


@register("fill_audit")
def q_fill_audit(spark: SparkSession, d: str) -> DataFrame:
    """A22 + Z4: count sums before and after zero-fill are equal."""
    f = roles.fish(spark, d)
    before = analyze.numeric_checksum(f.filter(F.col("Taxa").isNotNull()), ["Count"]).withColumn(
        "stage", F.lit("before"))
    after = analyze.numeric_checksum(fill.zero_fill(f, "Source", "SampleID", "Taxa"), ["Count"]) \
        .withColumn("stage", F.lit("after"))
    return before.unionByName(after).select("stage", r6("Count").alias("Count"))


@register("same_set")
def q_same_set(spark: SparkSession, d: str) -> DataFrame:
    """Ids only in the sample table / only in the catch lines."""
    return reshape.same_set(roles.samples(spark, d), roles.lines(spark, d), ["SampleID"])


@register("first_per_group")
def q_first_per_group(spark: SparkSession, d: str) -> DataFrame:
    """First line per sample by (line number, taxon, quantity)."""
    ln = roles.lines(spark, d).select("SampleID", "linenumber", "Taxa", "quantity")
    ln = ln.withColumn("_ord", F.struct("linenumber", "Taxa", "quantity"))
    return windows.first_per_group(ln, ["SampleID"], "_ord").drop("_ord")


@register("count_over")
def q_count_over(spark: SparkSession, d: str) -> DataFrame:
    """Rows per sample attached to each line."""
    ln = roles.lines(spark, d).select("SampleID", "linenumber", "Taxa")
    return windows.count_over(ln, ["SampleID"])


@register("integrity")
def q_integrity(spark: SparkSession, d: str) -> DataFrame:
    """Q12 + Q14: duplicate survey ids, duplicate fish keys, samples lost by
    zero-fill, samples missing a taxon, rows removed by distinct."""
    survey, fish_t = reshape.normalise([materialise(roles.dataset(spark, d))])
    filled = fill.zero_fill(fish_t, "Source", "SampleID", "Taxa")
    return quality.integrity(survey, fish_t, filled, materialise)


@register("golden_bounds")
def q_golden_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Q13: taxa below their recorded minimum rows or total."""
    ln = roles.lines(spark, d)
    bounds = ln.groupBy("Taxa").agg((F.count_if(F.col("returnflag") == "R") * 3).alias("min_rows"),
                                    (F.sum("quantity") / 20).alias("min_sum"))
    _, fish_t = _survey_fish(spark, d)
    out = quality.golden_bounds(fish_t, bounds)
    return out.select("Taxa", "min_rows", r6("min_sum").alias("min_sum"), "rows", r6("total").alias("total"))


@register("measured_exceeds_catch")
def q_measured_exceeds_catch(spark: SparkSession, d: str) -> DataFrame:
    """Q16: catches with more fish measured than caught."""
    ln = roles.lines(spark, d)
    catch = (ln.groupBy("SampleID", "Taxa")
             .agg(F.count_if(F.col("discount") >= 0.05).cast("double").alias("Catch")))
    lengths = ln.select("SampleID", "Taxa", F.when(F.col("Length") == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("Length")).alias("Length"))
    out = quality.measured_exceeds_catch(expand.expand_raise_catch(catch, lengths, ["SampleID", "Taxa"]))
    return out.select("SampleID", "Taxa", "TotalMeasured", "Catch").distinct()


# -- more inventory items ---------------------------------------------------------

@register("assemble_chain")
def q_assemble_chain(spark: SparkSession, d: str) -> DataFrame:
    """J4 + J13 + P2: sample -> station -> region assembly chain (inner joins),
    projected onto the survey contract with absent columns null-filled."""
    o = roles.read(spark, d, "orders").select(F.col("o_orderkey").alias("SampleID"),
                                               F.col("o_custkey").alias("custkey"),
                                               F.col("o_orderstatus").alias("Source"))
    c = roles.read(spark, d, "customer").select(F.col("c_custkey").alias("custkey"),
                                                 F.col("c_nationkey").alias("nationkey"))
    n = roles.read(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"),
                                               F.col("n_name").alias("Station"), F.col("n_regionkey").alias("regionkey"))
    r = roles.read(spark, d, "region").select(F.col("r_regionkey").alias("regionkey"),
                                               F.col("r_name").alias("Tow_direction"))
    out = joins.assemble([(o, [], ""), (c, ["custkey"], "inner"), (n, ["nationkey"], "inner"),
                          (r, ["regionkey"], "left")])
    return exprs.canonical(out, ["Source", "Station", "SampleID", "Method", "Tow_direction"], fill_missing=True) \
        .withColumn("Method", F.col("Method").cast("string"))


@register("union_split")
def q_union_split(spark: SparkSession, d: str) -> DataFrame:
    """U1 + R2 + S5: bind two exports with different columns and types by
    name (int widened to double, absent columns null), split a text column."""
    p = roles.read(spark, d, "part")
    a = p.filter(F.col("p_size") <= 25).select("p_partkey", F.col("p_size").alias("Size"), "p_name")
    b = p.filter(F.col("p_size") > 25).select("p_partkey", (F.col("p_size") / 2).alias("Size"), "p_type")
    u = scan_union([(a, {}), (b, {"p_type": "Kind"})])
    u = reshape.split_cols(u, "p_name", ["colour", "thing"], " ", cast=None)
    return u.select("p_partkey", "Size", "Kind", "colour", "thing")


@register("catch_filters")
def q_catch_filters(spark: SparkSession, d: str) -> DataFrame:
    """F5 + F11 + F18 + F16: positive known catch, dated rows only, date
    range, size cutoff (unknown lengths kept)."""
    c = roles.catch(spark, d).withColumn("Catch", F.col("Catch") - 1)
    c = filters.positive_catch(c)
    s = roles.samples(spark, d).select("SampleID", "Date")
    j = joins.join(c, s, ["SampleID"], "left", null_safe=False)
    j = filters.not_null(j, "Date")
    j = filters.date_range(j, "Date", "1996-01-01", "1998-12-31")
    ln = roles.lines(spark, d).select("SampleID", "Taxa", F.when(F.col("Length") == 0, F.lit(None).cast("double"))
                                      .otherwise(F.col("Length")).alias("Length"))
    ln = filters.size_cutoff(ln, 25.0)
    out = joins.join(j, ln.groupBy("SampleID", "Taxa").agg(F.count(F.lit(1)).alias("n_lengths")),
                     ["SampleID", "Taxa"], "left")
    return out.select("SampleID", "Taxa", "Catch", "Date", "n_lengths")


@register("tow_filters")
def q_tow_filters(spark: SparkSession, d: str) -> DataFrame:
    """F1 + F3 + P5 + F12 + F17 + F20: method whitelist, valid tows only,
    complete cases, taxon restriction, record removal with NA-drops rule."""
    ln = roles.lines(spark, d)
    rows = ln.select("SampleID", "Taxa", "linenumber", "quantity",
                     F.when(F.col("returnflag") == "R", F.lit(None).cast("string"))
                     .otherwise(F.col("returnflag")).alias("Method"),
                     exprs.tow_status(F.col("linenumber")).alias("Tow_status"),
                     F.when(F.col("tax") == 0, F.lit(None).cast("double")).otherwise(F.col("tax")).alias("tax"))
    rows = filters.keep_methods(rows, "Method", ["A", "N"])
    rows = filters.valid_tows(rows)
    rows = filters.complete_cases(rows, ["tax"])
    rows = filters.keep_taxa(rows, ["Brand#2", "Brand#3", "Brand#5", "UnID"])
    limit = F.when(F.col("Taxa") == "UnID", F.lit(10.0)).when(F.col("Taxa") == "Brand#2", F.lit(45.0))
    rows = filters.drop_where(rows, F.col("quantity") > limit)
    return rows.select("SampleID", "Taxa", "linenumber", "quantity", "Method", "Tow_status")


@register("effort_geometry")
def q_effort_geometry(spark: SparkSession, d: str) -> DataFrame:
    """P8 + P15 + P34 + P35: deg-min text coordinates, swept area from
    distance and from duration, life-stage harmonisation, R-style rounding."""
    c = roles.read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    txt = F.concat(F.lit("-122"), F.lit("°"), (F.abs(F.col("c_acctbal")) / 200).cast("string"))
    stage = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("YOY"))
             .when(F.col("c_mktsegment") == "MACHINERY", F.lit("Adult"))
             .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("Larval")))
    taxa = F.when(F.col("c_nationkey") < 10, F.lit("Morone saxatilis")).otherwise(F.lit("Other"))
    return c.select(
        "c_custkey",
        F.round(exprs.degmin_text_to_decimal(txt, subtract=True), 6).alias("Longitude"),
        F.round(exprs.swept_area_distance(F.abs(F.col("c_acctbal")) / 1000), 6).alias("Tow_area"),
        F.round(exprs.swept_area_duration(F.col("c_nationkey")), 6).alias("Tow_area_duration"),
        exprs.harmonise_lifestage(stage, taxa, {"Age-2+": ["Morone saxatilis"]}).alias("Lifestage"),
        F.bround(F.col("c_acctbal") / 3, 2).alias("Rounded"))


@register("size_bounds")
def q_size_bounds(spark: SparkSession, d: str) -> DataFrame:
    """J9 + J12: comments without explicit bounds take the size bounds of
    their (class, month, organism); ids already present are excluded."""
    ln = roles.lines(spark, d)
    s = roles.samples(spark, d).select("SampleID", F.month("Date").alias("Month"))
    com = joins.join(ln.filter(F.col("Length") == 0), s, ["SampleID"], "inner", null_safe=False).select(
        "SampleID", "Taxa", "Month",
        F.when(F.col("returnflag") == "A", F.lit("Age-0")).otherwise(F.lit("Age-1")).alias("Lifestage"),
        F.when(F.col("discount") > 0.05, F.col("quantity")).alias("Min_length"),
        F.lit(None).cast("double").alias("Max_length"))
    ages = (joins.join(ln, s, ["SampleID"], "inner", null_safe=False)
            .groupBy("Month", "Taxa").agg(F.min("quantity").alias("Min"), F.max("quantity").alias("Max"))
            .withColumn("Lifestage", F.lit("Age-0")))
    out = joins.size_bounds(com, ages, ["Lifestage", "Month", "Taxa"])
    present = ln.filter(F.col("linenumber") == 2).select("SampleID", "Taxa")
    out = joins.anti(out, present, ["SampleID", "Taxa"])
    return out.select("SampleID", "Taxa", "Month", "Lifestage", "Min_length", "Max_length")


@register("sorted_taxa")
def q_sorted_taxa(spark: SparkSession, d: str) -> DataFrame:
    """O1 + O2: sorted distinct taxa per source (as text), sources in order."""
    f = roles.fish(spark, d)
    per = f.groupBy("Source").agg(F.array_join(F.sort_array(F.collect_set("Taxa")), ",").alias("taxa"))
    return reshape.ordered(per, ["Source"])


# -- a whole survey job on role-mapped tables ---------------------------------------

def _brand_no(c: str) -> F.Column:
    return F.regexp_extract(F.col(c), r"#(\d+)", 1).cast("int")


def landed(tables: Callable) -> Callable:
    """Role tables as the exports land, every column as text (P1, S1): the jobs
    give them their types."""
    def as_text(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
        found, species = tables(spark, d)
        return {k: t.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in t.columns]) for k, t in found.items()}, species

    return as_text


@landed
def fmwt_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The FMWT source database played by the driver tables: orders are
    tows, (order, brand) pairs are catches, lines are measured fish (line 1
    unmeasured, zero tax exported as the "n/p" token); brands are species
    (brands 1-3 carry a life stage in the crosswalk)."""
    n = roles.read(spark, d, "nation").select("n_nationkey", "n_regionkey")
    stations = n.select(F.col("n_nationkey").alias("StationCode"),
                        (F.lit(37.0) + F.col("n_nationkey") * F.lit(0.09)).alias("DD_Latitude"),
                        (F.lit(-123.0) + F.col("n_regionkey") * F.lit(0.45)).alias("DD_Longitude"))
    ocn = roles.visits(spark, d).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    clock = F.concat_ws(":", F.lpad((F.col("c_nationkey") % 24).cast("string"), 2, "0"),
                        F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"), F.lit("00"))
    sample = ocn.select(
        F.col("o_orderkey").alias("SampleRowID"), F.col("c_nationkey").alias("StationCode"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("OTHER")).otherwise(F.lit("MWTR")).alias("MethodCode"),
        F.col("o_orderdate").alias("SampleDate"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(clock).alias("SampleTimeStart"),
        F.month("o_orderdate").alias("SurveyNumber"),
        (F.abs(F.col("c_acctbal")) / 400).alias("WaterTemperature"),
        (F.col("o_totalprice") / 50000).alias("Turbidity"), F.lit(0.5).alias("Secchi"),
        (F.col("o_orderstatus") == "F").alias("SecchiEstimated"),
        (F.col("o_totalprice") / 10).alias("ConductivityTop"), (F.col("o_totalprice") / 8).alias("ConductivityBottom"),
        F.col("n_regionkey").alias("TowDirectionCode"), F.lit(1000.0).alias("MeterStart"),
        (F.lit(1000.0) + F.col("o_totalprice") / 10).alias("MeterEnd"), F.lit(100.0).alias("CableOut"),
        F.col("n_regionkey").alias("TideCode"), (F.col("c_acctbal") / 100).alias("DepthBottom"))
    ln = roles.lines(spark, d)
    key = F.concat_ws("-", F.col("SampleID").cast("string"), _brand_no("brand").cast("string"))
    catch = ln.groupBy("SampleID", "brand").agg(
        (F.count(F.lit(1)) + F.count_if(F.col("discount") >= 0.05)).cast("double").alias("Catch"))
    catch = catch.select(key.alias("CatchRowID"), F.col("SampleID").alias("SampleRowID"),
                         _brand_no("brand").alias("OrganismCode"), "Catch")
    length = ln.select(key.alias("CatchRowID"),
                       F.when(F.col("tax") == 0, F.lit("n/p")).when(F.col("linenumber") == 1, F.lit("0"))
                       .otherwise(F.col("quantity").cast("string")).alias("ForkLength"),
                       F.lit("1").alias("LengthFrequency"))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("FMWT_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName", F.when(F.col("FMWT_Code") <= 3, F.lit("Age 0"))))
    return {"StationsLookUp": stations, "Sample": sample, "Catch": catch, "Length": length}, species


@register("fmwt_job")
def q_fmwt_job(spark: SparkSession, d: str) -> DataFrame:
    """K3 end to end (P2-P4, P9-P10, P14, P18, P23, P25-P27, J1, J7, A1, A4,
    A11, S2) on the driver tables in the FMWT roles."""
    tables, species = fmwt_tables(spark, d)
    ds = surveys.fmwt(tables, species).dataset
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi",
           "Tow_volume", "Cable_length", "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@register("integrate_fish")
def q_integrate_fish(spark: SparkSession, d: str) -> DataFrame:
    """The survey dataset bound, normalised and zero-filled per source;
    the integrated fish table.  The role dataset already holds all three
    sources (disjoint), so it is passed whole rather than split and rebound,
    which would evaluate its plan once per source."""
    out = integrate({"surveys": roles.dataset(spark, d)})
    return out.fish.select("SampleID", "Taxa", "Length", r6("Count").alias("Count"))


# The salvage study and station code tables.
SALVAGE_STUDIES = [("0000", "Normal count"), ("9999", "Second flush"), ("8888", "Special study")]
SALVAGE_STATIONS = [(1, "SWP"), (2, "CVP")]
# Times without sampling that occur in the driver's tables.
SALVAGE_TIMES = [("SWP A", "1995-01-01", "1996-12-31", 0.0, 0.0), ("CVP N", "1996-03-01", "1996-03-31", None, None)]


@landed
def salvage_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The salvage database played by the driver tables: orders are samples
    (urgent ones second flushes, low ones special studies; pending orders
    did not pump), an order's return flags are its buildings, (building,
    brand) pairs are catches and lines are measured fish.  Brand 24 plays
    the total-count pseudo-organism (98), brand 25 the excluded organism
    (81); brand 2 is an "Age" class the crosswalk filter drops."""
    o = roles.read(spark, d, "orders")
    clock = F.concat(F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":"),
                     F.lpad(((F.col("o_custkey") % 6) * 10).cast("string"), 2, "0"), F.lit(":00.0000000"))
    sample = o.select(
        F.col("o_orderkey").alias("SampleRowID"), F.col("o_orderdate").alias("SampleDate"),
        clock.alias("SampleTime"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("9999"))
         .when(F.col("o_orderpriority") == "5-LOW", F.lit("8888")).otherwise(F.lit("0000")).alias("StudyRowID"),
        F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).otherwise(F.col("o_totalprice") / 1000).alias("AcreFeet"),
        F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).otherwise(F.lit(60.0)).alias("MinutesPumping"),
        (F.lit(10.0) + (F.col("o_custkey") % 3) * 5).alias("SampleTimeLength"),
        (F.col("o_totalprice") % 80).alias("WaterTemperature"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "O", F.lit(2))
         .alias("SampleMethod"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("no count, shut down"))
         .alias("Comments_Sample"))
    ln = roles.lines(spark, d)
    flag_no = F.when(F.col("returnflag") == "A", F.lit(1)).when(F.col("returnflag") == "N", F.lit(2)).otherwise(F.lit(3))
    building_id = F.col("SampleID") * 10 + flag_no
    brand = _brand_no("brand")
    organism = F.when(brand == 24, F.lit(98)).when(brand == 25, F.lit(81)).otherwise(brand)
    ln = ln.withColumn("BuildingRowID", building_id).withColumn("OrganismCode", organism)
    building = ln.select("BuildingRowID", F.col("SampleID").alias("SampleRowID"),
                         F.when(F.col("returnflag") == "R", F.lit(2)).otherwise(F.lit(1)).alias("BuildingCode"),
                         F.col("returnflag").alias("Location")).distinct()
    catch_id = F.col("BuildingRowID") * 100 + F.col("OrganismCode")
    catch = (ln.groupBy("BuildingRowID", "OrganismCode")
             .agg((F.count(F.lit(1)) + F.count_if(F.col("discount") >= 0.05)).cast("double").alias("Count"))
             .withColumn("CatchRowID", catch_id))
    # fish of one length that differ in their clip only are added up
    length = ln.select(catch_id.alias("CatchRowID"), F.col("linenumber").alias("LengthRowID"),
                       (F.col("linenumber") % 2 == 0).alias("AdiposeClip"),
                       F.when(F.col("linenumber") == 1, F.lit(0.0)).otherwise(F.col("quantity")).alias("ForkLength"),
                       F.when(F.col("tax") == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0)).alias("LengthFrequency"))
    studies = spark.createDataFrame(SALVAGE_STUDIES, "StudyRowID string, Description string")
    stations = spark.createDataFrame(SALVAGE_STATIONS, "FacilityCode int, Comments_StationsLookUp string")
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("Salvage_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName",
                                                    F.when(F.col("Salvage_Code") == 2, F.lit("Age 1"))))
    return ({"Sample": sample, "Building": building, "Catch": catch, "Length": length,
             "StudiesLookUp": studies, "StationsLookUp": stations}, species)


def _salvage_here(tables: dict[str, DataFrame], species: DataFrame) -> surveys.SurveyResult:
    """The salvage job with exclusions that occur in the driver's tables."""
    spark = species.sparkSession
    times = spark.createDataFrame(SALVAGE_TIMES, "Station string, start string, end string, Count_is double, "
                                                 "Tow_volume_is double").select(
        "Station", F.to_date("start").alias("start"), F.to_date("end").alias("end"), "Count_is", "Tow_volume_is")
    return surveys.salvage(tables, species, exclusions=times, excluded_samples=["Salvage 7 1", "Salvage 39 1"],
                           imputed_samples=[32, 33, 34, 35])


@register("salvage_job")
def q_salvage_job(spark: SparkSession, d: str) -> DataFrame:
    """K10 end to end (J6, F8, P31, W2, W1, J1, A1, P19, A10, P25, F11, F19,
    P22, F6) on the driver tables in the salvage roles."""
    tables, species = salvage_tables(spark, d)
    ds = _salvage_here(tables, species).dataset
    dbl = ["Latitude", "Longitude", "Tow_volume", "Temp_surf", "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


# STN tide and tow-direction code tables.
STN_TIDES = [(1, "High Tide"), (2, "Ebb"), (3, "Low Tide")]
STN_DIRECTIONS = [(1, "With Current"), (2, "Against Current"), (3, "Neither")]


@landed
def stn_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The STN database played by the driver tables: orders are samples at
    the customer's nation, an order's return flags are its tows (flag number
    = tow number = meter serial), (tow, brand) pairs are catches (catch =
    lines with discount >= 0.05, so some are zero and some smaller than the
    number measured), lines are measured fish (line 1 unmeasured).  Meter
    calibrations of open lines are filed twenty years late."""
    sample = roles.visits(spark, d).select(
        F.col("o_orderkey").alias("SampleRowID"), F.col("o_orderdate").alias("SampleDate"),
        F.month("o_orderdate").alias("Survey"), F.col("c_nationkey").alias("StationCode"),
        (F.abs(F.col("c_acctbal")) / 400).alias("TemperatureTop"), (F.col("o_totalprice") / 10).alias("ConductivityTop"),
        F.lit(3.0).alias("TurbidityTop"), F.lit(50.0).alias("Secchi"),
        ((F.col("o_custkey") % 3) + 1).alias("TideCode"), (F.col("c_acctbal") / 100).alias("DepthBottom"))
    li = roles.read(spark, d, "lineitem")
    flag_no = F.when(F.col("l_returnflag") == "A", F.lit(1)).when(F.col("l_returnflag") == "N", F.lit(2)).otherwise(F.lit(3))
    li = li.withColumn("flag_no", flag_no).withColumn("TowRowID", F.col("l_orderkey") * 10 + F.col("flag_no"))
    clock = F.concat_ws(":", F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0"),
                        F.lpad((F.col("flag_no") * 7).cast("string"), 2, "0"), F.lit("30"))
    tow = li.groupBy("TowRowID", "l_orderkey", "flag_no").agg(
        F.when(F.min("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.min("l_extendedprice")).alias("MeterIn"),
        (F.max("l_quantity") * 1000).alias("MeterOut"))
    tow = tow.select("TowRowID", F.col("l_orderkey").alias("SampleRowID"), F.col("flag_no").alias("TowNumber"),
                     clock.alias("TimeStart"), F.col("flag_no").alias("MeterSerial"), "MeterIn", "MeterOut",
                     F.lit(100.0).alias("CableOut"), F.col("flag_no").alias("TowDirection"))
    n = roles.read(spark, d, "nation")
    stations = n.select(F.col("n_nationkey").alias("StationCode"), F.lit(38).alias("LatD"),
                        F.col("n_nationkey").alias("LatM"), F.lit(0.0).alias("LatS"), F.lit(121).alias("LonD"),
                        (F.col("n_regionkey") * 10).alias("LonM"), F.lit(30.0).alias("LonS"))
    corr = (li.groupBy((F.year("l_shipdate") + F.when(F.col("l_linestatus") == "F", 0).otherwise(20)).alias("StudyYear"), F.col("flag_no").alias("MeterSerial"))
            .agg((F.avg("l_discount") + 0.01).alias("kFactor")))
    ln = roles.lines(spark, d)
    ln = ln.withColumn("CatchRowID", (F.col("SampleID") * 10 + F.when(F.col("returnflag") == "A", 1)
                                      .when(F.col("returnflag") == "N", 2).otherwise(3)) * 100 + _brand_no("brand"))
    catch = ln.groupBy("CatchRowID").agg(
        F.first((F.col("CatchRowID") / 100).cast("bigint")).alias("TowRowID"),
        F.first(_brand_no("brand")).alias("OrganismCode"),
        F.count_if(F.col("discount") >= 0.05).cast("double").alias("Catch"))
    length = ln.select("CatchRowID", F.when(F.col("linenumber") == 1, F.lit(0.0)).otherwise(F.col("quantity"))
                       .alias("ForkLength"), F.lit(1.0).alias("LengthFrequency"))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("STN_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName",
                                                    F.when(F.col("STN_Code") == 3, F.lit("Age 0"))))
    return ({"Sample": sample, "TowEffort": tow, "luStation": stations, "Web_Local_Meter_Corrections": corr,
             "luTide": spark.createDataFrame(STN_TIDES, "TideRowID int, TideDesc string"),
             "luTowDirection": spark.createDataFrame(STN_DIRECTIONS, "TowDirectionID int, TowDirection_label string"),
             "Catch": catch, "Length": length}, species)


@register("stn_job")
def q_stn_job(spark: SparkSession, d: str) -> DataFrame:
    """K7 end to end (J4, J5, P7, P9, P11, P13, P16, P18, P21, J2, F4, F5,
    A1, A6, J1, J7, P25, P26, A11) on the driver tables in the STN roles."""
    tables, species = stn_tables(spark, d)
    ds = surveys.stn(tables, species).dataset
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi", "Tow_volume",
           "Cable_length", "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


# Bay Study tide code table.
BAY_TIDES = [(1, "High Slack"), (2, "Ebb"), (3, "Low Slack"), (4, "Flood")]


@landed
def baystudy_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The Bay Study database played by the driver tables: a station visit
    is (order year, month, customer nation); the net is the order priority
    (urgent/high midwater, medium/unspecified otter, low the EL net that is
    filtered out); lines are fish in size group 1 (< 25) or 2, line 1 is the
    plus count of unmeasured fish.  Codes in the length table are lower-case
    and upper-cased before the crosswalk."""
    oc = roles.visits(spark, d).select(
        F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Survey"),
        F.col("c_nationkey").cast("string").alias("Station"), "o_orderkey", "o_orderdate", "o_orderstatus",
        "o_totalprice", "c_acctbal",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(1))
         .when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit(2)).otherwise(F.lit(3)).alias("Net"))
    visit = ["Year", "Survey", "Station"]
    boat_station = oc.groupBy(*visit).agg(
        F.min("o_orderdate").cast("date").cast("string").alias("Date"), (F.avg("c_acctbal") / 100).alias("Depth"),
        F.lit(50.0).alias("Secchi"), ((F.min("Survey") % 4) + 1).alias("Tide"))
    # a visit has up to three tows of a net, by status
    boat_tow = oc.groupBy(*visit, "Net", "o_orderstatus").agg(
        F.min(F.when(F.col("o_orderstatus") == "P", 52).when(F.col("o_orderstatus") == "F", 1).otherwise(2)).alias("Tow"),
        F.max("o_orderdate").cast("string").alias("Time"),
        (F.sum("o_totalprice") / 100).alias("TotalMeter"), (F.count(F.lit(1)) * 0.5).alias("Distance"),
        F.lit(10.0).alias("Duration"))
    boat_tow = boat_tow.select(*visit, "Net", "Tow", "Time",
                               F.when(F.col("Net") == 1, F.lit(None).cast("int")).otherwise(F.lit(2)).alias("Tide"),
                               F.col("Net").alias("Direction"), "Duration", "TotalMeter", "Distance",
                               F.lit(None).cast("string").alias("TowComment"))
    salin = oc.groupBy(*visit).agg((F.avg("o_totalprice") / 10).alias("ECSurf"),
                                   (F.avg(F.abs(F.col("c_acctbal"))) / 400).alias("TempSurf"))
    n = roles.read(spark, d, "nation")
    stations = n.select(F.col("n_nationkey").cast("string").alias("Station"),
                        F.concat(F.lit("37°"), (F.col("n_nationkey") * 2).cast("string")).alias("Latitude"),
                        F.concat(F.lit("-122°"), (F.col("n_regionkey") * 5).cast("string")).alias("Longitude"))
    ln = joins.join(roles.lines(spark, d), oc.select(F.col("o_orderkey").alias("SampleID"), *visit, "Net"),
                    ["SampleID"], "inner", null_safe=False)
    ln = ln.withColumn("SizeGroup", F.when(F.col("quantity") < 25, F.lit(1)).otherwise(F.lit(2)))
    keys = [*visit, "Net", "SizeGroup"]
    catch = ln.groupBy(*keys, F.upper("brand").alias("AlphaCode")).agg(
        (F.sum("quantity") / 10).alias("QtsCaught"), F.count(F.lit(1)).cast("double").alias("QtsSubsampled"),
        F.when(F.max("tax") == 0, F.lit(None).cast("double"))
         .otherwise(F.count_if(F.col("linenumber") == 1).cast("double")).alias("PlusCount"))
    length = ln.filter(F.col("linenumber") != 1).select(
        *keys, F.lower("brand").alias("AlphaCode"), F.col("quantity").alias("Length"), F.lit(1.0).alias("Frequency"))
    p = roles.read(spark, d, "part").select(F.upper("p_brand").alias("Baystudy_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName", F.when(
        F.col("Baystudy_Code") == "BRAND#4", F.lit("Age 0"))))
    return ({"stations": stations, "TideCodes": spark.createDataFrame(BAY_TIDES, "Tide int, Description string"),
             "BoatStation": boat_station, "BoatTow": boat_tow, "SalinTemp": salin,
             "Fish Catch Data": catch, "Fish Length Data": length}, species)


@register("baystudy_job")
def q_baystudy_job(spark: SparkSession, d: str) -> DataFrame:
    """K1 end to end (J2, P4, P5, P8, P14, P15, P18, P28, J1, A3, J7, P25,
    A11, F1, F3, P26) on the driver tables in the Bay Study roles."""
    tables, species = baystudy_tables(spark, d)
    ds = surveys.baystudy(tables, species).dataset
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "Secchi", "Tow_duration", "Tow_area",
           "Tow_volume", "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@landed
def sls_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The SLS database played by the driver tables: a (order date, customer
    nation) pair is a station visit, the order priority number is the tow;
    water data of nations from 20 on carry other station numbers (so the full
    outer chain keeps tows without water data, and water data without tows); the meter corrections come twice, as the
    source's duplicated rows do; lines are measured fish except line 1."""
    oc = roles.visits(spark, d).select(
        F.to_date("o_orderdate").alias("Date"), F.col("c_nationkey").alias("Station"), "o_orderkey", "o_totalprice",
        "o_orderstatus", "c_acctbal", F.substring("o_orderpriority", 1, 1).cast("int").alias("Tow"),
        F.month("o_orderdate").alias("Survey"))
    # water data of nations from 20 on are filed under stations of their own
    at = F.when(F.col("Station") < 20, F.col("Station")).otherwise(F.col("Station") + 100)
    water = (oc.withColumn("Station", at).groupBy("Date", "Station").agg(
        (F.avg("o_totalprice") / 10).alias("TopEC"), (F.avg("o_totalprice") / 8).alias("BottomEC"),
        (F.avg(F.abs(F.col("c_acctbal"))) / 300).alias("TopTemp"), F.lit(50.0).alias("Secchi"),
        F.min("Survey").alias("NTU"), (F.min("Survey") + 1).alias("FNU"),
        F.when(F.min("o_orderstatus") == "F", F.lit("calm")).alias("Comments")))
    tow = oc.groupBy("Date", "Station", "Tow").agg(
        F.min("Survey").alias("Survey"),
        F.concat_ws(":", F.lpad((F.min("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("15"), F.lit("00")).alias("Time"),
        ((F.col("Tow") % 4) + 1).alias("Tide"), (F.avg("c_acctbal") / 100).alias("BottomDepth"),
        F.col("Tow").alias("NetMeterSerial"), (F.sum("o_totalprice") / 10).alias("NetMeterCheck"),
        F.lit(100.0).alias("CableOut"), (F.col("Tow") * 2.5).alias("Duration"),
        F.when(F.count(F.lit(1)) > 1, F.lit("several")).alias("Comments"))
    li = roles.read(spark, d, "lineitem")
    corr = li.groupBy(F.year("l_shipdate").alias("StudyYear"), F.col("l_linenumber").alias("MeterSerial")).agg(
        (F.avg("l_discount") + 0.01).alias("kfactor"),
        F.concat(F.lit("meter "), F.min("l_linenumber").cast("string")).alias("Notes"))
    # a mean summed up twice can differ in its last digit, so rows are repeated, not computed again
    corr = corr.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    ln = joins.join(roles.lines(spark, d), oc.select(F.col("o_orderkey").alias("SampleID"), "Date", "Station", "Tow"),
                    ["SampleID"], "inner", null_safe=False).withColumn("FishCode", _brand_no("brand"))
    catch = ln.groupBy("Date", "Station", "Tow", "FishCode").agg(
        (F.count(F.lit(1)) + F.count_if(F.col("discount") >= 0.05)).cast("double").alias("Catch"))
    lengths = ln.filter(F.col("linenumber") != 1).select("Date", "Station", "Tow", "FishCode",
                                                          F.col("quantity").alias("Length"))
    n = roles.read(spark, d, "nation")
    st = n.select(F.col("n_nationkey").alias("Station"), (F.lit(38.0) + F.col("n_nationkey") * F.lit(0.01)).alias("Latitude"),
                  (F.lit(-121.5) - F.col("n_regionkey") * F.lit(0.1)).alias("Longitude"))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("SLS_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName", F.when(F.col("SLS_Code") == 5, F.lit("Age 0"))))
    return ({"Water Info": water, "Tow Info": tow, "Meter Corrections": corr,
             "Catch": catch, "Lengths": lengths, "SLS Stations": st}, species)


@register("sls_job")
def q_sls_job(spark: SparkSession, d: str) -> DataFrame:
    """K6 end to end (J6, J5, J3, P10, P14, P18, P21, P29, P35, A1, A8, W1,
    J1, P25, P26, A11) on the driver tables in the SLS roles."""
    with roles.Once(spark, d, _scratch(spark, "sls"), ["linenumber", "discount", "quantity"]):
        tables, species = sls_tables(spark, d)
        ds = surveys.sls(tables, species, materialise).dataset  # reads lines and visits now
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Sal_bot", "Temp_surf", "Secchi", "Tow_volume",
           "Cable_length", "Tow_duration", "Length", "Count"]
    whole = ["TurbidityNTU", "TurbidityFNU"]  # the roles have none, as whole numbers
    return ds.select(*[q6(c).alias(c) if c in dbl else F.col(c).cast("int").alias(c) if c in whole else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@landed
def skt_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The SKT database played by the driver tables: orders are tows at the
    customer's nation (times in the export layout MM/dd/yyyy HH:mm), (order,
    brand) pairs are catches, orders without lines get the empty-net catch
    row (organism 0, no catch), lines are fish (line 1 unmeasured).  The
    crosswalk's SKT codes are text while the catch codes are numbers."""
    o = roles.read(spark, d, "orders")
    oc = roles.visits(spark, d)
    clock = F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" "),
                     F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":"),
                     F.lpad(((F.col("o_custkey") % 4) * 15).cast("string"), 2, "0"))
    sample = oc.select(
        F.col("o_orderkey").alias("SampleRowID"), F.col("o_orderdate").alias("SampleDate"),
        F.col("c_nationkey").alias("Station"), clock.alias("SampleTimeStart"),
        F.month("o_orderdate").alias("SurveyNumber"), (F.abs(F.col("c_acctbal")) / 400).alias("WaterTemperature"),
        (F.col("o_custkey") % 5).cast("int").alias("TideCode"), (F.col("c_acctbal") / 100).alias("DepthBottom"),
        F.lit(40.0).alias("Secchi"), (F.col("o_totalprice") / 10).alias("ConductivityTop"),
        (F.col("o_custkey") % 4).cast("int").alias("TowDirectionCode"),
        ((F.col("o_orderkey") % 100) * 10000).cast("double").alias("MeterStart"),
        (((F.col("o_orderkey") + 37) % 100) * 10000).cast("double").alias("MeterEnd"),
        F.lit(5.0).alias("NTU"), F.lit(6.0).alias("FNU"))
    n = roles.read(spark, d, "nation")
    stations = n.select(F.col("n_nationkey").alias("Station"), F.lit(38).alias("LatDeg"),
                        F.col("n_nationkey").cast("double").alias("LatMin"), F.lit(0.0).alias("LatSec"),
                        F.lit(121).alias("LongDec"), (F.col("n_regionkey") * 10).cast("double").alias("LongMin"),
                        F.lit(15.0).alias("LongSec"))
    ln = roles.lines(spark, d).withColumn("OrganismCode", _brand_no("brand"))
    catch_id = F.col("SampleID") * 100 + F.col("OrganismCode")
    catch = ln.groupBy("SampleID", "OrganismCode").agg(
        (F.count(F.lit(1)) + F.count_if(F.col("discount") >= 0.05)).cast("double").alias("Catch"))
    catch = catch.select(catch_id.alias("CatchRowID"), F.col("SampleID").alias("SampleRowID"), "OrganismCode", "Catch")
    empty = joins.join(o.select(F.col("o_orderkey").alias("SampleRowID")), ln.select(F.col("SampleID").alias("SampleRowID")),
                       ["SampleRowID"], "left_anti", null_safe=False)
    empty = empty.select((F.col("SampleRowID") * 100).alias("CatchRowID"), "SampleRowID",
                         F.lit(0).alias("OrganismCode"), F.lit(None).cast("double").alias("Catch"))
    fish = ln.select(catch_id.alias("CatchRowID"), F.when(F.col("linenumber") == 1, F.lit(0.0))
                     .otherwise(F.col("quantity")).alias("ForkLength"))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").cast("string").alias("SKT_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName", F.when(F.col("SKT_Code") == "6", F.lit("Age 0"))))
    return ({"StationsSKT": stations, "tblSample": sample, "tblCatch": catch.unionByName(empty),
             "tblFishInfo": fish}, species)


@register("skt_job")
def q_skt_job(spark: SparkSession, d: str) -> DataFrame:
    """K4 end to end (P7, P9, P10, P13, P14, P18 with the export time layout,
    J3, A1, A5, J1, J7, P25, P26, A11) on the driver tables in the SKT roles."""
    tables, species = skt_tables(spark, d)
    ds = surveys.skt(tables, species).dataset
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "TurbidityNTU", "TurbidityFNU", "Secchi",
           "Tow_volume", "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@landed
def tmm_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The 20mm database played by the driver tables: a survey is an order
    month, a station a (month, customer nation) pair, a tow an order, and
    each tow has the fish net (gear 2) and another gear (1, filtered out);
    half of the meters are calibrated in other years, so their (year, meter)
    pairs fall back to the meter's mean; (order, brand) pairs are fish
    samples (catch = lines with discount >= 0.05), lines are fish whose
    length is missing on line 1."""
    o = roles.read(spark, d, "orders")
    oc = roles.visits(spark, d).withColumn(
        "SurveyID", F.year("o_orderdate") * 100 + F.month("o_orderdate"))
    survey = oc.groupBy("SurveyID").agg(F.min("o_orderdate").alias("SampleDate"),
                                        F.min(F.month("o_orderdate")).alias("Survey"))
    station = oc.groupBy("SurveyID", "c_nationkey").agg(
        (F.avg(F.abs(F.col("c_acctbal"))) / 400).alias("Temp"), (F.avg("o_totalprice") / 10).alias("TopEC"),
        (F.avg("c_acctbal") / 100).alias("BottomDepth"))
    station = station.select((F.col("SurveyID") * 100 + F.col("c_nationkey")).alias("StationID"), "SurveyID",
                             F.col("c_nationkey").alias("Station"), "Temp", "TopEC", "BottomDepth",
                             F.lit(30.0).alias("Secchi"), (F.col("c_nationkey") * 0.5).alias("NTU"),
                             (F.col("c_nationkey") * 0.25).alias("FNU"), ((F.col("c_nationkey") % 4) + 1).alias("Tide"))
    tow = oc.select(F.col("o_orderkey").alias("TowID"), (F.col("SurveyID") * 100 + F.col("c_nationkey")).alias("StationID"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("TowNum"),
                    F.concat_ws(":", F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("20"),
                                F.lit("10")).alias("TowTime"), F.lit(50.0).alias("CableOut"))
    gear = o.select("o_orderkey", "o_totalprice")
    gear = gear.select((F.col("o_orderkey") * 10 + 2).alias("GearID"), F.col("o_orderkey").alias("TowID"),
                       F.lit(2).alias("GearCode"), (F.col("o_orderkey") % 7).cast("int").alias("MeterSerial"),
                       (F.col("o_totalprice") / 100).alias("MeterCheck")).unionByName(
        gear.select((F.col("o_orderkey") * 10 + 1).alias("GearID"), F.col("o_orderkey").alias("TowID"),
                    F.lit(1).alias("GearCode"), (F.col("o_orderkey") % 7).cast("int").alias("MeterSerial"),
                    F.lit(1.0).alias("MeterCheck")))
    n = roles.read(spark, d, "nation")
    stations = n.select(F.col("n_nationkey").alias("Station"), F.lit(38).alias("LatD"), F.col("n_nationkey").alias("LatM"),
                        F.lit(30.0).alias("LatS"), F.lit(121).alias("LonD"), (F.col("n_regionkey") * 7).alias("LonM"),
                        F.lit(0.0).alias("LonS"))
    li = roles.read(spark, d, "lineitem")
    # even meters' calibrations are filed twenty years late
    late = F.when(F.col("l_linenumber") % 2 == 0, 20).otherwise(0)
    corr = (li.groupBy((F.year("l_shipdate") + late).alias("StudyYear"), (F.col("l_linenumber") - 1).alias("MeterSerial"))
            .agg((F.avg("l_discount") + 0.01).alias("kFactor")))
    ln = roles.lines(spark, d).withColumn("FishCode", _brand_no("brand"))
    fish_sample = ln.groupBy("SampleID", "FishCode").agg(
        F.count_if(F.col("discount") >= 0.05).cast("double").alias("Catch")).select(
        (F.col("SampleID") * 100 + F.col("FishCode")).alias("FishSampleID"),
        (F.col("SampleID") * 10 + 2).alias("GearID"), "FishCode", "Catch")
    fish_length = ln.select((F.col("SampleID") * 100 + F.col("FishCode")).alias("FishSampleID"),
                            F.when(F.col("linenumber") == 1, F.lit(None).cast("double"))
                            .otherwise(F.col("quantity")).alias("Length"))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("TMM_Code"),
                                             F.col("p_brand").alias("ScientificName")).distinct()
    species = p.withColumn("Taxa", exprs.taxa_label("ScientificName", F.when(F.col("TMM_Code") == 7, F.lit("Age 0"))))
    return ({"Survey": survey, "Station": station, "Tow": tow, "Gear": gear, "20mmStations": stations,
             "MeterCorrections": corr, "FishSample": fish_sample, "FishLength": fish_length}, species)


@register("tmm_job")
def q_tmm_job(spark: SparkSession, d: str) -> DataFrame:
    """K5 end to end (J4, J3, J5, A12, F1, P7, P9, P10, P14, P18, A1, A6, J1,
    J7, P25, P26, A11) on the driver tables in the 20mm roles."""
    tables, species = tmm_tables(spark, d)
    ds = surveys.tmm(tables, species).dataset
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "TurbidityNTU", "TurbidityFNU", "Secchi", "Tow_volume", "Cable_length",
           "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@landed
def edsm_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The EDSM exports played by the driver tables: each line is a catch
    record of its order's tow; brand 1 plays Chinook (line 7 tagged, race by
    length); orders without lines are empty-net records, and finished orders
    also carry a spurious empty-net record.  Urgent orders come from the
    20 mm export, whose count column is named Catch (S5 renames it back)."""
    n = roles.read(spark, d, "nation").select("n_nationkey", "n_regionkey")
    ocn = roles.visits(spark, d).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    prio = F.substring("o_orderpriority", 1, 1)
    sample_cols = [
        F.col("o_orderkey").alias("SampleRowID"), F.col("o_orderstatus").alias("status"),
        F.col("c_nationkey").cast("string").alias("StationCode"),
        F.when(prio == "1", F.date_format("o_orderdate", "MM-dd-yyyy"))  # as the 20 mm export writes dates
         .otherwise(F.to_date("o_orderdate").cast("string")).alias("SampleDate"),
        F.concat_ws(":", F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("15"), F.lit("30")).alias("SampleTime"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("HS")).when(F.col("o_custkey") % 3 == 1, F.lit("LS"))
         .otherwise(F.lit("Flood")).alias("Tide"),
        (F.lit(-121.0) - F.col("n_regionkey")).alias("LongitudeStart"),
        (F.lit(38.0) + F.col("c_nationkey")).alias("LatitudeStart"), prio.cast("double").alias("TowNumber"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("o_custkey") % 10).cast("int")).alias("GearConditionCode"),
        (F.col("o_totalprice") / 10).alias("SpecificConductanceTop"), (F.abs(F.col("c_acctbal")) / 400).alias("WaterTempTop"),
        F.lit(5.0).alias("TurbidityTop"), F.lit(0.5).alias("Secchi"), (F.col("c_acctbal") / 100).alias("BottomDepth"),
        F.when(F.col("o_orderstatus") == "F", F.lit("U")).when(F.col("o_orderstatus") == "O", F.lit("D"))
         .otherwise(F.lit("X")).alias("SamplingDirection"),
        F.when(prio == "1", F.lit("20mm")).when(prio == "2", F.lit("KTS12")).otherwise(F.lit("KDTR")).alias("MethodCode"),
        (F.col("o_totalprice") / 1000).alias("sample_volume")]
    sa = ocn.select(*sample_cols)
    ln = roles.lines(spark, d)
    brand = _brand_no("brand")
    fish = joins.join(ln, sa.withColumnRenamed("SampleRowID", "SampleID"), ["SampleID"], "inner", null_safe=False).select(
        "*", F.when(F.col("returnflag") == "R", F.lit("Y")).when(F.col("returnflag") == "A", F.lit("N")).alias("FlowDebris"),
        F.when(F.col("tax") == 0, F.lit(0.0)).otherwise(F.col("price") / 100).alias("Volume"),
        F.when(brand == 1, F.lit("CHN")).otherwise(F.concat(F.lit("B"), brand.cast("string"))).alias("OrganismCode"),
        F.when(F.col("linenumber") == 1, F.lit(0.0)).otherwise(F.col("quantity")).alias("ForkLength"),
        F.ceil(F.col("quantity") / 10).cast("double").alias("Count"),
        F.when(F.col("linenumber") == 7, F.lit("AD")).alias("MarkCode"),
        F.when(F.col("quantity") < 25, F.lit("Fall")).otherwise(F.lit("Spring")).alias("RaceByLength"))
    cols = ["StationCode", "SampleDate", "SampleTime", "Tide", "LongitudeStart", "LatitudeStart", "TowNumber",
            "GearConditionCode", "FlowDebris", "SpecificConductanceTop", "WaterTempTop", "TurbidityTop", "Secchi",
            "BottomDepth", "Volume", "SamplingDirection", "MethodCode", "OrganismCode", "ForkLength", "Count",
            "MarkCode", "RaceByLength"]
    fish = fish.withColumnRenamed("SampleID", "SampleRowID").select(*cols)
    empty_attrs = [F.lit(None).cast("string").alias("FlowDebris"), F.col("sample_volume").alias("Volume"),
                   F.lit("NOFISH").alias("OrganismCode"), F.lit(None).cast("double").alias("ForkLength"),
                   F.lit(None).cast("double").alias("Count"), F.lit(None).cast("string").alias("MarkCode"),
                   F.lit(None).cast("string").alias("RaceByLength")]
    with_lines = ln.select(F.col("SampleID").alias("SampleRowID")).distinct().withColumn("lines", F.lit(True))
    # a record for an order without lines, and a spurious one for a finished order with lines
    empty = (joins.join(sa, with_lines, ["SampleRowID"], "left", null_safe=False)
             .filter(F.col("lines").isNull() | (F.col("status") == "F")).select("*", *empty_attrs).select(*cols))
    allrows = fish.unionByName(empty)
    kdtr = allrows.filter(F.col("MethodCode") != "20mm")
    mm = allrows.filter(F.col("MethodCode") == "20mm").withColumnRenamed("Count", "Catch")
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("code"), F.col("p_brand").alias("ScientificName")).distinct()
    species = p.select(F.when(F.col("code") == 1, F.lit("CHN")).otherwise(F.concat(F.lit("B"), F.col("code").cast("string")))
                       .alias("USFWS_Code"),
                       exprs.taxa_label("ScientificName", F.when(F.col("code") == 9, F.lit("Age 0"))).alias("Taxa"))
    return {"EDSM": scan_union([(kdtr, {}), (mm, {"Catch": "Count"})])}, species


@register("edsm_job")
def q_edsm_job(spark: SparkSession, d: str) -> DataFrame:
    """K8 end to end (S5, F2, P17, P12, P10, P11, P6, P9, P4, P21, A7, A11, F9,
    J1, P23, P26) on the driver tables in the EDSM roles."""
    with roles.Once(spark, d, _scratch(spark, "edsm"), ["linenumber", "tax", "price", "quantity", "returnflag"]):
        tables, species = edsm_tables(spark, d)
        ds = surveys.edsm(tables, species, materialise).dataset  # reads the export once, now
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi", "Tow_volume",
           "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@landed
def djfmp_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The DJFMP export played by the driver tables: each line is a catch
    record of its order's haul at the customer's nation (hauls at hour 0 are
    midnight, i.e. unknown times); brand 1 plays Chinook (line 7 tagged, race
    by length); orders without lines are empty-net records.  Every organism
    code is in the crosswalk, so the new-species guard passes."""
    prio = F.substring("o_orderpriority", 1, 1)
    sa = roles.visits(spark, d).select(
        F.col("o_orderkey").alias("SampleRowID"), F.col("c_nationkey").cast("string").alias("StationCode"),
        F.to_date("o_orderdate").cast("string").alias("SampleDate"),
        F.concat(F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("SampleTime"),
        prio.cast("int").alias("TowNumber"), (F.abs(F.col("c_acctbal")) / 400).alias("WaterTemp"),
        F.lit(3.0).alias("Turbidity"),
        F.when(prio == "1", F.lit("SEIN")).when(prio == "2", F.lit("MWTR")).otherwise(F.lit("KDTR")).alias("MethodCode"),
        (F.col("c_acctbal") / 100).alias("SeineDepth"),
        F.when(F.col("o_orderstatus") == "F", F.lit("U")).when(F.col("o_orderstatus") == "O", F.lit("D"))
         .otherwise(F.lit("X")).alias("SamplingDirection"),
        (F.col("o_totalprice") / 10).alias("SpecificConductance"), F.lit(0.4).alias("Secchi"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("o_custkey") % 10).cast("int")).alias("GearConditionCode"),
        (F.col("o_totalprice") / 1000).alias("sample_volume"))
    ln = roles.lines(spark, d)
    brand = _brand_no("brand")
    cols = ["StationCode", "SampleDate", "SampleTime", "TowNumber", "WaterTemp", "Turbidity", "MethodCode", "Volume",
            "FlowDebris", "SeineDepth", "SamplingDirection", "ForkLength", "SpecificConductance", "Secchi",
            "OrganismCode", "Count", "MarkCode", "RaceByLength", "GearConditionCode"]
    fish = joins.join(ln, sa.withColumnRenamed("SampleRowID", "SampleID"), ["SampleID"], "inner", null_safe=False).select(
        "*", F.when(F.col("returnflag") == "R", F.lit("Y")).when(F.col("returnflag") == "A", F.lit("Yes")).alias("FlowDebris"),
        (F.col("price") / 100).alias("Volume"),
        F.when(brand == 1, F.lit("CHN")).otherwise(F.concat(F.lit("B"), brand.cast("string"))).alias("OrganismCode"),
        F.when(F.col("linenumber") == 1, F.lit(0.0)).otherwise(F.col("quantity")).alias("ForkLength"),
        F.ceil(F.col("quantity") / 10).cast("double").alias("Count"),
        F.when(F.col("linenumber") == 7, F.lit("AD")).when(F.col("linenumber") % 2 == 1, F.lit("None")).alias("MarkCode"),
        F.when(F.col("quantity") < 25, F.lit("Fall")).otherwise(F.lit("Spring")).alias("RaceByLength")).select(*cols)
    with_lines = ln.select(F.col("SampleID").alias("SampleRowID")).distinct()
    empty = joins.join(sa, with_lines, ["SampleRowID"], "left_anti", null_safe=False).select(
        "*", F.col("sample_volume").alias("Volume"), F.lit(None).cast("string").alias("FlowDebris"),
        F.lit(None).cast("double").alias("ForkLength"), F.lit("NOFISH").alias("OrganismCode"),
        F.lit(None).cast("double").alias("Count"), F.lit(None).cast("string").alias("MarkCode"),
        F.lit(None).cast("string").alias("RaceByLength")).select(*cols)
    n = roles.read(spark, d, "nation")
    stations = n.select(F.col("n_nationkey").cast("string").alias("StationCode"),
                        (F.lit(38.0) + F.col("n_nationkey") * F.lit(0.01)).alias("Latitude"),
                        (F.lit(-121.5) - F.col("n_regionkey") * F.lit(0.1)).alias("Longitude"))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("code"), F.col("p_brand").alias("ScientificName")).distinct()
    species = p.select(F.when(F.col("code") == 1, F.lit("CHN")).otherwise(F.concat(F.lit("B"), F.col("code").cast("string")))
                       .alias("USFWS_Code"),
                       exprs.taxa_label("ScientificName", F.when(F.col("code") == 11, F.lit("Age 0"))).alias("Taxa"))
    return {"DJFMP": fish.unionByName(empty), "DJFMP_stations": stations}, species


@register("djfmp_job")
def q_djfmp_job(spark: SparkSession, d: str) -> DataFrame:
    """K9 end to end (Q15 guard, F2, P17, P18 midnight rule, P12, P10, P4, P21,
    A7, A11, J3, J1, P23, P26) on the driver tables in the DJFMP roles."""
    with roles.Once(spark, d, _scratch(spark, "djfmp"), ["linenumber", "price", "quantity", "returnflag"]):
        tables, species = djfmp_tables(spark, d)
        ds = surveys.djfmp(tables, species, keep=materialise).dataset  # reads the export once, now
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi", "Tow_volume",
           "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


@landed
def suisun_tables(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The Suisun database played by the driver tables: orders are samples
    (urgent ones midwater, low ones a beach seine, the rest otter trawls; a
    quarter carry the "NA" tide token, a seventh a tide nobody knows), lines
    are catch rows (line 1 unmeasured, length 0; tax 0.08 a trawl not made,
    0.07 an empty one), several depth readings per sample (one per line) are
    averaged.  An unmeasured line has a translated comment by its discount:
    above 0.05 a bound, 0.02 a length, 0.01 a life stage that the table of
    sizes at age bounds for half of the taxa, 0.03 one to ignore."""
    o = roles.read(spark, d, "orders")
    prio = F.substring("o_orderpriority", 1, 1)
    cust = F.col("o_custkey")
    sample = roles.visits(spark, d).select(
        F.col("o_orderkey").cast("string").alias("SampleRowID"),
        F.when(prio == "1", F.lit("MWTR")).when(prio.isin("2", "3", "4"), F.lit("OTR"))
         .otherwise(F.lit("BSEIN")).alias("MethodCode"),
        F.col("c_nationkey").cast("string").alias("StationCode"),
        F.to_date("o_orderdate").cast("string").alias("SampleDate"),
        F.concat(F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":30:00")).alias("SampleTime"),
        F.lit(True).alias("QADone"), (F.abs(F.col("c_acctbal")) / 400).alias("WaterTemperature"),
        F.lit(45.0).alias("Secchi"), (F.col("o_totalprice") / 10).alias("SpecificConductance"),
        F.when(cust % 7 == 0, F.lit("turning")).when(cust % 4 == 0, F.lit("flood")).when(cust % 4 == 1, F.lit("ebb"))
         .when(cust % 4 == 2, F.lit("NA")).otherwise(F.lit("outgoing")).alias("TideCode"))
    li = roles.read(spark, d, "lineitem")
    depth = li.select(F.col("l_orderkey").cast("string").alias("SampleRowID"), (F.col("l_quantity") / 10).alias("Depth"))
    effort = o.select(F.col("o_orderkey").cast("string").alias("SampleRowID"),
                      (F.lit(5.0) + F.col("o_orderkey") % 10).alias("TowDuration"),
                      F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("net "), F.col("o_orderkey").cast("string")))
                      .alias("TrawlComments"))
    n = roles.read(spark, d, "nation")
    stations = n.select(F.col("n_nationkey").cast("string").alias("Station"),
                        (F.lit(38.0) + F.col("n_nationkey") * F.lit(0.01)).alias("Latitude"),
                        (F.lit(-122.0) - F.col("n_regionkey") * F.lit(0.01)).alias("Longitude"))
    tax, percent = F.round(F.col("tax") * 100), F.round(F.col("discount") * 100)
    note = F.when(F.col("linenumber") == 1, F.when(percent > 5, F.concat(F.lit("<"), F.col("linenumber").cast("string")))
                  .when(percent == 2, F.lit("~")).when(percent == 1, F.lit("YOY")).when(percent == 3, F.lit("with eggs")))
    ln = roles.lines(spark, d).withColumn("code", _brand_no("brand")).withColumn("note", note)
    ln = joins.join(ln, roles.samples(spark, d).select("SampleID", F.month("Date").alias("Month")), ["SampleID"], "inner",
                    null_safe=False)
    fish = F.when(F.col("discount") >= 0.05, F.lit(2.0)).otherwise(F.lit(1.0)).alias("Count")
    catch = ln.select(F.col("SampleID").cast("string").alias("SampleRowID"),
                      F.when(tax == 8, F.lit("NOTRAWL")).when(tax == 7, F.lit("NOCATCH"))
                      .otherwise(F.col("code").cast("string")).alias("OrganismCode"),
                      F.col("Length").alias("StandardLength"), F.lit("N").alias("Dead"), fish,
                      F.col("note").alias("CatchComments"))
    label = exprs.taxa_label(F.col("brand"), F.when(F.col("code") == 13, F.lit("Age 0")))
    comments = ln.filter(F.col("note").isNotNull() & ~tax.isin(7, 8)).select(
        exprs.sample_id(F.lit("Suisun"), exprs.braced("SampleID")).alias("SampleID"), label.alias("Taxa"), fish,
        F.col("note").alias("CatchComments"), F.lit(None).cast("double").alias("Min_length"),
        F.when(percent == 2, F.col("quantity")).alias("Length"), F.when(percent > 5, F.col("quantity")).alias("Max_length"),
        F.when(percent == 1, F.lit("YOY")).alias("Lifestage"), "Month", F.when(percent == 3, F.lit(1)).alias("Ignore"))
    ages = (ln.groupBy("Month", F.col("code").cast("string").alias("OrganismCode"))
            .agg(F.min("quantity").alias("Min"), F.max("quantity").alias("Max"))
            .withColumn("Class", F.when(F.col("OrganismCode").cast("int") % 2 == 0, F.lit("Age-0")).otherwise(F.lit("Age-1"))))
    p = roles.read(spark, d, "part").select(_brand_no("p_brand").alias("code"), F.col("p_brand").alias("ScientificName")).distinct()
    species = p.select(F.col("code").cast("string").alias("SMF_Code"),
                       exprs.taxa_label("ScientificName", F.when(F.col("code") == 13, F.lit("Age 0"))).alias("Taxa"))
    return ({"Sample": sample, "Depth": depth, "StationsLookUp": stations, "TrawlEffort": effort,
             "Catch": catch, "comments": comments, "AgesBySizeMo": ages}, species)


@register("suisun_job")
def q_suisun_job(spark: SparkSession, d: str) -> DataFrame:
    """K2 end to end (S2, A12, P15, P21 braced ids, J8 size groups, A9, F9,
    W2, J1, J7, A11, P25, P26) on the driver tables in the Suisun roles."""
    tables, species = suisun_tables(spark, d)
    ds = surveys.suisun(tables, species, materialise).dataset
    dbl = ["Latitude", "Longitude", "Depth", "Sal_surf", "Temp_surf", "Secchi", "Tow_duration", "Tow_area",
           "Length", "Count"]
    return ds.select(*[q6(c).alias(c) if c in dbl else
                       (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c in ds.columns])


# -- measured lengths and the ten-source integration ------------------------------

#: Survey job and the tables it reads, by query prefix.
SURVEY_JOBS = {
    "fmwt": (surveys.fmwt, fmwt_tables), "skt": (surveys.skt, skt_tables), "stn": (surveys.stn, stn_tables),
    "tmm": (surveys.tmm, tmm_tables), "sls": (surveys.sls, sls_tables), "edsm": (surveys.edsm, edsm_tables),
    "djfmp": (surveys.djfmp, djfmp_tables), "baystudy": (surveys.baystudy, baystudy_tables),
    "suisun": (surveys.suisun, suisun_tables), "salvage": (_salvage_here, salvage_tables),
}

#: Those that read tables of theirs several times.
KEEPING = ("edsm", "djfmp", "suisun")


def _measured(name: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        job, tables = SURVEY_JOBS[name]
        out = job(*tables(spark, d), **({"keep": materialise} if name in KEEPING else {})).measured_lengths
        return out.select(*[q6(c).alias(c) if c in ("Length", "Count") else F.col(c) for c in out.columns])

    query.__doc__ = f"K11: the measured-length table of the {name} job."
    return query


# EDSM and DJFMP measure no fish apart from their plus counts and have none.
for _name in ("fmwt", "skt", "stn", "tmm", "sls", "baystudy", "suisun", "salvage"):
    register(f"measured_{_name}")(_measured(_name))


#: Published folders of this application, by the tables they were made of.
_PUBLISHED: dict[tuple[str, str], str] = {}
#: Jobs planned side by side: each leaves cores idle while it plans, and holds its plan in the driver.
AT_ONCE = 2
#: Stored bytes of the tables up to which jobs run side by side as well.  Larger ones
#: keep the cores busy alone, and their shuffle files would lie on disk at once.
SIDE_BY_SIDE = 64 << 20


def _published(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Run the ten jobs, publish each dataset as a version (S9) under the folder
    driver and executors share, and read them back through the registry (S6).
    Once for an application and its tables, as long as the folder is there: three
    queries read them."""
    made = (spark.sparkContext.applicationId, d)
    if made not in _PUBLISHED or len(Versions(spark, _PUBLISHED[made]).current()) < len(SURVEY_JOBS):
        root = _scratch(spark, "surveys")
        turn = nullcontext() if stored_bytes(spark, d) <= SIDE_BY_SIDE else Lock()

        def run(name: str) -> None:
            job, tables = SURVEY_JOBS[name]
            with once.here(), Stored(f"{root}/kept") as stored:
                def keep(df: DataFrame) -> DataFrame:
                    with turn:
                        return stored(df)

                result = job(*tables(spark, d), **({"keep": keep} if name in (*KEEPING, "sls") else {}))
                with turn:
                    Versions(spark, root).publish(name, result.dataset)

        with freeing(spark), roles.Once(spark, d, f"{root}/kept") as once, ThreadPoolExecutor(AT_ONCE) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(run), name) for name in SURVEY_JOBS]:
                done.result()
        _PUBLISHED[made] = root
    return Versions(spark, _PUBLISHED[made]).load()


def _by_sample(fish: DataFrame) -> DataFrame:
    """Fish rows stored in buckets by sample: what is distinct or grouped by
    sample then shuffles nothing."""
    spark = fish.sparkSession
    path = _scratch(spark, "fish")
    with freeing(spark):
        write_bucketed(fish, path, int(spark.conf.get("spark.sql.shuffle.partitions")), None)
    return spark.table(table_name(path))


@register("integrate_all")
def q_integrate_all(spark: SparkSession, d: str) -> DataFrame:
    """K12 over all ten jobs (S6, S9, U1 across their differing columns): the
    survey table and the zero-filled fish table, reported per survey and
    taxon: rows, rows with catch, fish, and the survey's samples and dates."""
    out = integrate(_published(spark, d), keep=_by_sample)
    source = F.regexp_extract("SampleID", r"^(Bay Study|\S+)", 1)
    fish = (out.fish.groupBy(source.alias("Source"), "Taxa")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("Count") > 0).alias("n_caught"),
                 F.round(F.sum("Count"), 3).alias("total")))
    samples = materialise(out.survey.groupBy("Source").agg(
        F.count(F.lit(1)).alias("n_samples"), F.min("Date").alias("first_date"), F.max("Date").alias("last_date")))
    return joins.join(fish, samples, ["Source"], "inner", null_safe=False)


@register("integrate_all_survey")
def q_integrate_all_survey(spark: SparkSession, d: str) -> DataFrame:
    """The integrated survey table's rows over all ten sources, every
    column of the contract, those a source lacks null."""
    survey = integrate(_published(spark, d)).survey
    return survey.select(*[q6(c).alias(c) if kind == "double" else
                           (F.col(c).cast("string").alias(c) if c == "Datetime" else F.col(c)) for c, kind in survey.dtypes])


@register("integrate_all_fish")
def q_integrate_all_fish(spark: SparkSession, d: str) -> DataFrame:
    """The integrated fish table's rows with catch over all ten sources:
    lengths, counts and notes (``integrate_all`` counts the zeros)."""
    fish = integrate(_published(spark, d)).fish.filter(F.col("Count") != 0)
    return fish.select(*[q6(c).alias(c) if kind == "double" else F.col(c) for c, kind in fish.dtypes])


# -- sinks read back -----------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share, new for each call."""
    base = checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("sinks_survey_csv")
def q_sinks_survey_csv(spark: SparkSession, d: str) -> DataFrame:
    """S8 + S7 + S1 + S2: the integrated tables written in both formats, the
    survey table read back from CSV by its types."""
    survey, fish = _survey_fish(spark, d)
    root = _scratch(spark, "sinks")
    write_integrated({"survey": survey, "fish": fish}, root, "both")
    back = read_typed_csv(spark, f"{root}/survey_csv", {f.name: f.dataType.simpleString() for f in survey.schema.fields})
    return back.select(*[r6(c).alias(c) if kind == "double" else F.col(c) for c, kind in back.dtypes])


@register("sinks_fish_parquet")
def q_sinks_fish_parquet(spark: SparkSession, d: str) -> DataFrame:
    """S8 + S3: the fish table read back from the columnar sink, by name from
    the tables the folder holds."""
    survey, fish = _survey_fish(spark, d)
    root = _scratch(spark, "sinks")
    write_integrated({"survey": survey, "fish": fish}, root, "columnar")
    back = load_tables(spark, root, ["fish"], available=["survey", "fish"])["fish"]
    return back.withColumn("Count", r6("Count"))


@register("species_crosswalk")
def q_species_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """K13 + S4: the crosswalk built from its CSV (codes typed, NA missing,
    labels with life stage), and looked up again as a small table."""
    p = roles.read(spark, d, "part").select(F.col("p_brand").alias("ScientificName"), _brand_no("p_brand").alias("n")).distinct()
    path = _scratch(spark, "species")
    write_csv(p.select("ScientificName", F.when(F.col("n") % 3 != 0, F.col("n")).alias("STN_Code"),
                       F.concat(F.lit("C"), F.col("n").cast("string")).alias("SKT_Code"),
                       F.when(F.col("n") % 5 == 0, F.lit("Age 0")).alias("Lifestage")), path)
    species = build_species(spark, path)
    again = load_lookup(spark, path, {"ScientificName": "string", "STN_Code": "int"}, fmt="csv")
    again = again.select("ScientificName", F.col("STN_Code").alias("Looked_up"))
    return joins.lookup(species.select("ScientificName", "STN_Code", "SKT_Code", "Lifestage", "Taxa"), again, ["ScientificName"])


@register("publication")
def q_publication(spark: SparkSession, d: str) -> DataFrame:
    """All tables written in both formats, and the coverage row, which is
    that of the written survey table; the dataset is kept while both are made of it."""
    root = _scratch(spark, "publication")
    with Stored(f"{root}/kept") as keep:
        c = publication(integrate({"surveys": keep(roles.dataset(spark, d))}), root)
    return c.select(r6("south").alias("south"), r6("north").alias("north"), r6("west").alias("west"),
                    r6("east").alias("east"), "begin", "end")


@register("typed_projection")
def q_typed_projection(spark: SparkSession, d: str) -> DataFrame:
    """P1 + P20: text columns cast by a type list (bad values null), local
    wall-clock times as instants."""
    li = roles.read(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("SampleID"), "l_linenumber",
        F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("Length"),
        F.to_date("l_shipdate").cast("string").alias("Date"))
    typed = exprs.cast_cols(li, {"bigint": ["SampleID"], "double": ["Length"], "date": ["Date"]})
    wall = F.make_timestamp_ntz(F.year("Date"), F.month("Date"), F.dayofmonth("Date"), F.lit(12), F.col("l_linenumber"), F.lit(0))
    return typed.select("SampleID", F.col("l_linenumber").alias("Tow"), "Length", "Date",
                        exprs.force_tz(wall).cast("string").alias("Utc"))


# -- the sparse store, versions and checks at publishing ------------------------------

SLICE_TAXA = ["Brand#13", "Brand#2", "UnID"]


def _store(spark: SparkSession, d: str) -> SparseStore:
    survey, fish = _survey_fish(spark, d)
    path = _scratch(spark, "sparse")
    write_sparse(survey, fish, path)
    return SparseStore(spark, path)


@register("sparse_slice")
def q_sparse_slice(spark: SparkSession, d: str) -> DataFrame:
    """Z1 + Z2 + K14 (F14, F17, J14): a slice of three taxa of the zero-filled
    table, read from the sparse store; zeros are made of the taxa asked for."""
    out = _store(spark, d).slice(sources=["F", "O"], months=[1, 2, 3, 4, 5, 6], years=(1996, 2000), taxa=SLICE_TAXA)
    return out.select("SampleID", "Source", "Date", "Taxa", "Length", q6("Count").alias("Count"))


@register("sparse_slice_aggregate")
def q_sparse_slice_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Z1 + K14 (F14, F15, F17, A15, J14): the same over all taxa, counts summed
    over the lengths in each source's window, joined by bucket."""
    out = _store(spark, d).slice(sources=["F", "O"], months=[1, 2, 3, 4, 5, 6], years=(1996, 2000),
                                 bounds={"O": (10.0, 40.0)}, default_bounds=(5.0, 45.0), aggregate=True)
    return out.select("SampleID", "Source", "Date", "Taxa", q6("Count").alias("Count"))


@register("replace_source")
def q_replace_source(spark: SparkSession, d: str) -> DataFrame:
    """S9 + S6: a dataset published as a version, one source of it published
    again alone, and the current version read back."""
    v = Versions(spark, _scratch(spark, "versions"))
    fish = roles.fish(spark, d).select("Source", "SampleID", "Taxa", "Length", "Count")
    v.publish("fish", fish.withColumn("Count", F.lit(-1.0)))
    v.publish("fish", fish)
    again = fish.filter((F.col("Source") == "P") & F.col("Taxa").isNotNull()).withColumn("Count", F.col("Count") * 2)
    replace_sources(again, v.path("fish"))
    return v.load(["fish"])["fish"].select("Source", "SampleID", "Taxa", "Length", "Count")


@register("publish_checks")
def q_publish_checks(spark: SparkSession, d: str) -> DataFrame:
    """Q14, N13, P1 and rules while publishing: text columns cast by a type
    list, rows once, written as a version; failed casts, rows lost and rows
    that break a rule are counted by the write itself."""
    li = joins.join(roles.lines(spark, d), roles.samples(spark, d).select("SampleID", "Source", "Date"), ["SampleID"],
                    "inner", null_safe=False)
    no = F.col("linenumber")
    text = li.select("Source", F.col("SampleID").cast("string").alias("SampleID"), "Taxa",
                     F.when(no == 3, F.lit("n/p")).when(no == 5, F.lit(None).cast("string"))
                     .otherwise(F.col("Length").cast("string")).alias("Length"),
                     F.when(no == 2, F.lit("13/32/99")).otherwise(F.col("Date").cast("string")).alias("Date"))
    rules = quality.range_rules({"Length": (1.0, 45.0)}) | {"no_date": F.col("Date").isNull()}
    report = Versions(spark, _scratch(spark, "checked")).publish(
        "fish", once(typed(text, {"SampleID": "bigint", "Length": "double", "Date": "date"})), rules=rules,
        allowed={"failed_SampleID": 0})
    return spark.createDataFrame(sorted(report.items()), "check string, value long")


@register("broken_samples")
def q_broken_samples(spark: SparkSession, d: str) -> DataFrame:
    """Q1-Q10 per source with the first three samples that break each rule."""
    ds = roles.dataset(spark, d)
    out = quality.broken_samples(ds, quality.dataset_rules(ds.columns, dict(ds.dtypes)), k=3)
    return out.withColumn("keys", F.array_join("keys", ","))


@register("sample_fingerprints")
def q_sample_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """U3 + A17: per source a digest of the samples in the survey table, and
    whether the zero-filled fish table and the lines have just the same."""
    survey, fish_t = _survey_fish(spark, d)
    own = reshape.fingerprint(survey, ["SampleID"], ["Source"])
    filled = fill.zero_fill(fish_t, "Source", "SampleID", "Taxa")
    sides = {"filled": filled, "caught": fish_t.filter(F.col("Taxa").isNotNull())}
    out = own
    for name, df in sides.items():
        other = reshape.fingerprint(df, ["SampleID"], ["Source"], distinct=True)
        same = reshape.same_fingerprint(own, other, ["Source"])
        out = joins.join(out, same.select("Source", F.col("n_right").alias(f"n_{name}"), F.col("same").alias(f"same_{name}")),
                         ["Source"], "left")
    return out


def _crosswalk(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Crosswalk, organism list and spelling map: every third taxon has no code
    yet, every fourth is not in the crosswalk, every fifth is misspelled in
    the list, every sixth has a new code there; 7 has two codes, 8 and 10 share
    one."""
    p = roles.read(spark, d, "part").select(F.col("p_brand").alias("name"), _brand_no("p_brand").alias("n")).distinct()
    n = F.col("n")
    species = p.filter(n % 4 != 0).select(F.col("name").alias("ScientificName"), F.when(n % 3 != 0, n).alias("Salvage_Code"),
                                          F.concat(F.lit("C"), n.cast("string")).alias("SKT_Code"))
    code = F.when(n == 1, 90).when(n == 10, 8).when(n % 6 == 5, n + 200).otherwise(n)
    wrong = F.when(n % 5 == 0, F.concat(F.lit("Bramd#"), n.cast("string"))).otherwise(F.col("name"))
    codes = F.when(n == 7, F.array(F.lit(7), F.lit(107))).otherwise(F.array(code))
    organisms = p.select(F.explode(codes).alias("OrganismCode"),
                         F.when(n % 2 == 0, F.lit("NA")).otherwise(wrong).alias("Genus"),
                         F.lit(None).cast("string").alias("Species"),
                         F.when(n % 2 == 0, wrong).alias("Family"), F.lit("fish").alias("CommonName"))
    spelling = p.filter(n % 5 == 0).select(F.concat(F.lit("Bramd#"), n.cast("string")).alias("Wrong"), F.col("name").alias("Right"))
    return species, organism_names(organisms), spelling


@register("crosswalk_changes")
def q_crosswalk_changes(spark: SparkSession, d: str) -> DataFrame:
    """New, corrected, recoded and clashing names of an organism list."""
    return crosswalk_changes(*_crosswalk(spark, d), "Salvage_Code")


@register("crosswalk_refresh")
def q_crosswalk_refresh(spark: SparkSession, d: str) -> DataFrame:
    """The crosswalk after the update by name."""
    return refresh_species(*_crosswalk(spark, d), "Salvage_Code")
