"""Survey jobs (K1-K11): relational source tables -> published dataset.

Each job takes the survey's tables (``Mapping[str, DataFrame]``, names as
the source database has them) and the species crosswalk, and returns the
survey-level dataset (sample columns + Taxa, Length, Count, Length_NA_flag)
and its measured-length table.  Jobs are lazy plans built only from the
library's operators; sample identifiers come from natural keys (never a
global row number, N12).
"""

from __future__ import annotations

from typing import Callable, Mapping, NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.functions import exprs
from shoal.functions.nulls import recode, strict_sum
from shoal.functions.salinity import clamp_salinity, with_salinity
from shoal.functions.schema import NO_FISH, UNKNOWN_LENGTH
from shoal.operators import expand, filters, joins, samples, windows
from shoal.operators.analyze import mean_by
from shoal.plans.types import ingest
from shoal.session import as_is
from shoal.sources.io import normalize_na

Tables = Mapping[str, DataFrame]
#: What a job does with a table that it reads several times.
Keep = Callable[[DataFrame], DataFrame]


class SurveyResult(NamedTuple):
    dataset: DataFrame
    measured_lengths: DataFrame | None  #: none where counts are plus-count expansions


# Tow direction labels per survey.
TOW_DIRECTION_FMWT = {1: "With current", 2: "Against current", 3: "Unknown"}
TOW_DIRECTION_BAY = {1: "With current", 2: "Against current", 3: "Slack or cross-current"}
# Bay Study net codes.
BAY_METHODS = {1: "Midwater trawl", 2: "Otter trawl", 3: "EL"}
# STN tow volume default and flow meters known to be suspect.
STN_DEFAULT_VOLUME = 735.0
STN_SUSPECT_TOWS = [6612, 12815, 2551, 12786, 8031, 1857]
# A tow number entered wrong (sample, tow, number).
STN_TOW_NUMBERS = [(7078, 12153, 2)]
# A record whose catch was confirmed later (date, station, tow,
# taxon, catch).
TMM_CATCHES = [("2021-03-23", "610", 1, "Gasterosteus aculeatus", 1.0)]
# Gear conditions that void a tow (EDSM, DJFMP).
BAD_GEAR_CONDITIONS = [3, 4, 9]
# Conductivity standardisation date (EDSM, DJFMP).
CONDUCTIVITY_CUTOFF = "2019-06-01"


def _ec(col: str) -> F.Column:
    """Specific conductance uS/cm -> mS/cm."""
    return exprs.convert(col, "us_cm", "ms_cm")


def _finish(df: DataFrame, cols: list[str]) -> DataFrame:
    """Strip life stages, merge counts that became duplicates (A11), order.
    Rows are dealt by sample, so equal ones meet and a sample's rows, which are
    few, stay together: what is stored or made distinct of them is small."""
    df = df.withColumn("Taxa", exprs.strip_lifestage("Taxa"))
    return expand.merge_duplicates(df.select(*cols).repartition("SampleID"), "Count")


def _with_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Add the missing ones of optional columns as nulls."""
    return df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})


# -- K3 FMWT -------------------------------------------------------------------------

def fmwt(t: Tables, species: DataFrame) -> SurveyResult:
    """K3: Fall Midwater Trawl."""
    t = ingest("fmwt", t)
    st = (t["StationsLookUp"].select(exprs.pad_station("StationCode", 3).alias("Station"),
                                     F.col("DD_Latitude").cast("double").alias("Latitude"),
                                     F.col("DD_Longitude").cast("double").alias("Longitude"))
          .dropna())
    s = t["Sample"]
    s = s.select(
        "SampleRowID", exprs.pad_station(F.col("StationCode"), 3).alias("Station"),
        F.col("MethodCode").alias("Method"), F.to_date("SampleDate").alias("Date"),
        F.col("SampleTimeStart").alias("Time"), F.col("SurveyNumber").alias("Survey"),
        F.col("WaterTemperature").alias("Temp_surf"), F.col("Turbidity").alias("TurbidityNTU"),
        exprs.convert("Secchi", "m", "cm").alias("Secchi"),
        F.col("SecchiEstimated").alias("Secchi_estimated"),
        "ConductivityTop",
        recode("TowDirectionCode", TOW_DIRECTION_FMWT, default=None).alias("Tow_direction"),
        exprs.tow_volume(F.col("MeterEnd") - F.col("MeterStart"), 0.02687, 10.7,
                         zero_is_null=True).alias("Tow_volume"),
        exprs.convert("CableOut", "ft", "m").alias("Cable_length"),
        exprs.tide("TideCode").alias("Tide"), exprs.convert("DepthBottom", "ft", "m").alias("Depth"))
    s = filters.keep_methods(s, "Method", ["MWTR"]).withColumn("Method", F.lit("Midwater trawl"))
    s = s.withColumn("Datetime", exprs.compose_datetime("Date", "Time", midnight_is_null=True))
    s = joins.lookup(s, st, ["Station"]).withColumn("SampleID", exprs.sample_id(F.lit("FMWT"), "SampleRowID"))
    s = with_salinity(s, _ec("ConductivityTop"), "Sal_surf")

    catch = t["Catch"].filter(F.col("OrganismCode").isNotNull())
    catch = joins.to_taxa(catch, species, "OrganismCode", "FMWT_Code")
    ln = normalize_na(t["Length"]).select(
        "CatchRowID", F.col("ForkLength").try_cast("double").alias("ForkLength"),
        F.col("LengthFrequency").try_cast("double").alias("LengthFrequency"))
    cl = expand.expand_counts(catch.select("CatchRowID", "SampleRowID", "Taxa", "Catch"), ln,
                              ["CatchRowID"], length="ForkLength", freq="LengthFrequency")
    d = joins.retain_samples(s, cl.select("SampleRowID", "Taxa", "ForkLength", "Count"),
                             ["SampleRowID"])
    d = (d.withColumn("Source", F.lit("FMWT")).withColumnRenamed("ForkLength", "Length")
         .withColumn("Length_NA_flag", F.when(F.col("Length").isNull() & F.col("Count").isNull(), F.lit(NO_FISH))
                     .when(F.col("Length").isNull(), F.lit(UNKNOWN_LENGTH)))
         .withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag")))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth",
            "SampleID", "Method", "Tide", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi",
            "Secchi_estimated", "Tow_volume", "Tow_direction", "Cable_length", "Taxa", "Length",
            "Count", "Length_NA_flag"]
    dataset = _finish(d, cols)
    ml = expand.length_frequency(filters.measured_only(ln, "ForkLength"), ["CatchRowID"],
                                 "ForkLength", "LengthFrequency")
    ids = joins.join(catch.select("CatchRowID", "SampleRowID", "Taxa"),
                     s.select("SampleRowID", "SampleID"), ["SampleRowID"], "inner")
    ml = joins.join(ml, ids, ["CatchRowID"], "left").withColumn("Taxa", exprs.strip_lifestage("Taxa"))
    ml = ml.groupBy("SampleID", "Taxa", F.col("ForkLength").alias("Length")).agg(
        F.sum("LengthFrequency").alias("Count"))
    return SurveyResult(dataset, ml)


# -- K4 SKT ----------------------------------------------------------------------------

def skt(t: Tables, species: DataFrame) -> SurveyResult:
    """K4: Spring Kodiak Trawl."""
    t = ingest("skt", t)
    st = t["StationsSKT"].select(
        F.col("Station").cast("string").alias("Station"),
        exprs.dms_to_decimal("LatDeg", "LatMin", "LatSec").alias("Latitude"),
        exprs.dms_to_decimal("LongDec", "LongMin", "LongSec", west=True).alias("Longitude")).dropna()
    s = t["tblSample"].select(
        "SampleRowID", F.col("Station").cast("string").alias("Station"),
        F.to_date("SampleDate").alias("Date"), F.col("SampleTimeStart").alias("Time"),
        F.col("SurveyNumber").alias("Survey"), F.col("WaterTemperature").alias("Temp_surf"),
        exprs.tide("TideCode").alias("Tide"), exprs.convert("DepthBottom", "ft", "m").alias("Depth"),
        "Secchi", "ConductivityTop",
        exprs.tow_volume(exprs.meter_delta("MeterStart", "MeterEnd"), 0.026873027, 13.95).alias("Tow_volume"),
        recode("TowDirectionCode", TOW_DIRECTION_FMWT, default=None).alias("Tow_direction"),
        F.col("NTU").alias("TurbidityNTU"), F.col("FNU").alias("TurbidityFNU"))
    s = s.withColumn("Datetime", exprs.compose_datetime("Date", "Time", midnight_is_null=True))
    s = joins.lookup(s, st, ["Station"])
    s = with_salinity(s, _ec("ConductivityTop"), "Sal_surf")
    fi = t["tblFishInfo"].withColumn("LengthFrequency", F.lit(1.0))
    cl = expand.expand_counts(t["tblCatch"].select("CatchRowID", "SampleRowID", "OrganismCode", "Catch"),
                              fi, ["CatchRowID"], length="ForkLength", freq="LengthFrequency",
                              unmeasured="total", drop_null=False)
    cl = cl.filter(~(F.col("Count").isNull() & F.coalesce(F.col("OrganismCode") != 0, F.lit(False))))
    cl = joins.to_taxa(cl, species, "OrganismCode", "SKT_Code")
    d = joins.retain_samples(s, cl.select("SampleRowID", "OrganismCode", "Taxa", "ForkLength", "Count"),
                             ["SampleRowID"])
    d = (d.withColumn("Source", F.lit("SKT")).withColumn("Method", F.lit("Kodiak trawl"))
         .withColumn("SampleID", exprs.sample_id(F.lit("SKT"), "SampleRowID"))
         .withColumnRenamed("ForkLength", "Length")
         .withColumn("Length_NA_flag",
                     F.when(F.col("OrganismCode") == 0, F.lit(NO_FISH))
                     .when(F.col("Length").isNull() & (F.col("Count") > 0), F.lit(UNKNOWN_LENGTH)))
         .withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag")))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth",
            "SampleID", "Method", "Tide", "Sal_surf", "Temp_surf", "TurbidityNTU", "TurbidityFNU",
            "Secchi", "Tow_volume", "Tow_direction", "Taxa", "Length", "Count", "Length_NA_flag"]
    dataset = _finish(d, cols)  # merging leaves one row for each value of the other columns: distinct
    ml = filters.measured_only(t["tblFishInfo"], "ForkLength")
    ml = joins.join(ml, t["tblCatch"].select("CatchRowID", "SampleRowID", "OrganismCode"), ["CatchRowID"], "inner")
    ml = joins.to_taxa(ml, species, "OrganismCode", "SKT_Code").withColumn(
        "SampleID", exprs.sample_id(F.lit("SKT"), "SampleRowID"))
    ml = ml.groupBy("SampleID", exprs.strip_lifestage("Taxa").alias("Taxa"),
                    F.col("ForkLength").alias("Length")).agg(F.count(F.lit(1)).cast("double").alias("Count"))
    return SurveyResult(dataset, ml)


# -- K7 STN ----------------------------------------------------------------------------

def stn(t: Tables, species: DataFrame) -> SurveyResult:
    """K7: Summer Townet."""
    t = ingest("stn", t)
    s = joins.join(t["Sample"], t["TowEffort"], ["SampleRowID"], "inner")
    fixes = s.sparkSession.createDataFrame(STN_TOW_NUMBERS, "SampleRowID long, TowRowID long, TowNumber int")
    s = joins.apply_patches(s, fixes, ["SampleRowID", "TowRowID"], ["TowNumber"], "set")
    s = joins.lookup(s, t["luStation"], ["StationCode"])
    s = s.withColumn("Year", F.year("SampleDate"))
    corr = t["Web_Local_Meter_Corrections"].select(
        F.col("StudyYear").cast("int").alias("Year"), "MeterSerial", F.col("kFactor").alias("k_factor"))
    s = joins.lookup(s, corr, ["Year", "MeterSerial"])
    total = exprs.meter_delta("MeterIn", "MeterOut")
    vol = F.col("k_factor") * total * 1.49
    s = s.withColumn("Tow_volume", exprs.default_effort(
        vol, STN_DEFAULT_VOLUME, missing_when=F.col("MeterIn").isNull(),
        suspect=F.col("TowRowID").isin(STN_SUSPECT_TOWS)))
    s = s.select(
        "TowRowID", F.lit("STN").alias("Source"), F.col("StationCode").cast("string").alias("Station"),
        exprs.dms_to_decimal("LatD", "LatM", "LatS").alias("Latitude"),
        exprs.dms_to_decimal("LonD", "LonM", "LonS", west=True).alias("Longitude"),
        F.to_date("SampleDate").alias("Date"),
        exprs.compose_datetime(F.to_date("SampleDate"), "TimeStart", with_seconds=True).alias("Datetime"),
        "Survey", exprs.convert("DepthBottom", "ft", "m").alias("Depth"),
        exprs.sample_id(F.lit("STN"), F.to_date("SampleDate"), "Survey", "StationCode", "TowNumber").alias("SampleID"),
        F.lit("STN net").alias("Method"), "TideCode", "TowDirection",
        "ConductivityTop", F.col("TemperatureTop").alias("Temp_surf"),
        F.col("TurbidityTop").alias("TurbidityNTU"), "Secchi", "Tow_volume",
        exprs.convert("CableOut", "ft", "m").alias("Cable_length"))
    s = with_salinity(s, _ec("ConductivityTop"), "Sal_surf")
    s = s.withColumn("Sal_surf", exprs.null_if("Sal_surf", F.col("Sal_surf") > 40))
    s = joins.decode(s, t["luTide"], "TideCode", "TideRowID", "TideDesc", "Tide")
    s = s.withColumn("Tide", recode("Tide", {"High Tide": "High Slack", "Low Tide": "Low Slack"}))
    s = joins.decode(s, t["luTowDirection"], "TowDirection", "TowDirectionID", "TowDirection_label",
                     "Tow_direction")
    s = s.withColumn("Tow_direction", recode("Tow_direction", {"Against Current": "Against current",
                                                              "With Current": "With current"}))
    catch = filters.positive_catch(t["Catch"])
    ln = filters.measured_only(t["Length"], "ForkLength")
    cl = expand.expand_raise_catch(catch.select("TowRowID", "CatchRowID", "OrganismCode", "Catch"),
                                   ln, ["CatchRowID"], length="ForkLength", freq="LengthFrequency")
    cl = joins.to_taxa(cl, species, "OrganismCode", "STN_Code")
    d = joins.retain_samples(s, cl.select("TowRowID", "Taxa", "ForkLength", "LengthFrequency", "Catch",
                                          "Count", F.col("Length_NA_flag").alias("_flag")), ["TowRowID"])
    d = (d.withColumn("Length_NA_flag", F.when(F.col("Catch").isNull(), F.lit(NO_FISH))
                      .otherwise(F.col("_flag")))
         .withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
         .withColumnRenamed("ForkLength", "Length"))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth",
            "SampleID", "Method", "Tide", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi",
            "Tow_volume", "Tow_direction", "Cable_length", "Taxa", "Length", "Count", "Length_NA_flag"]
    dataset = _finish(d, cols)
    ml = (d.filter(F.col("LengthFrequency").isNotNull())
          .select("SampleID", exprs.strip_lifestage("Taxa").alias("Taxa"), "Length",
                  F.col("LengthFrequency").alias("Count")))
    return SurveyResult(dataset, ml)


# -- K5 20mm ---------------------------------------------------------------------------

def tmm(t: Tables, species: DataFrame) -> SurveyResult:
    """K5: 20 mm Survey (J4 chain, J5 calibration, A6 expansion, P32 patch)."""
    t = ingest("tmm", t)
    station = _with_columns(t["Station"], {"NTU": "double", "FNU": "double"})
    s = joins.assemble([(t["Survey"], [], ""), (station, ["SurveyID"], "inner"),
                        (t["Tow"], ["StationID"], "inner"), (t["Gear"], ["TowID"], "inner")])
    s = joins.lookup(s, t["20mmStations"], ["Station"])
    s = s.withColumn("StudyYear", F.year("SampleDate"))
    s = joins.calibrate(s, t["MeterCorrections"], "StudyYear", "MeterSerial")
    s = s.filter(F.col("GearCode") == 2)
    s = s.select(
        "GearID", "TowNum", F.lit("20mm").alias("Source"), F.col("Station").cast("string").alias("Station"),
        exprs.dms_to_decimal("LatD", "LatM", "LatS").alias("Latitude"),
        exprs.dms_to_decimal("LonD", "LonM", "LonS", west=True).alias("Longitude"),
        F.to_date("SampleDate").alias("Date"),
        exprs.compose_datetime(F.to_date("SampleDate"), "TowTime", with_seconds=True).alias("Datetime"),
        "Survey", exprs.convert("BottomDepth", "ft", "m").alias("Depth"),
        exprs.sample_id(F.lit("20mm"), "GearID").alias("SampleID"), F.lit("20mm net").alias("Method"),
        exprs.tide("Tide").alias("Tide"), F.col("Temp").alias("Temp_surf"), "TopEC", "Secchi",
        F.col("NTU").alias("TurbidityNTU"), F.col("FNU").alias("TurbidityFNU"),
        F.lit(None).cast("string").alias("Tow_direction"),
        exprs.tow_volume("MeterCheck", F.col("kFactor_final"), 1.51).alias("Tow_volume"),
        exprs.convert("CableOut", "ft", "m").alias("Cable_length"))
    s = with_salinity(s, _ec("TopEC"), "Sal_surf")
    fs = t["FishSample"].select("GearID", "FishSampleID", "FishCode", "Catch")
    fl = joins.join(fs.select("FishSampleID", "GearID", "FishCode"), t["FishLength"].select("FishSampleID", "Length"),
                    ["FishSampleID"], "inner")
    cl = expand.expand_raise_catch(fs, fl.drop("GearID", "FishCode"), ["FishSampleID"], length="Length")
    cl = joins.to_taxa(cl, species, "FishCode", "TMM_Code")
    d = joins.retain_samples(s, cl.select("GearID", "Taxa", "Length", "LengthFrequency", "Catch", "Count",
                                          F.col("Length_NA_flag").alias("_flag")), ["GearID"])
    d = (d.withColumn("Length_NA_flag", F.when(F.col("Catch").isNull(), F.lit(NO_FISH)).otherwise(F.col("_flag")))
         .withColumn("_plain", exprs.strip_lifestage("Taxa")))
    fixes = d.sparkSession.createDataFrame(TMM_CATCHES, "day string, Station string, TowNum int, _plain string, _confirmed double")
    fixes = fixes.select(F.to_date("day").alias("Date"), "Station", "TowNum", "_plain", "_confirmed")
    d = joins.lookup(d.withColumn("TowNum", F.col("TowNum").cast("int")), fixes, ["Date", "Station", "TowNum", "_plain"])
    confirmed = F.col("_confirmed").isNotNull() & F.col("Catch").isNull()
    d = (d.withColumn("Length_NA_flag", F.when(confirmed, F.lit(UNKNOWN_LENGTH)).otherwise(F.col("Length_NA_flag")))
         .withColumn("Count", F.when(confirmed, F.col("_confirmed")).otherwise(F.col("Count")))
         .withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag")))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth",
            "SampleID", "Method", "Tide", "Sal_surf", "Temp_surf", "TurbidityNTU", "TurbidityFNU", "Secchi",
            "Tow_volume", "Tow_direction", "Cable_length", "Taxa", "Length", "Count", "Length_NA_flag"]
    dataset = _finish(d, cols)
    ml = (d.filter(F.col("LengthFrequency").isNotNull())
          .select("SampleID", exprs.strip_lifestage("Taxa").alias("Taxa"), "Length",
                  F.col("LengthFrequency").alias("Count")))
    return SurveyResult(dataset, ml)


# -- K6 SLS ----------------------------------------------------------------------------

def sls(t: Tables, species: DataFrame, keep: Keep = as_is) -> SurveyResult:
    """K6: Smelt Larva Survey (J6 full-outer chain, J5 calibration, A8).
    ``keep`` gets the four tables of the chain; the lengths are read twice."""
    t = ingest("sls", t)
    water = _with_columns(t["Water Info"], {"NTU": "int", "FNU": "int"}).select(
        F.to_date("Date").alias("Date"), "Station", "TopEC", "BottomEC",
        F.bround("TopTemp", 2).alias("Temp_surf"), "Secchi",
        F.col("NTU").alias("TurbidityNTU"), F.col("FNU").alias("TurbidityFNU"), F.col("Comments").alias("Notes_env"))
    water = with_salinity(water, _ec("TopEC"), "Sal_surf")
    water = with_salinity(water, _ec("BottomEC"), "Sal_bot")
    tow = _with_columns(t["Tow Info"], {"CableOut": "double", "Duration": "double"}).withColumn("Date", F.to_date("Date")).withColumn("StudyYear", F.year("Date"))
    corr = _with_columns(t["Meter Corrections"], {"Notes": "string"}).distinct().select(
        "StudyYear", F.col("MeterSerial").alias("NetMeterSerial"), "kfactor", F.col("Notes").alias("Notes_flowmeter"))
    tow = joins.lookup(tow, corr, ["StudyYear", "NetMeterSerial"])
    tow = tow.select(
        "Date", "Station", "Tow", "Survey",
        exprs.compose_datetime("Date", "Time", with_seconds=True).alias("Datetime"),
        exprs.tide("Tide").alias("Tide"), exprs.convert("BottomDepth", "ft", "m").alias("Depth"),
        (F.col("NetMeterCheck") * F.col("kfactor") * 0.37).alias("Tow_volume"),
        exprs.convert("CableOut", "ft", "m").alias("Cable_length"), F.col("Duration").alias("Tow_duration"),
        "Notes_flowmeter",
        F.col("Comments").alias("Notes_tow"))
    catch = t["Catch"].withColumn("Date", F.to_date("Date")).select("Date", "Station", "Tow", "FishCode", "Catch")
    ln = t["Lengths"].withColumn("Date", F.to_date("Date"))
    ln = keep(expand.length_frequency(ln, ["Date", "Station", "Tow", "FishCode"], "Length"))
    ln = windows.total_over(ln, ["Date", "Station", "Tow", "FishCode"], "LengthFrequency", "TotalLengthMeasured")
    d = joins.full_outer_chain([(keep(water), []), (keep(tow), ["Date", "Station"]), (keep(catch), ["Date", "Station", "Tow"]),
                                (ln, ["Date", "Station", "Tow", "FishCode"])])
    d = joins.to_taxa(d, species, "FishCode", "SLS_Code")
    d = joins.lookup(d, t["SLS Stations"], ["Station"])
    d = d.withColumn("Notes_tow", exprs.merge_notes("Notes_tow", "Notes_env"))
    count = F.when(F.col("Length").isNull(), F.col("Catch").cast("double")).otherwise(
        F.try_divide(F.col("LengthFrequency"), F.col("TotalLengthMeasured")) * F.col("Catch"))
    d = (d.withColumn("Source", F.lit("SLS")).withColumn("Method", F.lit("Oblique tow"))
         .withColumn("SampleID", exprs.sample_id(F.lit("SLS"), "Date", "Station", "Tow"))
         .withColumn("Station", F.col("Station").cast("string"))
         .withColumn("Count", count)
         .withColumn("Length_NA_flag", F.when(F.col("Count").isNull(), F.lit(NO_FISH))
                     .when(F.col("Length").isNull() & (F.col("Count") > 0), F.lit(UNKNOWN_LENGTH)))
         .withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag")))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth",
            "SampleID", "Method", "Tide", "Sal_surf", "Sal_bot", "Temp_surf", "Secchi",
            "TurbidityNTU", "TurbidityFNU", "Tow_volume", "Cable_length", "Tow_duration", "Taxa", "Length", "Count",
            "Length_NA_flag", "Notes_tow", "Notes_flowmeter"]
    dataset = _finish(d, cols)
    ml = (d.filter(F.col("LengthFrequency").isNotNull())
          .select("SampleID", exprs.strip_lifestage("Taxa").alias("Taxa"), "Length",
                  F.col("LengthFrequency").alias("Count")))
    return SurveyResult(dataset, ml)


# -- K8 EDSM / K9 DJFMP: plus-count groups ---------------------------------------------

def _plus_count_groups(d: DataFrame, code: str = "OrganismCode") -> DataFrame:
    """Untagged Chinook are grouped by race, each marked fish is its own
    group (a hash of the row's natural key - never pooled), others none; fish
    without a mark code (null) are in no group."""
    mark = F.col("MarkCode")
    tag = F.concat(F.lit("Tag "), F.xxhash64(*[F.col(c) for c in d.columns]).cast("string"))
    return d.withColumn("Group", F.when((mark == "None") & (F.col(code) == "CHN"), F.col("RaceByLength"))
                        .when(mark != "None", tag))


def _either_date(c: str) -> F.Column:
    """The two exports write year-month-day and month-day-year; other text
    is null."""
    text = F.col(c).cast("string")
    # a failed parse costs an exception a row, so only text that begins as the pattern does is tried
    usual = F.when(text.rlike("^[0-9]{2}-[0-9]{2}-"), F.try_to_timestamp(text, F.lit("MM-dd-yyyy")))
    return F.coalesce(usual, text.try_cast("timestamp")).cast("date")


def edsm(t: Tables, species: DataFrame, keep: Keep = as_is) -> SurveyResult:
    """K8: Enhanced Delta Smelt Monitoring (S5 union of exports, F2, P17,
    P12, P6, A7, F9).  ``keep`` gets the rows as read, the attribute rows and
    those merged before and after the expansion, each read twice."""
    t = ingest("edsm", t)
    d = t["EDSM"]
    d = filters.drop_conditions(d, "GearConditionCode", BAD_GEAR_CONDITIONS)
    d = d.select(
        F.col("StationCode").alias("Station"), _either_date("SampleDate").alias("Date"),
        F.col("SampleTime").alias("Time"), "Tide", F.col("LongitudeStart").alias("Longitude"),
        F.col("LatitudeStart").alias("Latitude"), F.col("TowNumber").alias("Tow"),
        exprs.invalidate_effort("Volume", "FlowDebris", zero_is_null=True).alias("Tow_volume"),
        F.col("SpecificConductanceTop").alias("Conductivity"), F.col("WaterTempTop").alias("Temp_surf"),
        F.col("TurbidityTop").alias("TurbidityNTU"), exprs.convert("Secchi", "m", "cm").alias("Secchi"),
        F.col("BottomDepth").alias("Depth"), F.col("SamplingDirection").alias("Tow_direction"),
        F.col("MethodCode").alias("Method"), "OrganismCode", F.col("ForkLength").alias("Length"),
        "Count", F.coalesce("MarkCode", F.lit("None")).alias("MarkCode"), "RaceByLength")
    d = (d.withColumn("Source", F.lit("EDSM"))
         .withColumn("Datetime", exprs.compose_datetime("Date", "Time"))
         .withColumn("Conductivity", exprs.null_before("Conductivity", "Date", CONDUCTIVITY_CUTOFF)))
    d = with_salinity(d, _ec("Conductivity"), "Sal_surf")
    d = (d.withColumn("Sal_surf", clamp_salinity(F.col("Sal_surf")))
         .withColumn("Method", exprs.classify("Method", [(r"^K(D)?T(R|S\d+)", "Kodiak trawl"),
                                                         (r"^20mm$", "20mm net")]))
         .withColumn("Tow_direction", recode("Tow_direction", {"U": "Upstream", "D": "Downstream"}))
         .withColumn("Depth", F.when(F.col("Method") == "20mm net", exprs.convert("Depth", "ft", "m"))
                     .otherwise(F.col("Depth")))
         .withColumn("Tide", recode("Tide", {"HS": "High Slack", "LS": "Low Slack"}))
         .withColumn("SampleID", exprs.sample_id(F.col("Datetime"), "Station", "Tow", "Method",
                                                 "Latitude", "Longitude")))
    d = _plus_count_groups(d).drop("Time", "MarkCode", "RaceByLength")
    d, attributes = samples.split(keep(d), ["OrganismCode", "Length", "Count", "Group"], keep=keep)
    d = expand.expand_plus_count_group(d, [samples.SAMPLE, "OrganismCode", "Group"],
                                       empty_code=("OrganismCode", "NOFISH"), drop_zero_counts=True, keep=keep)
    d = keep(expand.merge_duplicates(d.drop("Group"), "Count"))
    d = filters.drop_spurious_no_fish(d, samples.SAMPLE, "Count", F.col("OrganismCode") == "NOFISH")
    d = samples.attach(d, attributes)
    d = joins.to_taxa(d, species, "OrganismCode", "USFWS_Code")
    d = (d.withColumn("SampleID", exprs.sample_id(F.lit("EDSM"), "SampleID"))
         .withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
         .filter(F.col("Method").isNotNull()))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Depth", "SampleID",
            "Method", "Tide", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi", "Tow_volume",
            "Tow_direction", "Taxa", "Length", "Count", "Length_NA_flag"]
    return SurveyResult(d.withColumn("Taxa", exprs.strip_lifestage("Taxa")).select(*cols), None)


def djfmp(t: Tables, species: DataFrame, check_species: bool = True, keep: Keep = as_is) -> SurveyResult:
    """K9: Delta Juvenile Fish Monitoring Program.  When the plan runs it
    stops on organism codes the crosswalk does not know (Q15), except the
    empty-net code.  ``keep`` gets the rows as read, the attribute rows and
    the merged ones, each read twice."""
    t = ingest("djfmp", t)
    d = t["DJFMP"]
    d = filters.drop_conditions(d, "GearConditionCode", BAD_GEAR_CONDITIONS)
    d = d.select(
        F.col("StationCode").alias("Station"), F.to_date("SampleDate").alias("Date"),
        F.col("SampleTime").alias("Time"), F.col("TowNumber"), F.col("WaterTemp").alias("Temp_surf"),
        F.col("Turbidity").alias("TurbidityNTU"), F.col("MethodCode").alias("Method"),
        exprs.invalidate_effort("Volume", "FlowDebris", ("Y",)).alias("Tow_volume"),
        F.col("SeineDepth").alias("Depth"), F.col("SamplingDirection").alias("Tow_direction"),
        F.col("ForkLength").alias("Length"), F.col("SpecificConductance").alias("Conductivity"),
        exprs.convert("Secchi", "m", "cm").alias("Secchi"), "OrganismCode", "Count",
        F.when(F.col("OrganismCode") == "NOFISH", F.lit("None")).otherwise(F.col("MarkCode")).alias("MarkCode"),
        "RaceByLength")
    d = (d.withColumn("Source", F.lit("DJFMP"))
         .withColumn("Datetime", exprs.compose_datetime("Date", "Time", midnight_is_null=True, with_seconds=True))
         .withColumn("Conductivity", exprs.null_before("Conductivity", "Date", CONDUCTIVITY_CUTOFF)))
    d = with_salinity(d, _ec("Conductivity"), "Sal_surf")
    d = (d.withColumn("Method", recode("Method", {"MWTR": "Midwater trawl", "KDTR": "Kodiak trawl",
                                                  "SEIN": "Beach seine"}))
         .withColumn("Tow_direction", recode("Tow_direction", {"U": "Upstream", "D": "Downstream", "X": "Neither"}))
         .withColumn("SampleID", exprs.sample_id(F.coalesce(F.col("Datetime").cast("string"),
                                                            F.col("Date").cast("string")),
                                                 "Station", "TowNumber", "Method")))
    d = _plus_count_groups(d).drop("Time", "MarkCode", "RaceByLength", "Conductivity")
    d, attributes = samples.split(keep(d), ["OrganismCode", "Length", "Count", "Group"], keep=keep)
    d = expand.expand_plus_count_group(d, [samples.SAMPLE, "OrganismCode", "Group"], keep=keep)
    d = joins.lookup(samples.attach(d.drop("Group"), attributes), t["DJFMP_stations"].withColumnRenamed("StationCode", "Station"),
                     ["Station"])
    d = joins.to_taxa(d, species, "OrganismCode", "USFWS_Code")
    if check_species:
        code = F.col("OrganismCode")
        d = d.withColumn("Taxa", F.when(
            F.col("Taxa").isNull() & code.isNotNull() & (code != "NOFISH"),
            F.raise_error(F.concat(F.lit("new species code, update the crosswalk: "), code))).otherwise(F.col("Taxa")))
    d = d.withColumn("SampleID", exprs.sample_id(F.lit("DJFMP"), "SampleID"))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Depth", "SampleID",
            "Method", "Sal_surf", "Temp_surf", "TurbidityNTU", "Secchi", "Tow_volume", "Tow_direction",
            "Taxa", "Length", "Count", "Length_NA_flag"]
    d = _finish(d, cols)
    no_fish = F.coalesce(F.col("Length_NA_flag") == NO_FISH, F.lit(False))
    d = (d.withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
         .withColumn("Taxa", F.when(no_fish, F.lit(None).cast("string")).otherwise(F.col("Taxa"))))
    return SurveyResult(d, None)


# -- K1 Bay Study ------------------------------------------------------------------------

def baystudy(t: Tables, species: DataFrame) -> SurveyResult:
    """K1: San Francisco Bay Study (J2 decodes, P5 tow status, P8 station
    coordinates, A3 volumetric expansion, F3 valid tows)."""
    t = ingest("baystudy", t)
    st = t["stations"].select(
        "Station", exprs.degmin_text_to_decimal("Latitude").alias("Latitude"),
        exprs.degmin_text_to_decimal("Longitude", subtract=True).alias("Longitude"))
    st = (st.filter(F.col("Station") != "211E")
          .withColumn("Station", recode("Station", {"211W": "211"})))
    bs = joins.decode(t["BoatStation"], t["TideCodes"], "Tide", "Tide", "Description", "Tidestation")
    bs = bs.select("Year", "Survey", "Station", F.to_date("Date").alias("Date"), "Depth", "Secchi", "Tidestation")
    bt = joins.decode(t["BoatTow"], t["TideCodes"], "Tide", "Tide", "Description", "Tidetow")
    method = recode("Net", BAY_METHODS, default=None)
    bt = bt.select(
        "Year", "Survey", "Station", method.alias("Method"), "Tow", "Time", "Tidetow",
        recode("Direction", TOW_DIRECTION_BAY, default=None).alias("Tow_direction"),
        F.when(method == "Midwater trawl", exprs.tow_volume("TotalMeter", 0.02687, 10.7)).alias("Tow_volume"),
        F.when(method == "Otter trawl", exprs.swept_area_distance("Distance")).alias("Tow_area"),
        exprs.tow_status("Tow").alias("Tow_status"), F.col("Duration").alias("Tow_duration"),
        F.col("TowComment").alias("Notes_tow"))
    bt = filters.keep_methods(bt, "Method", ["Midwater trawl", "Otter trawl"])
    env = joins.join(bt, bs, ["Year", "Survey", "Station"], "left")
    env = (env.withColumn("Tide", F.coalesce("Tidetow", "Tidestation"))
           .withColumn("Datetime", exprs.compose_datetime("Date", "Time"))
           .withColumn("SampleID", exprs.sample_id(F.lit("Bay Study"), "Year", "Survey", "Station", "Method", "Tow", "Time")))
    env = joins.lookup(env, st, ["Station"])
    env = joins.join(env, t["SalinTemp"].select("Year", "Survey", "Station", "ECSurf", "TempSurf"),
                     ["Year", "Survey", "Station"], "left")
    keys = ["Year", "Survey", "Station", "Method", "SizeGroup", "Taxa"]
    catch = t["Fish Catch Data"].withColumn("Method", recode("Net", BAY_METHODS, default=None))
    catch = filters.keep_methods(catch, "Method", ["Midwater trawl", "Otter trawl"])
    catch = joins.to_taxa(catch, species, "AlphaCode", "Baystudy_Code").select(
        *keys, "QtsCaught", "QtsSubsampled", "PlusCount")
    ln = (t["Fish Length Data"].withColumn("Method", recode("Net", BAY_METHODS, default=None))
          .withColumn("AlphaCode", F.upper("AlphaCode")))
    ln = filters.keep_methods(ln, "Method", ["Midwater trawl", "Otter trawl"])
    ln = joins.to_taxa(ln, species, "AlphaCode", "Baystudy_Code").select(*keys, "Length", "Frequency")
    lc = expand.expand_volumetric(catch, ln, keys)
    d = joins.join(env, lc, ["Year", "Survey", "Station", "Method"], "left")
    d = with_salinity(d, _ec("ECSurf"), "Sal_surf")
    d = (d.withColumn("Source", F.lit("Bay Study")).withColumnRenamed("TempSurf", "Temp_surf")
         .withColumn("Length_NA_flag", F.when(F.col("Length").isNull(), F.lit(NO_FISH))))
    cols = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Survey", "Depth",
            "SampleID", "Method", "Tide", "Sal_surf", "Temp_surf", "Secchi", "Tow_duration", "Tow_area",
            "Tow_volume", "Tow_direction", "Notes_tow", "Tow_status", "Taxa", "Length", "Count",
            "Length_NA_flag"]
    d = _finish(d, cols)
    d = filters.valid_tows(d).drop("Tow_status")
    d = d.withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
    ml = joins.join(ln, env.select("Year", "Survey", "Station", "Method", "SampleID", "Tow_status")
                    .filter(F.col("Tow_status") == "Valid").drop("Tow_status"),
                    ["Year", "Survey", "Station", "Method"], "inner")
    ml = ml.select("SampleID", exprs.strip_lifestage("Taxa").alias("Taxa"),
                   F.col("SizeGroup").alias("Size_group"), "Length", F.col("Frequency").alias("Count"))
    return SurveyResult(d, ml)


# -- K2 Suisun ----------------------------------------------------------------------------

# Suisun method, tide words and the codes of empty trawls.
SUISUN_METHOD = ("OTR", "Otter trawl")
SUISUN_TIDES = {"flood": "Flood", "ebb": "Ebb", "low": "Low Slack", "high": "High Slack",
                "outgoing": "Ebb", "incoming": "Flood"}
NO_CATCH, NO_TRAWL = "NOCATCH", "NOTRAWL"
# Adult fish by age class.
SUISUN_ADULTS = {"Age-2+": ["Ameiurus melas", "Morone saxatilis"],
                 "Age-1+": ["Tridentiger bifasciatus", "Acanthogobius flavimanus"]}
# Record fixes - one fish more at a sample and length, a length
# known to be mistyped, a comment that cannot be read.
SUISUN_ADD_FISH = [("{8327B645-BC36-4405-ADB3-C6561718A17B}", 87.0, 1.0)]
SUISUN_MISTYPED = ("Pogonichthys macrolepidotus", 8)
SUISUN_COMMENT = ("Suisun {490F4873-8947-4352-81C9-3AA475D5FEEE}", "Gobiidae", "larval")


def _suisun_comments(t: Tables, species: DataFrame) -> DataFrame:
    """Comments of unmeasured fish that say something about size: ``Ignore``d
    ones left out, life stages harmonised (P34), missing bounds from the sizes
    at age (J9)."""
    com = _with_columns(t["comments"], {"CatchComments": "string", "Lifestage": "string", "Ignore": "int",
                                        "Month": "int"})
    com = com.filter(F.col("Ignore").isNull())
    com = com.withColumn("Lifestage", exprs.harmonise_lifestage("Lifestage", "Taxa", SUISUN_ADULTS))
    codes = species.select("Taxa", F.col("SMF_Code").alias("OrganismCode")).dropna().distinct()
    com = joins.lookup(com, codes, ["Taxa"])
    if "AgesBySizeMo" in t:
        ages = t["AgesBySizeMo"].filter(F.col("Class").isNotNull()).withColumnRenamed("Class", "Lifestage")
        com = joins.size_bounds(com, ages, ["Lifestage", "Month", "OrganismCode"])
    return com.select("SampleID", "Taxa", "Count", "CatchComments", "Min_length", "Length", "Max_length")


def suisun(t: Tables, species: DataFrame, keep: Keep = as_is) -> SurveyResult:
    """K2: Suisun Marsh otter trawls (S2, A12 mean depth, P15 swept area, P32
    record fixes, P34 and J9 sizes from life stages, J8 size groups from
    translated catch comments, A9, F9, F20).

    ``t["comments"]`` holds the translated comments of unmeasured fish:
    SampleID, Taxa, Count, Min_length, Length, Max_length (null when absent),
    and where known CatchComments, Lifestage, Month and Ignore.  A comment
    with a bound is a size group of its own, with length null if nothing of
    its taxon was measured in the sample; one with neither bound nor length
    gives fish of unknown length.  Samples without a catch row, and rows of
    trawls that were not made, are left out.  ``keep`` gets the samples, the
    catch, the comments and the rows to expand, each read several times.
    """
    t = ingest("suisun", t)
    spark = t["Sample"].sparkSession
    depth = mean_by(t["Depth"], ["SampleRowID"], "Depth")
    s = normalize_na(t["Sample"])
    s = filters.keep_methods(s, "MethodCode", [SUISUN_METHOD[0]])
    s = s.select(
        "SampleRowID", F.col("StationCode").alias("Station"), F.to_date("SampleDate").alias("Date"),
        exprs.compose_datetime(F.to_date("SampleDate"), "SampleTime").alias("Datetime"),
        F.lit(SUISUN_METHOD[1]).alias("Method"), recode("TideCode", SUISUN_TIDES).alias("Tide"),
        F.col("WaterTemperature").alias("Temp_surf"), "Secchi", "SpecificConductance", "QADone",
        exprs.sample_id(F.lit("Suisun"), exprs.braced("SampleRowID")).alias("SampleID"))
    s = keep(s)
    c = normalize_na(t["Catch"])
    c = c.withColumn("Count", F.when(F.col("OrganismCode") == NO_CATCH, F.lit(0.0)).otherwise(F.col("Count")))
    c = c.filter(F.col("OrganismCode") != NO_TRAWL)
    c = joins.to_taxa(c, species, "OrganismCode", "SMF_Code", distinct=True)
    c = joins.join(c, s.select("SampleRowID", "SampleID", "QADone"), ["SampleRowID"], "inner")
    c = joins.apply_patches(c, spark.createDataFrame(SUISUN_ADD_FISH, "SampleRowID string, StandardLength double, Count double"),
                            ["SampleRowID", "StandardLength"], ["Count"], "add")
    c = c.filter(~(~F.col("QADone") & (F.col("Taxa") == SUISUN_MISTYPED[0])
                   & (F.col("StandardLength") == SUISUN_MISTYPED[1])))
    unread = ((F.col("SampleID") == SUISUN_COMMENT[0]) & (F.col("Taxa") == SUISUN_COMMENT[1])
              & (F.col("StandardLength") == 0))
    c = c.select("SampleID", "Taxa", "Dead", "Count", F.when(F.col("Taxa").isNotNull(), F.col("StandardLength")).alias("StandardLength"),
                 F.when(unread, F.lit(SUISUN_COMMENT[2])).otherwise(F.col("CatchComments")).alias("CatchComments"))
    c = keep(c)
    # size groups: comments with a bound define groups 2, 3, ... of their sample and taxon
    key = ["SampleID", "Taxa"]
    com = keep(_suisun_comments(t, species))
    has_bound = F.col("Min_length").isNotNull() | F.col("Max_length").isNotNull()
    bounded = windows.numbered(com.filter(has_bound), ["Min_length", "Max_length", "Count", "Length", "CatchComments"],
                               key, out="SizeGroup").withColumn("SizeGroup", F.col("SizeGroup") + 1)
    measured = joins.assign_size_groups(c.filter(F.col("StandardLength") > 0), bounded, key, "StandardLength")
    known = c.filter(F.col("StandardLength") > 0).select(*key).distinct().withColumn("_known", F.lit(True))
    told = joins.join(bounded, known, key, "left").withColumn(
        "StandardLength", F.coalesce("Length", F.when(F.col("_known"), F.lit(0.0))))
    untold = com.filter(~has_bound).withColumn("SizeGroup", F.lit(1)).withColumn("StandardLength", F.col("Length"))
    cols = [*key, "StandardLength", "Count", "SizeGroup", "CatchComments", "Dead", "_flag"]
    unknown = F.when(F.col("StandardLength").isNull(), F.lit(UNKNOWN_LENGTH)).alias("_flag")
    nothing = F.when(F.col("StandardLength").isNull(), F.lit(NO_FISH)).alias("_flag")
    commented = told.select(*[x for x in cols[:6]], F.lit(None).cast("string").alias("Dead"), unknown).unionByName(
        untold.select(*cols[:6], F.lit(None).cast("string").alias("Dead"), unknown))
    commented = joins.semi(commented, s, ["SampleID"])
    plain = c.filter(F.col("StandardLength").isNull() | (F.col("StandardLength") <= 0)).withColumn("SizeGroup", F.lit(1))
    plain = (joins.anti(plain.filter(F.col("StandardLength") == 0), com, key)
             .unionByName(plain.filter(F.col("StandardLength").isNull() | (F.col("StandardLength") < 0))))
    rows = (measured.select(*cols[:7], F.lit(None).cast("string").alias("_flag"))
            .unionByName(plain.select(*cols[:7], nothing)).unionByName(commented))
    rows = keep(rows)
    ex = expand.expand_size_groups(rows, [*key, "SizeGroup"], "StandardLength", "Count")
    ex = ex.withColumn("Length_NA_flag", F.coalesce("Length_NA_flag", "_flag"))
    ex = ex.withColumn("Count", F.when((F.col("Count") != 0) & F.col("Taxa").isNotNull(), F.col("Count")))
    counted = F.col("Count").isNotNull()
    ex = ex.select("SampleID", F.when(counted, F.col("Taxa")).alias("Taxa"),
                   F.when(counted, F.col("StandardLength")).alias("Length"),
                   F.when(counted, F.col("CatchComments")).alias("Notes_catch"), "Count", "Length_NA_flag")
    s = with_salinity(s, _ec("SpecificConductance"), "Sal_surf")
    s = joins.join(s, depth, ["SampleRowID"], "left")
    s = joins.lookup(s, t["StationsLookUp"], ["Station"])
    eff = _with_columns(t["TrawlEffort"], {"TrawlComments": "string"}).select(
        "SampleRowID", F.col("TowDuration").alias("Tow_duration"),
        exprs.swept_area_duration("TowDuration").alias("Tow_area"), F.col("TrawlComments").alias("Notes_tow"))
    s = joins.join(s, eff, ["SampleRowID"], "left").withColumn("Source", F.lit("Suisun"))
    d = joins.join(ex, s, ["SampleID"], "inner")
    d = _finish(d, ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Depth", "SampleID",
                    "Method", "Tide", "Sal_surf", "Temp_surf", "Secchi", "Tow_duration", "Tow_area", "Taxa",
                    "Length", "Count", "Length_NA_flag", "Notes_catch", "Notes_tow"])
    # a sample's rows are few: a window in place of an aggregate joined back
    d = d.withColumn("_valid", F.coalesce(F.sum("Count").over(Window.partitionBy("SampleID")), F.lit(0.0)) > 0)
    d = (d.withColumn("Length_NA_flag", F.when(F.col("_valid"), F.col("Length_NA_flag")).otherwise(F.lit(NO_FISH)))
         .distinct()
         .filter(~(F.col("_valid") & F.col("Count").isNull())).drop("_valid"))
    d = d.withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
    ml = rows.filter(F.col("StandardLength") != 0).select(
        "SampleID", exprs.strip_lifestage("Taxa").alias("Taxa"), "Dead",
        F.col("StandardLength").alias("Length"), "Count")
    return SurveyResult(d, ml)


# -- K10 Salvage ----------------------------------------------------------------------------

# Facility coordinates.
FACILITY_COORDS = {"SWP": (37.825612769565474, -121.59584120116043),
                   "CVP": (37.81667106195238, -121.55857777929133)}
# Salvage pseudo-organisms (totals) and the excluded organism.
SALVAGE_TOTAL_CODES = [98, 99]
SALVAGE_EXCLUDED_CODES = [81]
SALVAGE_METHODS = ["Normal count", "Second flush"]


# Patterns marking notes of periods with no fish sampling.
NO_SAMPLING_PATTERNS = [
    r"no\s*(count|cnt|fish\s*(count|cnt|salvage))",
    r"(shut\s*down|shutdown|facilityshutdown)",
    r"down\s*for\s*(maintenance|repairs)",
    r"no\s*(pumping|water|flow|salvage|export|TFF.*salvage)",
    r"(zero|0)\s*(count|slvg|export|flow|pumping|salvage|units|bapp)",
    r"(power\s*outage|equipment\s*failure)",
    r"stopped\s*pumping\s*water",
    r"no\s+(fish\s+|10\s+(min(ute)?\.?\s+)?)?(count)",
]
# Times without sampling (station, from, to, and the count and
# volume that must be zero, if they must), one sample without, and the sample
# whose sampled minutes are imputed.
SALVAGE_EXCLUSIONS = [("CVP Federal Facility", "2021-06-11", "2021-06-16", 0.0, 0.0),
                      *(("SWP NA", day, day, None, None) for day in
                        ("2022-05-17", "2022-05-18", "2022-05-19", "2022-06-07", "2022-06-29", "2022-06-30", "2022-07-01"))]
SALVAGE_EXCLUDED_SAMPLES = ["Salvage 219623 1"]
SALVAGE_IMPUTED_SAMPLES = [29724]


def salvage(t: Tables, species: DataFrame, no_sampling_patterns=NO_SAMPLING_PATTERNS,
            exclusions: DataFrame | None = None, excluded_samples=SALVAGE_EXCLUDED_SAMPLES,
            imputed_samples=SALVAGE_IMPUTED_SAMPLES) -> SurveyResult:
    """Fish salvage at the export facilities (J6, F8, W2, A10, P19,
    F19, P22, F6, F7).

    ``exclusions`` has Station, start, end, Count_is, Tow_volume_is (null:
    any); by default the listed times.  Unmatched sides of the sample,
    building, catch and length tables have no study description and would be
    filtered out, so the chain starts from the samples.  Everything per
    sample, building label or catch is a window partitioned by the sample
    first: a sample's rows are few, and one exchange serves them all.
    """
    t = ingest("salvage", t)
    spark = t["Sample"].sparkSession
    s = t["Sample"].select("SampleRowID", "SampleDate", "SampleTime", "StudyRowID", "AcreFeet", "MinutesPumping",
                           "SampleTimeLength", "WaterTemperature", "SampleMethod", "Comments_Sample")
    s = filters.keep_methods(joins.lookup(s, t["StudiesLookUp"].select("StudyRowID", "Description"), ["StudyRowID"]),
                             "Description", SALVAGE_METHODS)
    b = joins.lookup(t["Building"].select("BuildingRowID", "SampleRowID", "BuildingCode", "Location"),
                     t["StationsLookUp"].select(F.col("FacilityCode").alias("BuildingCode"), "Comments_StationsLookUp"),
                     ["BuildingCode"]).drop("BuildingCode")
    c = t["Catch"].select("BuildingRowID", "OrganismCode", "Count", "CatchRowID")
    c = joins.to_taxa(c, species, "OrganismCode", "Salvage_Code", exclude_pattern="Age", distinct=True)
    fish = t["Length"].groupBy("CatchRowID", "ForkLength").agg(
        strict_sum("LengthFrequency").alias("LengthFrequency"), F.sum("LengthFrequency").alias("_known"))
    j = joins.join(joins.join(joins.join(s, b, ["SampleRowID"], "left"), c, ["BuildingRowID"], "left"),
                   fish, ["CatchRowID"], "left")
    j = j.withColumn("Station", exprs.facility_station("SampleMethod", "Location", "Comments_StationsLookUp"))
    j = j.withColumn("Facility", exprs.extract_facility("Station"))

    sample, building, catch = (Window.partitionBy("SampleRowID", *more) for more in ([], ["Station"], ["CatchRowID"]))
    code = F.col("OrganismCode")
    codes = F.size(F.collect_set(code).over(sample)) + F.max(F.when(code.isNull(), 1).otherwise(0)).over(sample)
    crab = F.max(F.when(code.isin(SALVAGE_EXCLUDED_CODES), 1).otherwise(0)).over(sample)
    j = j.withColumn("_codes", codes).withColumn("_crab", crab)
    total = F.coalesce(code.isin(SALVAGE_TOTAL_CODES), F.lit(False))
    j = j.filter(~(total & ((F.col("_codes") != 1) | (F.col("_crab") == 1)))
                 & ~F.coalesce(code.isin(SALVAGE_EXCLUDED_CODES), F.lit(False)))
    caught = ((F.coalesce(F.sum("_known").over(building), F.lit(0.0)) > 0)
              | (F.coalesce(F.sum("Count").over(building), F.lit(0.0)) > 0))
    j = (j.withColumn("FishCaught", caught)
         .withColumn("TotalMeasured", F.coalesce(F.sum("_known").over(catch), F.lit(0.0))))
    # fish that differ in nothing listed are added up
    listed = ["SampleRowID", "Facility", "Station", "Location", "Comments_StationsLookUp", "SampleDate", "SampleTime",
              "Description", "AcreFeet", "WaterTemperature", "CatchRowID", "Taxa", "TotalMeasured", "Count", "ForkLength",
              "MinutesPumping", "SampleTimeLength", "FishCaught", "StudyRowID", "OrganismCode", "Comments_Sample"]
    j = j.groupBy(*listed).agg(strict_sum("LengthFrequency").alias("LengthFrequency"))
    j = j.withColumn("Date", F.to_date("SampleDate"))
    # a malformed time parses to null, not an error
    local = F.concat_ws(" ", F.col("Date").cast("string"), F.substring("SampleTime", 1, 8)).try_cast("timestamp_ntz")
    fac = F.col("Comments_StationsLookUp")
    j = (j.withColumn("_dt", local).withColumn("Datetime", exprs.fix_dst_gap(F.col("_dt"))).drop("_dt")
         .withColumn("Tow_volume", exprs.convert("AcreFeet", "acre_ft", "m3"))
         .withColumn("Temp_surf", exprs.convert("WaterTemperature", "F", "C"))
         .withColumn("Temp_surf", exprs.null_if("Temp_surf", F.col("Temp_surf") < 0))
         .withColumn("Latitude", recode(fac, {k: v[0] for k, v in FACILITY_COORDS.items()}, default=None))
         .withColumn("Longitude", recode(fac, {k: v[1] for k, v in FACILITY_COORDS.items()}, default=None))
         .withColumn("Taxa", F.when(F.col("FishCaught"), F.col("Taxa")))
         .withColumn("Length", F.when(F.col("ForkLength") != 0, F.col("ForkLength"))))
    imputed = F.col("SampleRowID").isin(list(imputed_samples)) if imputed_samples else None
    j = expand.expand_time(j, imputed=imputed)
    j = j.withColumn("Length_NA_flag", F.when(~F.col("FishCaught"), F.lit(NO_FISH))
                     .when(F.col("Length").isNull() & (F.col("Count") > 0), F.lit(UNKNOWN_LENGTH)))
    j = filters.not_null(j, "Date")
    # the one unmeasured row of a catch whose other rows are measured
    unmeasured = F.col("LengthFrequency").isNull() | (F.col("LengthFrequency") == 0)
    lone = F.sum(F.when(unmeasured & F.col("Length_NA_flag").isNull(), 1).otherwise(0)).over(catch) == 1
    j = j.withColumn("_lone", lone & F.col("CatchRowID").isNotNull() & F.col("FishCaught"))
    j = j.filter(~(F.col("_lone") & unmeasured))
    number = F.dense_rank().over(Window.partitionBy("SampleRowID", "Facility").orderBy(F.col("Location").asc_nulls_last()))
    j = j.withColumn("Source", F.lit("Salvage")).withColumn("n", number).withColumn(
        "SampleID", exprs.sample_id("Source", "SampleRowID", "n"))
    ml = (j.filter(F.col("LengthFrequency").isNotNull())
          .select("SampleID", "Taxa", "Length", F.col("LengthFrequency").alias("Count")))
    d = j.select("SampleRowID", "Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "SampleID",
                 F.col("Description").alias("Method"), "Tow_volume", "Temp_surf",
                 F.col("Comments_Sample").alias("Notes_tow"), "Taxa", "Length", "Count", "Length_NA_flag")
    d = d.distinct().drop("SampleRowID")  # the id of the sample names it
    if no_sampling_patterns:
        d = filters.drop_no_sampling(d, "Notes_tow", list(no_sampling_patterns))
    if excluded_samples:
        d = d.filter(~F.col("SampleID").isin(list(excluded_samples)))
    if exclusions is None:
        exclusions = spark.createDataFrame(SALVAGE_EXCLUSIONS, "Station string, start string, end string, "
                                                               "Count_is double, Tow_volume_is double").select(
            "Station", F.to_date("start").alias("start"), F.to_date("end").alias("end"), "Count_is", "Tow_volume_is")
    return SurveyResult(joins.exclude(d, exclusions, ["Station"], "Date"), ml)


JOBS = {"Baystudy": baystudy, "Suisun": suisun, "FMWT": fmwt, "SKT": skt, "DJFMP": djfmp,
        "EDSM": edsm, "TMM": tmm, "SLS": sls, "STN": stn, "Salvage": salvage}
