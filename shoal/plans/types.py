"""Column types of the survey tables.

The exports land as text; ``ingest`` gives every listed column its type before
a job reads it.  Columns not listed are text, those a source lacks are skipped,
and a column that already has a type keeps it.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame

from shoal.functions.exprs import cast_cols

# The types of the columns that are not text, by survey and table.
SOURCE_TYPES: dict[str, dict[str, dict[str, list[str]]]] = {
    "fmwt": {
        "StationsLookUp": {"int": ["StationCode"], "double": ["DD_Latitude", "DD_Longitude"]},
        "Sample": {"bigint": ["SampleRowID"], "int": ["StationCode", "SurveyNumber", "TowDirectionCode", "TideCode"],
            "timestamp_ntz": ["SampleDate"], "double": ["WaterTemperature", "Turbidity", "Secchi", "ConductivityTop",
            "ConductivityBottom", "MeterStart", "MeterEnd", "CableOut", "DepthBottom"], "boolean":
            ["SecchiEstimated"]},
        "Catch": {"bigint": ["SampleRowID"], "int": ["OrganismCode"], "double": ["Catch"]},
    },
    "skt": {
        "StationsSKT": {"int": ["Station", "LatDeg", "LongDec"], "double": ["LatMin", "LatSec", "LongMin",
            "LongSec"]},
        "tblSample": {"bigint": ["SampleRowID"], "timestamp_ntz": ["SampleDate"], "int": ["Station", "SurveyNumber",
            "TideCode", "TowDirectionCode"], "double": ["WaterTemperature", "DepthBottom", "Secchi",
            "ConductivityTop", "MeterStart", "MeterEnd", "NTU", "FNU"]},
        "tblCatch": {"bigint": ["CatchRowID", "SampleRowID"], "int": ["OrganismCode"], "double": ["Catch"]},
        "tblFishInfo": {"bigint": ["CatchRowID"], "double": ["ForkLength"]},
    },
    "stn": {
        "Sample": {"bigint": ["SampleRowID", "TideCode"], "timestamp_ntz": ["SampleDate"], "int": ["Survey",
            "StationCode"], "double": ["TemperatureTop", "ConductivityTop", "TurbidityTop", "Secchi", "DepthBottom"]},
        "TowEffort": {"bigint": ["TowRowID", "SampleRowID"], "int": ["TowNumber", "MeterSerial", "TowDirection"],
            "double": ["MeterIn", "MeterOut", "CableOut"]},
        "luStation": {"int": ["StationCode", "LatD", "LatM", "LonD", "LonM"], "double": ["LatS", "LonS"]},
        "Web_Local_Meter_Corrections": {"int": ["StudyYear", "MeterSerial"], "double": ["kFactor"]},
        "luTide": {"int": ["TideRowID"]},
        "luTowDirection": {"int": ["TowDirectionID"]},
        "Catch": {"bigint": ["CatchRowID", "TowRowID"], "int": ["OrganismCode"], "double": ["Catch"]},
        "Length": {"bigint": ["CatchRowID"], "double": ["ForkLength", "LengthFrequency"]},
    },
    "tmm": {
        "Survey": {"int": ["SurveyID", "Survey"], "timestamp_ntz": ["SampleDate"]},
        "Station": {"int": ["StationID", "SurveyID", "Station", "Tide"], "double": ["Temp", "TopEC", "BottomDepth",
            "Secchi", "NTU", "FNU"]},
        "Tow": {"bigint": ["TowID"], "int": ["StationID", "TowNum"], "double": ["CableOut"]},
        "Gear": {"bigint": ["GearID", "TowID"], "int": ["GearCode", "MeterSerial"], "double": ["MeterCheck"]},
        "20mmStations": {"int": ["Station", "LatD", "LatM", "LonD", "LonM"], "double": ["LatS", "LonS"]},
        "MeterCorrections": {"int": ["StudyYear", "MeterSerial"], "double": ["kFactor"]},
        "FishSample": {"bigint": ["FishSampleID", "GearID"], "int": ["FishCode"], "double": ["Catch"]},
        "FishLength": {"bigint": ["FishSampleID"], "double": ["Length"]},
    },
    "sls": {
        "Water Info": {"date": ["Date"], "int": ["Station"], "double": ["NTU", "FNU", "TopEC", "BottomEC", "TopTemp",
            "Secchi"]},
        "Tow Info": {"date": ["Date"], "int": ["Station", "Tow", "Survey", "Tide", "NetMeterSerial"], "double":
            ["BottomDepth", "NetMeterCheck", "CableOut", "Duration"]},
        "Meter Corrections": {"int": ["StudyYear", "MeterSerial"], "double": ["kfactor"]},
        "Catch": {"date": ["Date"], "int": ["Station", "Tow", "FishCode"], "double": ["Catch"]},
        "Lengths": {"date": ["Date"], "int": ["Station", "Tow", "FishCode"], "double": ["Length"]},
        "SLS Stations": {"int": ["Station"], "double": ["Latitude", "Longitude"]},
    },
    "edsm": {
        "EDSM": {"double": ["LongitudeStart", "LatitudeStart", "TowNumber", "SpecificConductanceTop", "WaterTempTop",
            "TurbidityTop", "Secchi", "BottomDepth", "Volume", "ForkLength", "Count"], "int": ["GearConditionCode"]},
    },
    "djfmp": {
        "DJFMP": {"int": ["TowNumber", "GearConditionCode"], "double": ["WaterTemp", "Turbidity", "Volume",
            "SeineDepth", "ForkLength", "SpecificConductance", "Secchi", "Count"]},
        "DJFMP_stations": {"double": ["Latitude", "Longitude"]},
    },
    "baystudy": {
        "TideCodes": {"int": ["Tide"]},
        "BoatStation": {"int": ["Year", "Survey", "Tide"], "double": ["Depth", "Secchi"]},
        "BoatTow": {"int": ["Year", "Survey", "Net", "Tow", "Tide", "Direction"], "double": ["Duration", "TotalMeter",
            "Distance"]},
        "SalinTemp": {"int": ["Year", "Survey"], "double": ["ECSurf", "TempSurf"]},
        "Fish Catch Data": {"int": ["Year", "Survey", "Net", "SizeGroup"], "double": ["QtsCaught", "QtsSubsampled",
            "PlusCount"]},
        "Fish Length Data": {"int": ["Year", "Survey", "Net", "SizeGroup"], "double": ["Length", "Frequency"]},
    },
    "suisun": {
        "Sample": {"boolean": ["QADone"], "double": ["WaterTemperature", "Secchi", "SpecificConductance"]},
        "Depth": {"double": ["Depth"]},
        "StationsLookUp": {"double": ["Latitude", "Longitude"]},
        "TrawlEffort": {"double": ["TowDuration"]},
        "Catch": {"double": ["StandardLength", "Count"]},
        "comments": {"double": ["Count", "Min_length", "Length", "Max_length"], "int": ["Month", "Ignore"]},
        "AgesBySizeMo": {"int": ["Month"], "double": ["Min", "Max"]},
    },
    "salvage": {
        "Sample": {"bigint": ["SampleRowID"], "timestamp_ntz": ["SampleDate"], "double": ["AcreFeet",
            "MinutesPumping", "SampleTimeLength", "WaterTemperature"], "int": ["SampleMethod"]},
        "Building": {"bigint": ["BuildingRowID", "SampleRowID"], "int": ["BuildingCode"]},
        "Catch": {"bigint": ["BuildingRowID", "CatchRowID"], "int": ["OrganismCode"], "double": ["Count"]},
        "Length": {"bigint": ["CatchRowID"], "int": ["LengthRowID"], "boolean": ["AdiposeClip"], "double":
            ["ForkLength", "LengthFrequency"]},
        "StationsLookUp": {"int": ["FacilityCode"]},
    },
}


def ingest(survey: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of a survey with the listed columns cast where they are text;
    what cannot be read is null."""
    out = {}
    for name, df in tables.items():
        kinds, text = SOURCE_TYPES[survey].get(name, {}), {c for c, t in df.dtypes if t == "string"}
        asked = {kind: [c for c in cols if c in text] for kind, cols in kinds.items()}
        out[name] = cast_cols(df, asked) if any(asked.values()) else df
    return out
