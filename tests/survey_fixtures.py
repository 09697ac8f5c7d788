"""Hand-made source tables for the survey jobs (no survey data ships with
the reference).  About ten rows each, with the edge rows the jobs must
handle: empty samples, unmeasured catches, measured > caught, zero and null
lengths, duplicate lengths, meter rollover, midnight and DST times."""

from shoal.functions.exprs import taxa_label

SPECIES_SCHEMA = ("ScientificName string, Baystudy_Code string, CommonName string, USFWS_Code string, "
                  "SKT_Code string, STN_Code int, SMF_Code string, FMWT_Code int, TMM_Code int, "
                  "SLS_Code int, Salvage_Code int, Lifestage string")


def species(spark):
    rows = [
        ("Morone saxatilis", "STRBAS0", "Striped bass", "STB", "1", 1, "SB", 1, 1, 1, 3, "Age 0"),
        ("Morone saxatilis", "STRBAS1", "Striped bass", None, None, None, None, None, None, None, 4, "Age 1"),
        ("Hypomesus transpacificus", "DELSME", "Delta smelt", "DSM", "3", 3, "DS", 3, 3, 3, 20, None),
        ("Oncorhynchus tshawytscha", "CHISAL", "Chinook", "CHN", "9", 15, "CS", 9, 15, 15, 1, None),
        ("Spirinchus thaleichthys", "LONSME", "Longfin", "LFS", "2", 2, "LFS", 2, 2, 2, 2, None),
        ("Fish A", None, "A", None, None, 116, None, None, None, None, None, None),
        ("Fish B", None, "B", None, None, 116, None, None, None, None, None, None),
        ("Crab thing", None, "Crab", None, None, None, None, None, None, None, 81, None),
        ("Total fish", None, "Total", None, None, None, None, None, None, None, 98, None),
        ("UnID", None, "Unidentified", "UNID", None, None, None, None, None, None, 90, None),
    ]
    df = spark.createDataFrame(rows, SPECIES_SCHEMA)
    return df.withColumn("Taxa", taxa_label("ScientificName", "Lifestage"))


def fmwt(spark):
    return {
        "StationsLookUp": spark.createDataFrame([(5, 38.0, -122.0), (301, 38.1, -121.9), (99, None, None)],
                                                "StationCode int, DD_Latitude double, DD_Longitude double"),
        "Sample": spark.createDataFrame([
            (1, 5, "MWTR", "2020-09-10", "2020-09-10 10:15:00", 1, 18.0, 5.0, 0.5, False, 1000.0, 1200.0, 1, 1000.0, 11000.0, 100.0, 2, 20.0),
            (2, 301, "MWTR", "2020-09-11", "2020-09-11 00:00:00", 1, 17.0, 4.0, 0.6, True, 900.0, 950.0, 2, 500.0, 8000.0, 90.0, 4, 15.0),
            (3, 5, "MWTR", "2020-10-01", None, 2, 16.0, 6.0, 0.4, False, 800.0, 850.0, 3, 400.0, 400.0, 80.0, 1, 10.0),
            (4, 5, "OTHER", "2020-10-02", "2020-10-02 11:00:00", 2, 16.0, 6.0, 0.4, False, 800.0, 850.0, 3, 1.0, 2.0, 80.0, 1, 10.0)],
            "SampleRowID int, StationCode int, MethodCode string, SampleDate string, SampleTimeStart string, "
            "SurveyNumber int, WaterTemperature double, Turbidity double, Secchi double, SecchiEstimated boolean, "
            "ConductivityTop double, ConductivityBottom double, TowDirectionCode int, MeterStart double, "
            "MeterEnd double, CableOut double, TideCode int, DepthBottom double"),
        "Catch": spark.createDataFrame([(10, 1, 1, 10.0), (11, 1, 3, 4.0), (12, 3, 2, 2.0), (13, 1, None, 1.0)],
                                       "CatchRowID int, SampleRowID int, OrganismCode int, Catch double"),
        "Length": spark.createDataFrame([(10, "50", "1"), (10, "60", "3"), (10, "0", "2"), (10, "n/p", "1"),
                                         (12, "30", "1"), (12, "30", "1")],
                                        "CatchRowID int, ForkLength string, LengthFrequency string"),
    }


def skt(spark):
    return {
        "StationsSKT": spark.createDataFrame([(340, 38, 3.0, 0.0, 121, 50.0, 0.0)],
                                             "Station int, LatDeg int, LatMin double, LatSec double, LongDec int, "
                                             "LongMin double, LongSec double"),
        "tblSample": spark.createDataFrame([
            (1, "2021-01-05", 340, "01/05/2021 09:30", 1, 10.0, 4, 30.0, 40.0, 5000.0, 2, 999000.0, 1000.0, 5.0, 6.0),
            (2, "2021-01-06", 340, "01/06/2021 00:00", 1, 11.0, 1, 31.0, 41.0, 5100.0, 1, 100.0, 900.0, 5.0, 6.0)],
            "SampleRowID int, SampleDate string, Station int, SampleTimeStart string, SurveyNumber int, "
            "WaterTemperature double, TideCode int, DepthBottom double, Secchi double, ConductivityTop double, "
            "TowDirectionCode int, MeterStart double, MeterEnd double, NTU double, FNU double"),
        "tblCatch": spark.createDataFrame([(20, 1, 2, 5.0), (21, 1, 3, 2.0), (22, 2, 0, None)],
                                          "CatchRowID int, SampleRowID int, OrganismCode int, Catch double"),
        "tblFishInfo": spark.createDataFrame([(20, 40.0), (20, 40.0), (20, 50.0), (20, 0.0)],
                                             "CatchRowID int, ForkLength double"),
    }


def stn(spark):
    return {
        "Sample": spark.createDataFrame([
            (1, "2019-07-01", 1, 405, 20.0, 2000.0, 3.0, 50.0, 1, 20.0),
            (2, "2019-07-02", 1, 406, 21.0, 900000.0, 3.0, 50.0, 2, 21.0)],
            "SampleRowID int, SampleDate string, Survey int, StationCode int, TemperatureTop double, "
            "ConductivityTop double, TurbidityTop double, Secchi double, TideCode int, DepthBottom double"),
        "TowEffort": spark.createDataFrame([
            (100, 1, 1, "10:20:30", 7, 999500.0, 500.0, 60.0, 1),
            (101, 1, 2, "11:00:00", 8, None, 500.0, 60.0, 2),
            (6612, 2, 1, "12:00:00", 7, 100.0, 200.0, 60.0, 1)],
            "TowRowID int, SampleRowID int, TowNumber int, TimeStart string, MeterSerial int, MeterIn double, "
            "MeterOut double, CableOut double, TowDirection int"),
        "luStation": spark.createDataFrame([(405, 38, 5, 0.0, 121, 40, 0.0), (406, 38, 6, 0.0, 121, 41, 0.0)],
                                           "StationCode int, LatD int, LatM int, LatS double, LonD int, LonM int, LonS double"),
        "Web_Local_Meter_Corrections": spark.createDataFrame([(2019, 7, 0.03)], "StudyYear int, MeterSerial int, kFactor double"),
        "luTide": spark.createDataFrame([(1, "High Tide"), (2, "Ebb")], "TideRowID int, TideDesc string"),
        "luTowDirection": spark.createDataFrame([(1, "With Current"), (2, "Against Current")],
                                                "TowDirectionID int, TowDirection_label string"),
        "Catch": spark.createDataFrame([(1000, 100, 3, 2.0), (1001, 100, 2, 3.0), (1002, 101, 15, 0.0)],
                                       "CatchRowID int, TowRowID int, OrganismCode int, Catch double"),
        "Length": spark.createDataFrame([(1000, 30.0, 1.0), (1000, 35.0, 2.0), (1000, 0.0, 1.0)],
                                        "CatchRowID int, ForkLength double, LengthFrequency double"),
    }


def tmm(spark):
    return {
        "Survey": spark.createDataFrame([(1, "2021-03-23", 1)], "SurveyID int, SampleDate string, Survey int"),
        "Station": spark.createDataFrame([(10, 1, 610, 15.0, 3000.0, 10.0, 30.0, 2)],
                                         "StationID int, SurveyID int, Station int, Temp double, TopEC double, "
                                         "BottomDepth double, Secchi double, Tide int"),
        "Tow": spark.createDataFrame([(100, 10, 1, "09:10:00", 50.0), (101, 10, 2, "10:10:00", 50.0)],
                                     "TowID int, StationID int, TowNum int, TowTime string, CableOut double"),
        "Gear": spark.createDataFrame([(1000, 100, 2, 5, 1000.0), (1001, 101, 2, 9, 1000.0), (1002, 101, 1, 5, 1.0)],
                                      "GearID int, TowID int, GearCode int, MeterSerial int, MeterCheck double"),
        "20mmStations": spark.createDataFrame([(610, 38, 10, 0.0, 121, 30, 0.0)],
                                              "Station int, LatD int, LatM int, LatS double, LonD int, LonM int, LonS double"),
        "MeterCorrections": spark.createDataFrame([(2020, 5, 0.02), (2021, 5, 0.04), (2020, 9, 0.05)],
                                                  "StudyYear int, MeterSerial int, kFactor double"),
        "FishSample": spark.createDataFrame([(1, 1000, 3, 1.0), (2, 1000, 2, 4.0)],
                                            "FishSampleID int, GearID int, FishCode int, Catch double"),
        "FishLength": spark.createDataFrame([(1, 1, 20.0), (2, 1, 22.0), (3, 1, None)],
                                            "FishLengthID int, FishSampleID int, Length double"),
    }


def sls(spark):
    return {
        "Water Info": spark.createDataFrame([("2022-01-10", 405, 1000.0, 1100.0, 10.004, 50.0, "windy"),
                                             ("2022-01-11", 406, 900.0, 950.0, 9.0, 60.0, None)],
                                            "Date string, Station int, TopEC double, BottomEC double, TopTemp double, "
                                            "Secchi double, Comments string"),
        "Tow Info": spark.createDataFrame([("2022-01-10", 405, 1, 1, "08:00:00", 2, 20.0, 7, 1000.0, "ok"),
                                           ("2022-01-11", 406, 1, 1, "09:00:00", 3, 21.0, 8, 900.0, None)],
                                          "Date string, Station int, Tow int, Survey int, Time string, Tide int, "
                                          "BottomDepth double, NetMeterSerial int, NetMeterCheck double, Comments string"),
        "Meter Corrections": spark.createDataFrame([(2022, 7, 0.5), (2022, 7, 0.5)],
                                                   "StudyYear int, MeterSerial int, kfactor double"),
        "Catch": spark.createDataFrame([("2022-01-10", 405, 1, 2, 6.0), ("2022-01-10", 405, 1, 3, 2.0)],
                                       "Date string, Station int, Tow int, FishCode int, Catch double"),
        "Lengths": spark.createDataFrame([("2022-01-10", 405, 1, 2, 10.0), ("2022-01-10", 405, 1, 2, 10.0),
                                          ("2022-01-10", 405, 1, 2, 12.0)],
                                         "Date string, Station int, Tow int, FishCode int, Length double"),
        "SLS Stations": spark.createDataFrame([(405, 38.0, -121.8), (406, 38.1, -121.7)],
                                              "Station int, Latitude double, Longitude double"),
    }


EDSM_A = ("StationCode string, SampleDate string, SampleTime string, Tide string, LongitudeStart double, "
          "LatitudeStart double, TowNumber double, GearConditionCode int, FlowDebris string, "
          "SpecificConductanceTop double, WaterTempTop double, TurbidityTop double, Secchi double, "
          "BottomDepth double, Volume double, SamplingDirection string, MethodCode string, OrganismCode string, "
          "ForkLength double, Count double, MarkCode string, RaceByLength string")


def edsm(spark):
    from shoal.sources.io import scan_union
    kdtr = spark.createDataFrame([
        ("S1", "2020-01-05", "10:00:00", "HS", -121.5, 38.0, 1.0, 1, "N", 500.0, 10.0, 5.0, 0.5, 5.0, 100.0, "U", "KDTR", "DSM", 40.0, 1.0, None, None),
        ("S1", "2020-01-05", "10:00:00", "HS", -121.5, 38.0, 1.0, 1, "N", 500.0, 10.0, 5.0, 0.5, 5.0, 100.0, "U", "KDTR", "DSM", 0.0, 1.0, None, None),
        ("S1", "2020-01-05", "10:00:00", "HS", -121.5, 38.0, 1.0, 1, "N", 500.0, 10.0, 5.0, 0.5, 5.0, 100.0, "U", "KDTR", "CHN", 0.0, 3.0, None, "Fall"),
        ("S1", "2020-01-05", "10:00:00", "HS", -121.5, 38.0, 1.0, 1, "N", 500.0, 10.0, 5.0, 0.5, 5.0, 100.0, "U", "KDTR", "NOFISH", None, None, None, None),
        ("S2", "2020-01-06", "11:00:00", "LS", -121.6, 38.1, 1.0, None, "Y", 600.0, 11.0, 6.0, 0.6, 6.0, 120.0, "D", "KDTR", "NOFISH", None, None, None, None),
        ("S3", "2020-01-07", "12:00:00", "LS", -121.6, 38.1, 1.0, 3, "N", 600.0, 11.0, 6.0, 0.6, 6.0, 120.0, "D", "KDTR", "DSM", 30.0, 1.0, None, None)],
        EDSM_A)
    mm = spark.createDataFrame([("S4", "2019-07-01", "09:00:00", "HS", -121.7, 38.2, 1.0, 1, None, 700.0, 12.0,
                                 4.0, 0.3, 10.0, 0.0, "U", "20mm", "CHN", 35.0, 2.0, "AD", "Spring")],
                               EDSM_A.replace("BottomDepth double, ", "BottomDepth double, ").replace("Count double", "Catch double"))
    return {"EDSM": scan_union([(kdtr, {}), (mm, {"Catch": "Count"})])}


def djfmp(spark):
    rows = [("SR1", "2018-05-01", "10:00:00", 1, 15.0, 3.0, "SEIN", None, None, 1.0, "U", 50.0, 300.0, 0.4, "CHN", 1.0, "None", "Fall", None),
            ("SR1", "2018-05-01", "10:00:00", 1, 15.0, 3.0, "SEIN", None, None, 1.0, "U", 0.0, 300.0, 0.4, "CHN", 2.0, "None", "Fall", None),
            ("SR2", "2020-05-01", "00:00:00", 1, 15.0, 3.0, "KDTR", 50.0, "Y", None, "D", None, 300.0, 0.4, "NOFISH", None, None, None, None),
            ("SR3", "2020-05-02", "09:00:00", 1, 15.0, 3.0, "MWTR", 80.0, "N", None, "X", 45.0, 400.0, 0.4, "DSM", 1.0, "None", None, 4)]
    schema = ("StationCode string, SampleDate string, SampleTime string, TowNumber int, WaterTemp double, "
              "Turbidity double, MethodCode string, Volume double, FlowDebris string, SeineDepth double, "
              "SamplingDirection string, ForkLength double, SpecificConductance double, Secchi double, "
              "OrganismCode string, Count double, MarkCode string, RaceByLength string, GearConditionCode int")
    return {"DJFMP": spark.createDataFrame(rows, schema),
            "DJFMP_stations": spark.createDataFrame([("SR1", 38.5, -121.5), ("SR2", 38.4, -121.4)],
                                                    "StationCode string, Latitude double, Longitude double")}


def baystudy(spark):
    key = "Year int, Survey int, Station string"
    return {
        "stations": spark.createDataFrame([("101", "37°50.0", "-122°25.0"), ("211W", "38°1.2", "-122°10.0"),
                                           ("211E", "38°1.0", "-122°9.0")],
                                          "Station string, Latitude string, Longitude string"),
        "TideCodes": spark.createDataFrame([(1, "High Slack"), (2, "Ebb")], "Tide int, Description string"),
        "BoatStation": spark.createDataFrame([(2019, 3, "101", "2019-03-12", 10.0, 50.0, 1),
                                              (2019, 3, "211", "2019-03-13", 12.0, 60.0, 2)],
                                             key + ", Date string, Depth double, Secchi double, Tide int"),
        "BoatTow": spark.createDataFrame([(2019, 3, "101", 1, 1, "2019-03-12 09:30:00", None, 1, 10.0, 1000.0, None, "ok"),
                                          (2019, 3, "101", 2, 2, "2019-03-12 10:30:00", 2, 2, 10.0, None, 1.0, None),
                                          (2019, 3, "211", 1, 52, "2019-03-13 09:00:00", 1, 3, 10.0, 900.0, None, None),
                                          (2019, 3, "211", 3, 1, "2019-03-13 11:00:00", 1, 3, 10.0, 900.0, None, None)],
                                         key + ", Net int, Tow int, Time string, Tide int, Direction int, Duration double, "
                                         "TotalMeter double, Distance double, TowComment string"),
        "SalinTemp": spark.createDataFrame([(2019, 3, "101", 20000.0, 12.0)], key + ", ECSurf double, TempSurf double"),
        "Fish Catch Data": spark.createDataFrame([(2019, 3, "101", 1, "DELSME", 1, 4.0, 2.0, 1.0),
                                                  (2019, 3, "101", 1, "LONSME", 1, 1.0, 1.0, 0.0)],
                                                 key + ", Net int, AlphaCode string, SizeGroup int, QtsCaught double, "
                                                 "QtsSubsampled double, PlusCount double"),
        "Fish Length Data": spark.createDataFrame([(2019, 3, "101", 1, "delsme", 1, 40.0, 1.0),
                                                   (2019, 3, "101", 1, "DELSME", 1, 50.0, 2.0)],
                                                  key + ", Net int, AlphaCode string, SizeGroup int, Length double, Frequency double"),
    }


def suisun(spark):
    return {
        "Sample": spark.createDataFrame([
            ("A1", "OTR", "SU1", "2017-06-01", "08:00:00", True, 18.0, 40.0, 2000.0, "flood"),
            ("A2", "OTR", "SU2", "2017-06-02", "09:00:00", True, 19.0, 45.0, 1500.0, "NA"),
            ("A3", "BSEIN", "SU2", "2017-06-03", "09:00:00", True, 19.0, 45.0, 1500.0, "ebb"),
            ("A4", "MWTR", "SU2", "2017-06-03", "09:00:00", True, 19.0, 45.0, 1500.0, "ebb"),
            ("A5", "OTR", "SU2", "2017-06-04", "09:00:00", True, 19.0, 45.0, 1500.0, "slackish"),
            ("A6", "OTR", "SU2", "2017-06-05", "09:00:00", True, 19.0, 45.0, 1500.0, "ebb"),
            ("{B9}", "OTR", "SU2", "2017-06-06", "09:00:00", True, 19.0, 45.0, 1500.0, "ebb")],
            "SampleRowID string, MethodCode string, StationCode string, SampleDate string, SampleTime string, "
            "QADone boolean, WaterTemperature double, Secchi double, SpecificConductance double, TideCode string"),
        "Depth": spark.createDataFrame([("A1", 2.0), ("A1", 4.0)], "SampleRowID string, Depth double"),
        "StationsLookUp": spark.createDataFrame([("SU1", 38.2, -122.0), ("SU2", 38.21, -122.01)],
                                                "Station string, Latitude double, Longitude double"),
        "TrawlEffort": spark.createDataFrame([("A1", 5.0, "fine"), ("A2", 10.0, None)],
                                             "SampleRowID string, TowDuration double, TrawlComments string"),
        # A2 an empty net, A5 a trawl not made, A6 without any catch row
        "Catch": spark.createDataFrame([
            ("A1", "SB", 30.0, "N", 2.0, None), ("A1", "SB", 60.0, "Y", 1.0, None), ("A1", "SB", 0.0, "N", 3.0, "<40mm"),
            ("A1", "DS", 0.0, "N", 2.0, None), ("A2", "NOCATCH", 0.0, None, None, None),
            ("A4", "SB", 50.0, "N", 1.0, None), ("A5", "NOTRAWL", 0.0, None, 0.0, None),
            ("{B9}", "SB", 60.0, "N", 1.0, None), ("{B9}", "SB", 0.0, "N", 4.0, "YOY"),
            ("{B9}", "DS", 70.0, "N", 2.0, None), ("{B9}", "DS", 0.0, "N", 1.0, "YOY")],
            "SampleRowID string, OrganismCode string, StandardLength double, Dead string, Count double, CatchComments string"),
        # a bound; a life stage without sizes; a life stage with sizes at age
        "comments": spark.createDataFrame([
            ("Suisun {A1}", "Morone saxatilis (Age 0)", 3.0, None, None, 40.0, "<40mm", None, 6, None),
            ("Suisun {B9}", "Morone saxatilis (Age 0)", 4.0, None, None, None, "YOY", "YOY", 6, None),
            ("Suisun {B9}", "Hypomesus transpacificus", 1.0, None, None, None, "YOY", "YOY", 6, None),
            ("Suisun {B9}", "Hypomesus transpacificus", 9.0, None, None, 99.0, "with eggs", None, 6, 1)],
            "SampleID string, Taxa string, Count double, Min_length double, Length double, Max_length double, "
            "CatchComments string, Lifestage string, Month int, Ignore int"),
        "AgesBySizeMo": spark.createDataFrame([("Age-0", 6, "DS", 10.0, 80.0), (None, 6, "SB", 10.0, 80.0)],
                                              "Class string, Month int, OrganismCode string, Min double, Max double"),
    }


def salvage(spark):
    return {
        "Sample": spark.createDataFrame([
            (1, "2021-03-14", "02:00:00.0000000", "0000", 10.0, 60.0, 10.0, 50.0, 1, "fine"),
            (2, "2021-03-15", "10:00:00.0000000", "0000", 5.0, 0.0, 10.0, 50.0, 2, "Shut Down"),
            (3, "2021-03-16", "11:00:00.0000000", "9999", 5.0, 30.0, 10.0, 20.0, 1, None),
            (4, "2021-03-17", "12:00:00.0000000", "0000", 5.0, 30.0, 10.0, 50.0, 1, None)],
            "SampleRowID int, SampleDate string, SampleTime string, StudyRowID string, AcreFeet double, "
            "MinutesPumping double, SampleTimeLength double, WaterTemperature double, SampleMethod int, "
            "Comments_Sample string"),
        "Building": spark.createDataFrame([(11, 1, 1, "NA"), (12, 1, 1, "B2"), (21, 2, 2, None), (31, 3, 1, "NA"),
                                           (41, 4, 1, "NA")],
                                          "BuildingRowID int, SampleRowID int, BuildingCode int, Location string"),
        "Catch": spark.createDataFrame([(101, 11, 1, 4.0), (102, 11, 98, 0.0), (201, 21, 98, 0.0), (301, 31, 20, 2.0),
                                        (401, 41, 81, 5.0), (402, 41, 99, 0.0)],
                                       "CatchRowID int, BuildingRowID int, OrganismCode int, Count double"),
        "Length": spark.createDataFrame([(1, 101, 50.0, 1.0), (2, 101, 60.0, 1.0), (3, 301, 30.0, 3.0)],
                                        "LengthRowID int, CatchRowID int, ForkLength double, LengthFrequency double"),
        "StudiesLookUp": spark.createDataFrame([("0000", "Normal count"), ("9999", "Second flush"), ("8888", "Special")],
                                               "StudyRowID string, Description string"),
        "StationsLookUp": spark.createDataFrame([(1, "SWP"), (2, "CVP")], "FacilityCode int, Comments_StationsLookUp string"),
    }
