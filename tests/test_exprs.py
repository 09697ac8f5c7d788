import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoal.functions import exprs, salinity
from shoal.functions.schema import NO_FISH, UNKNOWN_LENGTH
from conftest import rows


@pytest.mark.parametrize("c,t,expected", [(42.914, 15.0, 35.0), (53.0649, 25.0, 35.0001),
                                          (10.0, 25.0, 5.6274), (1.0, 25.0, 0.4925), (0.0, 25.0, 0.0)])
def test_salinity_reference_points(spark, c, t, expected):
    df = spark.createDataFrame([(c,)], "c double")
    got = df.select(salinity.ec_to_salinity(F.col("c"), t).alias("s")).first().s
    assert got == pytest.approx(expected, abs=1e-4)


def test_salinity_negative_and_clamp(spark):
    df = spark.createDataFrame([(-1.0, -0.05), (None, 41.0), (1.0, 3.0)], "c double, s double")
    out = df.select(salinity.ec_to_salinity(F.col("c")).alias("x"),
                    salinity.clamp_salinity(F.col("s")).alias("y")).collect()
    assert out[0].x is None and out[0].y == 0.0 and out[1].x is None and out[1].y is None
    assert out[2].y == 3.0


def test_coordinates_and_units(spark):
    df = spark.createDataFrame([(38, 3, 36.0, "38°6", 10.0)], "d int, m int, s double, txt string, v double")
    r = df.select(exprs.dms_to_decimal("d", "m", "s").alias("lat"),
                  exprs.dms_to_decimal("d", "m", "s", west=True).alias("lon"),
                  exprs.degmin_text_to_decimal("txt").alias("t1"),
                  exprs.degmin_text_to_decimal(F.lit("-122°30"), subtract=True).alias("t2"),
                  exprs.convert("v", "ft", "m").alias("m"), exprs.convert("v", "F", "C").alias("c"),
                  exprs.convert("v", "acre_ft", "m3").alias("v3")).first()
    assert r.lat == pytest.approx(38.06) and r.lon == pytest.approx(-38.06)
    assert r.t1 == pytest.approx(38.1) and r.t2 == pytest.approx(-122.5)
    assert r.m == pytest.approx(3.048) and r.c == pytest.approx(-12.2222, abs=1e-4)
    assert r.v3 == pytest.approx(12334.8)


def test_meter_rollover_and_volume(spark):
    df = spark.createDataFrame([(999_990.0, 10.0), (100.0, 300.0), (5.0, 5.0)], "a double, b double")
    out = df.select(exprs.meter_delta("a", "b").alias("d")).collect()
    assert [r.d for r in out] == [20.0, 200.0, 0.0]
    v = df.select(exprs.tow_volume(exprs.meter_delta("a", "b"), 0.02687, 10.7, zero_is_null=True).alias("v")).collect()
    assert v[2].v is None and v[1].v == pytest.approx(200 * 0.02687 * 10.7)


def test_effort_default_and_invalidation(spark):
    df = spark.createDataFrame([(None, 1, "N"), (50.0, 6612, None), (20.0, 2, "Y"), (0.0, 3, "N")],
                               "vol double, tow int, debris string")
    out = df.select(exprs.default_effort("vol", 735.0, suspect=F.col("tow").isin(6612)).alias("d"),
                    exprs.invalidate_effort("vol", "debris", zero_is_null=True).alias("i")).collect()
    assert [r.d for r in out] == [735.0, 735.0, 20.0, 0.0]
    assert [r.i for r in out] == [None, 50.0, None, None]


def test_compose_datetime_midnight_rule(spark):
    df = spark.createDataFrame([("2020-01-02", "13:45:10"), ("2020-01-02", "00:00:00"), ("2020-01-02", None),
                                ("2020-01-02", "01/05/2020 09:30")], "d string, t string")
    out = df.select(exprs.compose_datetime(F.to_date("d"), "t", midnight_is_null=True).alias("x")).collect()
    assert out[0].x == dt.datetime(2020, 1, 2, 13, 45)
    assert out[1].x is None and out[2].x is None
    assert out[3].x == dt.datetime(2020, 1, 2, 9, 30)


def test_dst_gap_repair(spark):
    df = spark.createDataFrame([("2021-03-14 02:00:00",), ("2021-03-14 02:30:00",), ("2021-03-14 03:30:00",),
                                ("2021-11-07 01:30:00",)], "t string")
    ts = F.to_timestamp_ntz("t")
    out = df.select(exprs.fix_dst_gap(ts).cast("string").alias("x")).collect()
    assert [r.x for r in out] == ["2021-03-14 03:00:00", None, "2021-03-14 03:30:00", "2021-11-07 01:30:00"]


def test_ids_labels_flags(spark):
    df = spark.createDataFrame([("FMWT", 12, None, "Morone saxatilis", "Age 0", None, None),
                                ("STN", 3, "x", "Spirinchus thaleichthys", None, 20.0, 2.0),
                                ("SKT", 4, "y", "Hypomesus", None, None, 3.0)],
                               "src string, a int, b string, name string, stage string, L double, C double")
    out = df.select(exprs.sample_id("src", "a", "b").alias("id"),
                    exprs.taxa_label("name", "stage").alias("lab"),
                    exprs.strip_lifestage(exprs.taxa_label("name", "stage")).alias("taxa"),
                    exprs.length_flag("L", "C").alias("flag"),
                    exprs.zero_no_catch("C", exprs.length_flag("L", "C")).alias("c0")).collect()
    assert out[0].id == "FMWT 12 NA" and out[0].lab == "Morone saxatilis (Age 0)"
    assert out[0].taxa == "Morone saxatilis" and out[0].flag == NO_FISH and out[0].c0 == 0.0
    assert out[1].flag is None and out[1].c0 == 2.0
    assert out[2].flag == UNKNOWN_LENGTH


def test_codes(spark):
    df = spark.createDataFrame([(1, "KDTR", "7"), (53, "20mm", "211"), (9, "XX", None)], "c int, m string, st string")
    out = df.select(exprs.tide("c").alias("tide"), exprs.tow_status("c").alias("ts"),
                    exprs.classify("m", [(r"^K(D)?T(R|S\d+)", "Kodiak trawl"), ("^20mm$", "20mm net")]).alias("meth"),
                    exprs.pad_station("st").alias("st")).collect()
    assert [tuple(r) for r in out] == [("High Slack", "Valid", "Kodiak trawl", "007"),
                                       (None, "Invalid", "20mm net", "211"), (None, None, None, None)]


def test_size_comment_parse(spark):
    df = spark.createDataFrame([("<30mm",), (">50",), ("~40 YOY",), ("with eggs",), (None,)], "c string")
    out = df.select(exprs.parse_size_comment("c").alias("p")).select("p.*").collect()
    assert out[0].max_length and out[0].number == 30.0
    assert out[1].min_length and out[1].number == 50.0
    assert out[2].approx_length and out[2].lifestage == "YOY"
    assert out[3].ignore and out[3].number is None
    assert not out[4].ignore


def test_facility_and_notes(spark):
    df = spark.createDataFrame([(1, "Bldg 1", None, "a", None), (2, None, None, None, "b"),
                                (None, "X", "CVP", None, None)],
                               "m int, loc string, fb string, n1 string, n2 string")
    out = df.select(exprs.facility_station("m", "loc", "fb").alias("st"),
                    exprs.merge_notes("n1", "n2").alias("notes")).collect()
    assert [r.st for r in out] == ["SWP Bldg 1", "CVP Federal Facility", "CVP X"]
    assert [r.notes for r in out] == ["a", "b", None]
    ext = spark.createDataFrame([("SWP NA",), ("CVP Federal Facility",), ("Other",)], "s string") \
        .select(exprs.extract_facility("s").alias("f")).collect()
    assert [r.f for r in ext] == ["SWP", "CVP", None]


def test_long_station_codes_stay_whole(spark):
    df = spark.createDataFrame([("7",), ("71",), ("711",), ("1234",), ("1239",), (None,)], "st string")
    assert [r.st for r in df.select(exprs.pad_station("st").alias("st")).collect()] == [
        "007", "071", "711", "1234", "1239", None]


def test_braces_and_null_first_parts(spark):
    df = spark.createDataFrame([("{B9}", None), ("A1", "x")], "k string, f string")
    out = df.select(exprs.braced("k").alias("k"), exprs.sample_id("f", "k").alias("id")).collect()
    assert [tuple(r) for r in out] == [("{B9}", "NA {B9}"), ("{A1}", "x A1")]
