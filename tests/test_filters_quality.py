from pyspark.sql import functions as F

from shoal.functions.schema import NO_FISH
from shoal.operators import filters, quality, reshape
from conftest import rows


def test_drop_totals(spark):
    df = spark.createDataFrame([(1, 98), (2, 98), (2, 7), (3, 98), (3, 99), (4, 81), (4, 98), (None, 99)],
                               "s int, code int")
    out = filters.drop_totals(df, "s", "code", (98, 99), (81,))
    # 1: 98 alone kept; 2: 98 beside a real organism dropped; 3: 98+99 both dropped;
    # 4: 81 sample loses its total and (default) the 81 row itself
    assert rows(out) == [(None, 99), (1, 98), (2, 7)]
    keep81 = filters.drop_totals(df, "s", "code", (98, 99), (81,), drop_excluded_rows=False)
    assert (4, 81) in rows(keep81) and (4, 98) not in rows(keep81)


def test_drop_no_sampling(spark):
    df = spark.createDataFrame([("Shut Down", 0.0, "Normal count"), ("no count today", 0.0, "Normal count"),
                                ("shutdown", 2.0, "Normal count"), ("shutdown", 0.0, "Second flush"),
                                (None, 0.0, "Normal count"), ("fine", 0.0, "Normal count")],
                               "Notes string, Count double, Method string")
    out = filters.drop_no_sampling(df, "Notes", [r"(shut\s*down|shutdown)", r"no\s*(count|cnt)"])
    assert rows(out, "Notes") == [(None,), ("fine",), ("shutdown",), ("shutdown",)]


def test_drop_spurious_no_fish(spark):
    df = spark.createDataFrame([("a", "NOFISH", None), ("a", "x", 2.0), ("b", "NOFISH", None)],
                               "s string, code string, Count double")
    out = filters.drop_spurious_no_fish(df, "s", "Count", F.col("code") == "NOFISH")
    assert rows(out, "s", "code") == [("a", "x"), ("b", "NOFISH")]


def test_drop_partial_lengths(spark):
    df = spark.createDataFrame([(1, 10.0, None, True), (1, None, None, True), (2, None, None, True),
                                (3, 5.0, None, True), (3, 0.0, None, True), (3, None, None, True)],
                               "k int, f double, flag string, caught boolean")
    out = filters.drop_partial_lengths(df, "k", "f", "flag", "caught")
    assert rows(out, "k", "f") == [(1, 10.0), (3, None), (3, 0.0), (3, 5.0)]


def test_slice_and_windows(spark):
    df = spark.createDataFrame([("F", "2000-02-01", 10.0), ("O", "2001-07-01", None), ("P", "1999-01-01", 60.0)],
                               "Source string, Date string, Length double").withColumn("Date", F.to_date("Date"))
    assert filters.slice_filter(df, ["F", "O"], [1, 2], (1999, 2001)).count() == 1
    assert filters.slice_filter(df, None, list(range(1, 13)), None).count() == 3
    w = filters.length_window(df, {"F": (5.0, 20.0)}, (0.0, 50.0))
    assert rows(w, "Source") == [("F",), ("O",)]


def test_quality_report_counts(spark):
    df = spark.createDataFrame([
        ("FMWT", 38.0, -122.0, "Ebb", "Midwater trawl", None, None, 0.0, NO_FISH, 10.0),
        ("FMWT", 40.0, -122.0, "Storm", "Midwater trawl", "x", 10.0, 0.0, None, 0.0),
        ("Salvage", 38.0, -122.0, None, "Normal count", "x", None, 3.0, None, 0.0)],
        "Source string, Latitude double, Longitude double, Tide string, Method string, Taxa string, "
        "Length double, Count double, Length_NA_flag string, Tow_volume double")
    got = {r.rule: r.violations for r in quality.quality_report(df).collect()}
    assert got["q1_latitude_box"] == 1 and got["q3_tide_domain"] == 1
    assert got["q7_zero_not_flagged"] == 1 and got["q5_unknown_not_flagged"] == 1
    assert got["q8_zero_volume"] == 1 and got["q4_empty_not_flagged"] == 0


def test_key_checks(spark):
    a = spark.createDataFrame([("s1",), ("s1",), ("s2",)], "SampleID string")
    b = spark.createDataFrame([("s2",), ("s3",)], "SampleID string")
    assert rows(quality.duplicate_keys(a, ["SampleID"])) == [("s1", 2)]
    assert rows(quality.missing_keys(a, b, ["SampleID"])) == [("s1",)]
    assert rows(reshape.same_set(a, b, ["SampleID"])) == [(1, 1)]
    sp = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "code int, name string")
    assert rows(quality.crosswalk_duplicates(sp, ["code", "name"])) == [("code", "1", 2), ("name", "a", 2)]


def test_union_by_name_widens(spark):
    a = spark.createDataFrame([(1, "x")], "Survey int, A string")
    b = spark.createDataFrame([(2.5, 3)], "Survey double, B int")
    out = reshape.union_by_name([a, b])
    assert dict(out.dtypes)["Survey"] == "double"
    assert rows(out, "Survey", "A", "B") == [(1.0, "x", None), (2.5, None, 3)]
