import pytest
from pyspark.sql import functions as F

from shoal.operators import analyze, windows
from conftest import rows


def test_total_over_and_count_over(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "k string, v double")
    assert rows(windows.total_over(df, ["k"], "v", "t"), "k", "v", "t") == [
        ("a", None, 1.0), ("a", 1.0, 1.0), ("b", 2.0, 2.0)]
    assert rows(windows.total_over(df, ["k"], "v", "t", strict=True), "k", "t") == [
        ("a", None), ("a", None), ("b", 2.0)]
    assert rows(windows.count_over(df, ["k"]), "k", "n") == [("a", 2), ("a", 2), ("b", 1)]


def test_sample_has_catch(spark):
    df = spark.createDataFrame([("s1", 0.0), ("s1", None), ("s2", 3.0)], "SampleID string, Count double")
    got = {r.SampleID: r.FishCaught for r in windows.sample_has_catch(df, ["SampleID"], "Count").collect()}
    assert got == {"s1": False, "s2": True}


def test_daily_running_sum_preaggregates(spark):
    df = spark.createDataFrame([("SWP", "2020-01-01", 1.0), ("SWP", "2020-01-01", 2.0), ("SWP", "2020-01-03", 4.0),
                                ("CVP", "2020-01-02", 5.0)], "Facility string, Date string, v double")
    out = windows.daily_running_sum(df, ["Facility"], "Date", "v")
    assert rows(out, "Facility", "Date", "v", "cumulative") == [
        ("CVP", "2020-01-02", 5.0, 5.0), ("SWP", "2020-01-01", 3.0, 3.0), ("SWP", "2020-01-03", 4.0, 7.0)]


def test_first_per_group_and_numbered(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, o int, v string")
    assert rows(windows.first_per_group(df, ["k"], "o"), "k", "o", "v") == [("a", 1, "y"), ("b", 2, "z")]
    assert rows(windows.numbered(df, ["o"], ["k"]), "k", "o", "n") == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]


def test_summaries(spark):
    fish = spark.createDataFrame([("s1", "x", 10.0, 2.0), ("s1", "x", 20.0, 3.0), ("s2", "y", None, 0.0)],
                                 "SampleID string, Taxa string, Length double, Count double")
    assert rows(analyze.taxon_totals(fish)) == [("x", 5.0)]
    assert rows(analyze.sum_over_lengths(fish)) == [("s1", "x", 5.0), ("s2", "y", 0.0)]
    ep = analyze.extract_profile(fish).first()
    assert ep.rows == 3 and ep.fits_spreadsheet and ep.bytes_estimate == pytest.approx(3 * 0.00025 * 1048576)
    assert analyze.numeric_checksum(fish, ["Count"]).first().Count == 5.0
    assert rows(analyze.mean_by(fish, ["SampleID"], "Length")) == [("s1", 15.0), ("s2", None)]


def test_reconcile_and_cumulative(spark):
    ours = spark.createDataFrame([("x", "SWP", 10.0), ("y", "SWP", 5.0)], "Taxa string, Facility string, db double")
    theirs = spark.createDataFrame([("x", "SWP", 8.0), ("z", "CVP", 0.0)], "Taxa string, Facility string, web double")
    got = rows(analyze.reconcile(ours, theirs, ["Taxa", "Facility"], "db", "web"),
               "Taxa", "difference", "prop_difference")
    assert got == [("x", 2.0, 0.25), ("y", None, None), ("z", None, None)]
    daily = spark.createDataFrame([("SWP", "d1", 1.0, 2.0), ("SWP", "d2", 3.0, None)],
                                  "Facility string, Date string, a double, b double")
    cum = rows(analyze.cumulative_compare(daily, ["Facility"], "Date", ["a", "b"]), "series", "Date", "cumulative")
    assert cum == [("a", "d1", 1.0), ("a", "d2", 4.0), ("b", "d1", 2.0), ("b", "d2", 2.0)]


def test_salmon_loss(spark):
    df = spark.createDataFrame([("SWP", True, True, False, False, False, 100.0, 2.0, 50.0, 10.0, "0000"),
                                ("CVP", False, False, False, False, False, 100.0, 2.0, 150.0, 4.0, "9999")],
                               "Facility string, BayPump1 boolean, BayPump2 boolean, BayPump3 boolean, "
                               "BayPump4 boolean, BayPump5 boolean, PrimaryFlow double, PrimaryDepth double, "
                               "Length double, Count double, Method string")
    out = analyze.salmon_loss(df).collect()
    swp, cvp = out[0], out[1]
    assert swp.TotalWidth == 42 and cvp.TotalWidth == 84
    enc = 10.0 / (0.630 + 0.0494 * (100.0 / (2.0 * 42)))
    assert swp.Encounter == pytest.approx(enc)
    assert swp.Loss == pytest.approx(enc / 0.25 - 10.0 * 0.98)
    assert cvp.Loss == pytest.approx(4.0 * 0.569)


def test_convert_length(spark):
    df = spark.createDataFrame([("Suisun", "x", 10.0), ("FMWT", "x", 10.0), ("Suisun", "q", 7.0)],
                               "Source string, Taxa string, Length double")
    eq = spark.createDataFrame([("x", 1.0, 2.0)], "Species string, Intercept double, Slope double")
    assert rows(analyze.convert_length(df, eq), "Source", "Taxa", "Length") == [
        ("FMWT", "x", 10.0), ("Suisun", "q", 7.0), ("Suisun", "x", 21.0)]
