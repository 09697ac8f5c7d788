"""Survey jobs end to end on hand-made tables, with the dataset invariants
the reference asserts on its published data (flags, zero counts)."""

import pytest
from pyspark.sql import functions as F

import survey_fixtures as fx
from shoal.functions.schema import NO_FISH, UNKNOWN_LENGTH
from shoal.operators import quality
from shoal.plans import surveys
from shoal.plans.integrate import integrate

FLAG_RULES = ["q4_empty_not_flagged", "q4_flagged_not_empty", "q4_flagged_with_taxon",
              "q5_flagged_not_unknown", "q7_flagged_not_zero", "q7_null_count"]


@pytest.fixture(scope="module")
def species(spark):
    return fx.species(spark)


def check_flags(df):
    got = {r.rule: r.violations for r in quality.quality_report(df).collect()}
    bad = {k: got[k] for k in FLAG_RULES if got.get(k)}
    assert not bad, bad


def by(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()],
                  key=lambda t: tuple((v is not None, v) for v in t))


def test_fmwt(spark, species):
    res = surveys.fmwt(fx.fmwt(spark), species)
    d = res.dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    assert got == [("FMWT 1", "Hypomesus transpacificus", None, 4.0, UNKNOWN_LENGTH),
                   ("FMWT 1", "Morone saxatilis", 50.0, 2.5, None),
                   ("FMWT 1", "Morone saxatilis", 60.0, 7.5, None),
                   ("FMWT 2", None, None, 0.0, NO_FISH),
                   ("FMWT 3", "Spirinchus thaleichthys", 30.0, 2.0, None)]
    s = {r.SampleID: r for r in d.select("SampleID", "Station", "Datetime", "Tow_volume", "Secchi").distinct().collect()}
    assert s["FMWT 2"].Station == "301" and s["FMWT 2"].Datetime is None   # midnight is unknown
    assert s["FMWT 3"].Tow_volume is None and s["FMWT 1"].Secchi == pytest.approx(50.0)
    check_flags(d)
    assert by(res.measured_lengths, "SampleID", "Length", "Count") == [
        ("FMWT 1", 50.0, 1.0), ("FMWT 1", 60.0, 3.0), ("FMWT 3", 30.0, 2.0)]


def test_skt(spark, species):
    d = surveys.skt(fx.skt(spark), species).dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    assert got[0] == ("SKT 1", "Hypomesus transpacificus", None, 2.0, UNKNOWN_LENGTH)
    assert ("SKT 1", "Spirinchus thaleichthys", 40.0, pytest.approx(10 / 3), None) in got
    assert ("SKT 2", None, None, 0.0, NO_FISH) in got
    vol = {r.SampleID: r.Tow_volume for r in d.select("SampleID", "Tow_volume").distinct().collect()}
    assert vol["SKT 1"] == pytest.approx(2000 * 0.026873027 * 13.95)      # meter rollover
    check_flags(d)


def test_stn(spark, species):
    d = surveys.stn(fx.stn(spark), species).dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    # delta smelt: 3 measured > catch 2 -> catch raised to 3; longfin unmeasured
    assert ("STN 2019-07-01 1 405 1", "Hypomesus transpacificus", 35.0, 2.0, None) in got
    assert ("STN 2019-07-01 1 405 1", "Spirinchus thaleichthys", None, 3.0, UNKNOWN_LENGTH) in got
    assert ("STN 2019-07-01 1 405 2", None, None, 0.0, NO_FISH) in got   # zero catch is no catch
    vol = {r.SampleID: r.Tow_volume for r in d.select("SampleID", "Tow_volume").distinct().collect()}
    assert vol["STN 2019-07-01 1 405 1"] == pytest.approx(0.03 * 1000 * 1.49)
    assert vol["STN 2019-07-01 1 405 2"] == 735.0 and vol["STN 2019-07-02 1 406 1"] == 735.0
    sal = {r.SampleID: r.Sal_surf for r in d.select("SampleID", "Sal_surf").distinct().collect()}
    assert sal["STN 2019-07-02 1 406 1"] is None                        # > 40 nulled
    check_flags(d)


def test_20mm(spark, species):
    d = surveys.tmm(fx.tmm(spark), species).dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    assert ("20mm 1000", "Hypomesus transpacificus", 20.0, 1.0, None) in got   # catch 1 raised to 2
    assert ("20mm 1000", "Spirinchus thaleichthys", None, 4.0, UNKNOWN_LENGTH) in got
    assert ("20mm 1001", None, None, 0.0, NO_FISH) in got
    k = {r.SampleID: r.Tow_volume for r in d.select("SampleID", "Tow_volume").distinct().collect()}
    assert k["20mm 1000"] == pytest.approx(1000 * 0.04 * 1.51)
    assert k["20mm 1001"] == pytest.approx(1000 * 0.05 * 1.51)             # serial mean fallback
    check_flags(d)


def test_sls(spark, species):
    d = surveys.sls(fx.sls(spark), species).dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    assert ("SLS 2022-01-10 405 1", "Spirinchus thaleichthys", 10.0, 4.0, None) in got
    assert ("SLS 2022-01-10 405 1", "Spirinchus thaleichthys", 12.0, 2.0, None) in got
    assert ("SLS 2022-01-10 405 1", "Hypomesus transpacificus", None, 2.0, UNKNOWN_LENGTH) in got
    assert ("SLS 2022-01-11 406 1", None, None, 0.0, NO_FISH) in got
    notes = {r.SampleID: r.Notes_tow for r in d.select("SampleID", "Notes_tow").distinct().collect()}
    assert notes["SLS 2022-01-10 405 1"] == "ok; windy"
    check_flags(d)


def test_edsm(spark, species):
    d = surveys.edsm(fx.edsm(spark), species).dataset
    got = by(d, "Station", "Taxa", "Length", "Count", "Length_NA_flag")
    assert ("S1", "Hypomesus transpacificus", 40.0, 2.0, None) in got        # 1 of 2 measured
    assert ("S1", "Oncorhynchus tshawytscha", None, 3.0, UNKNOWN_LENGTH) in got
    assert not [r for r in got if r[0] == "S1" and r[1] is None]           # spurious empty-net row dropped
    assert ("S2", None, None, 0.0, NO_FISH) in got
    assert not [r for r in got if r[0] == "S3"]                            # gear condition 3
    s4 = d.filter(F.col("Station") == "S4").first()
    assert s4.Method == "20mm net" and s4.Tow_volume is None and s4.Depth == pytest.approx(3.048)
    check_flags(d)


def test_djfmp(spark, species):
    d = surveys.djfmp(fx.djfmp(spark), species).dataset
    got = by(d, "Station", "Taxa", "Length", "Count", "Length_NA_flag")
    assert ("SR1", "Oncorhynchus tshawytscha", 50.0, 3.0, None) in got
    assert ("SR2", None, None, 0.0, NO_FISH) in got
    assert not [r for r in got if r[0] == "SR3"]
    sr1 = d.filter(F.col("Station") == "SR1").first()
    assert sr1.Sal_surf is None and sr1.Latitude == 38.5                   # conductivity before cut-off
    sr2 = d.filter(F.col("Station") == "SR2").first()
    assert sr2.Datetime is None and sr2.Tow_volume is None
    check_flags(d)


def test_djfmp_new_species_stops(spark, species):
    t = fx.djfmp(spark)
    t["DJFMP"] = t["DJFMP"].withColumn("OrganismCode", F.lit("ZZZ"))
    with pytest.raises(Exception, match="new species code"):
        surveys.djfmp(t, species).dataset.collect()


def test_baystudy(spark, species):
    res = surveys.baystudy(fx.baystudy(spark), species)
    d = res.dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    # (3 measured + 1 plus) x 4/2 = 8 caught, spread 1:2 over the lengths
    mid = next(r[0] for r in got if r[0].startswith("Bay Study 2019 3 101 Midwater trawl 1 2019-03-12"))
    assert (mid, "Hypomesus transpacificus", 40.0, pytest.approx(8 / 3), None) in got
    assert (mid, "Hypomesus transpacificus", 50.0, pytest.approx(16 / 3), None) in got
    assert [r[1:] for r in got if r[0].startswith("Bay Study 2019 3 101 Otter trawl ")] == [(None, None, 0.0, NO_FISH)]
    assert not [r for r in got if "211" in r[0]]                            # invalid tow, EL net
    coords = d.filter(F.col("SampleID") == mid).select("Latitude", "Longitude", "Tide", "Tow_volume").first()
    assert coords.Latitude == pytest.approx(37 + 50 / 60) and coords.Longitude == pytest.approx(-122 - 25 / 60)
    assert coords.Tide == "High Slack" and coords.Tow_volume == pytest.approx(1000 * 0.02687 * 10.7)
    assert res.measured_lengths.count() == 2
    check_flags(d)


def test_suisun(spark, species):
    res = surveys.suisun(fx.suisun(spark), species)
    d = res.dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag")
    # "<40mm": 3 unmeasured join the 30 mm fish in size group 2 -> 2 * 5/2
    assert ("Suisun {A1}", "Morone saxatilis", 30.0, 5.0, None) in got
    assert ("Suisun {A1}", "Morone saxatilis", 60.0, 1.0, None) in got
    assert ("Suisun {A1}", "Hypomesus transpacificus", None, 2.0, UNKNOWN_LENGTH) in got
    assert ("Suisun {A2}", None, None, 0.0, NO_FISH) in got
    # no seine, no midwater trawl, no trawl that was not made, none without a catch row
    assert {r[0] for r in got} == {"Suisun {A1}", "Suisun {A2}", "Suisun {B9}"}
    assert {r.Method for r in d.collect()} == {"Otter trawl"}
    # "YOY" fish without sizes are not spread over the 60 mm one; with sizes they join the 70 mm ones
    assert ("Suisun {B9}", "Morone saxatilis", 60.0, 1.0, None) in got
    assert ("Suisun {B9}", "Morone saxatilis", None, 4.0, UNKNOWN_LENGTH) in got
    assert ("Suisun {B9}", "Hypomesus transpacificus", 70.0, 3.0, None) in got
    assert {r.Notes_tow for r in d.filter(F.col("SampleID") == "Suisun {A1}").collect()} == {"fine"}
    assert d.filter("Length_NA_flag = 'Unknown length' and SampleID like '%B9%'").first().Notes_catch == "YOY"
    assert sorted((r.Length, r.Dead) for r in res.measured_lengths.filter("SampleID = 'Suisun {A1}'").collect()) == [
        (30.0, "N"), (60.0, "Y")]
    a1 = d.filter(F.col("SampleID") == "Suisun {A1}").first()
    assert a1.Depth == 3.0 and a1.Tow_area == pytest.approx(5 / 60 * 4000 * 4.3 * 0.7)
    check_flags(d)


def test_salvage(spark, species):
    res = surveys.salvage(fx.salvage(spark), species,
                          no_sampling_patterns=[r"(shut\s*down|shutdown)"])
    d = res.dataset
    got = by(d, "SampleID", "Taxa", "Length", "Count", "Length_NA_flag", "Datetime")
    s1 = [r for r in got if r[0].startswith("Salvage 1 ")]
    # buildings numbered by label within the sample: "B2" -> 1 (empty), "NA" -> 2;
    # pumped 60 of 10 sampled minutes: 4 fish x 1/2 per length x 6
    assert [r[:5] for r in s1] == [("Salvage 1 1", None, None, 0.0, NO_FISH),
                                   ("Salvage 1 2", "Oncorhynchus tshawytscha", 50.0, 12.0, None),
                                   ("Salvage 1 2", "Oncorhynchus tshawytscha", 60.0, 12.0, None)]
    assert str(s1[1][5]).startswith("2021-03-14 03:00")                     # DST gap repaired
    assert not [r for r in got if r[0].startswith("Salvage 2 ")]           # shut down, zero count
    assert ("Salvage 3 1", "Hypomesus transpacificus", 30.0, 3.0) in [r[:4] for r in got]  # second flush
    assert not [r for r in got if r[1] == "Crab thing"]
    lat = d.filter(F.col("SampleID").startswith("Salvage 1")).select("Latitude").first().Latitude
    assert lat == pytest.approx(37.825612769565474)


def test_integrate_end_to_end(spark, species, tmp_path):
    ds = {"FMWT": surveys.fmwt(fx.fmwt(spark), species).dataset,
          "SKT": surveys.skt(fx.skt(spark), species).dataset,
          "STN": surveys.stn(fx.stn(spark), species).dataset}
    out = integrate(ds, path=str(tmp_path / "out"), format="both", write=True)
    fish = out.fish
    assert "Source" not in fish.columns and fish.filter(F.col("Taxa").isNull()).count() == 0
    # every FMWT sample has every FMWT taxon
    fmwt_ids = [r.SampleID for r in out.survey.filter(F.col("Source") == "FMWT").collect()]
    per = {r.SampleID: r.n for r in fish.filter(F.col("SampleID").isin(fmwt_ids))
           .groupBy("SampleID").agg(F.count_distinct("Taxa").alias("n")).collect()}
    assert set(per.values()) == {3} and len(per) == 3
    assert spark.read.parquet(str(tmp_path / "out" / "fish")).count() == fish.count()
    csv = spark.read.option("header", True).csv(str(tmp_path / "out" / "survey_csv"))
    assert csv.count() == out.survey.count()
    with pytest.raises(ValueError):
        integrate(ds, format="rds")


def test_salvage_adds_up_fish_that_differ_in_their_clip(spark, species):
    """Two length rows of one length and 6 fish each, clipped and not: 12
    fish of 12 counted, pumped 60 of 10 sampled minutes."""
    t = fx.salvage(spark)
    t["Catch"] = spark.createDataFrame([(101, 11, 1, 12.0)], "CatchRowID int, BuildingRowID int, OrganismCode int, Count double")
    t["Length"] = spark.createDataFrame([(1, 101, 50.0, 6.0, True), (2, 101, 50.0, 6.0, False)],
                                        "LengthRowID int, CatchRowID int, ForkLength double, LengthFrequency double, AdiposeClip boolean")
    d = surveys.salvage(t, species).dataset.filter(F.col("Length") == 50.0)
    assert [r.Count for r in d.collect()] == [72.0]
