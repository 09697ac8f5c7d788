import pytest
from pyspark.sql import functions as F

from shoal.functions.schema import NO_FISH, UNKNOWN_LENGTH
from shoal.operators import expand
from conftest import rows


@pytest.fixture
def catch(spark):
    # s1/a: 10 caught, lengths measured; s1/b: caught, nothing measured;
    # s2/a: catch smaller than the number measured; s3 has no catch row.
    return spark.createDataFrame([("s1", "a", 10.0), ("s1", "b", 4.0), ("s2", "a", 1.0)],
                                 "SampleID string, Taxa string, Catch double")


@pytest.fixture
def lengths(spark):
    return spark.createDataFrame(
        [("s1", "a", 50.0, 1.0), ("s1", "a", 60.0, 3.0), ("s1", "a", 60.0, 1.0),
         ("s1", "a", 0.0, 2.0), ("s1", "a", None, 1.0), ("s2", "a", 20.0, 1.0),
         ("s2", "a", 30.0, 1.0), ("s3", "c", 40.0, 1.0)],
        "SampleID string, Taxa string, Length double, Frequency double")


def test_length_frequency_strict(spark):
    df = spark.createDataFrame([("s", 1.0, 2.0), ("s", 1.0, None), ("s", 2.0, 1.0)],
                               "k string, L double, f double")
    assert rows(expand.length_frequency(df, ["k"], "L", "f")) == [("s", 1.0, None), ("s", 2.0, 1.0)]
    assert rows(expand.length_frequency(df, ["k"], "L")) == [("s", 1.0, 2.0), ("s", 2.0, 1.0)]


def test_expand_counts_scales_to_catch(spark, catch, lengths):
    out = expand.expand_counts(catch, lengths, ["SampleID", "Taxa"])
    got = rows(out, "SampleID", "Taxa", "Length", "Count")
    # s1/a: measured 50 x1, 60 x4 (0 and null are unmeasured) -> 10 * 1/5, 10 * 4/5
    assert got == [("s1", "a", 50.0, 2.0), ("s1", "a", 60.0, 8.0), ("s1", "b", None, 4.0),
                   ("s2", "a", 20.0, 0.5), ("s2", "a", 30.0, 0.5)]
    # sum conservation per catch
    sums = {(r.SampleID, r.Taxa): r.s for r in out.groupBy("SampleID", "Taxa").agg(F.sum("Count").alias("s")).collect()}
    assert sums == {("s1", "a"): 10.0, ("s1", "b"): 4.0, ("s2", "a"): 1.0}


def test_expand_raise_catch(spark, catch, lengths):
    ln = lengths.withColumn("Length", F.when(F.col("Length") == 0, None).otherwise(F.col("Length")))
    out = expand.expand_raise_catch(catch, ln, ["SampleID", "Taxa"])
    got = rows(out, "SampleID", "Taxa", "Length", "Count", "CatchNew", "Length_NA_flag")
    # s2/a: 2 measured > catch 1 -> catch raised to 2, one fish per length
    assert ("s2", "a", 20.0, 1.0, 2.0, None) in got
    # s1/b: nothing measured -> count = catch, unknown length
    assert ("s1", "b", None, 4.0, 4.0, UNKNOWN_LENGTH) in got


def test_expand_volumetric(spark):
    catch = spark.createDataFrame([("s", "a", 2.0, 10.0, 5.0), ("s", "b", None, 1.0, 1.0)],
                                  "SampleID string, Taxa string, PlusCount double, QtsCaught double, QtsSubsampled double")
    ln = spark.createDataFrame([("s", "a", 10.0, 1.0), ("s", "a", 20.0, 1.0), ("s", "b", 5.0, 1.0)],
                               "SampleID string, Taxa string, Length double, Frequency double")
    out = expand.expand_volumetric(catch, ln, ["SampleID", "Taxa"])
    # total catch (2 + 2) * 10/5 = 8 spread over 2 measured; b loses its catch side
    assert rows(out, "Taxa", "Length", "Count") == [("a", 10.0, 4.0), ("a", 20.0, 4.0), ("b", 5.0, None)]


def test_plus_count_group_zero_measured(spark):
    df = spark.createDataFrame(
        [("s", "CHN", "fall", 0.0, 3.0),                          # nothing measured -> unknown length
         ("s", "DSM", None, 40.0, 1.0), ("s", "DSM", None, 0.0, 1.0),  # 1 measured of 2
         ("s", "DSM", None, 40.0, 1.0),                           # duplicate merged
         ("t", "NOFISH", None, None, 5.0)],
        "SampleID string, OrganismCode string, Grp string, Length double, Count double")
    out = expand.expand_plus_count_group(df, ["SampleID", "OrganismCode", "Grp"],
                                         empty_code=("OrganismCode", "NOFISH"))
    got = rows(out, "OrganismCode", "Length", "Count", "Length_NA_flag")
    assert got == [("CHN", None, 3.0, UNKNOWN_LENGTH), ("DSM", 40.0, 3.0, None),
                   ("NOFISH", None, None, NO_FISH)]


def test_expand_size_groups(spark):
    df = spark.createDataFrame(
        [("s", "a", 1, 30.0, 2.0), ("s", "a", 1, 0.0, 2.0),   # 2 measured, 2 unmeasured -> x2
         ("s", "b", 1, 0.0, 3.0)],                           # nothing measured
        "SampleID string, Taxa string, SizeGroup int, Length double, Count double")
    out = expand.expand_size_groups(df, ["SampleID", "Taxa", "SizeGroup"])
    assert rows(out, "Taxa", "Length", "Count", "Length_NA_flag") == [
        ("a", 30.0, 4.0, None), ("b", None, 3.0, UNKNOWN_LENGTH)]


def test_expand_time(spark):
    df = spark.createDataFrame(
        [(4.0, 4.0, 1.0, 60.0, 10.0, "0000", True, "SWP", 1),
         (2.0, 4.0, 1.0, 60.0, 10.0, "9999", True, "SWP", 1),
         (3.0, None, None, 0.0, 10.0, "0000", False, "SWP", 1),
         (3.0, None, None, 60.0, 10.0, "8888", True, "SWP", 1),
         (0.0, None, None, 60.0, 10.0, "0000", True, "SWP", 98)],
        "Count double, TotalMeasured double, LengthFrequency double, MinutesPumping double, "
        "SampleTimeLength double, StudyRowID string, FishCaught boolean, Station string, OrganismCode int")
    out = expand.expand_time(df)
    got = [r.Count for r in out.collect()]
    # 1/4*4 * 60/10 = 6; raised to 4 measured: 1/4*4 = 1 (second flush, unscaled);
    # no pumping and no fish -> 0; special study -> 0; total code scaled (0 count) -> 0
    assert got == [6.0, 1.0, 0.0, 0.0, 0.0]


def test_merge_duplicates_strict(spark):
    df = spark.createDataFrame([("s", "a", 1.0, 1.0), ("s", "a", 1.0, 2.0), ("s", "b", 1.0, None),
                                ("s", "b", 1.0, 1.0)], "SampleID string, Taxa string, Length double, Count double")
    assert rows(expand.merge_duplicates(df)) == [("s", "a", 1.0, 3.0), ("s", "b", 1.0, None)]
