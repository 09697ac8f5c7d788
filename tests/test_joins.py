import random

import pytest
from pyspark.sql import functions as F

from shoal.operators import joins
from conftest import rows


def test_to_taxa_filters_crosswalk(spark):
    species = spark.createDataFrame([(1, "Morone saxatilis (Age 0)"), (None, "x"), (2, "Age thing")],
                                    "FMWT_Code int, Taxa string")
    df = spark.createDataFrame([(1,), (2,), (3,)], "OrganismCode int")
    out = joins.to_taxa(df, species, "OrganismCode", "FMWT_Code", exclude_pattern="Age")
    # "Age 0" also matches the exclusion pattern, as the salvage run does
    assert rows(out) == [(1, None), (2, None), (3, None)]
    out = joins.to_taxa(df, species, "OrganismCode", "FMWT_Code")
    assert rows(out) == [(1, "Morone saxatilis (Age 0)"), (2, "Age thing"), (3, None)]


def test_unique_keys_reports_fanout(spark):
    species = spark.createDataFrame([(116, "a"), (116, "b"), (5, "c")], "STN_Code int, Taxa string")
    assert rows(joins.unique_keys(species, "STN_Code")) == [(116, 2)]


def test_calibrate_falls_back_to_serial_mean(spark):
    corr = spark.createDataFrame([(2020, "m1", 1.0), (2021, "m1", 3.0), (2021, "m1", 3.0), (2020, "m2", 5.0)],
                                 "Year int, Serial string, kFactor double")
    tows = spark.createDataFrame([(1, 2020, "m1"), (2, 2022, "m1"), (3, 2022, "m9")],
                                 "id int, Year int, Serial string")
    out = joins.calibrate(tows, corr, "Year", "Serial")
    assert rows(out, "id", "kFactor_final") == [(1, 1.0), (2, 2.0), (3, None)]


def test_full_outer_chain(spark):
    w = spark.createDataFrame([("d1", "s1", 10.0), ("d2", "s1", 11.0)], "Date string, Station string, Temp double")
    t = spark.createDataFrame([("d1", "s1", 1, 0.5), ("d3", "s2", 1, 0.7)],
                              "Date string, Station string, Tow int, Vol double")
    c = spark.createDataFrame([("d1", "s1", 1, "x", 3), ("d1", "s1", 2, "y", 1)],
                              "Date string, Station string, Tow int, Fish string, Catch int")
    out = joins.full_outer_chain([(w, []), (t, ["Date", "Station"]), (c, ["Date", "Station", "Tow"])])
    got = rows(out, "Date", "Station", "Tow", "Temp", "Vol", "Fish")
    assert got == [("d1", "s1", 1, 10.0, 0.5, "x"), ("d1", "s1", 2, None, None, "y"),
                   ("d2", "s1", None, 11.0, None, None), ("d3", "s2", 1, None, 0.7, None)]


def test_assign_size_groups_strict_range(spark):
    measured = spark.createDataFrame([("s", "a", 20.0), ("s", "a", 30.0), ("s", "a", 45.0), ("s", "b", 10.0)],
                                     "SampleID string, Taxa string, Length double")
    ranges = spark.createDataFrame([("s", "a", None, 30.0, 2), ("s", "a", 40.0, None, 3)],
                                   "SampleID string, Taxa string, Min_length double, Max_length double, SizeGroup int")
    out = joins.assign_size_groups(measured, ranges, ["SampleID", "Taxa"], "Length")
    assert rows(out, "Taxa", "Length", "SizeGroup") == [("a", 20.0, 2), ("a", 30.0, 1), ("a", 45.0, 3), ("b", 10.0, 1)]


def test_exclude_windows_and_days(spark):
    df = spark.createDataFrame([(1, "CVP", "2021-06-12", 0.0), (2, "CVP", "2021-06-20", 0.0),
                                (3, "SWP", "2022-05-17", 0.0), (4, "SWP", "2022-05-17", 5.0),
                                (5, "CVP", "2021-06-13", 2.0)],
                               "id int, Station string, Date string, Count double").withColumn("Date", F.to_date("Date"))
    w = spark.createDataFrame([("CVP", "2021-06-11", "2021-06-16"), ("SWP", "2022-05-17", "2022-05-17")],
                              "Station string, start string, end string") \
        .select("Station", F.to_date("start").alias("start"), F.to_date("end").alias("end"))
    out = joins.exclude(df, w, ["Station"], "Date", conditions=F.col("Count") == 0)
    assert [r.id for r in out.orderBy("id").collect()] == [2, 4, 5]


def test_apply_patches_modes(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "id int, v double")
    p = spark.createDataFrame([(2, 60.0)], "id int, v double")
    assert rows(joins.apply_patches(df, p, ["id"], ["v"], "set")) == [(1, 5.0), (2, 60.0), (3, 7.0)]
    assert rows(joins.apply_patches(df, p, ["id"], ["v"], "add")) == [(1, 5.0), (2, 66.0), (3, 7.0)]
    assert rows(joins.apply_patches(df, p, ["id"], ["v"], "drop")) == [(1, 5.0), (3, 7.0)]


def test_exclusion_windows_with_values_of_their_own(spark):
    """One window asks for a zero count and volume, the other for nothing."""
    df = spark.createDataFrame([(1, "CVP", "2021-06-12", 0.0, 0.0), (2, "CVP", "2021-06-12", 0.0, 5.0),
                                (3, "CVP", "2021-06-12", 3.0, 0.0), (4, "CVP", "2021-07-12", 0.0, 0.0),
                                (5, "SWP", "2022-05-17", 3.0, 5.0), (6, "SWP", "2022-05-16", 0.0, 0.0),
                                (7, "CVP", "2021-06-12", None, 0.0)],
                               "id int, Station string, Date string, Count double, Volume double")
    w = spark.createDataFrame([("CVP", "2021-06-11", "2021-06-16", 0.0, 0.0), ("SWP", "2022-05-17", "2022-05-17", None, None)],
                              "Station string, start string, end string, Count_is double, Volume_is double")
    assert sorted(r.id for r in joins.exclude(df, w, ["Station"], "Date").collect()) == [2, 3, 4, 6, 7]


def test_size_groups_keep_repeated_fish_and_take_the_smallest_group(spark):
    fish = spark.createDataFrame([("a", 10.0), ("a", 10.0), ("a", 40.0), ("b", 10.0), (None, 10.0)], "k string, len double")
    rng = spark.createDataFrame([("a", None, 20.0, 3), ("a", 5.0, None, 2), ("b", 20.0, None, 2), (None, None, 50.0, 4)],
                                "k string, Min_length double, Max_length double, SizeGroup int")
    out = joins.assign_size_groups(fish, rng, ["k"], "len")
    assert rows(out, "k", "len", "SizeGroup") == [(None, 10.0, 4), ("a", 10.0, 2), ("a", 10.0, 2), ("a", 40.0, 2), ("b", 10.0, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_size_groups_by_sweep(spark, seed):
    rng = random.Random(seed)
    ranges = [(rng.choice(["a", "b", None]), rng.choice([None, *range(20)]), rng.choice([None, *range(5, 25)]), g)
              for g in range(2, 60)]
    measured = [(rng.choice(["a", "b", "c", None]), rng.choice([0, 5, 7.5, 20, 99, None]) if rng.random() < 0.3
                 else rng.randint(0, 25) / 1.0, k) for k in range(300)]
    measured = [(k, None if x is None else float(x), n) for k, x, n in measured]
    ranges = [(k, *(None if x is None else float(x) for x in (lo, hi)), g) for k, lo, hi, g in ranges]
    m = spark.createDataFrame(measured, "t string, Length double, n int")
    r = spark.createDataFrame(ranges, "t string, Min_length double, Max_length double, SizeGroup int")

    def group(key, x):
        hits = [g for k, lo, hi, g in ranges if k == key and x is not None
                and (lo is None or lo < x) and (hi is None or x < hi)]
        return min(hits, default=1)
    got = {row.n: row.SizeGroup for row in joins.assign_size_groups(m, r, ["t"], "Length").collect()}
    assert got == {n: group(k, x) for k, x, n in measured}


def test_ten_thousand_ranges_on_one_key(spark):
    n = 10_000
    ranges = spark.range(n).select(F.lit("a").alias("t"), (F.col("id") / 10).alias("Min_length"),
                                   (F.col("id") / 10 + 500).alias("Max_length"), (F.col("id") + 2).cast("int").alias("SizeGroup"))
    lengths = spark.range(1, 1201).select(F.lit("a").alias("t"), F.col("id").cast("double").alias("Length"))
    swept = joins.sweep_size_groups(lengths, ranges, ["t"], "Length")
    rows = {r.Length: r.SizeGroup for r in swept.collect()}
    assert len(rows) == 1200                       # one row a length, not one a range
    assert all(g == 2 + max(0, 10 * (int(x) - 500) + 1) for x, g in rows.items())
    plan = swept._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert joins.sweep_size_groups(lengths.limit(0), ranges, ["t"], "Length").count() == 0
    assert joins.sweep_size_groups(lengths, ranges.limit(0), ["t"], "Length").count() == 0
