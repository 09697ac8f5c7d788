import random

import pytest
from pyspark.sql import functions as F

from shoal.functions.schema import UNID
from shoal.operators import quality, reshape
from shoal.plans.integrate import SALVAGE_SPELLING, crosswalk_changes, organism_names, refresh_species
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_samples_of_broken_rules(spark, tmp_path):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), rng.randint(-3, 3)) for _ in range(500)]
    rules = {"negative": lambda n: n < 0, "three": lambda n: n == 3, "never": lambda n: n > 9}
    spark.createDataFrame(data, "Source string, SampleID int, n int").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    got = quality.broken_samples(df, {k: f(F.col("n")) for k, f in rules.items()}, k=4)
    want = []
    for name, broken in rules.items():
        for source in ("a", "b", None):
            ids = [i for s, i, n in data if s == source and broken(n)]
            if ids:
                some = sorted({i for i in ids if i is not None})
                want.append((name, source, len(ids), len(set(ids)), some[:4]))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    got.collect()
    final = plan_of(got)
    assert "WindowGroupLimit" in final and "Partial" in final


def test_rules_read_the_dataset_once(spark, tmp_path):
    spark.range(1000).select(F.lit("a").alias("Source"), F.col("id").alias("SampleID")).write.parquet(str(tmp_path / "d"))
    scans = spark.sparkContext.accumulator(0)
    df = spark.read.parquet(str(tmp_path / "d")).repartition(2)
    counted = spark.createDataFrame(df.rdd.map(lambda r: (scans.add(1), r)[1]), df.schema)
    out = quality.broken_samples(counted, {"even": F.col("SampleID") % 2 == 0}, k=2).collect()
    assert [tuple(r) for r in out] == [("even", "a", 500, 500, [0, 2])] and scans.value == 1000


def test_fingerprints(spark):
    a = spark.createDataFrame([("x", k, None if k % 7 == 0 else str(k)) for k in range(200)], "g string, k int, t string")
    b = a.orderBy(F.rand(3)).repartition(5)
    fp = lambda df, **kw: rows(reshape.fingerprint(df, ["k", "t"], ["g"], **kw))
    assert fp(a) == fp(b) == fp(a.unionByName(a), distinct=True) != fp(a.unionByName(a))
    assert fp(a)[0][1] == 200
    assert fp(a) != fp(a.filter("k <> 3")) and fp(a) != fp(a.withColumn("t", F.coalesce("t", F.lit(""))))
    assert fp(a) != fp(a.withColumn("k", F.when(F.col("k") == 3, 4).when(F.col("k") == 4, 3).otherwise(F.col("k"))))
    both = reshape.same_fingerprint(reshape.fingerprint(a, ["k"], ["g"]),
                                    reshape.fingerprint(b.withColumn("g", F.lit("y")).unionByName(b), ["k"], ["g"]), ["g"])
    assert rows(both) == [("x", 200, 200, True), ("y", None, 200, False)]
    assert rows(reshape.fingerprint(a.limit(0), ["k"])) == [(0, "0-0-0")]
    plan = plan_of(reshape.fingerprint(a, ["k"], ["g"]))
    assert plan.count("Exchange") == 1 and "partial_bit_xor" in plan      # digests are shuffled, ids are not


@pytest.fixture(scope="module")
def crosswalk(spark):
    species = spark.createDataFrame([("Clupea pallasii", 3, "h"), ("Morone saxatilis", None, "b"), ("Gone fishing", 9, "g"),
                                     ("Two codes", 4, "t"), ("Same same", 8, "s")],
                                    "ScientificName string, Salvage_Code int, SKT_Code string")
    organisms = spark.createDataFrame([
        (90, "NA", "NA", "NA", "unknown"), (5, "Clupea", "pallasi", "Clupeidae", "herring"), (6, "Morone", "saxatilis", "NA", "bass"),
        (7, "NA", "NA", "Gobiidae", "goby"), (10, None, None, None, "crayfish"), (11, "Two", "codes", None, None),
        (12, "Two", "codes", None, None), (13, "Acanthogobius", "NA", None, None), (8, "Same", "same", "NA", "NA"),
        (14, "A", "one", "NA", "NA"), (14, "A", "two", "NA", "NA"), (15, "NA", "NA", "NA", "NA"), (None, "No", "code", "NA", "NA")],
        "OrganismCode int, Genus string, Species string, Family string, CommonName string")
    spelling = spark.createDataFrame(sorted(SALVAGE_SPELLING.items()), "Wrong string, Right string")
    return species, organism_names(organisms), spelling


def test_crosswalk_changes(crosswalk):
    got = {(r.ScientificName, r.Code): (r.Given, r.Old, r.Known, r.Change)
           for r in crosswalk_changes(*crosswalk, "Salvage_Code").collect()}
    assert got == {
        (UNID, 90): (None, None, False, "new"), ("Clupea pallasii", 5): ("Clupea pallasi", 3, True, "recoded"),
        ("Morone saxatilis", 6): (None, None, True, "added"), ("Gobiidae", 7): (None, None, False, "new"),
        ("crayfish", 10): (None, None, False, "new"), ("Acanthogobius", 13): (None, None, False, "new"),
        ("Two codes", 11): (None, 4, True, "clash"), ("Two codes", 12): (None, 4, True, "clash"),
        ("A one", 14): (None, None, False, "clash"), ("A two", 14): (None, None, False, "clash"),
        ("Same same", 8): (None, 8, True, "same")}


def test_crosswalk_refresh(crosswalk):
    got = {r.ScientificName: (r.Salvage_Code, r.SKT_Code) for r in refresh_species(*crosswalk, "Salvage_Code").collect()}
    assert got == {"Clupea pallasii": (5, "h"), "Morone saxatilis": (6, "b"), "Gone fishing": (9, "g"), "Two codes": (4, "t"),
                   "Same same": (8, "s"), UNID: (90, None), "Gobiidae": (7, None), "crayfish": (10, None), "Acanthogobius": (13, None)}
