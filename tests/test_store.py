import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from shoal.operators import analyze, fill, reshape
from shoal.plans import roles
from shoal.plans.catalog import REGISTRY
from shoal.session import Reuse, materialise
from shoal.sources.io import QualityError, once, publish, typed
from shoal.sources.sparse import SparseStore, read_bucketed, write_sparse
from shoal.sources.versions import Versions, replace_sources
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    survey, fish = reshape.normalise([roles.dataset(spark, SF)])
    path = str(tmp_path_factory.mktemp("store") / "v1")
    write_sparse(survey, fish, path, buckets=4)
    return survey, fish, path


SLICE = dict(sources=["F", "O"], months=[1, 2, 3, 4, 5, 6], years=(1996, 2000))


@pytest.mark.parametrize("taxa", [None, ["Brand#13", "Brand#22", "nothing"], ["UnID"], ["nothing"]])
@pytest.mark.parametrize("aggregate", [False, True])
def test_slice_is_that_of_the_filled_table(spark, store, taxa, aggregate):
    survey, fish, path = store
    sv = survey.select("Source", "SampleID", "Date")
    bounds = dict(bounds={"O": (10.0, 40.0)}, default_bounds=(5.0, 45.0)) if aggregate else {}
    want = analyze.slice_query(sv, fill.integrate_fish(fish), taxa=taxa, aggregate=aggregate, **SLICE, **bounds)
    got = SparseStore(spark, path).slice(taxa=taxa, aggregate=aggregate, **SLICE, **bounds)
    cols = ["SampleID", "Source", "Date", "Taxa", "Count"] + ([] if aggregate else ["Length"])
    rounded = F.round("Count", 6).alias("Count")
    both = [rows(x.select(*[rounded if c == "Count" else c for c in cols])) for x in (want, got)]
    assert both[0] == both[1] and both[0]


def test_fill_is_the_integrated_table(spark, store):
    _, fish, path = store
    want = rows(fill.integrate_fish(fish).select("SampleID", "Taxa", "Length", "Count"))
    assert rows(SparseStore(spark, path).fill().select("SampleID", "Taxa", "Length", "Count")) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_taxa_make_three_rows_a_sample(spark, store):
    _, _, path = store
    s = SparseStore(spark, path)
    taxa = ["Brand#13", "Brand#22", "Brand#2"]
    zeros = s.samples.select("SampleID", F.explode(s.missing(taxa)).alias("Taxa"))
    most = zeros.groupBy("SampleID").count().agg(F.max("count")).first()[0]
    assert most == 3 and zeros.select("Taxa").distinct().count() == 3
    plan = plan_of(s.slice(taxa=taxa))
    # the taxa are intersected below the generator, and reach the scan of fish
    assert re.search(r"array_intersect\(.*Brand#13", plan[plan.index("Generate explode(_zeros"):])
    assert re.search(r"PushedFilters: .*In\(Taxa, \[", plan)


def test_slice_has_no_exchange(spark, store):
    _, _, path = store
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = SparseStore(spark, path).slice(taxa=["Brand#13"], aggregate=True, default_bounds=(5.0, 45.0), **SLICE)
        plan = plan_of(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # the one exchange gathers the sources' taxa, one row each
    assert {x.split(",")[0].split("- ")[-1] for x in plan.splitlines() if "Exchange" in x} == {"Exchange SinglePartition"}
    read = df.inputFiles()
    assert read and all("/taxa/" in f or "Source=F" in f or "Source=O" in f for f in read)


def test_store_is_read_by_another_session(spark, store):
    _, _, path = store
    other = spark.newSession()
    spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if t.name.startswith('shoal_')][0]}")
    again = read_bucketed(other, f"{path}/fish", 4)
    assert again.count() == spark.read.parquet(f"{path}/fish").count() > 0


def test_failed_publishing_leaves_the_old_version(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    assert v.current() == {} and v.load() == {}
    one = spark.createDataFrame([("a", 1), ("b", 2)], "Source string, n int")
    v.publish("fish", one)
    first = v.path("fish")
    with pytest.raises(Exception):
        v.publish("fish", one.withColumn("n", F.raise_error(F.lit("no")).cast("int")))
    assert v.path("fish") == first and rows(v.load(["fish"])["fish"], "Source", "n") == [("a", 1), ("b", 2)]
    v.publish("fish", one.withColumn("n", F.col("n") + 1))
    second = v.path("fish")
    v.publish("survey", one)
    assert v.path("fish") == second != first and sorted(v.load()) == ["fish", "survey"]
    assert rows(spark.read.parquet(first), "Source", "n") == [("a", 1), ("b", 2)]   # a reader of the old one goes on
    v.publish("fish", one)
    third = v.path("fish")
    assert v.drop_old("fish", keep=1) == [second, first] and v.path("fish") == third
    assert rows(v.load(["fish"])["fish"], "Source", "n") == [("a", 1), ("b", 2)]
    with pytest.raises(KeyError):
        v.load(["other"])


TEXT = [("a", "1", "2020-01-01"), ("a", "1", "2020-01-01"), ("b", "x", "2020-13-01"), ("b", None, "?"), ("b", "-3", None)]


def test_checks_come_with_the_write(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)
    text = spark.createDataFrame(spark.sparkContext.parallelize(TEXT, 2).map(lambda r: (scans.add(1), r)[1]),
                                 "Source string, n string, d string")
    df = once(typed(text, {"n": "int", "d": "date"}))
    report = publish(df, str(tmp_path / "x"), rules={"negative": F.col("n") < 0, "empty": F.col("n").isNull()})
    assert report == {"rows_in": 5, "rows_out": 3, "rows_lost": 2, "failed_n": 1, "failed_d": 2, "negative": 1, "empty": 1}
    assert scans.value == len(TEXT)          # read once, by the write
    back = spark.read.parquet(str(tmp_path / "x"))
    assert sorted(back.columns) == ["Source", "d", "n"] and back.count() == 3


def test_broken_rules_do_not_switch(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    df = spark.createDataFrame([("a", 1), ("a", -1)], "Source string, n int")
    rules = {"negative": F.col("n") < 0}
    with pytest.raises(QualityError) as e:
        v.publish("fish", df, rules=rules, allowed={"negative": 0})
    assert e.value.report["negative"] == 1 and v.current() == {}
    assert v.publish("fish", df, rules=rules, allowed={"negative": 1})["negative"] == 1 and list(v.current()) == ["fish"]
    assert v.publish("none", df.limit(0), rules=rules, allowed={"negative": 0, "rows_lost": 0})["rows_in"] == 0


def test_datasets_published_side_by_side(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    df = spark.createDataFrame([("a", 1)], "Source string, n int")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: v.publish(f"d{k % 8}", df) if k < 8 else v.load(), range(12)))
    assert sorted(v.current()) == [f"d{k}" for k in range(8)]


def test_replace_one_source(spark, tmp_path):
    path = str(tmp_path / "d")
    schema = "Source string, n int"
    replace_sources(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], schema), path)
    replace_sources(spark.createDataFrame([("b", 9), ("c", 4)], schema), path)
    assert rows(spark.read.parquet(path), "Source", "n") == [("a", 1), ("b", 9), ("c", 4)]


def test_scope_keeps_and_releases(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(spark.sparkContext.parallelize(range(10), 2).map(lambda x: (reads.add(1), (x,))[1]), "n long")
    with Reuse() as keep:
        once_kept = keep(df)
        assert once_kept.count() == 10 and once_kept.agg(F.sum("n")).first()[0] == 45
        assert reads.value == 10 and once_kept.is_cached
    assert not once_kept.is_cached
    with pytest.raises(ValueError):
        with Reuse() as keep:
            kept = keep(df)
            raise ValueError
    assert not kept.is_cached
    cut = materialise(df)
    before = reads.value
    assert cut.count() == cut.count() == 10 and reads.value == before


@pytest.mark.parametrize("name", ["suisun_job", "edsm_job", "integrity"])
def test_plans_read_their_tables_once(spark, name):
    plan = plan_of(REGISTRY[name](spark, SF))
    assert sum("Scan" in line for line in plan.splitlines()) < 25
