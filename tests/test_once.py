import glob
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from shoal.plans import catalog, roles, surveys
from shoal.plans.integrate import integrate
from shoal.session import materialise
from shoal.sources.io import publish
from tests.conftest import rows


@pytest.fixture
def tables(spark, tmp_path):
    """Role tables: three parts, two customers, four orders (one without lines,
    one without a customer) and lines, one of a part nobody knows."""
    d = str(tmp_path / "in")
    made = {
        "part": ([(1, "Brand#1"), (2, "Brand#2"), (3, "Brand#3")], "p_partkey long, p_brand string"),
        "customer": ([(1, 5, 10.0), (2, 6, -20.0)], "c_custkey long, c_nationkey int, c_acctbal double"),
        "nation": ([(5, 1), (6, 2)], "n_nationkey int, n_regionkey int"),
        "orders": ([(1, 1, "F", 100.0, "2020-01-02 00:00:00", "1-URGENT"), (2, 2, "F", 200.0, "2020-01-02 00:00:00", "2-HIGH"),
                    (3, 1, "O", 300.0, "2020-01-03 00:00:00", "3-MEDIUM"), (4, 9, "O", 400.0, "2020-01-03 00:00:00", "3-MEDIUM")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"),
        "lineitem": ([(1, 1, 1, 5.0, 50.0, 0.05, 0.0, "R", "F", "2020-02-01 00:00:00"),
                      (1, 2, 2, 6.0, 60.0, 0.01, 0.02, "A", "F", "2020-02-01 00:00:00"),
                      (3, 3, 1, 7.0, 70.0, 0.07, 0.02, "N", "O", "2020-02-01 00:00:00"),
                      (2, 8, 1, 8.0, 80.0, 0.07, 0.02, "N", "O", "2020-02-01 00:00:00")],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"),
    }
    for name, (data, schema) in made.items():
        df = spark.createDataFrame(data, schema)
        df = df.select(*[F.col(c).cast("timestamp_ntz") if c in ("o_orderdate", "l_shipdate") else F.col(c) for c in df.columns])
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def test_joins_made_once(spark, tables, tmp_path):
    lines, visits = rows(roles.lines(spark, tables)), rows(roles.visits(spark, tables))
    assert len(lines) == 3 and len(visits) == 3
    with roles.Once(spark, tables, str(tmp_path / "kept")):
        assert rows(roles.lines(spark, tables)) == lines and rows(roles.visits(spark, tables)) == visits
        files = roles.lines(spark, tables).inputFiles()
        assert roles.lines(spark, tables).inputFiles() == files and all("/kept/" in f for f in files)
        both = roles.lines(spark, tables).join(roles.visits(spark, tables).select(F.col("o_orderkey").alias("SampleID")), "SampleID")
        plan = both.groupBy("SampleID", "brand").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        # another thread takes part only where it is let in
        seen = []
        other = threading.Thread(target=lambda: seen.append(roles.lines(spark, tables).inputFiles() == files))
        other.start()
        other.join()
        assert seen == [False]
    assert not glob.glob(f"{tmp_path}/kept/*") and rows(roles.lines(spark, tables)) == lines


def test_only_columns_asked_for_are_stored(spark, tables, tmp_path):
    with roles.Once(spark, tables, str(tmp_path / "kept"), ["linenumber", "quantity"]):
        found = roles.lines(spark, tables)
        assert "price" not in found.columns and found.filter("Length = 6.0 and quantity = 6.0").count() == 1


def test_kept_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    kept = materialise(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and kept.count() == 7


def test_rows_of_a_sample_lie_together(spark, tmp_path):
    df = spark.createDataFrame([(f"s{k % 5}", "a", float(k)) for k in range(40)], "SampleID string, Source string, Count double")
    publish(df.coalesce(1), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    found = [r.SampleID for r in back.collect()]
    assert rows(back, "SampleID", "Source", "Count") == rows(df) and found == sorted(found)


def test_finished_rows_are_dealt_by_sample(spark):
    df = spark.createDataFrame([("s1", "A", 1.0, 2.0), ("s1", "A", 1.0, 3.0), (None, "A", 1.0, 1.0), (None, "A", 1.0, 4.0)],
                               "SampleID string, Taxa string, Length double, Count double")
    assert rows(surveys._finish(df, df.columns)) == [(None, "A", 1.0, 5.0), ("s1", "A", 1.0, 5.0)]
    plan = surveys._finish(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(SampleID" in plan


@pytest.mark.parametrize("most,at_once", [(-1, 1), (1 << 40, 2)])
def test_jobs_on_large_tables_take_turns(spark, tmp_path, monkeypatch, most, at_once):
    running, seen, lock = [0], [], threading.Lock()

    class Slow(catalog.Stored):
        def __call__(self, df):
            with lock:
                running[0] += 1
                seen.append(running[0])
            time.sleep(0.5)
            with lock:
                running[0] -= 1
            return df

    def job(tables, species, keep):
        return surveys.SurveyResult(keep(tables).withColumn("Source", F.lit("a")), None)

    monkeypatch.setattr(catalog, "Stored", Slow)
    monkeypatch.setattr(catalog, "SIDE_BY_SIDE", most)
    monkeypatch.setattr(catalog, "SURVEY_JOBS", {n: (job, lambda s, d: (s.range(5), None)) for n in ("edsm", "djfmp")})
    monkeypatch.setattr(catalog, "_PUBLISHED", {})
    out = catalog._published(spark, str(tmp_path))
    assert {n: df.count() for n, df in out.items()} == {"edsm": 5, "djfmp": 5} and max(seen) == at_once


def test_fill_of_kept_fish_shuffles_no_sample(spark):
    data = [("A", "s1", "x", 1.0, 2.0), ("A", "s1", "x", 1.0, 2.0), ("A", "s2", "y", None, None), ("A", None, "x", 3.0, 1.0),
            ("A", "s3", None, None, 0.0)]
    df = spark.createDataFrame(data, "Source string, SampleID string, Taxa string, Length double, Count double")
    cols = ["SampleID", "Taxa", "Length", "Count"]
    filled = integrate({"a": df}, keep=catalog._by_sample).fish
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(SampleID" not in plan and "Exchange hashpartitioning(Source#" in plan
    assert not re.search(r"Exchange hashpartitioning\([^)]*SampleID", plan)
    assert rows(filled, *cols) == rows(integrate({"a": df}).fish, *cols) and filled.count() == 8
