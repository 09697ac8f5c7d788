import os

import pytest
from pyspark.sql import functions as F

from shoal.plans import catalog, roles, surveys
from shoal.session import BYTES_A_PARTITION, SIZES, Stored, materialise, size_tasks
from shoal.sources.io import write_integrated
from tests.conftest import rows


@pytest.fixture
def settings(spark):
    keys = [*SIZES, "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k) for k in keys}
    yield spark.conf
    for k, v in old.items():
        spark.conf.set(k, v)


def test_tasks_stay_small_as_tables_grow(spark, settings):
    for k in SIZES:
        settings.set(k, "128m")
    settings.set("spark.sql.shuffle.partitions", "8")
    size_tasks(spark, 100 * BYTES_A_PARTITION)
    assert [settings.get(k) for k in SIZES] == [f"{v}b" for v in SIZES.values()]
    assert settings.get("spark.sql.shuffle.partitions") == "100"


def test_finer_settings_stay(spark, settings):
    for k in SIZES:
        settings.set(k, "1m")
    settings.set("spark.sql.shuffle.partitions", "8")
    size_tasks(spark, 1)
    assert [settings.get(k) for k in SIZES] == ["1m"] * len(SIZES)
    assert settings.get("spark.sql.shuffle.partitions") == "8"


def test_reading_a_role_table_sizes_tasks(spark, settings, tmp_path):
    for k in SIZES:
        settings.set(k, "128m")
    spark.range(10).write.parquet(f"{tmp_path}/orders.parquet")
    assert roles.read(spark, str(tmp_path), "orders").count() == 10
    assert [settings.get(k) for k in SIZES] == [f"{v}b" for v in SIZES.values()]


def test_kept_tables_are_compressed(spark):
    wide = spark.range(20000).select("id", *[F.lit("the same sample column").alias(f"c{k}") for k in range(20)])
    kept = materialise(wide)
    assert kept.schema.names == wide.schema.names and kept.exceptAll(wide).isEmpty() and kept.count() == 20000
    assert sum(os.path.getsize(f.removeprefix("file://")) for f in kept.inputFiles()) < 20000 * 20


@pytest.mark.parametrize("fails", [False, True])
def test_stored_tables_are_computed_once_and_go(spark, tmp_path, fails):
    reads = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(spark.sparkContext.parallelize(range(10), 2).map(lambda x: (reads.add(1), (x,))[1]), "n long")
    try:
        with Stored(str(tmp_path)) as keep:
            kept = keep(df)
            assert kept.join(kept.groupBy("n").count(), "n").count() == 10 and reads.value == 10
            assert os.listdir(tmp_path)
            if fails:
                raise ValueError
    except ValueError:
        assert fails
    assert not os.listdir(tmp_path)


def test_published_surveys_hold_no_cache(spark, tmp_path, monkeypatch):
    """The ten jobs' tables are stored, not cached: a cached plan ran in every
    shuffle partition, and twice where two stages began on it."""
    kept = []

    def job(tables, species, keep):
        kept.append(keep(tables))
        return surveys.SurveyResult(kept[-1].withColumn("Source", F.lit("a")), None)

    monkeypatch.setattr(catalog, "SURVEY_JOBS", {"edsm": (job, lambda s, d: (s.range(5), None))})
    monkeypatch.setattr(catalog, "_PUBLISHED", {})
    out = catalog._published(spark, str(tmp_path))
    assert out["edsm"].count() == 5 and not any(k.is_cached for k in kept)
    assert kept[0].inputFiles() and not any(os.path.exists(f.removeprefix("file://")) for f in kept[0].inputFiles())


def test_skt_merges_once(spark):
    plan = catalog.REGISTRY["skt_job"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Aggregate [" in line and "Tow_direction" in line and "Length_NA_flag" in line]
    assert len(wide) == 1


@pytest.mark.parametrize("text,day", [("03-04-2020", "2020-03-04"), ("2020-03-04", "2020-03-04"), ("2020-03-04 10:11:12", "2020-03-04"),
                                      ("13-40-2020", None), ("3-4-2020", None), ("x", None), (None, None)])
def test_either_date(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string").select(surveys._either_date("t").cast("string").alias("d"))
    assert rows(df) == [(day,)]


def test_both_formats_compute_a_table_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(spark.sparkContext.parallelize(range(10), 2).map(lambda x: (reads.add(1), (x, None))[1]),
                               "n long, t string")
    done = write_integrated({"survey": df}, str(tmp_path), "both")
    assert rows(done["survey"]) == [(k, None) for k in range(10)] and reads.value == 10
    back = spark.read.option("header", True).csv(f"{tmp_path}/survey_csv")
    assert rows(back) == [(str(k), "NA") for k in range(10)] and reads.value == 10
