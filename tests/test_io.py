import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoal.plans.integrate import build_species
from shoal.sources import io
from conftest import rows


def test_read_typed_csv_only_listed_columns(spark, tmp_path):
    p = tmp_path / "sample.csv"
    p.write_text("CatchRowID,ForkLength,LengthFrequency,Extra\n1,50,2,x\n2,n/p,1,y\n3,NA,,z\n4,abc,1,w\n")
    df = io.read_typed_csv(spark, str(p), {"CatchRowID": "int", "ForkLength": "double",
                                           "LengthFrequency": "double"}, na=("NA", "n/p", ""))
    assert df.columns == ["CatchRowID", "ForkLength", "LengthFrequency"]
    assert dict(df.dtypes) == {"CatchRowID": "int", "ForkLength": "double", "LengthFrequency": "double"}
    assert rows(df) == [(1, 50.0, 2.0), (2, None, 1.0), (3, None, None), (4, None, 1.0)]


def test_normalize_na_tokens(spark):
    df = spark.createDataFrame([("N/A", 1), ("", 2), ("ok", 3), ("n/p", 4)], "w string, k int")
    assert rows(io.normalize_na(df), "w", "k") == [(None, 1), (None, 2), (None, 4), ("ok", 3)]


def test_load_tables_and_registry(spark, tmp_path):
    for name in ("Sample", "Catch"):
        spark.range(3).write.parquet(str(tmp_path / name))
    t = io.load_tables(spark, str(tmp_path), ["Sample", "Catch"], available=["Sample", "Catch"])
    assert t["Catch"].count() == 3
    with pytest.raises(KeyError, match="available"):
        io.load_tables(spark, str(tmp_path), ["Length"], available=["Sample", "Catch"])
    reg = io.Registry(spark, str(tmp_path), ["Sample", "Catch"])
    assert set(reg.load()) == {"Sample", "Catch"}
    with pytest.raises(KeyError):
        reg.load(["FMWT"])


def test_write_csv_na_and_local_time(spark, tmp_path):
    df = spark.createDataFrame([("a", None, dt.datetime(2021, 3, 14, 2, 30))],
                               "id string, v double, Datetime timestamp_ntz")
    io.write_csv(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "id,v,Datetime" in text
    assert "a,NA,2021-03-14 02:30:00" in text      # nonexistent local time kept as written


def test_write_integrated_formats(spark, tmp_path):
    out = {"survey": spark.createDataFrame([(1, "x")], "SampleID int, Source string")}
    with pytest.raises(ValueError):
        io.write_integrated(out, str(tmp_path), format="rda")
    io.write_integrated(out, str(tmp_path), format="both")
    assert spark.read.parquet(str(tmp_path / "survey")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "survey_csv")).count() == 1
    assert io.write_integrated(out, str(tmp_path / "none"), write=False) is out
    assert not (tmp_path / "none").exists()


def test_publish_partitions_by_source(spark, tmp_path):
    df = spark.createDataFrame([("FMWT", 1), ("SKT", 2)], "Source string, n int")
    io.publish(df, str(tmp_path / "ds"))
    assert sorted(p.name for p in (tmp_path / "ds").iterdir() if p.is_dir()) == ["Source=FMWT", "Source=SKT"]
    back = spark.read.parquet(str(tmp_path / "ds")).filter(F.col("Source") == "SKT")
    assert back.count() == 1


def test_build_species(spark, tmp_path):
    p = tmp_path / "species.csv"
    p.write_text("ScientificName,Baystudy_Code,CommonName,USFWS_Code,SKT_Code,STN_Code,SMF_Code,FMWT_Code,"
                 "TMM_Code,SLS_Code,Salvage_Code,Lifestage,Taxa\n"
                 "Morone saxatilis,STRBAS0,Striped bass,STB,1,NA,SB,1,NA,NA,3,Age 0,x\n"
                 "Hypomesus transpacificus,DELSME,Delta smelt,DSM,3,3,DS,3,3,3,20,NA,y\n")
    sp = build_species(spark, str(p))
    got = rows(sp, "Taxa", "STN_Code", "FMWT_Code")
    assert got == [("Hypomesus transpacificus", 3, 3), ("Morone saxatilis (Age 0)", None, 1)]
    assert dict(sp.dtypes)["STN_Code"] == "int" and dict(sp.dtypes)["SKT_Code"] == "string"


def test_cut_lineage_uses_configured_folder(spark):
    from shoal.session import checkpoint_dir, cut_lineage
    assert checkpoint_dir(spark)
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90
