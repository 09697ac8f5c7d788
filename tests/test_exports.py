from shoal.operators import samples
from shoal.plans import catalog
from tests.conftest import rows
from tests.test_once import tables  # noqa: F401


def scans(df, column):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in line and column in line for line in plan.splitlines())


def test_attribute_rows_are_kept(spark):
    kept = []
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 6.0), ("b", 2, 7.0)], "SampleID string, Depth int, Count double")
    catch, attributes = samples.split(df, ["Count"], keep=lambda x: kept.append(x) or x)
    assert [k.count() for k in kept] == [2] and samples.SAMPLE in kept[0].columns
    assert rows(samples.attach(catch, attributes), "SampleID", "Depth", "Count") == rows(df)


def test_edsm_export(spark, tables):  # noqa: F811
    """Order 1 is finished and has lines, order 2 has only one of an unknown part,
    order 3 is open and has a line, order 4 has no customer."""
    export = catalog.edsm_tables(spark, tables)[0]["EDSM"]
    found = rows(export.select("MethodCode", "OrganismCode", "Volume"))
    assert found == sorted([("20mm", "CHN", "0.0"), ("20mm", "B2", "0.6"), ("20mm", "NOFISH", "0.1"),
                            ("KTS12", "NOFISH", "0.2"), ("KDTR", "B3", "0.7")])
    assert scans(export, "l_orderkey") == 4


def test_meter_corrections_come_twice_and_equal(spark, tables):  # noqa: F811
    corr = catalog.sls_tables(spark, tables)[0]["Meter Corrections"]
    assert corr.count() == 4 and corr.distinct().count() == 2
    # summed up once: two sums of the same numbers can differ in the last digit
    assert scans(corr, "l_shipdate") == 1


def test_sls_keeps_what_it_chains(spark, tables):  # noqa: F811
    from shoal.plans import surveys
    kept = []
    found = catalog.sls_tables(spark, tables)
    dataset = surveys.sls(*found, lambda df: kept.append(df) or df).dataset
    assert len(kept) == 4 and [c for c in kept[0].columns if c == "LengthFrequency"]
    assert rows(dataset, "SampleID", "Taxa", "Length", "Count") == rows(surveys.sls(*found).dataset, "SampleID", "Taxa", "Length", "Count")
