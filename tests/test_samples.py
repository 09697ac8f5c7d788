import pytest
from pyspark.sql import functions as F

from shoal.operators import analyze, samples
from tests.conftest import rows

WIDE = [("s1", 1.0, "x", "a", 1), ("s1", 1.0, "x", "b", 2), ("s1", 2.0, "x", "a", 3), ("s2", None, None, "a", 4), (None, 0.0, "y", None, 5),
        (None, -0.0, "y", None, 6), ("s2", None, None, "a", 4)]
SCHEMA = "SampleID string, Depth double, Tide string, Code string, Count int"


def test_split_and_attach_give_the_rows_back(spark):
    df = spark.createDataFrame(WIDE, SCHEMA)
    catch, attributes = samples.split(df, ["Code", "Count"])
    assert catch.columns == [samples.ROW, samples.SAMPLE, "Code", "Count"] and attributes.count() == 4
    back = samples.attach(catch, attributes).select(*df.columns)
    assert rows(back) == rows(df)
    per = catch.groupBy(samples.SAMPLE).agg(F.sum("Count").alias("n"))
    assert rows(per, "n") == [(6,), (8,), (11,)]
    assert samples.attach(*samples.split(df.limit(0), ["Code", "Count"])).count() == 0


@pytest.mark.parametrize("what", ["attribute rows", "samples"])
def test_shared_keys_stop_the_job(spark, what):
    def few(*cols):  # a hash of four values, for the attributes or the sample
        narrow = len(cols) == 1 if what == "samples" else len(cols) > 1
        return F.xxhash64(*cols) % 2 if narrow else F.xxhash64(*cols)

    df = spark.createDataFrame([(f"s{k}", float(k), "x", "a", 1) for k in range(9)], SCHEMA)
    catch, attributes = samples.split(df, ["Code", "Count"], hashed=few)
    with pytest.raises(Exception, match=f"two {what} share"):
        samples.attach(catch, attributes).collect()


def test_known_differences(spark):
    compared = spark.createDataFrame([("a", 5.0, 3.0, 2.0), ("b", 5.0, 3.0, 2.0), ("c", 5.0, 3.0, 2.0), ("d", 3.0, 3.0, 0.0),
                                      ("e", 3.0, 3.0, 0.0), ("f", None, 3.0, None), (None, 1.0, 0.0, 1.0)],
                                     "k string, ours double, theirs double, difference double")
    known = spark.createDataFrame([("b", 1.5), ("b", 0.5), ("c", 1.0), ("e", 4.0), ("g", 1.0), (None, 1.0)], "k string, amount double")
    got = {r.k: (r.known, r.status) for r in analyze.explain_differences(compared, known, ["k"], "amount").collect()}
    assert got == {"a": (None, "new"), "b": (2.0, "known"), "c": (1.0, "changed"), "d": (None, "equal"), "e": (4.0, "gone"),
                   "f": (None, "new"), "g": (1.0, "gone"), None: (1.0, "known")}
