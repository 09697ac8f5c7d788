from pyspark.sql import functions as F

from shoal.functions import nulls
from shoal.operators import joins
from conftest import rows


def test_strict_sum_and_sum0(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0), ("c", None)],
                               "k string, v double")
    out = df.groupBy("k").agg(nulls.strict_sum("v").alias("s"), nulls.sum0("v").alias("s0"))
    assert rows(out) == [("a", None, 1.0), ("b", 5.0, 5.0), ("c", None, 0.0)]


def test_r_ifelse_null_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    out = df.select("x", nulls.r_ifelse(F.col("x") > 2, "big", "small").alias("y"),
                    nulls.r_ifelse(F.col("x") > 2, "big", "small", missing="na").alias("z"))
    assert rows(out) == [(None, None, "na"), (1, "small", "small"), (3, "big", "big")]


def test_in_list_never_null(spark):
    df = spark.createDataFrame([(98,), (None,), (5,)], "c int")
    out = df.filter(nulls.not_in("c", [98, 99]))
    assert rows(out) == [(None,), (5,)]


def test_recode_defaults(spark):
    df = spark.createDataFrame([(1,), (2,), (7,), (None,)], "c int")
    out = df.select(nulls.recode("c", {1: "High Slack", 2: "Ebb"}, default=None).alias("a"),
                    nulls.recode(F.col("c").cast("string"), {"1": "one"}).alias("b"))
    assert rows(out) == [(None, None), (None, "7"), ("Ebb", "2"), ("High Slack", "one")]


def test_grepl_null_is_false(spark):
    df = spark.createDataFrame([("Shut Down",), (None,), ("fine",)], "t string")
    assert df.filter(nulls.r_grepl("t", "shut\\s*down", ignore_case=True)).count() == 1
    assert df.filter(~nulls.r_grepl("t", "shut\\s*down", ignore_case=True)).count() == 2


def test_null_safe_join_matches_null_keys(spark):
    a = spark.createDataFrame([("s1", None, 1.0), ("s1", "x", 2.0)], "s string, t string, v double")
    b = spark.createDataFrame([("s1", None, "empty"), ("s1", "x", "fish")], "s string, t string, w string")
    out = joins.join(a, b, ["s", "t"], "left")
    assert rows(out) == [("s1", None, 1.0, "empty"), ("s1", "x", 2.0, "fish")]
    plain = joins.join(a, b, ["s", "t"], "left", null_safe=False)
    assert rows(plain, "t", "w") == [(None, None), ("x", "fish")]


def test_full_join_coalesces_keys(spark):
    a = spark.createDataFrame([(1, "a")], "k int, x string")
    b = spark.createDataFrame([(2, "b")], "k int, y string")
    assert rows(joins.join(a, b, ["k"], "full")) == [(1, "a", None), (2, None, "b")]
