"""Survey roles played by the driver's tables.

The engine's operators work on survey-shaped data: samples (net tows), a
catch table (total catch per sample and taxon), a length table (measured
fish with frequencies) and lookups.  The registered queries run them on the
driver's star schema with this fixed role assignment:

==================  ==========================================================
survey concept      driver data
==================  ==========================================================
Source              ``o_orderstatus`` (three sources, uneven sizes)
SampleID            ``o_orderkey``; orders with no lineitem are no-catch samples
Date                ``o_orderdate`` as a calendar date
Station             customer's nation name
Taxa                ``p_brand`` of the line's part; ``Brand#1`` plays ``UnID``
Length              ``l_quantity``; line 1 of an order is unmeasured (0)
Frequency           1 per line (one measured fish per line)
Catch               per (sample, taxon): lines + lines with discount >= 0.05
Count (fish rows)   ``l_linenumber - 1``; null where ``l_tax = 0``
conductivity uS/cm  ``l_extendedprice / 2``
temperature deg C   ``abs(c_acctbal) / 400``
notes               ``documents.text``
==================  ==========================================================

All of it is derived by Spark from the given tables, so the work of every
query grows with them.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock
from types import TracebackType
from typing import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.operators.joins import join
from shoal.session import freeing, remove, size_tasks, stored_bytes
from shoal.sources.sparse import table_name, write_bucketed

# The brand standing in for the unidentified taxon.
UNID_BRAND = "Brand#1"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table, with tasks that are small enough for it."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    size_tasks(spark, stored_bytes(spark, path))
    return df


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample: Source, SampleID, Date, Survey, Method, custkey."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderstatus").alias("Source"),
        F.col("o_orderkey").alias("SampleID"),
        F.to_date("o_orderdate").alias("Date"),
        F.month("o_orderdate").alias("Survey"),
        F.col("o_orderpriority").alias("Method"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_totalprice").alias("totalprice"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey -> Station (nation name) and derived coordinates."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    return cn.select(
        F.col("c_custkey").alias("custkey"),
        F.col("n_name").alias("Station"),
        (F.lit(37.0) + F.col("n_nationkey") * F.lit(0.09)).alias("Latitude"),
        (F.lit(-123.0) + F.col("n_regionkey") * F.lit(0.45)).alias("Longitude"),
        (F.abs(F.col("c_acctbal")) / F.lit(400.0)).alias("Temperature"),
        (F.abs(F.col("c_acctbal")) / F.lit(300.0)).alias("Salinity"),
    )


#: Columns of ``lines`` and what they are in the driver's tables.
LINE_COLUMNS = {"linenumber": "l_linenumber", "discount": "l_discount", "tax": "l_tax", "price": "l_extendedprice",
                "quantity": "l_quantity", "returnflag": "l_returnflag", "shipdate": "l_shipdate"}


def _branded(spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(LINE_COLUMNS)) -> DataFrame:
    """Lines with the brand of their part."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *[LINE_COLUMNS[c] for c in columns])
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).drop("l_partkey", "p_partkey")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey)


class Once:
    """Scope in which the two joins that nearly every role table begins with,
    lines with their part and orders with their customer, are made once, when
    they are first asked for: stored under ``root`` in buckets by sample, so that
    what joins or groups them by sample shuffles neither, and removed at the end.
    ``columns`` are those of ``lines`` that are asked for.  Other threads take part
    by ``here``."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, columns: Sequence[str] = tuple(LINE_COLUMNS)):
        self.spark, self.sf_dir, self.root, self.columns = spark, sf_dir, root.rstrip("/"), columns
        self.lock, self.paths = Lock(), {}

    def _get(self, name: str, made: Callable[[], DataFrame], key: str) -> DataFrame:
        with self.lock:
            if name not in self.paths:
                df, self.paths[name] = made(), f"{self.root}/{name}-{uuid.uuid4().hex}"
                with freeing(self.spark):
                    write_bucketed(df, self.paths[name], int(self.spark.conf.get("spark.sql.shuffle.partitions")), None, key)
            return self.spark.table(table_name(self.paths[name]))

    def lines(self) -> DataFrame:
        return self._get("lines", lambda: _branded(self.spark, self.sf_dir, self.columns), "l_orderkey")

    def visits(self) -> DataFrame:
        return self._get("visits", lambda: _visits(self.spark, self.sf_dir), "o_orderkey")

    @contextmanager
    def here(self) -> Iterator[None]:
        token = _ONCE.set(self)
        try:
            yield
        finally:
            _ONCE.reset(token)

    def __enter__(self) -> Once:
        self.token = _ONCE.set(self)
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        _ONCE.reset(self.token)
        for path in self.paths.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
            remove(self.spark, path)


_ONCE: ContextVar[Once | None] = ContextVar("joins made once", default=None)


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer: the orders' columns, c_custkey, c_nationkey, c_acctbal."""
    once = _ONCE.get()
    return once.visits() if once and once.sf_dir == sf_dir else _visits(spark, sf_dir)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per catch line: SampleID, Taxa, Length (0 = unmeasured), Frequency,
    linenumber, discount, tax, price, quantity, returnflag, shipdate, brand (in
    the scope of ``Once``, those it was asked for)."""
    once = _ONCE.get()
    lp = once.lines() if once and once.sf_dir == sf_dir else _branded(spark, sf_dir)
    return lp.select(
        F.col("l_orderkey").alias("SampleID"),
        F.when(F.col("p_brand") == UNID_BRAND, F.lit("UnID")).otherwise(F.col("p_brand")).alias("Taxa"),
        F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("Length"),
        F.lit(1.0).alias("Frequency"),
        *[F.col(c).alias(name) for name, c in LINE_COLUMNS.items() if c in lp.columns],
        F.col("p_brand").alias("brand"),
    )


def catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total catch per (SampleID, Taxa): lines + lines with discount >= 0.05."""
    return (lines(spark, sf_dir).groupBy("SampleID", "Taxa")
            .agg((F.count(F.lit(1)) + F.count_if(F.col("discount") >= 0.05))
                 .cast("double").alias("Catch")))


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length table: (SampleID, Taxa, Length, Frequency), unmeasured rows as 0."""
    return lines(spark, sf_dir).select("SampleID", "Taxa", "Length", "Frequency")


def fish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide fish rows as the survey datasets publish them, before zero-fill:
    Source, SampleID, Taxa, Length, Count, Notes_catch.  A sample with no
    lines is one row with null taxon and length and count 0."""
    s = samples(spark, sf_dir).select("Source", "SampleID")
    ln = lines(spark, sf_dir).select(
        "SampleID", "Taxa",
        F.col("quantity").alias("Length"),
        F.when(F.col("tax") == 0, F.lit(None).cast("double"))
         .otherwise((F.col("linenumber") - 1).cast("double")).alias("Count"),
        F.col("returnflag").alias("Notes_catch"),
        F.lit(True).alias("_caught"))
    out = join(s, ln, ["SampleID"], "left", null_safe=False)
    return (out.withColumn("Count", F.when(F.col("_caught").isNull(), F.lit(0.0))
                           .otherwise(F.col("Count")))
            .drop("_caught"))


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A survey-level dataset as one survey job publishes it: sample columns
    (Source, Station, Latitude, Longitude, Date, Survey, SampleID, Method,
    Tide, Sal_surf, Temp_surf, Tow_volume) + Taxa, Length, Count,
    Length_NA_flag; empty samples kept as "No fish caught" rows."""
    from shoal.functions import exprs
    from shoal.operators import expand
    sv = join(samples(spark, sf_dir), stations(spark, sf_dir), ["custkey"], "inner",
              null_safe=False)
    sv = sv.select("Source", "Station", "Latitude", "Longitude", "Date", "Survey", "SampleID",
                   "Method", exprs.tide("Survey").alias("Tide"),
                   F.col("Salinity").alias("Sal_surf"), F.col("Temperature").alias("Temp_surf"),
                   (F.col("totalprice") / 100).alias("Tow_volume"))
    ex = expand.expand_counts(catch(spark, sf_dir), lengths(spark, sf_dir), ["SampleID", "Taxa"])
    ds = join(sv, ex.select("SampleID", "Taxa", "Length", "Count"), ["SampleID"], "left",
              null_safe=False)
    ds = ds.withColumn("Length_NA_flag", exprs.length_flag("Length", "Count"))
    return ds.withColumn("Count", exprs.zero_no_catch("Count", "Length_NA_flag"))
