"""Sparse survey store (Z1, F14, F17, J14, K14): zero-fill when read.

The zero-filled fish table holds a row for every sample and every taxon its
source ever recorded; nearly all are zeros.  The store keeps what was caught:

============  ================================================================
``samples``   one row a sample: its attributes and ``Present``, the taxa caught
``fish``      the rows as caught, distinct
``taxa``      one row a source: the sorted array of its taxa
============  ================================================================

``samples`` and ``fish`` are partitioned by source and bucketed by sample, so a
slice prunes folders, pushes its other filters to the scans and joins fish to
samples without an exchange.  Zeros are made when a slice is read: the taxa
asked for are intersected with the source's array, the taxa present taken off,
and only what is left is exploded.  A slice of three taxa makes at most three
rows a sample, whatever the crosswalk holds.
"""

from __future__ import annotations

import hashlib
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.functions.schema import UNID
from shoal.operators.analyze import sum_over_lengths
from shoal.operators.filters import length_window, slice_filter

KEY = "SampleID"


def write_bucketed(df: DataFrame, path: str, buckets: int, partition_by: str | None = "Source", key: str = KEY) -> None:
    """A folder of Parquet files bucketed and sorted by sample: one file for a
    bucket and source, written by one task."""
    name = table_name(path)
    w = df.repartition(buckets, key).write.mode("overwrite").option("compression", "zstd").option("path", path)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)


def table_name(path: str) -> str:
    return "shoal_" + hashlib.md5(path.encode()).hexdigest()[:20]


def read_bucketed(spark: SparkSession, path: str, buckets: int, partition_by: str = "Source") -> DataFrame:
    """The folder as a table that knows its buckets, in whatever session."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{partition_by}`) "
                  f"CLUSTERED BY (`{KEY}`) SORTED BY (`{KEY}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_sparse(survey: DataFrame, fish: DataFrame, path: str, buckets: int | None = None) -> None:
    """Store the survey table (one row a sample) and the fish table as caught
    (``Source, SampleID, Taxa, Length, Count, ...``; null taxa are samples
    without catch and need no row)."""
    spark = survey.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    caught = fish.filter(F.col("Taxa").isNotNull()).distinct()
    write_bucketed(caught, f"{path}/fish", buckets)
    caught = read_bucketed(spark, f"{path}/fish", buckets)
    present = caught.groupBy(KEY).agg(F.array_sort(F.collect_set("Taxa")).alias("Present"))
    none = F.array().cast("array<string>")
    write_bucketed(survey.join(present, KEY, "left").withColumn("Present", F.coalesce("Present", none)),
                   f"{path}/samples", buckets)
    (caught.select("Source", "Taxa").distinct().groupBy("Source").agg(F.array_sort(F.collect_set("Taxa")).alias("Taxa"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/taxa"))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(f"{path}/layout")


class SparseStore:
    """What ``write_sparse`` wrote, read by slices."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        buckets = spark.read.schema("buckets int").json(f"{path}/layout").first()[0]
        self.samples = read_bucketed(spark, f"{path}/samples", buckets)
        self.fish = read_bucketed(spark, f"{path}/fish", buckets)
        self.taxa = spark.read.parquet(f"{path}/taxa")

    def missing(self, taxa: Sequence[str] | None = None) -> Column:
        """The taxa a sample gets zeros for: those of its source that are asked
        for and were not caught.  The sources' arrays are one value (a scalar
        subquery); zero counts of the unidentified taxon are never kept (F10)."""
        arrays = self.taxa.agg(F.map_from_entries(F.collect_list(F.struct("Source", "Taxa")))).scalar()
        asked = F.array_remove(F.try_element_at(arrays, F.col("Source")), UNID)
        if taxa is not None:
            asked = F.array_intersect(asked, F.array(*[F.lit(t) for t in taxa]).cast("array<string>"))
        return F.coalesce(F.array_except(asked, "Present"), F.array().cast("array<string>"))

    def slice(self, sources: Sequence[str] | None = None, months: Sequence[int] | None = None,
              years: tuple[int, int] | None = None, taxa: Sequence[str] | None = None,
              bounds: Mapping[str, tuple[float, float]] | None = None, default_bounds: tuple[float, float] | None = None,
              aggregate: bool = False) -> DataFrame:
        """K14 on the zero-filled table without filling it: sample attributes,
        ``Taxa, Length, Count`` and further columns of the fish table.

        A sample for which neither a fish nor a zero is left stays with null
        taxa.  With ``aggregate`` counts of the lengths inside the bounds of
        their source are summed, and ``Length`` is not returned."""
        s = slice_filter(self.samples, sources, months, years).withColumn("_zeros", self.missing(taxa))
        f = self.fish.withColumn("Count", F.coalesce("Count", F.lit(0.0)))
        if sources is not None:
            f = f.filter(F.col("Source").isin(list(sources)))
        if taxa is not None:
            f = f.filter(F.col("Taxa").isin(list(taxa)))
        f = f.filter(~((F.col("Taxa") == UNID) & (F.col("Count") == 0)))
        if aggregate:
            f = length_window(f, dict(bounds or {}), default_bounds or (float("-inf"), float("inf")))
            f = sum_over_lengths(f)
        else:
            f = f.drop("Source")
        kept = s.join(f, KEY, "left").filter(F.col("Taxa").isNotNull() | (F.size("_zeros") == 0))
        zeros = (s.withColumn("Taxa", F.explode("_zeros")).withColumn("Count", F.lit(0.0)))
        return kept.unionByName(zeros, allowMissingColumns=True).drop("_zeros", "Present")

    def fill(self, taxa: Sequence[str] | None = None) -> DataFrame:
        """The zero-filled fish table itself (Z1, Z2), of all or some taxa."""
        whole = self.slice(taxa=taxa)
        return whole.filter(F.col("Taxa").isNotNull()).select(KEY, *[c for c in self.fish.columns if c not in (KEY, "Source")])
