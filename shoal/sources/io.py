"""Scans and sinks.

Sources are read with explicit schemas (no inference) and only the listed
columns; Parquet is the default landing and output format, partitioned by
source so a slice on Source prunes whole directories.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.operators.reshape import union_by_name
from shoal.session import SURVEY_TZ, freeing

# Tokens the source exports use for missing values.
NA_TOKENS = ["NA", "n/p", "N/A", ""]


def read_typed_csv(spark: SparkSession, path: str | Sequence[str],
                   schema: Mapping[str, str], na: Sequence[str] = ("NA", "")) -> DataFrame:
    """Read only the listed columns of a CSV export, typed.

    Columns are read as text, missing tokens become null (S2) and the text
    is ``try_cast`` to the target type, so a bad value is null, not an
    error.  Unlisted columns are never materialised.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cols = [c for c in schema if c in raw.columns]
    df = normalize_na(raw.select(*cols), na)
    return df.select(*[F.col(f"`{c}`").try_cast(schema[c]).alias(c) for c in cols])


def normalize_na(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Custom missing tokens -> null on every string column."""
    tokens = list(tokens)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def load_tables(spark: SparkSession, root: str, names: Sequence[str], fmt: str = "parquet",
                available: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """S3: one DataFrame per table of a relational source.

    ``available`` (the tables the landing directory holds) is checked first,
    and an unknown name raises listing what exists.
    """
    if available is not None:
        missing = [n for n in names if n not in available]
        if missing:
            raise KeyError(f"unknown tables {missing}; available: {sorted(available)}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return {n: reader.load(f"{root}/{n}") for n in names}


def load_lookup(spark: SparkSession, path: str, schema: Mapping[str, str] | None = None,
                fmt: str = "parquet") -> DataFrame:
    """A small lookup table (stations, comment translations, length
    equations); joins broadcast it after a size check."""
    if fmt == "csv":
        return read_typed_csv(spark, path, schema or {})
    df = spark.read.format(fmt).load(path)
    if schema:
        df = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in schema.items()])
    return df


def scan_union(parts: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """One logical dataset from several files with different columns:
    rename each part, then bind by name with null fill and type widening."""
    return union_by_name([df.withColumnsRenamed(dict(ren)) for df, ren in parts])


class Registry:
    """Named survey datasets under one root, one Parquet folder each."""

    def __init__(self, spark: SparkSession, root: str, names: Sequence[str]):
        self.spark, self.root, self.names = spark, root, list(names)

    def load(self, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
        names = list(names or self.names)
        bad = [n for n in names if n not in self.names]
        if bad:
            raise KeyError(f"unknown datasets {bad}; available: {self.names}")
        return {n: self.spark.read.parquet(f"{self.root}/{n}") for n in names}


def format_local(df: DataFrame, cols: Sequence[str] = ("Datetime",), tz: str = SURVEY_TZ) -> DataFrame:
    """Timestamp columns as local ``yyyy-MM-dd HH:mm:ss`` text.  NTZ values
    already hold local wall-clock time; instants are shown in ``tz``."""
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        dt = df.schema[c].dataType
        # NTZ is formatted as is (date_format would pass it through the
        # session zone and move nonexistent local times); instants are first
        # turned into wall-clock time in ``tz``.
        v = F.col(c) if isinstance(dt, T.TimestampNTZType) else F.convert_timezone(F.lit(tz), F.col(c))
        out = out.withColumn(c, F.substring(v.cast("string"), 1, 19))
    return out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, nulls as ``NA`` and local-time timestamps.
    Written in parallel (one file per partition), not coalesced."""
    (format_local(df).write.mode(mode).option("header", True).option("nullValue", "NA")
     .csv(path))


FORMATS = ("columnar", "csv", "both")


def write_integrated(out: Mapping[str, DataFrame], path: str, format: str = "columnar",
                     write: bool = True) -> Mapping[str, DataFrame]:
    """Persist the integrated tables: zstd Parquet, CSV or both.

    The format is validated before anything runs; ``write=False`` returns
    the tables untouched.  The returned tables keep their timestamps (the
    CSV text form exists only in the files).  For both formats each table is
    computed once: the CSV is written from the Parquet files, which the returned
    tables read as well.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if not write:
        return out
    done = dict(out)
    for name, df in out.items():
        if format in ("columnar", "both"):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
        if format == "both":
            done[name] = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")
        if format in ("csv", "both"):
            write_csv(done[name], f"{path}/{name}_csv")
    return done


class QualityError(ValueError):
    """Rules were broken; ``report`` has the counts."""

    def __init__(self, report: Mapping[str, int], broken: Sequence[str]):
        super().__init__(", ".join(f"{n}: {report[n]}" for n in broken))
        self.report = dict(report)


#: Hidden columns that ``publish`` counts and leaves out: input rows behind a
#: row, and casts of a column that failed behind it.
ROWS, FAILED = "_rows", "_failed_"


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns cast by a type list.  What cannot be read becomes
    null, as R does with a warning; the hidden column ``_failed_<column>`` is 1
    there, so that writing reports it."""
    cast = {c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()}
    failed = [(F.col(f"`{c}`").isNotNull() & v.isNull()).cast("long").alias(FAILED + c) for c, v in cast.items()]
    return df.select(*[cast[c].alias(c) if c in cast else F.col(f"`{c}`") for c in df.columns], *failed)


def _hidden(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == ROWS or c.startswith(FAILED)]


def once(df: DataFrame) -> DataFrame:
    """Q14: ``distinct``, with the number of rows behind each in ``_rows``."""
    hidden = _hidden(df)
    rows = F.sum(ROWS) if ROWS in hidden else F.count(F.lit(1))
    return (df.groupBy(*[c for c in df.columns if c not in hidden])
            .agg(rows.alias(ROWS), *[F.sum(c).alias(c) for c in hidden if c != ROWS]))


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ("Source",),
            rules: Mapping[str, Column] | None = None, allowed: Mapping[str, int] | None = None) -> dict[str, int]:
    """Overwrite a dataset, partitioned by source when it has one, the rows
    of a sample side by side in a file, where their columns repeat.

    With ``rules`` (name -> condition of a bad row) the writing job itself
    counts: ``rows_in``, ``rows_out`` and ``rows_lost`` between (``once``),
    failed casts by column (``typed``) and the rows that break each rule.
    Nothing is scanned again, and the counts are taken in the last stage, where
    every partition counts once, also one that ran again.  ``allowed`` gives
    the count up to which a check passes; one that exceeds it raises
    ``QualityError`` (under ``Versions`` nothing is switched then).  Checks it
    does not name are reported only.
    """
    hidden = _hidden(df)
    cols = [c for c in partition_by if c in df.columns]
    seen, out = Observation(), df
    if rules is not None:
        count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
        out = df.observe(seen, F.count(F.lit(1)).alias("rows_out"),
                         (F.sum(ROWS) if ROWS in hidden else F.count(F.lit(1))).alias("rows_in"),
                         *[F.sum(c).alias(f"failed_{c[len(FAILED):]}") for c in hidden if c != ROWS],
                         *[count(cond).alias(name) for name, cond in rules.items()])
    out = out.drop(*hidden)
    if "SampleID" in out.columns:
        out = out.sortWithinPartitions(*cols, "SampleID")
    w = out.write.mode("overwrite").option("compression", "zstd")
    if cols:
        w = w.partitionBy(*cols)
    with freeing(df.sparkSession):
        w.parquet(path)
    if rules is None:
        return {}
    report = {k: v or 0 for k, v in seen.get.items()}
    report["rows_lost"] = report["rows_in"] - report["rows_out"]
    unknown = [n for n in allowed or {} if n not in report]
    if unknown:
        raise KeyError(f"unknown checks {unknown}; available: {sorted(report)}")
    broken = [n for n, most in (allowed or {}).items() if report[n] > most]
    if broken:
        raise QualityError(report, broken)
    return report
