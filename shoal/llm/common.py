"""Helpers shared by the operators: lineage cuts, table access, null rules.

Conventions of every operator in this subpackage
------------------------------------------------
* Only the columns an operator needs are selected, under internal names, so
  further columns of the input (whatever their names) never clash.
* A null text is the empty text.
* A null id is an id of its own kind: joins on ids are null-safe.
* An empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import os
import tempfile
import time
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent (tests, notebooks) a folder beside the
    warehouse is used, which Spark shares among executors as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        named = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named or current


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget its lineage.

    A reliable checkpoint: a lost executor re-reads the files instead of
    recomputing everything upstream, and values assigned by position (such
    as names given after a sort) are frozen.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended: it does so
    once the driver's JVM has collected their plans, which takes two turns."""
    system = spark.sparkContext._jvm.System
    system.gc()
    time.sleep(0.2)
    system.gc()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, unless they inherit its path.

    Spark distributes the archive; nothing else is read from local folders."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if top in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_shoal_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="shoal-code-"), "shoal-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "shoal")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    sc._shoal_shipped = True


_RESIDENT: dict = {}


def resident(key: str, make):
    """In a Python worker: the object made for ``key``, kept for later tasks.
    There is room for one, so models of different operators do not add up."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def evict() -> None:
    """Make room for a task that needs memory but keeps no model."""
    _RESIDENT.clear()


def strings(column, step: int = 256) -> Iterator:
    """Values of an Arrow column as Python objects, a few at a time."""
    for k in range(0, len(column), step):
        yield from column.slice(k, step).to_pylist()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that by itself on pure ASCII;
    other texts go through ``translate``, which touches no further letter."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def small(df: DataFrame, most_bytes: int = 8 << 20) -> DataFrame:
    """``df``, to be broadcast if its values take at most ``most_bytes``; a
    larger one is joined by shuffle.  For tables that have been cut: their
    estimates are those of the plan before, which are far too high."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    size = F.lit(16 * len(df.columns)) + sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= most_bytes else df


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, made longer until ``docs`` has no such column."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
        taken.add(n.lower())
    return out


def keep_once(docs: DataFrame, keep: DataFrame, id_col: str, key: Column) -> DataFrame:
    """The rows of ``docs``, all columns, whose (id, key) is in ``keep``
    (``doc_id, key``), one row per pair.

    ``keep`` has a pair as often as ``docs`` has the row, so rows that are
    repeated show there; only those are compared again row by row."""
    own_id, own_key, count, of = unused(docs, "__id", "__key", "__n", "__of")
    pairs = cut(keep.groupBy(F.col("doc_id").alias(own_id), F.col("key").alias(own_key)).agg(F.count(F.lit(1)).alias(count)))
    keyed, cols = docs.withColumn(of, key), [F.col(f"`{c}`") for c in docs.columns]

    def rows(which: DataFrame) -> DataFrame:
        hit = (F.col(of) == F.col(own_key)) & F.col(f"`{id_col}`").eqNullSafe(F.col(own_id))
        return keyed.join(which, hit, "left_semi")

    once = rows(pairs.filter(F.col(count) == 1)).select(*cols)
    repeated = pairs.filter(F.col(count) > 1)
    if repeated.isEmpty():
        return once
    return once.unionByName(rows(repeated).dropDuplicates([id_col, of]).select(*cols))
