"""SparkSession construction and lineage cutting.

Everything in the library is lazy DataFrame code; the session only fixes the
settings the semantics depend on (ANSI arithmetic, local time zone of the
surveys) and turns on adaptive execution so joins and shuffles are re-planned
from runtime sizes, with skewed partitions split.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from types import TracebackType
from typing import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SURVEY_TZ = "America/Los_Angeles"

SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": SURVEY_TZ,
    "spark.sql.parquet.compression.codec": "zstd",
    # checkpoints go when the driver no longer knows the table cut
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "shoal",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    ``conf`` entries override the defaults; on a cluster leave ``master``
    unset so the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()


# A task's share.  Survey rows repeat their sample's columns, so they shuffle and
# store at a twentieth to a hundredth of what they take in a sort or a hash table;
# Spark's own sizes (128 MB read, 64 MB shuffled) make tasks of gigabytes of them.
SIZES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
#: Stored bytes of a table for each shuffle partition.
BYTES_A_PARTITION = 4 << 20


def size_tasks(spark: SparkSession, stored: int) -> None:
    """Let tasks be small enough for a table of ``stored`` bytes, however large:
    sizes above ``SIZES`` are lowered, and shuffles get a partition for every
    ``BYTES_A_PARTITION`` (adaptive execution joins those that turn out small).
    What the session has set finer stays."""
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in SIZES.items():
        if to_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    enough = math.ceil(stored / BYTES_A_PARTITION)
    if enough > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(enough))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, by the file system it is on."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


#: Spark's setting for removing a query's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Scope in which a table that is written leaves no shuffle files behind:
    else they stay on disk until the driver's JVM collects its garbage."""
    old = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, old)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir``.

    The data is written to the shared folder, so a lost executor does not
    force recomputation of the whole upstream plan.  Raises when no
    checkpoint folder is configured rather than silently using local disk.
    """
    if not checkpoint_dir(df.sparkSession):
        raise RuntimeError("spark.checkpoint.dir is not set; name a "
                           "folder that driver and executors share")
    return df.checkpoint(eager=True)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the shared folder from then on
    (S10): for a table that a lazy plan needs several times.

    Parquet in the checkpoint folder the session names; where it names none (one
    machine, as in tests) beside the warehouse.  Unlike a checkpoint's plain rows
    it is compressed, and each reader takes only the columns it needs.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    path = f"{base.rstrip('/')}/kept-{uuid.uuid4().hex}"
    return _stored(df, path)


def _stored(df: DataFrame, path: str) -> DataFrame:
    with freeing(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stored:
    """Scope in which tables read several times are written once under ``root``
    (S10), and removed at the end.  For large ones: unlike ``Reuse`` it takes no
    memory, each is computed before anything reads it, in as many tasks as it
    needs, and readers take only their columns."""

    def __init__(self, root: str):
        self.root, self.kept = root.rstrip("/"), []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.kept.append((df.sparkSession, f"{self.root}/kept-{uuid.uuid4().hex}"))
        return _stored(df, self.kept[-1][1])

    def __enter__(self) -> Stored:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        while self.kept:
            remove(*self.kept.pop())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is on."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


class Reuse:
    """Scope in which tables read several times are kept (S10): what it is
    called on is persisted and given back, and all of it is unpersisted at the
    end.  For work that is done inside the scope, such as publishing; a lost
    executor's blocks are computed again."""

    def __init__(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self.level, self.kept = level, []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.kept.append(df.persist(self.level))
        return self.kept[-1]

    def __enter__(self) -> Reuse:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        while self.kept:
            self.kept.pop().unpersist()


def as_is(df: DataFrame) -> DataFrame:
    """Neither: the plan repeats what it needs several times."""
    return df
