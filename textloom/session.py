"""Session settings and tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A table is broadcast only when it is known to have no more rows than this.
BROADCAST_ROWS = 500_000
# A key is "hot" when it holds more than 1/HOT_KEYS of the rows, so there are
# never more than HOT_KEYS of them and a list of hot keys may be broadcast.
HOT_KEYS = 100_000
# Nor when its values take more than this.
BROADCAST_BYTES = 128 << 20
# Lists of the tables written within scratch blocks, innermost last.
_OPEN: list[list[str]] = []


def get_spark(app: str = "textloom", master: str | None = None,
              partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster, master, memory and partition numbers come from spark-submit;
    the arguments are for tests and local runs.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        b = b.config(key.replace("__", "."), str(value))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/textloom/{app}/{tag}-{uuid.uuid4().hex[:12]}"
    for tables in _OPEN[-1:]:
        tables.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written below the shared folder within this block when it is left.

    For jobs that have written their result by then; what they read lazily is gone.
    """
    tables: list[str] = []
    _OPEN.append(tables)
    try:
        yield
    finally:
        _OPEN.remove(tables)
        for path in tables:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write a table once and go on from the files.

    Cuts the lineage, keeps column pruning and size statistics, and a lost
    executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """A parquet table, spread over the cores when its files give too few tasks.

    A large table has more splits than there are cores and is read as it lies.
    Only one too small for that is dealt out, by key, before row-wise work.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key) if key else df.repartition(cores)
