"""Shared working storage: written tables that cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def release() -> None:
    """Delete all working tables written so far: for drivers between queries whose results were taken, and at exit."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone; then the folder's owner cleans up
            pass


atexit.register(release)


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir``, or in a local session a temporary one if that is unset.

    On a cluster without that setting this is an error: each executor would write to a disk of its own, and reading
    back would find a part of the rows, or none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; master {master} has none")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="voxloom-")
    return "file://" + _LOCAL_ROOTS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared root."""
    return f"{shared_root(spark)}/voxloom/{name}-{uuid.uuid4().hex}"


def scratch(spark: SparkSession, name: str) -> str:
    """Unused path below the shared root that ``release`` deletes."""
    path = new_path(spark, name)
    _WRITTEN.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove ``path`` through Hadoop's file system, whatever its scheme."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to shared storage and return it as read back, with its path.

    Compressed parquet is several times smaller than an RDD checkpoint and keeps column pruning.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """``write_table`` for callers that don't delete it themselves."""
    return write_table(df, name)[0]


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``, from file sizes; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
