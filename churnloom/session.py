"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

#: Independent fits whose jobs are submitted side by side.
SIDE_BY_SIDE = 4

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_local_root: str | None = None


def local_session(name: str = "churnloom", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benches. Clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a throw-away one only in local mode."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="churnloom-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{scratch_root(spark)}/churnloom/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> bool:
    """Removes the application's intermediate tables; call it when no DataFrame that reads them is needed any more."""
    jvm, folder = spark.sparkContext._jvm, run_folder(spark)
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Used where a result feeds several later jobs, or where partition-dependent ids must not
    change when a lost executor forces a recompute.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(calls: Sequence[Callable[[], T]], workers: int = SIDE_BY_SIDE) -> list[T]:
    """Results of independent ``calls`` in their order; their Spark jobs share the executors instead of queueing up.

    The first exception is raised once all calls have ended.
    """
    shared = inheritable_thread_target(SparkSession.active())
    with ThreadPool(max(1, min(workers, len(calls)))) as pool:
        return [r.get() for r in [pool.apply_async(shared(f)) for f in calls]]
