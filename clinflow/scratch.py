"""Tables that cut lineage: written to a shared folder of the cluster and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

T = TypeVar("T")

_JOB: ContextVar[str | None] = ContextVar("clinflow_job_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, else the session's checkpoint folder, else the warehouse.

    All of them are shared by driver and executors; the session is left as it is. A warehouse that nobody set is a folder of the
    driver's machine, so on a cluster that one is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if "://" not in warehouse.removeprefix("file://"):
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return warehouse


def new_path(spark: SparkSession, label: str) -> str:
    folder = _JOB.get() or f"{shared_folder(spark).rstrip('/')}/clinflow"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def job_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """One scratch folder for everything a job keeps; it is removed at the end, however the job ends."""
    path = new_path(spark, label)
    token = _JOB.set(path)
    try:
        yield path
    finally:
        _JOB.reset(token)
        remove(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Compute once, keep as parquet in shared storage, go on from the files.

    Survives lost executors, and gives later joins real file sizes to plan with.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As ``materialize``, with the number of rows, which the write itself counts."""
    rows = Observation()
    kept = materialize(df.observe(rows, F.count(F.lit(1)).alias("n")), label)
    return kept, rows.get.get("n", 0)


def side_by_side(tasks: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Results of tasks that run Spark jobs and do not depend on one another, all started at once."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        started = {name: pool.submit(copy_context().run, task) for name, task in tasks.items()}
        return {name: task.result() for name, task in started.items()}
