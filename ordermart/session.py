"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
JOBS_AT_ONCE = 4
# Codec of what is written on the way: smaller than the default one.
SCRATCH_CODEC = "zstd"

# Runtime settings the plans count on; a value the user has set is left alone.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables count as large as their counted rows, not as their compressed files, which may be a fiftieth of that.
    "spark.sql.cbo.planStats.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in ADAPTIVE.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder is made only in local mode, where driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ordermart-"))
    return context.getCheckpointDir().rstrip("/")


def application_dir(spark: SparkSession) -> str:
    """Part of the shared folder that belongs to this application run."""
    return f"{shared_dir(spark)}/ordermart-{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one call, so that no later call touches what a frame still reads."""
    return f"{application_dir(spark)}/stage/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute a frame once: written to the shared folder and read back as a plain scan.

    Files survive the loss of an executor. The optimizer takes the bytes of the files for the size of the
    frame; one that grows with the input and is joined is written by ``catalog.materialise_table``.
    """
    path = path or fresh_dir(df.sparkSession, "frame")
    df.write.parquet(path, compression=SCRATCH_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_stage(spark: SparkSession) -> None:
    """Delete what this application has staged: written frames, files and stage databases; frames that read them end."""
    for row in spark.sql("SHOW DATABASES LIKE 'ordermart_stage_*'").collect():
        spark.sql(f"DROP DATABASE IF EXISTS `{row[0]}` CASCADE")
    delete_path(spark, f"{application_dir(spark)}/stage")


def at_once(spark: SparkSession, tasks: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent jobs side by side, so that one fills the executors another leaves idle."""
    if not tasks:
        return {}
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
        return {name: future.result() for name, future in running.items()}
