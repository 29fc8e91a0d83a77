"""Written intermediate tables.

An operator that needs two passes over the same rows writes them once to the
shared checkpoint folder and reads them back. The copy survives the loss of
executors, cuts the lineage, and gives the optimizer the exact size of the
table, which is what decides later between broadcast and shuffle joins.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Session setting that names the run whose tables are being staged.
RUN = "tidemark.staging.run"
# Spark then deletes the shuffle files of a query when it ends, instead of when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The step of the run that the calling thread is in.
_STEP: ContextVar[str | None] = ContextVar("step", default=None)
# Tables are written once and read a few times: fewer bytes are worth the time.
COMPRESSION = "zstd"


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    ``spark.checkpoint.dir``, or the context's checkpoint folder, names it. Only a
    local master may do without: there all tasks share the machine, so a temporary
    folder is shared as well. It is one per process and removed when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def staging_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the staging root."""
    run = spark.conf.get(RUN, None)
    folder = "/".join(filter(None, ("tidemark", run, _STEP.get())))
    return f"{staging_root(spark)}/{folder}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to a fresh staging table and return the table's scan."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[None]:
    """Keep the tables staged inside together and delete them at the end.

    For jobs whose results are written before the block ends. A nested block belongs
    to the outer one. Shuffle files of queries inside go with their query, unless the session says otherwise: a run
    has many queries, and what they moved would fill the disks together.
    """
    if spark.conf.get(RUN, None):
        yield
        return
    run = f"run-{uuid.uuid4().hex}"
    spark.conf.set(RUN, run)
    said = CLEANUP in spark.conf.getAll
    if not said:
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(RUN)
        if not said:
            spark.conf.unset(CLEANUP)
        remove(spark, f"{staging_root(spark)}/tidemark/{run}")


@contextmanager
def staging_step(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that the calling thread stages inside as soon as the block ends.

    For a part of a run whose result is written by then. Threads have steps of their own; a nested block belongs
    to the outer one.
    """
    if _STEP.get():
        yield
        return
    step = f"step-{uuid.uuid4().hex}"
    token = _STEP.set(step)
    folder = staging_path(spark, step).rsplit("/", 1)[0]
    try:
        yield
    finally:
        _STEP.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
