"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("regionpanel")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it; a temporary one only in local mode, which goes
    when the process ends."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    used = spark.sparkContext.getCheckpointDir()
    if used:
        return used.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="regionpanel-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# Folders of the runs that are on, the innermost last.
_runs: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder not used before, below the folder of the run or else the shared folder."""
    return f"{_runs[-1] if _runs else shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables made inside the ``with``, deleted at its end, also when the run fails.

    Frames that read such tables must have been written or collected by then. One run at a time in a process; runs may be
    nested.
    """
    folder = new_folder(spark, "run")
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write a frame once and go on from the written rows.

    Used where two branches must see the very same rows in the very same slices; the written table survives
    the loss of executors.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
