"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on.  Dates are UTC calendar dates and a
# partitioned overwrite must only touch the partitions it writes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # streaming state may outgrow the executors' memory
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Lists and texts of a team can be megabytes and are the same for its managers.  Files keep each
    # once, and writers look at what they hold after a few rows, not after a hundred.
    "parquet.dictionary.page.size": str(64 << 20),
    "parquet.page.size.row.check.min": "4",
    "parquet.block.size.row.check.min": "4",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "teampulse") -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp" if os.path.isdir("/tmp") else None)
    return _LOCAL_DIRS[app]


# Scratch folder of each local application that names none; the setting itself is fixed once Spark runs.
_LOCAL_DIRS: dict[str, str] = {}
# Folders of the runs that are under way, the innermost last.
_RUNS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the run's folder, else the shared one; no two calls return the same one."""
    return f"{_RUNS[-1] if _RUNS else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession, root: str) -> Iterator[str]:
    """Intermediate tables of a run go below its own root and are deleted when it ends.

    What the run returns must not depend on them.
    """
    folder = f"{root.rstrip('/')}/_run-{uuid.uuid4().hex}"
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later steps that read it several times neither recompute it nor depend on the
    executors that made it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
