"""Sessions, shared scratch space and lineage control."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BATCH_BYTES = 8 << 20  # of an Arrow batch, however long its rows
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_folders: dict[str, str] = {}


def local_session(app: str = "ratingloom", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to BATCH_BYTES where they may be larger; Python workers hold a batch several times."""
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)b?", spark.conf.get(_BATCH_SETTING).strip().lower()).groups()
    now = int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0)
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    Only a local-mode session without the setting gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ratingloom-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(_scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark).rstrip("/"), "ratingloom", spark.sparkContext.applicationId)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; call it once the results are saved elsewhere."""
    return delete_path(spark, _scratch_root(spark))


def delete_path(spark: SparkSession, name: str) -> bool:
    """Delete a folder this application wrote, on whatever file system it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.delete(path, True))


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The table survives lost executors, ends the lineage, and its file sizes tell the optimiser
    whether a later join may broadcast it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
