"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(app_name: str = "playrank", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder; a cluster without the
    setting is refused, since a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return _shared(spark, configured)
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return _shared(spark, existing)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="playrank-"))
    return spark.sparkContext.getCheckpointDir()


_probed: set[tuple[str, str]] = set()


def _shared(spark: SparkSession, path: str) -> str:
    """A bare local path on a cluster may be a mount that all machines share or a folder of each: see once which it is."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if not spark.sparkContext.master.startswith("local") and ":" not in path and default.startswith("file:"):
        key = (spark.sparkContext.applicationId, path)
        if key not in _probed and not _seen_by_all(spark, path):
            raise RuntimeError(f"spark.checkpoint.dir {path!r} is a local folder; name a shared one, or a shared mount as file://")
        _probed.add(key)
    return path


def _seen_by_all(spark: SparkSession, path: str) -> bool:
    """Whether the rows that tasks write to the folder are all found again."""
    place, tasks = os.path.join(path, f"probe-{uuid.uuid4().hex}"), max(8, 2 * spark.sparkContext.defaultParallelism)
    spark.range(0, tasks, 1, tasks).write.parquet(place)
    try:
        return spark.read.schema("id bigint").parquet(place).count() == tasks
    except Exception:  # a task that does not find a file of another fails
        return False
    finally:
        drop_tables(spark, [place])


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


_recorders: list[list[str]] = []


@contextmanager
def recording() -> Iterator[list[str]]:
    """Collects the paths of all tables that ``materialize`` writes meanwhile."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders[:] = [r for r in _recorders if r is not paths]


def drop_tables(spark: SparkSession, paths: Iterable[str], keep: DataFrame | None = None) -> None:
    """Delete tables that ``materialize`` wrote and no result needs any more; those that ``keep`` reads stay."""
    paths = list(paths)
    if not paths:
        return
    read = keep.inputFiles() if keep is not None else []
    for path in paths:
        if not any(f"{os.path.basename(path)}/" in file for file in read):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder_stamp(spark: SparkSession, path: str) -> tuple[int, int, int] | None:
    """Files, bytes and time of change of a table; None if it is gone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return None
    held = system.getContentSummary(place)
    return held.getFileCount(), held.getLength(), system.getFileStatus(place).getModificationTime()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs meanwhile go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage like ``checkpoint()``, survives lost executors, and leaves a columnar
    table behind, so later steps prune columns, push filters down and count from footers. The
    shuffles that made it are cleared away at once.
    """
    path = new_path(df.sparkSession, name)
    for paths in _recorders:
        paths.append(path)
    with own_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
