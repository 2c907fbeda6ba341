"""Session settings, shared scratch space and short-lived caching."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "rosterline", **conf: str) -> SparkSession:
    """A session with the settings the engine expects. On a cluster pass no master:
    spark-submit supplies it, together with spark.checkpoint.dir."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that functions in tasks find it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_rosterline_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="rosterline-package-")  # read by the driver alone, which serves it
    archive = shutil.make_archive(os.path.join(folder, "rosterline"), "zip", os.path.dirname(here), os.path.basename(here))
    sc.addPyFile(archive)
    sc._rosterline_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir. Only a
    local master may fall back to a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="rosterline-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


_uses: dict[tuple[str, int], int] = {}  # how many blocks hold a cached plan open
_uses_lock = threading.Lock()


@contextlib.contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for the several passes of one fit, spilling to disk; lost blocks are
    recomputed from lineage. Fits side by side that cache the same plan share one entry, which
    the last of them gives up; a frame that the caller has cached stays so."""
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash())
    with _uses_lock:
        mine = key in _uses or df.storageLevel == StorageLevel.NONE
        if mine:
            _uses[key] = _uses.get(key, 0) + 1
            if _uses[key] == 1:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if mine:
            with _uses_lock:
                _uses[key] -= 1
                if not _uses[key]:
                    del _uses[key]
                    df.unpersist()


A, B = TypeVar("A"), TypeVar("B")


def in_parallel(spark: SparkSession, fn: Callable[[A], B], items: Sequence[A], parallelism: int = 4) -> list[B]:
    """Run independent Spark work from several driver threads; results in the order of items."""
    if len(items) < 2 or parallelism < 2:
        return [fn(i) for i in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(fn), items, chunksize=1)


def rank_buckets(spark: SparkSession) -> int:
    """How many ranges a whole-table ranking is cut into: grows with the cluster's own
    shuffle width, so no range outgrows a task."""
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
