"""Session construction and shared-storage locations.

Intermediate tables that cut lineage are written under the cluster's
``spark.checkpoint.dir`` (a shared, fault-tolerant filesystem on a real
cluster). Only when that setting is absent *and* Spark runs in local mode is
a private directory created, as tests need.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}

# Settings a large cluster run should start from (documented, applied by
# ``cluster_conf``): AQE re-plans joins from measured sizes, splits skewed
# partitions and coalesces small ones; file splits of 256 MB keep the scan
# task count near 400k for 100 TB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", app: str = "ticketflow",
                  extra: dict[str, str] | None = None) -> SparkSession:
    conf = dict(LOCAL_CONF)
    conf.update(extra or {})
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM: ``local`` or ``local[…]``, not ``local-cluster[…]``."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory; set a private one only if unset locally."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    d = tempfile.mkdtemp(prefix="ticketflow-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_ON_EXIT: list = []


def _leave() -> None:
    for action in reversed(_ON_EXIT):
        try:
            action()
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass


def on_exit(spark: SparkSession, action: Callable[[], object]) -> None:
    """Run ``action`` when the driver ends, if its session still runs."""
    if not _ON_EXIT:
        atexit.register(_leave)  # after Spark's own, so that it runs before
    _ON_EXIT.append(action)


def _drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever filesystem Spark reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


# Rows that one task sorts or aggregates at once: wide rows of text stay well below its memory.
ROWS_PER_TASK = 250_000


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks over which ``rows`` are dealt, so that a task's share does not grow with the input."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


@contextmanager
def sized_shuffles(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Jobs run inside have ``tasks`` shuffle partitions at least; AQE still merges small ones."""
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    if int(old) >= tasks:
        yield
        return
    spark.conf.set(name, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(name, old)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action run inside are deleted when it ends, not when the driver happens to collect its garbage.

    For actions whose result is written: nothing reads their shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder.

    The scratch folder of an application is deleted when its driver ends.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ticketflow"
    if base not in _SCRATCH:
        _SCRATCH.add(base)
        on_exit(spark, lambda: _drop_folder(spark, base))
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
