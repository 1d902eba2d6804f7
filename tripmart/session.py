"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording a call site for every column costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Paths of the open workspaces, the innermost last.
_OWNERS: list[list[str]] = []
# Shuffle data per task; adaptive execution merges what turns out smaller.
BYTES_PER_SHUFFLE_TASK = 128 << 20
# Tasks a shuffle starts with where no input size is given. Merging brings small loads down to a few; a load of a
# hundred terabytes wants more still and should name its size.
INITIAL_TASKS = 20_000


def shuffle_partitions(input_bytes: int, least: int = 200) -> int:
    """Shuffle tasks for a load of this size at 128 MiB a task."""
    return max(least, -(-input_bytes // BYTES_PER_SHUFFLE_TASK))


def get_session(
    app_name: str = "tripmart", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """Build or reuse a session sized for ``input_bytes``; ``extra`` keys use ``__`` for ``.``.

    On a cluster a session without a size starts its shuffles with many tasks, which adaptive execution merges.
    """
    builder = SparkSession.builder.appName(app_name)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    elif master and not master.startswith("local"):
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_TASKS))
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting, as in tests, gets a folder of its own; a cluster must name one, for its executors
    could not read each other's disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.tripmart.shared.dir", None)
    if not folder:
        if is_cluster(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tripmart-")
        spark.conf.set("spark.tripmart.shared.dir", folder)
    return folder.rstrip("/")


def is_cluster(master: str) -> bool:
    """Whether executors run apart from the driver; local-cluster counts as a cluster."""
    return not master.startswith("local") or master.startswith("local-cluster")


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet; the innermost workspace owns it."""
    path = f"{shared_folder(spark)}/tripmart/{name}-{uuid.uuid4().hex}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


@contextmanager
def workspace(spark: SparkSession) -> Iterator[list[str]]:
    """Own what is written to the shared folder meanwhile, and remove it in the end.

    A job wraps its run in one, results included: what it returns must be stored elsewhere before the end.
    """
    paths: list[str] = []
    _OWNERS.append(paths)
    try:
        yield paths
    finally:
        _OWNERS.remove(paths)
        jvm = spark.sparkContext._jvm
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
