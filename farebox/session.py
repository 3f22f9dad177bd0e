"""Session set-up for local runs, and the shared folder for staged data."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every run of the library relies on.  AQE re-plans joins and shuffle
# partition counts from runtime sizes; the session zone is pinned to UTC (the store's
# zone) although trip timestamps are zone-free timestamp_ntz.
LIBRARY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "farebox") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FAREBOX_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in LIBRARY_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and staged tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only a session
    with a ``local`` master may go without: a folder is chosen and registered.  On a cluster
    a machine-local folder would lose what other machines wrote, so there the setting is
    required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
        raise RuntimeError("set spark.checkpoint.dir to the cluster's shared folder")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if not root:
        root = tempfile.mkdtemp(prefix="farebox-checkpoints-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/farebox-staging/{name}-{uuid.uuid4().hex[:12]}"


_GROUP_PROPERTIES = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")


class JobWatch:
    """The jobs of one block of code (``watched``)."""

    def __init__(self, spark: SparkSession, group: str):
        self.spark, self.group = spark, group

    def ran_once(self) -> bool:
        """Whether every task of the block's jobs ran once: no stage was tried again and no
        task failed.  False as well when nothing is known of them."""
        context = self.spark.sparkContext
        context._jsc.sc().listenerBus().waitUntilEmpty()
        tracker = context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(self.group)]
        if not jobs or None in jobs:
            return False
        stages = [tracker.getStageInfo(s) for j in jobs for s in j.stageIds]
        # A stage that was skipped, its shuffle being there already, has no info.
        return all(s is None or s.currentAttemptId == 0 and s.numFailedTasks == 0 for s in stages)


@contextlib.contextmanager
def watched(spark: SparkSession) -> Iterator[JobWatch]:
    """Run a block's jobs in a group of their own; the caller's group is put back."""
    context = spark.sparkContext
    before = {p: context.getLocalProperty(p) for p in _GROUP_PROPERTIES}
    watch = JobWatch(spark, f"watched-{uuid.uuid4().hex}")
    context.setJobGroup(watch.group, before["spark.job.description"] or "")
    try:
        yield watch
    finally:
        for name, value in before.items():
            context.setLocalProperty(name, value)
