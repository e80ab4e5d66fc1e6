"""Session construction and shared working directories."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TOGETHER = 5              # independent feeds, dimensions or facts whose jobs run side by side

# Settings that matter at scale: AQE re-plans joins and partition counts at
# runtime from real sizes, splits skewed join partitions and coalesces small
# shuffle partitions.  The broadcast threshold is a *checked* size bound.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "motorlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator and is read from the session; a
    session without one is an error there. Only a local master (tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="motorlake-ckpt-"))
        d = sc.getCheckpointDir()
    return d


def run_dir(spark: SparkSession, tag: str) -> str:
    """The path of a fresh sub-folder of the shared folder; Spark's writers create it."""
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def together(f: Callable, items: Iterable) -> list:
    """``f`` of each item, several at a time, in the order of the items; the first error is raised. For jobs that do not
    need each other's results: the cores that the last tasks of one leave free then work on the next."""
    with ThreadPoolExecutor(TOGETHER) as pool:
        return list(pool.map(f, items))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a job are removed when it ends, not when the driver happens to collect garbage. For runs of many
    jobs that pass their results on by tables: the disk then holds the shuffles of the jobs that run, not those of all before."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
