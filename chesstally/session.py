"""Spark session construction and the shared scratch location.

Intermediate data (generated fixtures, stream checkpoints, staged outputs) goes under the folder
the cluster names in ``spark.checkpoint.dir``. Only when that is unset *and* Spark runs in local
mode (tests) do we create our own temporary folder; on a cluster an unset checkpoint dir is an
error, because a machine-local folder is not visible to the executors.
"""

from __future__ import annotations

import tempfile
import threading

from pyspark.sql import SparkSession

_LOCK = threading.Lock()


def build_session(
    master: str | None = None,
    app_name: str = "chesstally",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings this library is tuned for.

    AQE stays on so shuffle partitions coalesce at run time and skewed partitions split; the
    static ``spark.sql.shuffle.partitions`` is only an upper bound for the aggregate exchange.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.scheduler.mode": "FAIR",  # months that are ingested at a time share the executors
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate data: ``spark.checkpoint.dir`` or the context's dir."""
    with _LOCK:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            current = spark.sparkContext.getCheckpointDir()
            if current:
                # A context-level checkpoint dir points at <root>/<uuid>; use its parent.
                root = current.rstrip("/").rsplit("/", 1)[0]
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set; set it to a folder shared by all executors"
                )
            # spark.checkpoint.dir is a core setting and cannot change at run time; the
            # context's checkpoint dir can, and later calls derive the root from it.
            root = "file:" + tempfile.mkdtemp(prefix="chesstally-")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([scratch_root(spark), "chesstally", *parts])
