"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortex") -> SparkSession:
    """A local session configured the way the engine expects (tests, bench)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables, models and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (or the checkpoint dir already set on
    the context). Only when neither is set and the master is local (tests) a private
    folder is created and registered as the checkpoint dir; on a cluster that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if root:
        # the context appends a per-application uuid folder; use its parent
        root = os.path.dirname(root.rstrip("/"))
    else:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            # a machine-local folder is not visible to the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="cohortex-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/") + "/cohortex"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
