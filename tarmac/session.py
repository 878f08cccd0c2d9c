"""Session helpers: a configured SparkSession and a shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. The session time zone only affects
# how timestamps are displayed; all time arithmetic here is zone-explicit.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tarmac",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a SparkSession with the package defaults.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset so the cluster's
    own settings apply; AQE coalesces/splits shuffle partitions at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch folder.

    ``spark.checkpoint.dir`` of the session (the folder the cluster names for lineage
    cuts), else the checkpoint folder already registered with the context. With neither,
    a local master gets a private folder (tests, single machine); any other master is
    an error, since executors cannot read each other's local folders.
    """
    sc = spark.sparkContext
    registered = sc.getCheckpointDir()
    root = sc.getConf().get("spark.checkpoint.dir", None) or registered
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        key = sc.applicationId
        if key not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[key] = (os.environ.get("TARMAC_SCRATCH")
                                 or tempfile.mkdtemp(prefix="tarmac-scratch-"))
        root = _LOCAL_ROOTS[key]
    if registered is None:
        sc.setCheckpointDir(root.rstrip("/") + "/checkpoints")
    return root.rstrip("/")


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never a local tmp on a cluster)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
