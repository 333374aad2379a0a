"""Session settings and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on.  All timestamps are interpreted in UTC: the
# wire format carries an explicit offset, and output is emitted as
# timestamp_ntz holding UTC wall-clock values.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "lumenlog",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for the engine.

    On a cluster the submitter supplies master, memory and
    ``spark.checkpoint.dir``; this helper is for local runs and tests.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Every query of the engine computes in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """Folder on shared storage for sink output, checkpoints and lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir``.  Where none is set, a local
    session gets a folder of its own; on a cluster, whose executors do not share
    the driver's disk, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            # SparkContext appends its own uuid folder; keep the parent.
            root = os.path.dirname(jdir.get().rstrip("/"))
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lumenlog-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one run of one job."""
    return f"{shared_root(spark)}/lumenlog/{name}-{uuid.uuid4().hex[:12]}"
