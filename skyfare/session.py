"""Session and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "skyfare",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew-join splitting) switched on.

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; here we only set what the engine needs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # a feed object with a repeated key keeps the last value (as a JSON
        # decoder building a dict does) instead of failing the job
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001
        pass
    shared_root(spark)
    return spark


def app_id(spark: SparkSession) -> str:
    """The application id (also on sessions without a SparkContext handle)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (e.g. a Spark Connect session)
        return spark.conf.get("spark.app.id", None) or f"session-{id(spark):x}"


def shared_root(spark: SparkSession) -> str:
    """Folder for materialised layers and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared file system).  Only
    on a local master, where there is one machine, is a folder of our own made
    when it is unset; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            root = None
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="skyfare-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001
        pass
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder per run under the shared root; never reused.  Spark's
    writers create it (local, HDFS or object-store URIs alike)."""
    return f"{shared_root(spark)}/skyfare/{app_id(spark)}/{name}-{uuid.uuid4().hex[:12]}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES: dict[int, int] = {}
_WRITES_LOCK = threading.Lock()


@contextmanager
def transient_shuffles(spark: SparkSession):
    """Inside, a write's shuffle files go when it ends instead of when the driver happens to
    collect its garbage.  For tables that are read back from their files: a DataFrame that is
    run again would have to shuffle again."""
    key = id(spark)
    with _WRITES_LOCK:
        own = bool(_WRITES.get(key)) or spark.conf.get(CLEANUP, None) != "true"  # else it is the session's
        if own:
            _WRITES[key] = _WRITES.get(key, 0) + 1
            spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _WRITES_LOCK:
            if own:
                _WRITES[key] -= 1
                if not _WRITES[key]:
                    spark.conf.unset(CLEANUP)
