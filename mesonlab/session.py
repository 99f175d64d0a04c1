"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Defaults that matter at any scale: AQE re-plans shuffles at runtime (coalesces
# small partitions, splits skewed join partitions), and the UI server stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpointed results (histogram bins) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str, master: str | None = None, config: dict | None = None,
                enable_hive: bool = False) -> SparkSession:
    """Build (or fetch) a session. ``app_name`` is required, the rest optional."""
    if not app_name:
        raise ValueError("app_name is required")
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(config or {})}.items():
        builder = builder.config(key, value)
    if enable_hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def cores(spark: SparkSession) -> int:
    """Task slots of the cluster (falls back to the configuration when the
    session has no driver-side context, as in a remote session)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", str(os.cpu_count() or 8)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system).
    Only a local-mode session without the setting gets a private folder, the
    way tests run.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server side owns the folder
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="mesonlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder; whoever writes there
    makes the folder, in the file system that the path means to Spark."""
    return f"{checkpoint_root(spark)}/mesonlab/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None) -> None:
    """Make this package importable by the Python workers (the effect of
    ``--py-files``): zip it once per application and ``addPyFile`` it; Spark
    serves the file to every executor. Needed by the Arrow/pandas user
    functions, whose code lives in this package."""
    if spark is None:
        return
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # remote session: the server side must provide the package
        return
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="mesonlab-pkg-"), "mesonlab.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
