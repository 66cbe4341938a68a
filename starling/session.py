"""Session helpers: building a session for local runs, and the shared scratch folder.

Scratch data (materialised warehouse tables, CSV feeds, streaming logs and
checkpoints) always lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is missing (unit tests, a
laptop) do we pick a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "starling", extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark.  On a cluster, the cluster's own
    configuration is used instead and this function is not called."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_ROOT: dict[str, str] = {}


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # a session without a local SparkContext
        return spark.conf.get("spark.app.id", "session")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set only if unset."""
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:
        current = None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    # Unset: a local run or a test.  On a cluster each executor would write to its own disk.
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    key = app_id(spark)
    if key not in _OWN_ROOT:
        _OWN_ROOT[key] = tempfile.mkdtemp(prefix="starling-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(_OWN_ROOT[key])
        except Exception:
            pass
    return _OWN_ROOT[key]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return _join(checkpoint_root(spark), "starling", f"{purpose}-{uuid.uuid4().hex[:12]}")


def _join(root: str, *parts: str) -> str:
    if "://" in root:
        return "/".join([root.rstrip("/"), *parts])
    return os.path.join(root, *parts)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, as the file system it names sees it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
