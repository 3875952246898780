"""Session construction and the shared scratch folder.

Library code never invents a machine-local folder on a cluster: scratch
tables and checkpoints live under ``spark.checkpoint.dir``, which the
cluster names.  Only a local-mode session without that setting (tests,
benchmarks) gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pipeline relies on.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "starloom", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session created elsewhere."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session; set a temporary one only in local mode where
    nothing is configured.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{scratch_root(spark).rstrip('/')}/starloom/{name}-{uuid.uuid4().hex[:12]}"
