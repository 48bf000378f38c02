"""Spark session helpers.

Cluster jobs get their session from the platform; these helpers only fill in
settings that are unset (tests, bench, local runs).
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's plans rely on (AQE re-plans shuffles and splits skewed
# join partitions at runtime; UTC keeps micro-second arithmetic zone-free).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # checkpoint files of intermediates go away once their DataFrames do
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "chronoweave", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("CW_DRIVER_MEMORY", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the plans rely on (idempotent)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Spark applies that setting when the context starts. Only when nothing is
    configured (tests, local runs) is a scratch folder of our own set — via
    ``setCheckpointDir``, since the config itself cannot change at runtime.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cw-ckpt-")  # one machine only
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
