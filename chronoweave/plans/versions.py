"""Packaged versions become visible as a whole, by one commit.

Every run writes its tables under a run id of its own (``dataset=/version=/run=``) and, last, one
small file to ``commits``. Readers resolve that table first: of each dataset version they see the
rows of its last committed run, in every table, and nothing of runs that have not committed. A job
that dies between two of its writes leaves the version that was there; running it again, or
retrying a batch, adds a run and never mixes with one.
"""
from __future__ import annotations

import os
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PARTS = ["dataset", "version", "run"]
COMMITS = "run string, version string, seq long"


def table_path(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


def new_run() -> str:
    return uuid.uuid4().hex


def stage(df: DataFrame, root: str, name: str, ids: DataFrame, version: str, run: str) -> None:
    """Write one table of a run; ``ids(session_id, dataset)`` gives rows their dataset."""
    if "dataset" not in df.columns:
        df = df.join(ids.select("session_id", "dataset"), "session_id")
    (df.withColumns({"version": F.lit(version), "run": F.lit(run)}).write.mode("append")
     .option("compression", "zstd").partitionBy(*PARTS).parquet(table_path(root, name)))


def commit(spark: SparkSession, root: str, version: str, run: str) -> None:
    """Make a run visible. One file: Spark's committer moves it into place at once."""
    row = [(run, version, time.time_ns())]
    spark.createDataFrame(row, COMMITS).coalesce(1).write.mode("append").parquet(table_path(root, "commits"))


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    # partition values stay strings whatever they look like (``version=1`` is no integer)
    return df.withColumns({c: F.col(c).cast("string") for c in (*PARTS, "session_id") if c in df.columns})


def visible_runs(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, version, run): the last committed run of each dataset version. A run names its
    datasets by its manifest, of which only partition values are read."""
    commits, manifest = _read(spark, table_path(root, "commits")), _read(spark, table_path(root, "manifest"))
    if commits is None or manifest is None:
        return spark.createDataFrame([], "dataset string, version string, run string")
    last = Window.partitionBy("dataset", "version").orderBy(F.desc("seq"), F.desc("run"))
    return (manifest.select(*PARTS).distinct().join(commits, ["run", "version"])
            .withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*PARTS))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A packaged table as its last committed runs left it."""
    df = _read(spark, table_path(root, name))
    if df is None:
        raise FileNotFoundError(table_path(root, name))
    if "run" not in df.columns:
        return df
    return df.join(visible_runs(spark, root), PARTS, "left_semi").drop("run")


def read_run(spark: SparkSession, root: str, name: str, version: str, run: str) -> DataFrame:
    """A table of one run, committed or not: what the job itself reads back."""
    df = _read(spark, table_path(root, name))
    return df.where((F.col("version") == version) & (F.col("run") == run)).drop("run")
