"""Changed frames of two versions from their hash layers.

At packaging every stream keeps a tree of digests: one for each chunk of frames, then one for each
sixteen nodes, up to one. Two versions are compared from the top: equal nodes end the search, and
only the children of unequal ones are read, so the work follows the changes and not the data.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import STREAM_KEYS
from .provenance import ROW_CHUNK
from .scan import written

KEYS = STREAM_KEYS
FAN = 16


def hash_layers(chunks: DataFrame, fan: int = FAN) -> DataFrame:
    """``chunks(session_id, device_id, stream_id, chunk, sha256)`` → (keys, level, idx, sha256) of
    all layers: level 0 are the chunks, a node hashes the numbers and digests of its children."""
    layer = written(chunks.select(*KEYS, F.col("chunk").cast("long").alias("idx"), "sha256"))
    out = layer.withColumn("level", F.lit(0))
    top, level = layer.agg(F.max("idx")).first()[0] or 0, 0
    while top > 0:
        child = F.struct("idx", F.concat_ws(":", F.col("idx").cast("string"), "sha256").alias("x"))
        layer = layer.groupBy(*KEYS, F.floor(F.col("idx") / fan).cast("long").alias("up")).agg(
            F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(child)), lambda c: c["x"])), 256).alias("sha256"))
        layer = layer.withColumnRenamed("up", "idx")
        top, level = top // fan, level + 1
        out = out.unionByName(layer.withColumn("level", F.lit(level)))
    return out.select(*KEYS, "level", "idx", "sha256")


def changed_chunks(a: DataFrame, b: DataFrame, fan: int = FAN) -> DataFrame:
    """(keys, idx, status) of the chunks that differ between two versions' layers: ``changed``, or
    ``added`` / ``removed`` where one version has no such chunk."""
    tops = [x.agg(F.max("level")).first()[0] for x in (a, b)]
    start = min(x for x in tops if x is not None) if any(x is not None for x in tops) else 0
    # a version without frames has no layer: all of the other's chunks are compared
    start = 0 if None in tops else start
    parents = None
    for level in range(start, -1, -1):
        x, y = (v.where(F.col("level") == level).select(*KEYS, "idx", F.col("sha256").alias(n)) for v, n in ((a, "sa"), (b, "sb")))
        if parents is not None:
            x, y = (v.withColumn("up", F.floor(F.col("idx") / fan).cast("long")).join(parents, [*KEYS, "up"], "left_semi").drop("up") for v in (x, y))
        unequal = x.join(y, [*KEYS, "idx"], "full").where(~F.col("sa").eqNullSafe(F.col("sb")))
        if level:
            parents = unequal.select(*KEYS, F.col("idx").alias("up"))
    status = F.when(F.col("sa").isNull(), "added").when(F.col("sb").isNull(), "removed").otherwise("changed")
    return unequal.select(*KEYS, "idx", status.alias("status"))


def changed_ranges(changes: DataFrame, chunk: int = ROW_CHUNK) -> DataFrame:
    """Neighbouring chunks of one status as frame ranges: (keys, status, first_frame, end_frame),
    the end not included (of a stream's last chunk it may lie past its last frame)."""
    run = F.col("idx") - F.row_number().over(Window.partitionBy(*KEYS, "status").orderBy("idx"))
    return (changes.withColumn("_run", run).groupBy(*KEYS, "status", "_run")
            .agg((F.min("idx") * chunk).alias("first_frame"), ((F.max("idx") + 1) * chunk).alias("end_frame"))
            .select(*KEYS, "status", "first_frame", "end_frame"))
