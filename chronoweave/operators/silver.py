"""Silver projections and per-stream aggregates.

``silver_long`` is the source of truth; ``silver_wide`` is its per-frame
projection with one column per payload element.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import shape_width
from ..schemas import STREAM_KEYS

KEYS = STREAM_KEYS


def feature_names(streams: DataFrame) -> DataFrame:
    """Bare ``stream_id`` when unique in the session, else
    ``<device>.<stream>``. Adds ``feature`` and ``width`` to ``streams``."""
    w = Window.partitionBy("session_id", "stream_id")
    n = F.count(F.lit(1)).over(w)
    return (streams.withColumn("feature", F.when(n == 1, F.col("stream_id"))
                               .otherwise(F.concat_ws(".", "device_id", "stream_id")))
                   .withColumn("width", shape_width("shape")))


def stream_coverage(silver: DataFrame, streams: DataFrame | None = None) -> DataFrame:
    """A1: coverage = mean(valid) per stream; a stream without frames → 0.0."""
    cov = silver.groupBy(*KEYS).agg(F.avg(F.col("valid").cast("double")).alias("coverage"))
    if streams is None:
        return cov
    return (streams.select(*KEYS).join(cov, KEYS, "left")
            .select(*KEYS, F.coalesce("coverage", F.lit(0.0)).alias("coverage")))


def stream_stats(silver: DataFrame) -> DataFrame:
    """One pass over Silver: coverage, confidence mean over valid frames,
    NaN-skipping value range over valid frames, sample and frame counts."""
    valid = F.col("valid")
    vals = F.filter("value", lambda x: ~F.isnan(x))
    return silver.groupBy(*KEYS).agg(
        F.avg(valid.cast("double")).alias("coverage"),
        F.avg(F.when(valid, F.col("confidence"))).alias("confidence_mean"),
        F.min(F.when(valid, F.array_min(vals))).alias("value_min"),
        F.max(F.when(valid, F.array_max(vals))).alias("value_max"),
        F.sum(valid.cast("long")).alias("sample_count"),
        F.count(F.lit(1)).alias("frames"))


def coverage_min(stream_cov: DataFrame, sessions: DataFrame) -> DataFrame:
    """A2: min coverage over a session's streams; no streams → 1.0."""
    m = stream_cov.groupBy("session_id").agg(F.min("coverage").alias("coverage_min"))
    return (sessions.select("session_id").distinct().join(m, "session_id", "left")
            .select("session_id", F.coalesce("coverage_min", F.lit(1.0)).alias("coverage_min")))


def mean_confidence(silver: DataFrame, sessions: DataFrame) -> DataFrame:
    """A3: mean over streams (with a valid frame) of the mean confidence of the
    stream's valid frames; none → 0.0. A mean of means, not a global mean."""
    per = (silver.where("valid").groupBy(*KEYS).agg(F.avg("confidence").alias("_m")))
    m = per.groupBy("session_id").agg(F.avg("_m").alias("label_confidence"))
    return (sessions.select("session_id").distinct().join(m, "session_id", "left")
            .select("session_id", F.coalesce("label_confidence", F.lit(0.0)).alias("label_confidence")))


def export_counts(silver: DataFrame, grid: DataFrame) -> DataFrame:
    """A4: frame_count = grid length, sample_count = Σ valid over streams."""
    fc = grid.groupBy("session_id").agg(F.count(F.lit(1)).alias("frame_count"))
    sc = silver.groupBy("session_id").agg(F.sum(F.col("valid").cast("long")).alias("sample_count"))
    return (fc.join(sc, "session_id", "left")
            .select("session_id", "frame_count",
                    F.coalesce("sample_count", F.lit(0)).cast("long").alias("sample_count")))


def stream_meta(streams: DataFrame, silver: DataFrame) -> DataFrame:
    """Key, device, kind, units, kernel, shape, width, coverage per feature."""
    fn = feature_names(streams)
    cov = stream_coverage(silver, streams)
    return (fn.join(cov, KEYS, "left")
            .select("session_id", "feature",
                    F.concat_ws("::", "device_id", "stream_id").alias("key"),
                    "device_id", "stream_id", "payload_kind", "units", "kernel", "shape",
                    "width", F.coalesce("coverage", F.lit(0.0)).alias("coverage")))


def topology_rows(streams: DataFrame) -> DataFrame:
    """P10/O1: per session, the devices declaring a topology ref or hash,
    sorted by device, as ``array<struct<device_id, topology_ref, topology_hash>>``."""
    t = (streams.where("topology_ref is not null or topology_hash is not null")
         .select("session_id", "device_id", "topology_ref", "topology_hash").distinct())
    agg = t.groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("device_id", "topology_ref", "topology_hash"))).alias("topology"))
    return (streams.select("session_id").distinct().join(agg, "session_id", "left")
            .select("session_id", F.coalesce("topology", F.array().cast(agg.schema["topology"].dataType))
                    .alias("topology")))


def session_identity(meta: DataFrame, metric_col: str = "metric_session_id") -> DataFrame:
    """Upstream metric id, else the session's id, else ``sess_<clock>``;
    empty strings count as missing."""
    metric = F.nullif(F.col(metric_col), F.lit("")) if metric_col in meta.columns else F.lit(None)
    return meta.withColumn("resolved_session_id", F.coalesce(
        metric, F.nullif(F.col("session_id"), F.lit("")),
        F.concat(F.lit("sess_"), F.col("reference_clock_id"))))


def silver_wide(silver: DataFrame, features: list[tuple[str, str, str, int]]) -> DataFrame:
    """Per (session, frame): ``t_ref_us``, ``frame_index``, then for each
    feature ``<f>.cNNN`` float32 …, ``<f>.valid``, ``<f>.confidence`` float32.

    ``features`` = [(device_id, stream_id, feature, width)] — the explicit
    pivot list (from the small streams dimension), so no distinct job runs and
    the output schema is fixed. Features absent in a session are NULL.
    """
    aggs = []
    named = "feature" in silver.columns
    for dev, sid, feat, width in features:
        hit = (F.col("device_id") == dev) & (F.col("stream_id") == sid)
        if named:      # names are decided per session (see with_feature)
            hit = hit & (F.col("feature") == feat)
        # scalar first() per element keeps the aggregate hash-based and codegen'd
        for j in range(width):
            aggs.append(F.first(F.when(hit, F.col("value")[j]), True).cast("float")
                        .alias(f"{feat}.c{j:03d}"))
        aggs.append(F.first(F.when(hit, F.col("valid")), True).alias(f"{feat}.valid"))
        aggs.append(F.first(F.when(hit, F.col("confidence")), True).cast("float")
                    .alias(f"{feat}.confidence"))
    return silver.groupBy("session_id", "frame_index", "t_ref_us").agg(*aggs)


def with_feature(silver: DataFrame, streams: DataFrame) -> DataFrame:
    """Attach each row's per-session feature name, so pivots over several
    sessions put a stream under the name its own session gives it."""
    return silver.join(feature_names(streams).select(*KEYS, "feature"), KEYS)


def feature_list(streams: DataFrame) -> list[tuple[str, str, str, int]]:
    """The pivot list: distinct (device, stream, feature, width) over sessions.

    Collected from the streams *dimension* (one row per stream, not per
    frame); a feature set shared by many sessions collapses to a few rows.
    """
    fn = feature_names(streams).select("device_id", "stream_id", "feature", "width").distinct()
    rows = fn.orderBy("feature", "device_id", "stream_id").collect()
    return [(r.device_id, r.stream_id, r.feature, int(r.width)) for r in rows]


def write_silver(silver: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: zstd Parquet partitioned by session, sorted by stream and frame so
    row-group min/max statistics skip on (device, stream, frame) filters.
    Range partitioning (sampled bounds) splits a hot stream across writers."""
    (silver.repartitionByRange("session_id", "device_id", "stream_id", "frame_index")
           .sortWithinPartitions("session_id", "device_id", "stream_id", "frame_index")
           .write.mode(mode).option("compression", "zstd")
           .partitionBy("session_id").parquet(path))


def feature_sets(streams: DataFrame) -> DataFrame:
    """(session_id, feature_set, signature): the sorted (feature, width,
    device, stream) list a session's wide table needs, and its JSON text."""
    fn = feature_names(streams)
    fs = fn.groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("feature", "width", "device_id", "stream_id"))).alias("feature_set"))
    return fs.withColumn("signature", F.to_json("feature_set"))


def silver_wide_by_feature_set(silver: DataFrame, streams: DataFrame) -> list[tuple[list, DataFrame]]:
    """P8 for heterogeneous sessions: one wide table per distinct feature set
    (sessions with different devices get their own schema instead of the
    union of every column). Only the distinct sets reach the driver."""
    fs = feature_sets(streams)
    out = []
    for row in fs.select("signature", "feature_set").distinct().collect():
        feats = [(x.device_id, x.stream_id, x.feature, int(x.width)) for x in row.feature_set]
        sess = fs.where(F.col("signature") == row.signature).select("session_id")
        out.append((feats, silver_wide(silver.join(sess, "session_id", "left_semi"), feats)))
    return out
