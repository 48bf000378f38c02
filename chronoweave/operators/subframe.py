"""Sub-frame bucketing (F1–F2, J9, O4): high-rate samples gathered into
fixed-size ``[R, width]`` bursts per anchor interval.

Rules: K anchors give K−1 frames over ``[a_k, a_{k+1})``; at most R samples
per frame (the earliest); ``m_k`` = real count capped at R; a short frame is
padded by repeating its last real sample; an empty frame is zeros and
``valid = false`` — never padded from a neighbour.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_neighbors
from .depth import CELL_US, TARGET_ROWS


def compute_R(grid_rate_hz: float, anchor_fps: float) -> int:
    """R = ceil(grid_rate / anchor_fps)."""
    return int(math.ceil(grid_rate_hz / anchor_fps))


def subframes(anchors: DataFrame, samples: DataFrame, streams: DataFrame, R: int, *,
              cell_us: int = CELL_US, target_rows: int = TARGET_ROWS) -> DataFrame:
    """F2.

    ``anchors(session_id, anchor_index, t_anchor_us)`` (0-based, increasing),
    ``samples(session_id, device_id, stream_id, t_us, row, value)``,
    ``streams(session_id, device_id, stream_id, shape|width)`` →
    ``(session_id, device_id, stream_id, frame_index, t_start_us, t_end_us,
    m_k, valid, samples array<array<float>>)``.

    The sample → interval assignment is an as-of (latest anchor ≤ t) on
    bucketed windows, not a range join; each frame group collects ≤ R rows.
    Row numbers may have holes (a filtered payload): the earliest R are ranked
    by (t, row), and ``m_k`` counts what was kept.
    """
    keys = ["session_id", "device_id", "stream_id"]
    a = anchors.select("session_id", "anchor_index", "t_anchor_us")
    nb = asof_neighbors(samples.select(*keys, "t_us", "row", "value"), a, ["session_id"],
                        left_t="t_us", right_t="t_anchor_us", right_cols=["anchor_index"],
                        cell_us=cell_us, target_rows=target_rows, prev="_p", nxt="_x")
    # a sample belongs to frame k when a_k ≤ t < a_{k+1}; past the last anchor → none
    inside = nb.where(F.col("_p").isNotNull() & F.col("_x").isNotNull()) \
               .withColumn("frame_index", F.col("_p.anchor_index"))
    # the rank limit is applied before the shuffle, too (at most R rows of a frame per task)
    fk = keys + ["frame_index"]
    rank = F.row_number().over(Window.partitionBy(*fk).orderBy("t_us", "row"))
    kept = inside.withColumn("_rank", rank).where(F.col("_rank") <= R)
    cnt = kept.groupBy(*fk).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.struct(F.col("_rank"), F.col("value")))).alias("_kept"))
    # every frame of every stream appears, empty ones included
    nxt = a.select("session_id", (F.col("anchor_index") - 1).alias("anchor_index"),
                   F.col("t_anchor_us").alias("t_end_us"))
    frames = a.join(nxt, ["session_id", "anchor_index"]).select(
        "session_id", F.col("anchor_index").alias("frame_index"),
        F.col("t_anchor_us").alias("t_start_us"), "t_end_us")
    if "width" not in streams.columns:
        from ..functions.expr import shape_width
        streams = streams.withColumn("width", shape_width("shape"))
    all_frames = frames.join(streams.select(*keys, "width"), "session_id")
    j = all_frames.join(cnt, keys + ["frame_index"], "left")
    m = F.least(F.coalesce(F.col("_n"), F.lit(0)), F.lit(R)).cast("int")
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0).cast("float"), F.col("width").cast("int")), R)
    padded = F.transform(F.sequence(F.lit(1), F.lit(R)),
                         lambda i: F.element_at(F.col("_kept"), F.least(i, m))["value"])
    return j.select(*keys, "frame_index", "t_start_us", "t_end_us", m.cast("int").alias("m_k"),
                    (m > 0).alias("valid"),
                    F.when(m > 0, padded).otherwise(zeros).alias("samples"))
