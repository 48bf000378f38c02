"""Reference grid, frame numbering, clock models and grid-rate inference."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import exact_median

# Frames generated per task-sized chunk: a long session's grid is produced by
# many tasks instead of one explode of a billion-element sequence.
GRID_CHUNK = 1 << 16


def grid_from_bounds(bounds: DataFrame, step_us: int, *, chunk: int = GRID_CHUNK,
                     lo="lo_us", hi="hi_us") -> DataFrame:
    """bounds(session_id, lo_us, hi_us) → grid(session_id, frame_index, t_ref_us).

    ``t_ref = lo + k·step`` for ``k = 0 … floor((hi − lo)/step)``. Generation is
    chunked: one tiny row per chunk is exploded first and repartitioned so the
    frames themselves are produced in parallel.
    """
    n = (F.floor((F.col(hi) - F.col(lo)) / F.lit(step_us)) + 1).cast("long")
    b = bounds.select("session_id", F.col(lo).alias("_lo"), n.alias("_n")).where("_n > 0")
    chunks = (b.withColumn("_c", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk).cast("long"))))
               .repartition("session_id", "_c"))
    start = F.col("_c") * chunk
    end = F.least(start + chunk, F.col("_n")) - 1
    g = chunks.select("session_id", "_lo",
                      F.explode(F.sequence(start, end)).alias("frame_index"))
    return g.select("session_id", "frame_index",
                    (F.col("_lo") + F.col("frame_index") * F.lit(step_us)).alias("t_ref_us"))


def grid_over_samples(samples: DataFrame, step_us: int, t="t_us") -> DataFrame:
    """B1: a grid at ``step_us`` over each session's sample span (all devices)."""
    bounds = samples.groupBy("session_id").agg(F.min(t).alias("lo_us"), F.max(t).alias("hi_us"))
    return grid_from_bounds(bounds, step_us)


def apply_clock(samples: DataFrame, models: DataFrame, t="t_us", out="t_ref_us") -> DataFrame:
    """B2: ``t_ref = alpha·t + beta`` per (session, device) clock model.

    ``models([session_id,] device_id, alpha, beta)`` is one row per device
    (per session when ``session_id`` is given); a device without a model
    keeps its own clock (alpha 1, beta 0).
    """
    keys = [k for k in ("session_id", "device_id") if k in models.columns]
    m = models.select(*keys, "alpha", "beta")
    j = samples.join(m, keys, "left")
    a = F.coalesce(F.col("alpha"), F.lit(1.0))
    bb = F.coalesce(F.col("beta"), F.lit(0.0))
    return j.withColumn(out, F.round(a * F.col(t).cast("double") + bb).cast("long")) \
            .drop("alpha", "beta")


def grid_deltas(grid: DataFrame) -> DataFrame:
    """(session_id, frame_index, dt_us) = t[k] − t[k−1] for k ≥ 1, in frame order.

    A self-join on ``frame_index + 1`` keeps this distributed; a ``lag`` window
    would put a whole session in one task.
    """
    prev = grid.select("session_id", (F.col("frame_index") + 1).alias("frame_index"),
                       F.col("t_ref_us").alias("_tp"))
    return (grid.join(prev, ["session_id", "frame_index"])
                .select("session_id", "frame_index",
                        (F.col("t_ref_us") - F.col("_tp")).alias("dt_us")))


def delta_bounds(grid: DataFrame) -> DataFrame:
    """(session_id, _mono, _dmin, _dmax) over the steps of :func:`grid_deltas`; no row without one.

    A step between repeated frames is one of each pair of their rows. Its least and greatest follow
    from the ends of each frame's times, so a frame of n rows is n rows here and never n² pairs.
    """
    per = grid.groupBy("session_id", "frame_index").agg(F.min("t_ref_us").alias("_lo"), F.max("t_ref_us").alias("_hi"))
    prev = per.select("session_id", (F.col("frame_index") + 1).alias("frame_index"),
                      F.col("_lo").alias("_plo"), F.col("_hi").alias("_phi"))
    d = per.join(prev, ["session_id", "frame_index"]).groupBy("session_id").agg(
        F.min(F.col("_lo") - F.col("_phi")).alias("_dmin"), F.max(F.col("_hi") - F.col("_plo")).alias("_dmax"))
    return d.select("session_id", (F.col("_dmin") > 0).alias("_mono"), "_dmin", "_dmax")


def infer_grid_rate(grid: DataFrame) -> DataFrame:
    """rate = 1e6 / median(Δt); fewer than two points or Δt ≤ 0 → 0.0.

    Returns (session_id, grid_rate_hz) for every session of ``grid``.
    """
    med = exact_median(grid_deltas(grid), ["session_id"], "dt_us", out="median_dt")
    sessions = grid.select("session_id").distinct()
    return (sessions.join(med, "session_id", "left")
            .select("session_id",
                    F.when(F.col("median_dt") > 0, F.lit(1e6) / F.col("median_dt"))
                     .otherwise(F.lit(0.0)).alias("grid_rate_hz")))
