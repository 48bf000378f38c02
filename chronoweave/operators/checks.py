"""Data-quality checks (Q1–Q12) as one boolean aggregate per session.

Every check returns ``pass``/``fail``; the result is the long table
``checks(session_id, name, status)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import shape_width
from ..schemas import STREAM_KEYS
from .grid import delta_bounds, infer_grid_rate

KEYS = STREAM_KEYS
CHECK_ORDER = ("grid_frame_index_aligned", "stream_shapes_consistent", "schema_version_present",
               "grid_monotonic", "bounded_step", "no_fabricated_gaps",
               "session_id_present", "reference_clock_present", "grid_rate_positive",
               "has_streams", "confidence_in_unit_interval", "confidence_zero_at_gaps")


def _status(ok):
    return F.when(F.coalesce(ok, F.lit(True)), "pass").otherwise("fail")


def _in_unit(c):
    """Per-stream aggregate: NaN-skipping min ≥ 0 and max ≤ 1; empty passes,
    all-NaN fails (numpy nanmin of all-NaN is NaN and compares false)."""
    x = F.col(c)
    notnan = F.when(~F.isnan(x), x)
    return F.when(F.count(x) == 0, F.lit(True)).otherwise(
        F.coalesce((F.min(notnan) >= 0) & (F.max(notnan) <= 1), F.lit(False)))


def schema_checks(silver: DataFrame, grid: DataFrame, streams: DataFrame,
                  meta: DataFrame) -> DataFrame:
    """Q1–Q3 per session (wide: one column per check)."""
    g = grid.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_grid"),
        F.count("frame_index").alias("_nf"),
        F.countDistinct("frame_index").alias("_nd"),
        F.min("frame_index").alias("_fmin"), F.max("frame_index").alias("_fmax"))
    st = streams.select(*KEYS, shape_width("shape").alias("width"))
    per = (silver.join(st, KEYS, "left").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("valid").alias("_nv"), F.count("confidence").alias("_nc"),
        F.bool_and(F.coalesce(F.size("value") == F.col("width"), F.lit(False))).alias("_shape_ok")))
    per = (st.select(*KEYS).join(per, KEYS, "left")
             .join(g.select("session_id", "n_grid"), "session_id", "left")
             .select("session_id",
                     ((F.coalesce("_rows", F.lit(0)) == F.coalesce("n_grid", F.lit(0))) &
                      (F.coalesce("_nv", F.lit(0)) == F.coalesce("n_grid", F.lit(0))) &
                      (F.coalesce("_nc", F.lit(0)) == F.coalesce("n_grid", F.lit(0))) &
                      F.coalesce("_shape_ok", F.lit(True))).alias("_ok")))
    shapes = per.groupBy("session_id").agg(F.bool_and("_ok").alias("stream_shapes_consistent"))
    m = meta.select("session_id", "schema_version")
    return (m.join(g, "session_id", "left").join(shapes, "session_id", "left")
            .select("session_id",
                    ((F.coalesce("_nf", F.lit(0)) == F.coalesce("n_grid", F.lit(0))) &
                     (F.coalesce("_nd", F.lit(0)) == F.coalesce("n_grid", F.lit(0))) &
                     (F.coalesce("_fmin", F.lit(0)) == 0) &
                     (F.coalesce("_fmax", F.lit(-1)) == F.coalesce("n_grid", F.lit(0)) - 1)
                     ).alias("grid_frame_index_aligned"),
                    F.coalesce("stream_shapes_consistent", F.lit(True)).alias("stream_shapes_consistent"),
                    (F.coalesce(F.length("schema_version"), F.lit(0)) > 0).alias("schema_version_present")))


def timeline_checks(silver: DataFrame, grid: DataFrame, meta: DataFrame) -> DataFrame:
    """Q4 monotonic (Δt in frame order > 0), Q5 bounded step
    (min Δt ≥ 1 and max Δt ≤ 2·min Δt), Q6 no fabricated gaps."""
    d = delta_bounds(grid)
    gaps = (silver.where("not valid").groupBy("session_id")
            .agg(F.bool_and(F.forall("value", lambda x: F.isnan(x))).alias("_nofab")))
    return (meta.select("session_id").join(d, "session_id", "left").join(gaps, "session_id", "left")
            .select("session_id",
                    F.coalesce("_mono", F.lit(True)).alias("grid_monotonic"),
                    F.when(F.col("_dmin").isNull(), F.lit(True))
                     .otherwise((F.col("_dmin") >= 1) & (F.col("_dmax") <= 2 * F.col("_dmin")))
                     .alias("bounded_step"),
                    F.coalesce("_nofab", F.lit(True)).alias("no_fabricated_gaps")))


def resolved_grid_rate(grid: DataFrame, meta: DataFrame) -> DataFrame:
    """The session's declared rate, else 1e6/median Δt (A6). Only sessions
    without a declared rate feed the median job."""
    undeclared = meta.where(F.coalesce(F.col("grid_rate_hz"), F.lit(0.0)) == 0).select("session_id")
    inf = infer_grid_rate(grid.join(undeclared, "session_id", "left_semi"))
    return (meta.select("session_id", F.col("grid_rate_hz").alias("_decl"))
            .join(inf, "session_id", "left")
            .select("session_id",
                    F.when(F.coalesce(F.col("_decl"), F.lit(0.0)) != 0, F.col("_decl"))
                     .otherwise(F.coalesce("grid_rate_hz", F.lit(0.0))).alias("grid_rate_hz")))


def metadata_checks(grid: DataFrame, streams: DataFrame, meta: DataFrame) -> DataFrame:
    """Q7–Q10."""
    rate = resolved_grid_rate(grid, meta)
    ns = streams.groupBy("session_id").agg(F.count(F.lit(1)).alias("_ns"))
    return (meta.select("session_id", "reference_clock_id").join(rate, "session_id", "left")
            .join(ns, "session_id", "left")
            .select("session_id",
                    (F.coalesce(F.length("session_id"), F.lit(0)) > 0).alias("session_id_present"),
                    (F.coalesce(F.length("reference_clock_id"), F.lit(0)) > 0).alias("reference_clock_present"),
                    (F.coalesce("grid_rate_hz", F.lit(0.0)) > 0).alias("grid_rate_positive"),
                    (F.coalesce("_ns", F.lit(0)) > 0).alias("has_streams")))


def confidence_checks(silver: DataFrame, meta: DataFrame) -> DataFrame:
    """Q11 all four confidence columns in [0, 1] (NaN-skipping), Q12 scalar
    confidence is 0 on invalid frames."""
    per = silver.groupBy(*KEYS).agg(
        (_in_unit("confidence") & _in_unit("conf_source") & _in_unit("conf_clock")
         & _in_unit("conf_interp")).alias("_unit"),
        F.bool_and(F.col("valid") | (F.col("confidence") == 0)).alias("_zero"))
    s = per.groupBy("session_id").agg(F.bool_and("_unit").alias("_u"), F.bool_and("_zero").alias("_z"))
    return (meta.select("session_id").join(s, "session_id", "left")
            .select("session_id", F.coalesce("_u", F.lit(True)).alias("confidence_in_unit_interval"),
                    F.coalesce("_z", F.lit(True)).alias("confidence_zero_at_gaps")))


def session_quality(silver: DataFrame, grid: DataFrame, streams: DataFrame,
                    meta: DataFrame) -> DataFrame:
    """All twelve checks plus the gate's metrics (coverage_min,
    label_confidence) per session, from one per-stream aggregate over Silver
    and one aggregate over the grid (the separate check functions above give
    the same answers one family at a time)."""
    st = streams.select(*KEYS, shape_width("shape").alias("width"))
    valid = F.col("valid")
    per = silver.join(st, KEYS, "left").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("valid").alias("_nv"),
        F.count("confidence").alias("_nc"),
        F.bool_and(F.coalesce(F.size("value") == F.col("width"), F.lit(False))).alias("_shape_ok"),
        (_in_unit("confidence") & _in_unit("conf_source") & _in_unit("conf_clock")
         & _in_unit("conf_interp")).alias("_unit"),
        F.bool_and(valid | (F.col("confidence") == 0)).alias("_zero"),
        F.bool_and(F.when(~valid, F.forall("value", lambda x: F.isnan(x)))).alias("_nofab"),
        F.avg(valid.cast("double")).alias("_cov"),
        F.avg(F.when(valid, F.col("confidence"))).alias("_cmean"))
    g = grid.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_grid"), F.count("frame_index").alias("_nf"),
        F.countDistinct("frame_index").alias("_nd"),
        F.min("frame_index").alias("_fmin"), F.max("frame_index").alias("_fmax"))
    d = delta_bounds(grid)
    per = (st.select(*KEYS).join(per, KEYS, "left").join(g.select("session_id", "n_grid"), "session_id", "left"))
    n = F.coalesce("n_grid", F.lit(0))
    ses = per.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("_ns"),
        F.bool_and((F.coalesce("_rows", F.lit(0)) == n) & (F.coalesce("_nv", F.lit(0)) == n)
                   & (F.coalesce("_nc", F.lit(0)) == n) & F.coalesce("_shape_ok", F.lit(True))).alias("_shapes"),
        F.bool_and(F.coalesce("_unit", F.lit(True))).alias("_u"),
        F.bool_and(F.coalesce("_zero", F.lit(True))).alias("_z"),
        F.bool_and(F.coalesce("_nofab", F.lit(True))).alias("_nofab"),
        F.min(F.coalesce("_cov", F.lit(0.0))).alias("_covmin"),
        F.avg("_cmean").alias("_conf"))
    rate = resolved_grid_rate(grid, meta)
    m = (meta.select("session_id", "reference_clock_id", "schema_version")
         .join(g, "session_id", "left").join(d, "session_id", "left")
         .join(ses, "session_id", "left").join(rate, "session_id", "left"))
    ng = F.coalesce("n_grid", F.lit(0))
    return m.select(
        "session_id",
        ((F.coalesce("_nf", F.lit(0)) == ng) & (F.coalesce("_nd", F.lit(0)) == ng)
         & (F.coalesce("_fmin", F.lit(0)) == 0) & (F.coalesce("_fmax", F.lit(-1)) == ng - 1))
        .alias("grid_frame_index_aligned"),
        F.coalesce("_shapes", F.lit(True)).alias("stream_shapes_consistent"),
        (F.coalesce(F.length("schema_version"), F.lit(0)) > 0).alias("schema_version_present"),
        F.coalesce("_mono", F.lit(True)).alias("grid_monotonic"),
        F.when(F.col("_dmin").isNull(), F.lit(True))
         .otherwise((F.col("_dmin") >= 1) & (F.col("_dmax") <= 2 * F.col("_dmin"))).alias("bounded_step"),
        F.coalesce("_nofab", F.lit(True)).alias("no_fabricated_gaps"),
        (F.coalesce(F.length("session_id"), F.lit(0)) > 0).alias("session_id_present"),
        (F.coalesce(F.length("reference_clock_id"), F.lit(0)) > 0).alias("reference_clock_present"),
        (F.coalesce("grid_rate_hz", F.lit(0.0)) > 0).alias("grid_rate_positive"),
        (F.coalesce("_ns", F.lit(0)) > 0).alias("has_streams"),
        F.coalesce("_u", F.lit(True)).alias("confidence_in_unit_interval"),
        F.coalesce("_z", F.lit(True)).alias("confidence_zero_at_gaps"),
        F.coalesce("_covmin", F.lit(1.0)).alias("coverage_min"),
        F.coalesce("_conf", F.lit(0.0)).alias("label_confidence"))


def all_checks_wide(silver, grid, streams, meta) -> DataFrame:
    return session_quality(silver, grid, streams, meta).drop("coverage_min", "label_confidence")


def to_long(wide: DataFrame, names=CHECK_ORDER) -> DataFrame:
    """Wide boolean check columns → ``checks(session_id, name, status)``."""
    present = [n for n in names if n in wide.columns]
    arr = F.array(*[F.struct(F.lit(n).alias("name"), _status(F.col(n)).alias("status"))
                    for n in present])
    return wide.select("session_id", F.inline(arr))


def run_checks(silver, grid, streams, meta) -> DataFrame:
    return to_long(all_checks_wide(silver, grid, streams, meta))
