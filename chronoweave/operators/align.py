"""Apply alignment indices to payloads → ``silver_long``.

The indices are applied, never re-derived: HOLD takes the payload row at
``source_index``; CONTINUOUS blends ``source_index`` and ``next_index`` by
``weight`` in float32. Gaps are NaN of full width and flagged ``valid=false``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import blend, nan_array, shape_width, unit_confidence
from ..schemas import STREAM_KEYS

KEYS = STREAM_KEYS


class AlignmentError(ValueError):
    pass


def _payload_side(payload: DataFrame, name: str) -> DataFrame:
    return payload.select(*KEYS, F.col("row").alias(f"_{name}_key"),
                          F.col("value").alias(f"_{name}_val"))


def gather(alignment: DataFrame, payload: DataFrame) -> DataFrame:
    """Left gather-joins of the payload rows at ``source_index`` and
    ``next_index``.

    Rows that need no value (gaps, hold kernels for the second join, -1
    indices) join on a unique negative key ``-1 - frame_index`` instead of a
    shared -1 or NULL: it never matches a payload row (rows are ≥ 0) and
    spreads those rows evenly over partitions instead of one hot key.
    """
    kern = F.col("kernel")
    need_src = F.col("valid") & (F.col("source_index") >= 0)
    need_next = need_src & (kern == "continuous") & (F.col("next_index") >= 0)
    miss = -1 - F.col("frame_index")
    a = (alignment.withColumn("_a_key", F.when(need_src, F.col("source_index")).otherwise(miss))
                  .withColumn("_b_key", F.when(need_next, F.col("next_index")).otherwise(miss)))
    return (a.join(_payload_side(payload, "a"), KEYS + ["_a_key"], "left")
             .join(_payload_side(payload, "b"), KEYS + ["_b_key"], "left")
             .drop("_a_key", "_b_key"))


def project(alignment: DataFrame, payload: DataFrame, streams: DataFrame,
            grid: DataFrame | None = None) -> DataFrame:
    """Alignment ⋈ streams ⋈ payload (twice) → ``silver_long``.

    ``alignment`` may carry ``t_ref_us`` and ``kernel`` already (the as-of
    adapter keeps them); otherwise they are joined from ``grid`` / ``streams``.
    Raises where a stream has no descriptor, an index is past the payload, or a
    payload row that is used has another width than the declared shape.
    """
    st = streams.select(*KEYS, "kernel", "shape")
    a = alignment
    if "kernel" in a.columns:
        a = a.drop("kernel")
    # Every aligned stream needs a descriptor row; one without raises below
    a = a.join(st, KEYS, "left")
    if "t_ref_us" not in a.columns:
        if grid is None:
            raise AlignmentError("alignment has no t_ref_us and no grid was given")
        a = a.join(grid.select("session_id", "frame_index", "t_ref_us"),
                   ["session_id", "frame_index"])
    g = gather(a, payload)
    width = shape_width("shape")
    kern = F.col("kernel")
    place = F.concat_ws("/", *KEYS, F.col("frame_index").cast("string"))
    wants = F.col("valid") & (F.col("source_index") >= 0)
    wants_next = wants & (kern == "continuous") & (F.col("next_index") >= 0)
    # A payload row that is used has the declared width
    wrong = lambda v: F.col(v).isNotNull() & (F.size(v) != width)
    value = (F.when(F.col("shape").isNull(), F.raise_error(F.concat(F.lit("stream without a descriptor: "), place)))
              .when((wants & F.col("_a_val").isNull()) | (wants_next & F.col("_b_val").isNull()),
                    F.raise_error(F.concat(F.lit("index past the payload: "), place)))
              .when(wrong("_a_val") | wrong("_b_val"),
                    F.raise_error(F.concat(F.lit("payload width differs from the declared shape: "), place)))
              .when(F.col("_a_val").isNull(), nan_array(width))
              .when((kern == "continuous") & F.col("_b_val").isNotNull(),
                    blend("_a_val", "_b_val", "weight"))
              .otherwise(F.col("_a_val")))
    s, c, i, scalar = unit_confidence("conf_source", "conf_clock", "conf_interp")
    return g.select(*KEYS, "frame_index", "t_ref_us", value.alias("value"),
                    F.col("valid").cast("boolean").alias("valid"),
                    scalar.alias("confidence"), s.alias("conf_source"),
                    c.alias("conf_clock"), i.alias("conf_interp"))


def frame_flags(alignment: DataFrame) -> DataFrame:
    """The columns of ``silver_long`` that need no payload (all but ``value``):
    validity and confidence of every aligned frame, without a join."""
    s, c, i, scalar = unit_confidence("conf_source", "conf_clock", "conf_interp")
    return alignment.select(*KEYS, "frame_index", "t_ref_us", F.col("valid").cast("boolean").alias("valid"),
                            scalar.alias("confidence"), s.alias("conf_source"),
                            c.alias("conf_clock"), i.alias("conf_interp"))


def out_of_range_indices(alignment: DataFrame, payload: DataFrame) -> DataFrame:
    """J1 assertion: alignment rows whose ``source_index`` names no payload row
    (numpy would raise IndexError). Empty when the indices are sound."""
    p = payload.select(*KEYS, F.col("row").alias("source_index"))
    return (alignment.where("valid and source_index >= 0")
            .join(p, KEYS + ["source_index"], "left_anti"))


def payload_width_violations(payload: DataFrame, streams: DataFrame) -> DataFrame:
    """Payload rows whose flat width differs from the declared shape."""
    st = streams.select(*KEYS, shape_width("shape").alias("width"))
    return (payload.join(st, KEYS)
            .where(F.size("value") != F.col("width")))


def assert_empty(df: DataFrame, what: str) -> None:
    """Raise when ``df`` has a row (one ``limit(1)`` job, no full collect)."""
    row = df.limit(1).collect()
    if row:
        raise AlignmentError(f"{what}: {row[0].asDict()}")
