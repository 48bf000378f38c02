"""Inspection: dataset summaries and version diffs."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import round6
from ..schemas import STREAM_KEYS
from .silver import feature_names, stream_stats

KEYS = STREAM_KEYS
STREAM_FIELDS = ("device_id", "payload_kind", "shape", "units", "kernel")


def summarize_streams(silver: DataFrame, streams: DataFrame) -> DataFrame:
    """I1 per stream: descriptor fields, coverage, confidence mean over valid
    frames (0.0 without), NaN-skipping value range over valid frames, all
    rounded to 6 digits. A stream without frames has coverage 0.0."""
    st = stream_stats(silver)
    fn = feature_names(streams)
    j = fn.join(st, KEYS, "left")
    return j.select("session_id", F.col("feature").alias("stream"), *STREAM_FIELDS,
                    round6(F.coalesce("coverage", F.lit(0.0))).alias("coverage"),
                    round6(F.coalesce("confidence_mean", F.lit(0.0))).alias("confidence_mean"),
                    F.col("value_min").cast("double").alias("value_min"),
                    F.col("value_max").cast("double").alias("value_max"))


def summarize_sessions(silver: DataFrame, streams: DataFrame, grid: DataFrame,
                       meta: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """I1/I2 per session: identity, rate, n_grid, coverage_min (no streams →
    1.0); from a manifest also verdict, content hash and formats."""
    per = summarize_streams(silver, streams)
    cm = per.groupBy("session_id").agg(F.min("coverage").alias("_cm"))
    n = grid.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_grid"))
    out = (meta.select("session_id", "reference_clock_id", "grid_rate_hz")
           .join(n, "session_id", "left").join(cm, "session_id", "left")
           .select("session_id", "reference_clock_id", "grid_rate_hz",
                   F.coalesce("n_grid", F.lit(0)).cast("long").alias("n_grid"),
                   round6(F.coalesce("_cm", F.lit(1.0))).alias("coverage_min")))
    if manifest is not None:
        out = out.join(manifest.select("session_id", "qa_verdict", "content_hash", "formats"),
                       "session_id", "left")
    return out


def diff_streams(a: DataFrame, b: DataFrame) -> DataFrame:
    """I3 per stream: full outer join of two stream summaries by (session,
    stream): ``added`` (absent in a), ``removed`` (absent in b), ``changed``
    when any field differs (null-safe), else ``same``; deltas b − a rounded."""
    cols = list(STREAM_FIELDS) + ["coverage", "confidence_mean"]
    x = a.select("session_id", "stream", *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(True).alias("_a"))
    y = b.select("session_id", "stream", *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(True).alias("_b"))
    j = x.join(y, ["session_id", "stream"], "full")
    same = None
    for c in cols:
        e = F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        same = e if same is None else same & e
    status = (F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed")
               .when(same, "same").otherwise("changed"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return j.select("session_id", "stream", status.alias("status"),
                    F.when(both, round6(F.col("b_coverage") - F.col("a_coverage"))).alias("coverage_delta"),
                    F.when(both, round6(F.col("b_confidence_mean") - F.col("a_confidence_mean")))
                    .alias("confidence_delta"))


def diff_sessions(a: DataFrame, b: DataFrame) -> DataFrame:
    """I3 per session: identical-hash flag (needs a non-empty hash), n_grid
    delta, verdict pair, coverage_min pair."""
    def pick(df, p):
        cols = [F.col(c).alias(f"{p}_{c}") for c in ("n_grid", "coverage_min", "qa_verdict", "content_hash")
                if c in df.columns]
        return df.select("session_id", *cols)
    j = pick(a, "a").join(pick(b, "b"), "session_id", "full")
    ident = (F.coalesce(F.length("a_content_hash"), F.lit(0)) > 0) & \
        F.col("a_content_hash").eqNullSafe(F.col("b_content_hash")) \
        if "a_content_hash" in j.columns and "b_content_hash" in j.columns else F.lit(False)
    return j.select("session_id", F.coalesce(ident, F.lit(False)).alias("content_hash_identical"),
                    (F.col("b_n_grid") - F.col("a_n_grid")).alias("n_grid_delta"),
                    *([F.col("a_qa_verdict"), F.col("b_qa_verdict")] if "a_qa_verdict" in j.columns else []),
                    F.col("a_coverage_min"), F.col("b_coverage_min"))
