"""Release gate (Q13–Q16): worst-first verdict per session with the upstream
sync verdict as a ceiling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CRITICAL_CHECKS, THRESHOLDS, VERDICTS


def verdict_rank(v) -> Column:
    """BLOCKED 0 … CERTIFIED 3; ``unknown`` → ``unknown`` (caller's default)."""
    c = F.upper(v) if not isinstance(v, str) else F.upper(F.col(v))
    e = None
    for i, name in enumerate(VERDICTS):
        e = (F.when(c == name, i) if e is None else e.when(c == name, i))
    return e


def check_flags(checks: DataFrame) -> DataFrame:
    """(session_id, critical_failed, any_failed, checks map) from the long table."""
    fail = F.col("status") == "fail"
    crit = F.col("name").isin(*CRITICAL_CHECKS)
    return checks.groupBy("session_id").agg(
        F.max((fail & crit).cast("int")).cast("boolean").alias("critical_failed"),
        F.max(fail.cast("int")).cast("boolean").alias("any_failed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "status")))).alias("checks"))


def release_gate(metrics: DataFrame, checks: DataFrame | None = None, *,
                 lineage_signed=False, thresholds: dict | None = None) -> DataFrame:
    """Q13/Q14/Q16.

    ``metrics(session_id, coverage_min, label_confidence, sync_resid_us,
    sync_verdict)`` one row per session; ``checks`` the long check table (or
    NULL-free ``critical_failed``/``any_failed`` columns already on metrics).
    ``lineage_signed`` is a bool or a column name.
    """
    th = thresholds or THRESHOLDS
    m = metrics
    if checks is not None:
        m = m.join(check_flags(checks), "session_id", "left")
    signed = F.col(lineage_signed) if isinstance(lineage_signed, str) else F.lit(bool(lineage_signed))
    missing = (F.lit(1.0) - F.col("coverage_min")) * 100.0
    resid = F.coalesce(F.col("sync_resid_us").cast("double"), F.lit(0.0))
    conf = F.col("label_confidence")

    # Spark orders NaN above every number: a NaN figure meets no band and trips no hard limit
    def below(x, limit):
        return ~F.isnan(x) & (x < limit)

    def at_least(x, limit):
        return ~F.isnan(x) & (x >= limit)

    crit = F.coalesce(F.col("critical_failed"), F.lit(False))
    anyf = F.coalesce(F.col("any_failed"), F.lit(False))
    hf, rel, ct = th["hard_fail"], th["release"], th["certified"]
    hard = (at_least(missing, hf["missing_frame_pct"]) | at_least(resid, hf["sync_resid_us"])
            | below(conf, hf["label_confidence"])
            | (F.lit(bool(hf.get("require_lineage_signed", True))) & ~signed) | crit)
    publishable = (below(missing, rel["missing_frame_pct"]) & below(resid, rel["sync_resid_us"])
                   & at_least(conf, rel["label_confidence"]) & ~anyf)
    certified = (below(missing, ct["missing_frame_pct"]) & below(resid, ct["sync_resid_us"])
                 & at_least(conf, ct["label_confidence"]))
    raw = (F.when(hard, "BLOCKED").when(~publishable, "NEEDS_REVIEW")
            .when(certified, "CERTIFIED").otherwise("RELEASE"))
    ceiling = F.coalesce(F.upper(F.col("sync_verdict")), F.lit("CERTIFIED"))
    capped = F.when(verdict_rank(raw) > F.coalesce(verdict_rank(ceiling), F.lit(3)), ceiling) \
              .otherwise(raw)
    detail = F.format_string(
        "missing=%.3f%% sync_resid=%.1fus label_conf=%.3f lineage_signed=%s sync_ceiling=%s",
        missing, resid, conf, F.when(signed, "True").otherwise("False"), ceiling)
    return m.select(
        "session_id", capped.alias("gate_verdict"), raw.alias("uncapped_verdict"),
        ceiling.alias("sync_ceiling"),
        missing.alias("missing_frame_pct"), F.col("coverage_min"), signed.alias("lineage_signed"),
        resid.alias("sync_resid_us"), conf.alias("label_confidence"),
        crit.alias("critical_failed"), anyf.alias("any_failed"),
        *([F.col("checks")] if "checks" in m.columns else []),
        detail.alias("detail"))


def publishable(report: DataFrame) -> DataFrame:
    """Q15: RELEASE or CERTIFIED may be published."""
    return report.withColumn("ok_to_publish", F.col("gate_verdict").isin("RELEASE", "CERTIFIED"))
