"""Query catalog: one Spark plan per operator of the inventory, each reading
the shared test tables through the adapters, plus its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is SQL over the
pre-registered views. Queries without an oracle get a rows-only check.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..config import checkpoint_dir
from ..functions.expr import round6
from ..operators import align, checks as ck, gate, silver as sv
from ..operators.grid import infer_grid_rate
from ..sources import driver_tables as dt
from . import sql_events as q

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


KEYS = ["session_id", "device_id", "stream_id"]


def _ev(spark, sf, mode="day", reuse=False, values=True, kernel=None, **kw):
    """Event-adapter inputs plus Silver. ``reuse``: Silver feeds several
    aggregates, so it is written once to the checkpoint folder (a reliable
    checkpoint, not a cache) and every consumer scans that. ``values=False``:
    Silver without its values, which needs no payload join. ``kernel``: only
    the streams of that kernel are gathered."""
    inp = dt.event_inputs(spark, sf, mode, **kw)
    al = inp["alignment"] if kernel is None else inp["alignment"].where(F.col("kernel") == kernel)
    silver = align.project(al, inp["payload"], inp["streams"]) if values else align.frame_flags(al)
    if reuse:
        checkpoint_dir(spark)
        silver = silver.checkpoint(eager=True)
        inp["grid"] = silver.select("session_id", "frame_index", "t_ref_us").distinct()
    inp["silver"] = silver
    return inp


# ---------------------------------------------------------------------------
# B1–B4 adapters and P1–P5 alignment
# ---------------------------------------------------------------------------
@register("grid", q.with_("SELECT session_id, frame_index, t_ref_us FROM grid"))
def grid_q(spark, sf):
    return dt.event_grid(spark, sf)


@register("asof_align", q.with_(
    "SELECT session_id, device_id, stream_id, frame_index, source_index, next_index, weight, "
    "valid FROM al"))
def asof_align_q(spark, sf):
    a = dt.event_alignment(spark, sf, with_clock=False)
    return a.select(*KEYS, "frame_index", "source_index", "next_index", "weight", "valid")


@register("confidence_components", q.with_(
    "SELECT session_id, device_id, stream_id, frame_index, round(conf_source, 6) AS conf_source, "
    "round(conf_clock, 6) AS conf_clock, round(conf_interp, 6) AS conf_interp FROM al"))
def confidence_components_q(spark, sf):
    a = dt.event_alignment(spark, sf)
    return a.select(*KEYS, "frame_index", round6("conf_source").alias("conf_source"),
                    round6("conf_clock").alias("conf_clock"), round6("conf_interp").alias("conf_interp"))


_SL_COLS = ("session_id, device_id, stream_id, frame_index, t_ref_us, value, valid, "
            "round(confidence, 6) AS confidence")


def _sl(df):
    return df.select(*KEYS, "frame_index", "t_ref_us", "value", "valid",
                     round6("confidence").alias("confidence"))


@register("align_hold", q.with_(f"SELECT {_SL_COLS} FROM sl WHERE kernel = 'hold'"))
def align_hold_q(spark, sf):
    return _sl(_ev(spark, sf, kernel="hold")["silver"])


@register("align_continuous", q.with_(f"SELECT {_SL_COLS} FROM sl WHERE kernel = 'continuous'"))
def align_continuous_q(spark, sf):
    return _sl(_ev(spark, sf, kernel="continuous")["silver"])


@register("silver_long", q.with_(
    "SELECT session_id, device_id, stream_id, frame_index, t_ref_us, value, valid, "
    "round(confidence, 6) AS confidence, round(conf_source, 6) AS conf_source, "
    "round(conf_clock, 6) AS conf_clock, round(conf_interp, 6) AS conf_interp FROM sl"))
def silver_long_q(spark, sf):
    s = _ev(spark, sf)["silver"]
    return s.select(*KEYS, "frame_index", "t_ref_us", "value", "valid",
                    *[round6(c).alias(c) for c in ("confidence", "conf_source", "conf_clock", "conf_interp")])


@register("confidence_fold", q.with_(
    "SELECT session_id, device_id, stream_id, frame_index, round(confidence, 6) AS confidence "
    "FROM sl"))
def confidence_fold_q(spark, sf):
    s = _ev(spark, sf, values=False)["silver"]
    return s.select(*KEYS, "frame_index", round6("confidence").alias("confidence"))


@register("payload_width_check", q.with_(
    "SELECT p.session_id, p.device_id, p.stream_id, count(*) AS n_rows, "
    "sum(CASE WHEN len(p.value) <> s.width THEN 1 ELSE 0 END)::BIGINT AS n_bad "
    "FROM payload p JOIN streams s USING (session_id, device_id, stream_id) "
    "GROUP BY ALL"))
def payload_width_check_q(spark, sf):
    return _width_counts(dt.event_payload(spark, sf), dt.event_streams(spark, sf))


@register("payload_width_mismatch", q.with_(
    "SELECT session_id, device_id, stream_id, count(*) AS n_rows, "
    "sum(CASE WHEN len(value) <> CASE WHEN device_id = 'error' THEN 6 ELSE 2 END THEN 1 ELSE 0 END)::BIGINT AS n_bad "
    "FROM payload GROUP BY ALL"))
def payload_width_mismatch_q(spark, sf):
    """P14 against descriptors that declare another shape for one device."""
    st = dt.event_streams(spark, sf)
    wrong = st.withColumn("shape", F.when(F.col("device_id") == "error", F.array(F.lit(2), F.lit(3))).otherwise(F.col("shape")))
    return _width_counts(dt.event_payload(spark, sf), wrong)


def _width_counts(p, st):
    bad = align.payload_width_violations(p, st).groupBy(*KEYS).agg(F.count("*").alias("n_bad"))
    return (p.groupBy(*KEYS).agg(F.count("*").alias("n_rows")).join(bad, KEYS, "left")
            .select(*KEYS, "n_rows", F.coalesce("n_bad", F.lit(0)).alias("n_bad")))


# ---------------------------------------------------------------------------
# Silver aggregates (A1–A6), naming and wide projection
# ---------------------------------------------------------------------------
@register("coverage", q.with_(
    "SELECT session_id, device_id, stream_id, round(avg(valid::INT), 6) AS coverage "
    "FROM sl GROUP BY ALL"))
def coverage_q(spark, sf):
    e = _ev(spark, sf, values=False)
    return sv.stream_coverage(e["silver"], e["streams"]).select(*KEYS, round6("coverage").alias("coverage"))


@register("coverage_min", q.with_(
    "SELECT session_id, round(min(c), 6) AS coverage_min FROM "
    "(SELECT session_id, device_id, stream_id, avg(valid::INT) AS c FROM sl GROUP BY ALL) "
    "GROUP BY session_id"))
def coverage_min_q(spark, sf):
    e = _ev(spark, sf, values=False)
    cov = sv.stream_coverage(e["silver"], e["streams"])
    return sv.coverage_min(cov, e["session_meta"]).select("session_id", round6("coverage_min").alias("coverage_min"))


@register("mean_confidence", q.with_(
    "SELECT m.session_id, round(coalesce(avg(x.c), 0.0), 6) AS label_confidence FROM meta m "
    "LEFT JOIN (SELECT session_id, device_id, stream_id, avg(confidence) AS c FROM sl "
    "WHERE valid GROUP BY ALL) x USING (session_id) GROUP BY m.session_id"))
def mean_confidence_q(spark, sf):
    e = _ev(spark, sf, values=False)
    return sv.mean_confidence(e["silver"], e["session_meta"]).select(
        "session_id", round6("label_confidence").alias("label_confidence"))


@register("export_counts", q.with_(
    "SELECT g.session_id, g.frame_count, coalesce(s.sample_count, 0) AS sample_count FROM "
    "(SELECT session_id, count(*) AS frame_count FROM grid GROUP BY 1) g LEFT JOIN "
    "(SELECT session_id, sum(valid::BIGINT)::BIGINT AS sample_count FROM sl GROUP BY 1) s USING (session_id)"))
def export_counts_q(spark, sf):
    e = _ev(spark, sf, values=False)
    return sv.export_counts(e["silver"], e["grid"])


@register("value_range", q.with_(
    "SELECT session_id, device_id, stream_id, min(x) AS value_min, max(x) AS value_max "
    "FROM (SELECT session_id, device_id, stream_id, unnest(value) AS x FROM sl WHERE valid) "
    "WHERE NOT isnan(x) GROUP BY ALL"))
def value_range_q(spark, sf):
    st = sv.stream_stats(_ev(spark, sf)["silver"])
    return st.where("value_min is not null").select(*KEYS, "value_min", "value_max")


@register("grid_rate", q.with_(
    "SELECT session_id, round(CASE WHEN median(dt) > 0 THEN 1e6 / median(dt) ELSE 0.0 END, 6) "
    "AS grid_rate_hz FROM (SELECT session_id, t_ref_us - lag(t_ref_us) OVER "
    "(PARTITION BY session_id ORDER BY frame_index) AS dt FROM grid) GROUP BY session_id"))
def grid_rate_q(spark, sf):
    r = infer_grid_rate(dt.event_grid(spark, sf))
    return r.select("session_id", round6("grid_rate_hz").alias("grid_rate_hz"))


@register("feature_names", q.with_(
    "SELECT session_id, device_id, stream_id, feature FROM feat"))
def feature_names_q(spark, sf):
    return sv.feature_names(dt.event_streams(spark, sf)).select(*KEYS, "feature")


@register("feature_names_mixed", q.with_(
    "SELECT session_id, device_id, stream_id, CASE WHEN count(*) OVER (PARTITION BY session_id, stream_id) = 1 "
    "THEN stream_id ELSE device_id || '.' || stream_id END AS feature FROM "
    "(SELECT session_id, device_id, CASE WHEN kernel = 'hold' THEN 'alert' ELSE device_id || '_value' END AS stream_id "
    "FROM streams)"))
def feature_names_mixed_q(spark, sf):
    """P6/A8 where some stream ids are unique in their session and others are not."""
    st = dt.event_streams(spark, sf)
    st = st.withColumn("stream_id", F.when(F.col("kernel") == "hold", "alert")
                       .otherwise(F.concat("device_id", F.lit("_value"))))
    return sv.feature_names(st).select(*KEYS, "feature")


@register("stream_meta", q.with_(
    "SELECT f.session_id, f.feature, f.device_id || '::' || f.stream_id AS key, f.payload_kind, "
    "f.units, f.kernel, f.width, round(c.cov, 6) AS coverage FROM feat f JOIN "
    "(SELECT session_id, device_id, stream_id, avg(valid::INT) AS cov FROM sl GROUP BY ALL) c "
    "USING (session_id, device_id, stream_id)"))
def stream_meta_q(spark, sf):
    e = _ev(spark, sf, values=False)
    m = sv.stream_meta(e["streams"], e["silver"])
    return m.select("session_id", "feature", "key", "payload_kind", "units", "kernel", "width",
                    round6("coverage").alias("coverage"))


def _wide_sql():
    devs = ["click", "error", "purchase", "signup", "view"]
    cols = []
    for d in devs:
        f = f"{d}.value"
        hit = f"device_id = '{d}'"
        for j in range(2):
            cols.append(f'any_value(CASE WHEN {hit} THEN value[{j + 1}] END) AS "{f}.c{j:03d}"')
        cols.append(f'any_value(CASE WHEN {hit} THEN valid END) AS "{f}.valid"')
        cols.append(f'any_value(CASE WHEN {hit} THEN confidence::FLOAT END) AS "{f}.confidence"')
    return q.with_("SELECT session_id, frame_index, t_ref_us, " + ", ".join(cols)
                   + " FROM sl GROUP BY session_id, frame_index, t_ref_us")


@register("silver_wide", _wide_sql())
def silver_wide_q(spark, sf):
    e = _ev(spark, sf)
    return sv.silver_wide(sv.with_feature(e["silver"], e["streams"]), sv.feature_list(e["streams"]))


# ---------------------------------------------------------------------------
# Checks (Q1–Q12) and gate (Q13–Q16)
# ---------------------------------------------------------------------------
_CHECK_SQL = {
    "check_schema": """
SELECT m.session_id,
  CASE WHEN g.n = g.nd AND g.fmin = 0 AND g.fmax = g.n - 1 THEN 'pass' ELSE 'fail' END AS grid_frame_index_aligned,
  CASE WHEN coalesce(s.ok, true) THEN 'pass' ELSE 'fail' END AS stream_shapes_consistent,
  CASE WHEN length(m.schema_version) > 0 THEN 'pass' ELSE 'fail' END AS schema_version_present
FROM meta m
LEFT JOIN (SELECT session_id, count(*) AS n, count(DISTINCT frame_index) AS nd, min(frame_index) AS fmin,
                  max(frame_index) AS fmax FROM grid GROUP BY 1) g USING (session_id)
LEFT JOIN (SELECT x.session_id, bool_and(x.rows = gg.n AND x.shape_ok) AS ok
           FROM (SELECT sl.session_id, sl.device_id, sl.stream_id, count(*) AS rows,
                        bool_and(len(sl.value) = st.width) AS shape_ok
                 FROM sl JOIN streams st USING (session_id, device_id, stream_id) GROUP BY ALL) x
           JOIN (SELECT session_id, count(*) AS n FROM grid GROUP BY 1) gg USING (session_id)
           GROUP BY 1) s USING (session_id)""",
    "check_timeline": """
SELECT m.session_id,
  CASE WHEN coalesce(d.mono, true) THEN 'pass' ELSE 'fail' END AS grid_monotonic,
  CASE WHEN d.dmin IS NULL OR (d.dmin >= 1 AND d.dmax <= 2 * d.dmin) THEN 'pass' ELSE 'fail' END AS bounded_step
FROM meta m LEFT JOIN (
  SELECT session_id, bool_and(dt > 0) AS mono, min(dt) AS dmin, max(dt) AS dmax FROM (
    SELECT session_id, t_ref_us - lag(t_ref_us) OVER (PARTITION BY session_id ORDER BY frame_index) AS dt
    FROM grid) WHERE dt IS NOT NULL GROUP BY 1) d USING (session_id)""",
    "check_gaps": """
SELECT m.session_id,
  CASE WHEN coalesce(x.ok, true) THEN 'pass' ELSE 'fail' END AS no_fabricated_gaps
FROM meta m LEFT JOIN (
  SELECT session_id, bool_and(list_bool_and(list_transform(value, lambda v: isnan(v)))) AS ok
  FROM sl WHERE NOT valid GROUP BY 1) x USING (session_id)""",
    "check_metadata": """
SELECT m.session_id,
  CASE WHEN length(m.session_id) > 0 THEN 'pass' ELSE 'fail' END AS session_id_present,
  CASE WHEN length(m.reference_clock_id) > 0 THEN 'pass' ELSE 'fail' END AS reference_clock_present,
  CASE WHEN m.grid_rate_hz > 0 THEN 'pass' ELSE 'fail' END AS grid_rate_positive,
  CASE WHEN coalesce(s.n, 0) > 0 THEN 'pass' ELSE 'fail' END AS has_streams
FROM meta m LEFT JOIN (SELECT session_id, count(*) AS n FROM streams GROUP BY 1) s USING (session_id)""",
    "check_confidence": """
SELECT m.session_id,
  CASE WHEN coalesce(x.u, true) THEN 'pass' ELSE 'fail' END AS confidence_in_unit_interval,
  CASE WHEN coalesce(x.z, true) THEN 'pass' ELSE 'fail' END AS confidence_zero_at_gaps
FROM meta m LEFT JOIN (
  SELECT session_id, bool_and(u) AS u, bool_and(z) AS z FROM (
    SELECT session_id, device_id, stream_id,
      min(confidence) >= 0 AND max(confidence) <= 1 AND min(conf_source) >= 0 AND max(conf_source) <= 1
      AND min(conf_clock) >= 0 AND max(conf_clock) <= 1 AND min(conf_interp) >= 0
      AND max(conf_interp) <= 1 AS u,
      bool_and(valid OR confidence = 0) AS z
    FROM sl GROUP BY ALL) GROUP BY 1) x USING (session_id)""",
}

_CHECK_COLS = {
    "check_schema": ["grid_frame_index_aligned", "stream_shapes_consistent", "schema_version_present"],
    "check_timeline": ["grid_monotonic", "bounded_step"],
    "check_gaps": ["no_fabricated_gaps"],
    "check_metadata": ["session_id_present", "reference_clock_present", "grid_rate_positive", "has_streams"],
    "check_confidence": ["confidence_in_unit_interval", "confidence_zero_at_gaps"],
}


def _check_query(name):
    cols = _CHECK_COLS[name]

    def run(spark, sf):
        e = _ev(spark, sf, reuse=True)
        w = ck.all_checks_wide(e["silver"], e["grid"], e["streams"], e["session_meta"])
        return w.select("session_id", *[ck._status(F.col(c)).alias(c) for c in cols])
    run.__name__ = name
    return run


for _n in _CHECK_COLS:
    register(_n, q.with_(_CHECK_SQL[_n]))(_check_query(_n))

_GATE_CTES = """
  cov AS (SELECT session_id, min(c) AS coverage_min FROM
          (SELECT session_id, device_id, stream_id, avg(valid::INT) AS c FROM sl GROUP BY ALL) GROUP BY 1),
  conf AS (SELECT m.session_id, coalesce(avg(x.c), 0.0) AS label_confidence FROM meta m
           LEFT JOIN (SELECT session_id, device_id, stream_id, avg(confidence) AS c FROM sl
                      WHERE valid GROUP BY ALL) x USING (session_id) GROUP BY 1),
  gaps AS (SELECT m.session_id, coalesce(bool_and(list_bool_and(list_transform(s.value, lambda v: isnan(v)))), true) AS nofab
           FROM meta m LEFT JOIN (SELECT * FROM sl WHERE NOT valid) s USING (session_id) GROUP BY 1),
  zero AS (SELECT session_id, bool_and(valid OR confidence = 0) AS z FROM sl GROUP BY 1),
  g AS (SELECT m.session_id, (1.0 - cov.coverage_min) * 100.0 AS missing, m.sync_resid_us AS resid,
               conf.label_confidence AS conf, NOT gaps.nofab AS crit, (NOT gaps.nofab OR NOT zero.z) AS anyf,
               coalesce(upper(m.sync_verdict), 'CERTIFIED') AS ceiling
        FROM meta m JOIN cov USING (session_id) JOIN conf USING (session_id)
        JOIN gaps USING (session_id) JOIN zero USING (session_id)),
  v AS (SELECT *, CASE
          WHEN missing >= 3.0 OR resid >= 5000.0 OR conf < 0.85 OR NOT {signed} OR crit THEN 'BLOCKED'
          WHEN NOT (missing < 1.0 AND resid < 2000.0 AND conf >= 0.90 AND NOT anyf) THEN 'NEEDS_REVIEW'
          WHEN missing < 0.2 AND resid < 500.0 AND conf >= 0.95 THEN 'CERTIFIED'
          ELSE 'RELEASE' END AS raw FROM g)"""
_GATE_BODY = """
SELECT session_id, raw AS gate_verdict, round(missing, 6) AS missing_frame_pct,
       round(conf, 6) AS label_confidence, crit AS critical_failed, anyf AS any_failed,
       raw IN ('RELEASE', 'CERTIFIED') AS ok_to_publish
FROM v"""


def _gate(spark, sf, signed):
    e = _ev(spark, sf, reuse=True)
    meta = e["session_meta"]
    qual = ck.session_quality(e["silver"], e["grid"], e["streams"], meta)
    metrics = meta.select("session_id", "sync_resid_us", "sync_verdict").join(
        qual.select("session_id", "coverage_min", "label_confidence"), "session_id")
    checks = ck.to_long(qual)
    rep = gate.publishable(gate.release_gate(metrics, checks, lineage_signed=signed))
    return rep.select("session_id", "gate_verdict", round6("missing_frame_pct").alias("missing_frame_pct"),
                      round6("label_confidence").alias("label_confidence"), "critical_failed",
                      "any_failed", "ok_to_publish")


@register("release_gate", q.with_more(_GATE_CTES.format(signed="false"), _GATE_BODY))
def release_gate_q(spark, sf):
    """The reference's unsigned (HMAC) lineage: BLOCKED by the hard rule."""
    return _gate(spark, sf, False)


@register("publishable", q.with_more(_GATE_CTES.format(signed="true"), _GATE_BODY))
def publishable_q(spark, sf):
    """The same gate with signed lineage: verdicts driven by the metrics."""
    return _gate(spark, sf, True)
from . import catalog_gold  # noqa: E402,F401
from . import catalog_lineage  # noqa: E402,F401
from . import catalog_verdicts  # noqa: E402,F401
from . import catalog_versions  # noqa: E402,F401
