"""Catalog, part 4: the checks and the release gate over whole tables whose rows
fail as well as pass (Q1–Q16), with their DuckDB oracles.

``checks_lines``: every order of ``lineitem`` is a session of one stream; line
numbers are the frames, ship dates the grid, so holes, repeats and steps back
in time come from the data. ``gate_orders``: every order is a session's gate
input; its key and customer set the metrics, so that all bands, hard limits and
ceilings occur.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..config import checkpoint_dir
from ..operators import checks as ck
from ..operators import gate
from ..sources import driver_tables as dt
from .catalog import KEYS, register

# The rules of the adapter, in SQL that both engines read alike.
_SESSION = "CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE concat('order_', CAST(l_orderkey AS VARCHAR(20))) END"
_VALID = "l_returnflag <> 'R'"
_CONFIDENCE = f"CASE WHEN {_VALID} OR l_tax > 0.06 THEN l_quantity / 48.0 ELSE 0.0 END"
_META = """min(CASE WHEN l_orderkey % 29 = 0 THEN '' ELSE 'ship_date' END) AS reference_clock_id,
min(CASE WHEN l_orderkey % 23 = 0 THEN '' ELSE '1.0' END) AS schema_version,
min(CASE WHEN l_orderkey % 31 = 0 THEN -1.0 WHEN l_orderkey % 3 = 0 THEN NULL ELSE 1.0 END) AS grid_rate_hz,
min(CASE WHEN l_orderkey % 19 = 0 THEN 3 ELSE 2 END) AS width,
max(CASE WHEN l_orderkey % 10 = 3 THEN 0 ELSE 1 END) AS described"""

_CHECKS = f"""
WITH sl AS (SELECT {_SESSION} AS session_id, CAST(l_linenumber - 1 AS BIGINT) AS frame_index,
                   epoch_us(l_shipdate) AS t_ref_us, {_VALID} AS valid, {_VALID} OR l_discount > 0.08 AS has_value,
                   {_CONFIDENCE} AS confidence FROM lineitem),
meta AS (SELECT {_SESSION} AS session_id, {_META} FROM lineitem GROUP BY 1),
g AS (SELECT session_id, count(*) AS n, count(DISTINCT frame_index) AS nd, min(frame_index) AS lo, max(frame_index) AS hi
      FROM sl GROUP BY 1),
dt AS (SELECT a.session_id, a.t_ref_us - b.t_ref_us AS dt FROM sl a
       JOIN sl b ON a.session_id = b.session_id AND a.frame_index = b.frame_index + 1),
d AS (SELECT session_id, min(dt) AS lo, max(dt) AS hi, median(dt) AS mid FROM dt GROUP BY 1),
s AS (SELECT session_id, bool_and(valid OR NOT has_value) AS nofab, min(confidence) >= 0 AND max(confidence) <= 1 AS unit,
             bool_and(valid OR confidence = 0) AS zero FROM sl GROUP BY 1),
w AS (SELECT m.session_id,
  g.n = g.nd AND g.lo = 0 AND g.hi = g.n - 1 AS grid_frame_index_aligned,
  m.described = 0 OR m.width = 2 AS stream_shapes_consistent,
  m.schema_version <> '' AS schema_version_present,
  d.lo IS NULL OR d.lo > 0 AS grid_monotonic,
  d.lo IS NULL OR (d.lo >= 1 AND d.hi <= 2 * d.lo) AS bounded_step,
  m.described = 0 OR s.nofab AS no_fabricated_gaps,
  m.session_id <> '' AS session_id_present,
  m.reference_clock_id <> '' AS reference_clock_present,
  CASE WHEN m.grid_rate_hz IS NOT NULL THEN m.grid_rate_hz > 0 ELSE coalesce(d.mid > 0, false) END AS grid_rate_positive,
  m.described = 1 AS has_streams,
  m.described = 0 OR s.unit AS confidence_in_unit_interval,
  m.described = 0 OR s.zero AS confidence_zero_at_gaps
  FROM meta m JOIN g USING (session_id) JOIN s USING (session_id) LEFT JOIN d USING (session_id))
SELECT session_id, {', '.join(f"CASE WHEN {c} THEN 'pass' ELSE 'fail' END AS {c}" for c in ck.CHECK_ORDER)} FROM w"""


@register("checks_lines", _CHECKS)
def checks_lines_q(spark, sf):
    """Q1–Q12 over all orders as sessions; each check has sessions that pass and that fail."""
    li = dt.read(spark, sf, "lineitem")
    session = F.expr(_SESSION).alias("session_id")
    keys = [F.lit("ship").alias("device_id"), F.lit("line").alias("stream_id")]
    nan = F.lit(float("nan")).cast("float")
    value = F.when(F.expr(f"{_VALID} OR l_discount > 0.08"),
                   F.array(F.col("l_quantity").cast("float"), F.col("l_discount").cast("float"))).otherwise(F.array(nan, nan))
    conf = F.expr(_CONFIDENCE).cast("double")
    checkpoint_dir(spark)
    silver = li.select(
        session, *keys, (F.col("l_linenumber") - 1).cast("long").alias("frame_index"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("t_ref_us"), value.alias("value"),
        F.expr(_VALID).alias("valid"), conf.alias("confidence"), F.lit(1.0).alias("conf_source"),
        F.lit(1.0).alias("conf_clock"), conf.alias("conf_interp"))
    silver = silver.checkpoint()  # the grid, its steps and the streams all read it
    meta = li.groupBy(session).agg(*[F.expr(x) for x in _META.split(",\n")])
    meta = meta.withColumn("grid_rate_hz", F.col("grid_rate_hz").cast("double")).checkpoint()
    streams = meta.where("described = 1").select("session_id", *keys, F.array("width").alias("shape"))
    grid = silver.select("session_id", "frame_index", "t_ref_us")
    w = ck.all_checks_wide(silver, grid, streams.select(*KEYS, "shape"), meta)
    return w.select("session_id", *[ck._status(F.col(c)).alias(c) for c in ck.CHECK_ORDER])


_METRICS = """concat('order_', CAST(o_orderkey AS VARCHAR(20))) AS session_id,
CAST(10000 - 15 * (o_orderkey % 12) * (o_orderkey % 3) AS DOUBLE) / 10000 AS coverage_min,
CAST(84 + o_orderkey % 17 AS DOUBLE) / 100 AS label_confidence,
CAST(o_custkey % 5 * 1250 AS DOUBLE) AS sync_resid_us,
CASE o_custkey % 6 WHEN 1 THEN 'certified' WHEN 2 THEN 'Release' WHEN 3 THEN 'NEEDS_REVIEW' WHEN 4 THEN 'BLOCKED'
     WHEN 5 THEN 'unheard_of' END AS sync_verdict,
o_orderkey % 53 = 0 AS critical_failed,
o_orderkey % 7 = 0 OR o_orderkey % 53 = 0 AS any_failed,
o_orderkey % 47 <> 0 AS lineage_signed"""

_GATE = f"""
WITH m AS (SELECT {_METRICS} FROM orders),
x AS (SELECT *, (1.0::DOUBLE - coverage_min) * 100.0::DOUBLE AS missing,
             coalesce(upper(sync_verdict), 'CERTIFIED') AS ceiling FROM m),
r AS (SELECT *, CASE
        WHEN missing >= 3.0 OR sync_resid_us >= 5000.0 OR label_confidence < 0.85 OR NOT lineage_signed OR critical_failed
          THEN 'BLOCKED'
        WHEN NOT (missing < 1.0 AND sync_resid_us < 2000.0 AND label_confidence >= 0.90 AND NOT any_failed)
          THEN 'NEEDS_REVIEW'
        WHEN missing < 0.2 AND sync_resid_us < 500.0 AND label_confidence >= 0.95 THEN 'CERTIFIED'
        ELSE 'RELEASE' END AS uncapped_verdict FROM x),
v AS (SELECT *, CASE WHEN list_position(['BLOCKED', 'NEEDS_REVIEW', 'RELEASE', 'CERTIFIED'], ceiling)
                        < list_position(['BLOCKED', 'NEEDS_REVIEW', 'RELEASE', 'CERTIFIED'], uncapped_verdict)
                     THEN ceiling ELSE uncapped_verdict END AS gate_verdict FROM r)
SELECT session_id, gate_verdict, uncapped_verdict, ceiling AS sync_ceiling, round(missing, 6) AS missing_frame_pct,
       lineage_signed, critical_failed, any_failed, gate_verdict IN ('RELEASE', 'CERTIFIED') AS ok_to_publish,
       printf('missing=%.3f%% sync_resid=%.1fus label_conf=%.3f lineage_signed=%s sync_ceiling=%s', missing, sync_resid_us,
              label_confidence, CASE WHEN lineage_signed THEN 'True' ELSE 'False' END, ceiling) AS detail
FROM v"""


@register("gate_orders", _GATE)
def gate_orders_q(spark, sf):
    """Q13–Q16 over all orders as gate inputs: every verdict, with and without each ceiling."""
    m = dt.read(spark, sf, "orders").selectExpr(*_METRICS.replace("\n     ", " ").split(",\n"))
    rep = gate.publishable(gate.release_gate(m, lineage_signed="lineage_signed"))
    return rep.select("session_id", "gate_verdict", "uncapped_verdict", "sync_ceiling",
                      F.round("missing_frame_pct", 6).alias("missing_frame_pct"), "lineage_signed", "critical_failed",
                      "any_failed", "ok_to_publish", "detail")
