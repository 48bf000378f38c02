"""Catalog, part 2: Gold exports (K3–K8), sub-frame bursts (F1–F2) and
topology-derived features (D1–D8) with their DuckDB oracles."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import round6
from ..operators import derived as dv
from ..operators import exports as ex
from ..operators.grid import grid_from_bounds
from ..operators.subframe import compute_R, subframes
from ..schemas import DATASET_ID_PREFIX
from ..sources import driver_tables as dt
from . import sql_events as q
from .catalog import KEYS, _ev, register

DEVS = ["click", "error", "purchase", "signup", "view"]

_EPISODES = """
ep AS (SELECT session_id, row_number() OVER (ORDER BY session_id) - 1 AS episode_index, length,
              coalesce(sum(length) OVER (ORDER BY session_id ROWS BETWEEN UNBOUNDED PRECEDING
                                         AND 1 PRECEDING), 0)::BIGINT AS index_offset
       FROM (SELECT session_id, count(DISTINCT frame_index) AS length FROM sl GROUP BY 1)),
obs AS (SELECT session_id, frame_index, t_ref_us, {cols} FROM sl GROUP BY session_id, frame_index, t_ref_us)"""


def _obs_cols():
    cols = []
    for d in DEVS:
        f = f"{d}.value"
        cols.append(f"any_value(CASE WHEN device_id = '{d}' THEN value END) AS \"observation.{f}\"")
        cols.append(f"any_value(CASE WHEN device_id = '{d}' THEN confidence::FLOAT END) "
                    f"AS \"observation.{f}.confidence\"")
    return ", ".join(cols)


def _obs_names():
    out = []
    for d in DEVS:
        out += [f'"observation.{d}.value"', f'"observation.{d}.value.confidence"']
    return ", ".join(out)


_EP_CTES = _EPISODES.format(cols=_obs_cols())


@register("lerobot_frames", q.with_more(_EP_CTES, f"""
SELECT o.session_id, {_obs_names()}, (o.t_ref_us / 1e6)::FLOAT AS timestamp, o.frame_index,
       e.episode_index, e.index_offset + o.frame_index AS "index", e.episode_index AS task_index
FROM obs o JOIN ep e USING (session_id)"""))
def lerobot_frames_q(spark, sf):
    e = _ev(spark, sf)
    return ex.lerobot_frames(e["silver"], e["streams"])


@register("lerobot_features", q.with_("""
SELECT DISTINCT 'observation.' || feature AS feature, 'float32' AS dtype,
       CASE WHEN len(shape) > 0 THEN shape ELSE [1] END AS shape, units FROM feat
UNION ALL SELECT DISTINCT 'observation.' || feature || '.confidence', 'float32', [1], 'none' FROM feat
UNION ALL SELECT 'timestamp', 'float32', [1], 's'
UNION ALL SELECT 'frame_index', 'int64', [1], NULL
UNION ALL SELECT 'episode_index', 'int64', [1], NULL
UNION ALL SELECT 'index', 'int64', [1], NULL
UNION ALL SELECT 'task_index', 'int64', [1], NULL"""))
def lerobot_features_q(spark, sf):
    return ex.lerobot_features(dt.event_streams(spark, sf)).distinct()


@register("lerobot_episodes", q.with_more(_EP_CTES, """
SELECT session_id, episode_index, [session_id] AS tasks, length FROM ep"""))
def lerobot_episodes_q(spark, sf):
    return ex.lerobot_episodes(_ev(spark, sf)["silver"])


@register("rlds_steps", q.with_more(_EP_CTES, f"""
SELECT o.session_id, {_obs_names()}, 0::FLOAT AS reward, 1::FLOAT AS discount,
       o.frame_index = b.f0 AS is_first, o.frame_index = b.f1 AS is_last,
       o.frame_index = b.f1 AS is_terminal, o.frame_index
FROM obs o JOIN (SELECT session_id, min(frame_index) AS f0, max(frame_index) AS f1 FROM obs GROUP BY 1) b
USING (session_id)"""))
def rlds_steps_q(spark, sf):
    e = _ev(spark, sf)
    return ex.rlds_steps(e["silver"], e["streams"])


@register("rlds_episodes", q.with_("""
SELECT session_id AS episode_id, 'unknown' AS outcome, count(DISTINCT frame_index) AS num_steps,
       '0.1.0' AS version, session_id,
       'ds_' || session_id || '_' || substr(sha256('{DATASET_ID_PREFIX}' || session_id), 1, 12) AS dataset_id
FROM sl GROUP BY session_id""".replace("{DATASET_ID_PREFIX}", DATASET_ID_PREFIX)))
def rlds_episodes_q(spark, sf):
    from ..operators.provenance import dataset_id
    e = _ev(spark, sf)
    ids = e["session_meta"].select("session_id", dataset_id("session_id").alias("dataset_id"))
    return ex.rlds_episodes(e["silver"], ids)


@register("message_log_export", q.with_("""
SELECT s.session_id, f.feature AS topic, (s.t_ref_us - t.t0) * 1000 AS log_time_ns,
       (s.t_ref_us - t.t0) * 1000 AS publish_time_ns, s.t_ref_us, s.value,
       round(s.confidence, 6) AS confidence
FROM sl s JOIN feat f USING (session_id, device_id, stream_id)
JOIN (SELECT session_id, min(t_ref_us) AS t0 FROM sl GROUP BY 1) t USING (session_id)
WHERE s.valid"""))
def message_log_export_q(spark, sf):
    e = _ev(spark, sf)
    m = ex.message_log(e["silver"], e["streams"])
    return m.select("session_id", "topic", "log_time_ns", "publish_time_ns", "t_ref_us", "value",
                    round6("confidence").alias("confidence"))


_TRAINER = f"""
SELECT s.session_id, f.feature, s.frame_index // {ex.TRAINER_BATCH_FRAMES} AS batch_id,
       any_value(n.num_samples) AS num_samples,
       min(s.frame_index) AS frame_start, count(*)::INT AS n_frames,
       list(s.value ORDER BY s.frame_index) AS "values",
       list(s.confidence::FLOAT ORDER BY s.frame_index) AS confidence,
       list(s.valid::TINYINT ORDER BY s.frame_index) AS valid,
       list((s.t_ref_us / 1e6)::FLOAT ORDER BY s.frame_index) AS timestamp
FROM sl s JOIN feat f USING (session_id, device_id, stream_id)
JOIN (SELECT session_id, count(DISTINCT frame_index) AS num_samples FROM sl GROUP BY 1) n USING (session_id)
GROUP BY 1, 2, 3"""


@register("trainer_batches", q.with_(_TRAINER))
def trainer_batches_q(spark, sf):
    e = _ev(spark, sf)
    return ex.trainer_batches(e["silver"], e["streams"])


@register("trainer_batches_long", q.with_(_TRAINER, session=q.ONE))
def trainer_batches_long_q(spark, sf):
    """K8 over all events as one session, which is longer than a chunk."""
    e = _ev(spark, sf, "all")
    return ex.trainer_batches(e["silver"], e["streams"])


# ---------------------------------------------------------------------------
# F1–F2 sub-frame bursts (B8: events as the high-rate stream, 6 h anchors)
# ---------------------------------------------------------------------------
ANCHOR_US = 6 * 3600 * 1_000_000
SUB_RATE_HZ = 1e6 / (30 * 60 * 1_000_000)     # nominal high rate: one sample per 30 min
R_SUB = compute_R(SUB_RATE_HZ, 1e6 / ANCHOR_US)


@register("subframe", q.with_more(f"""
anchors AS (SELECT session_id, anchor_index, lo + anchor_index * {ANCHOR_US} AS t_anchor
            FROM (SELECT session_id, lo, unnest(range(0, (hi - lo) // {ANCHOR_US} + 1)) AS anchor_index
                  FROM bounds)),
frames AS (SELECT a.session_id, a.anchor_index AS frame_index, a.t_anchor AS t_start_us,
                  b.t_anchor AS t_end_us
           FROM anchors a JOIN anchors b ON a.session_id = b.session_id
                                        AND b.anchor_index = a.anchor_index + 1),
asg AS (SELECT p.*, f.frame_index FROM payload p JOIN frames f ON p.session_id = f.session_id
        AND p.t_us >= f.t_start_us AND p.t_us < f.t_end_us),
rk AS (SELECT *, row_number() OVER (PARTITION BY session_id, device_id, stream_id, frame_index
                                    ORDER BY t_us, "row") AS r FROM asg),
agg AS (SELECT session_id, device_id, stream_id, frame_index, count(*) AS n,
               list(value ORDER BY r) FILTER (WHERE r <= {R_SUB}) AS kept FROM rk GROUP BY ALL),
sub AS (SELECT f.session_id, s.device_id, s.stream_id, f.frame_index, f.t_start_us, f.t_end_us,
               least(coalesce(a.n, 0), {R_SUB}) AS m, a.kept
        FROM frames f JOIN streams s USING (session_id)
        LEFT JOIN agg a USING (session_id, device_id, stream_id, frame_index))""", f"""
SELECT session_id, device_id, stream_id, frame_index, t_start_us, t_end_us, m::INT AS m_k, m > 0 AS valid,
       CASE WHEN m > 0 THEN list_transform(range(1, {R_SUB + 1}), lambda i: kept[least(i, m)])
            ELSE list_transform(range({R_SUB}), lambda i: [0::FLOAT, 0::FLOAT]) END AS samples
FROM sub"""))
def subframe_q(spark, sf):
    s = dt.event_samples(spark, sf)
    bounds = s.groupBy("session_id").agg(F.min("t_us").alias("lo_us"), F.max("t_us").alias("hi_us"))
    anchors = grid_from_bounds(bounds, ANCHOR_US).select(
        "session_id", F.col("frame_index").alias("anchor_index"), F.col("t_ref_us").alias("t_anchor_us"))
    payload = dt.event_payload(spark, sf)
    return subframes(anchors, payload, dt.event_streams(spark, sf), R_SUB)


# ---------------------------------------------------------------------------
# D1–D8 on whole embeddings as (sensors, 3) with the synthetic topology
# ---------------------------------------------------------------------------
_CLUSTERS = ["thumb", "index", "middle", "ring", "palm"]
_CL_CASE = "CASE least(k // 4, 4) " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CLUSTERS)) + " END"
_DERIVED_CTES = f"""
WITH emb AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS frame_index, embedding IS NOT NULL AS valid,
                    (SELECT CAST((max(len(embedding)) + 2) // 3 * 3 AS BIGINT) FROM embeddings) AS width, embedding
             FROM embeddings),
el AS (SELECT frame_index, valid, unnest(range(width)) AS pos, unnest(list_resize(embedding, width, 0)) AS v0 FROM emb),
e2 AS (SELECT frame_index, pos, CASE WHEN valid THEN v0::FLOAT ELSE 'NaN'::FLOAT END AS v FROM el),
b AS (SELECT pos, median(v::DOUBLE) AS b0 FROM e2 WHERE NOT isnan(v) GROUP BY pos),
d AS (SELECT e2.frame_index, e2.pos, e2.v::DOUBLE - coalesce(b.b0, 'NaN'::DOUBLE) AS db
      FROM e2 LEFT JOIN b USING (pos)),
sens AS (SELECT frame_index, pos // 3 AS k, sqrt(sum(db * db)) AS r,
                sum(CASE WHEN pos % 3 = 0 THEN db END) AS dx, sum(CASE WHEN pos % 3 = 1 THEN db END) AS dy
         FROM d GROUP BY 1, 2),
cl AS (SELECT frame_index, {_CL_CASE} AS cluster_id, r, dx, dy, 0.01::DOUBLE * k AS x,
              0.01::DOUBLE * (k % 4) AS y FROM sens),
feat AS (SELECT frame_index, cluster_id, avg(r) AS normal_proxy, avg(dx) AS shear_x, avg(dy) AS shear_y,
                sqrt(avg(dx) * avg(dx) + avg(dy) * avg(dy)) AS shear_mag,
                CASE WHEN sum(r) = 0 THEN 'NaN'::DOUBLE ELSE sum(r * x) / sum(r) END AS centroid_x_m,
                CASE WHEN sum(r) = 0 THEN 'NaN'::DOUBLE ELSE sum(r * y) / sum(r) END AS centroid_y_m
         FROM cl GROUP BY 1, 2)"""
_EMB_KEYS = f"'emb' AS session_id, '{dt.EMB_DEVICE}' AS device_id, '{dt.EMB_STREAM}' AS stream_id"


def _emb(spark, sf):
    s = dt.embedding_frames(spark, sf)
    n = dt.embedding_sensors(spark, sf)
    st = dt.embedding_streams(spark, n)
    sensors, members = dt.synthetic_topology(spark, n)
    return s, st, sensors, members


@register("derived_baseline", _DERIVED_CTES + f"\nSELECT {_EMB_KEYS}, pos, round(b0, 6) AS b0 FROM b")
def derived_baseline_q(spark, sf):
    s, _st, _se, _m = _emb(spark, sf)
    return dv.baseline(s).select(*KEYS, F.col("pos").cast("long").alias("pos"), round6("b0").alias("b0"))


@register("derived_delta", _DERIVED_CTES + f"""
SELECT {_EMB_KEYS}, frame_index, list(round(db, 6) ORDER BY pos) AS db FROM d GROUP BY frame_index""")
def derived_delta_q(spark, sf):
    s, st, _se, _m = _emb(spark, sf)
    d = dv.delta_rows(s, st)
    return d.select(*KEYS, "frame_index", F.transform("db", lambda x: F.round(x, 6)).alias("db"))


def _cf(spark, sf):
    s, st, se, m = _emb(spark, sf)
    return dv.cluster_features(s, st, se, m)


@register("derived_normal", _DERIVED_CTES + f"""
SELECT {_EMB_KEYS}, frame_index, cluster_id, round(normal_proxy, 6) AS normal_proxy FROM feat""")
def derived_normal_q(spark, sf):
    return _cf(spark, sf).select(*KEYS, "frame_index", "cluster_id", round6("normal_proxy").alias("normal_proxy"))


@register("derived_shear", _DERIVED_CTES + f"""
SELECT {_EMB_KEYS}, frame_index, cluster_id, round(shear_x, 6) AS shear_x, round(shear_y, 6) AS shear_y,
       round(shear_mag, 6) AS shear_mag FROM feat""")
def derived_shear_q(spark, sf):
    return _cf(spark, sf).select(*KEYS, "frame_index", "cluster_id", round6("shear_x").alias("shear_x"),
                                 round6("shear_y").alias("shear_y"), round6("shear_mag").alias("shear_mag"))


@register("derived_centroid", _DERIVED_CTES + f"""
SELECT {_EMB_KEYS}, frame_index, cluster_id, round(centroid_x_m, 6) AS centroid_x_m,
       round(centroid_y_m, 6) AS centroid_y_m FROM feat""")
def derived_centroid_q(spark, sf):
    return _cf(spark, sf).select(*KEYS, "frame_index", "cluster_id", round6("centroid_x_m").alias("centroid_x_m"),
                                 round6("centroid_y_m").alias("centroid_y_m"))


def _derived_wide_sql():
    cols = []
    for c in _CLUSTERS:
        for f in ("normal_proxy", "shear_x", "shear_y", "shear_mag", "centroid_x_m", "centroid_y_m"):
            cols.append(f"any_value(CASE WHEN cluster_id = '{c}' THEN {f}::FLOAT END) AS \"derived.{c}.{f}\"")
    return (_DERIVED_CTES + f"\nSELECT {_EMB_KEYS}, frame_index, frame_index * 625 AS t_ref_us, "
            + ", ".join(cols) + " FROM feat GROUP BY frame_index")


@register("derived_features", _derived_wide_sql())
def derived_features_q(spark, sf):
    s, st, se, m = _emb(spark, sf)
    return dv.derived_export(s, st, se, m)
