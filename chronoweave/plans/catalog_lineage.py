"""Catalog, part 3: identity and provenance (K11–K16, A7), inspection
(I1–I3), payload sources (S1–S11), lineage rows (P10, P15) and clock
models (B2), with their DuckDB oracles."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.uri import normalize_uri, strip_fragment, uri_rest, uri_scheme
from ..operators import inspect as insp
from ..operators import provenance as pv
from ..operators import silver as sv
from ..operators.asof import number_rows
from ..operators.grid import apply_clock
from ..schemas import DATASET_ID_PREFIX, MAG_KIND, TEMP_KIND
from ..sources import driver_tables as dt
from ..sources import messages as msg
from ..sources import payload as pl
from . import sql_events as q
from .catalog import KEYS, _ev, register

# ---------------------------------------------------------------------------
# K11–K15 on event sessions and document digests
# ---------------------------------------------------------------------------
_DSID = f"'ds_' || session_id || '_' || substr(sha256('{DATASET_ID_PREFIX}' || session_id), 1, 12)"


@register("dataset_id", q.with_(f"SELECT session_id, {_DSID} AS dataset_id FROM meta"))
def dataset_id_q(spark, sf):
    m = dt.event_session_meta(spark, sf)
    return m.select("session_id", pv.dataset_id("session_id").alias("dataset_id"))


_DOC_DIGESTS = "SELECT sha256(text) AS h FROM documents WHERE text IS NOT NULL"


@register("content_hash", f"""
WITH d AS ({_DOC_DIGESTS}),
l1 AS (SELECT substr(h, 1, 4) AS p, sha256(string_agg(h, '' ORDER BY h)) AS d FROM d GROUP BY 1),
l2 AS (SELECT substr(p, 1, 2) AS p, sha256(string_agg(d, '' ORDER BY p)) AS d FROM l1 GROUP BY 1)
SELECT sha256(string_agg(d, '' ORDER BY p)) AS content_hash, (SELECT count(*) FROM d) AS n_leaves FROM l2""")
def content_hash_q(spark, sf):
    d = dt.read(spark, sf, "documents").where("text is not null").select(F.sha2("text", 256).alias("sha256"))
    return pv.content_hash_tree(d)


def _merkle_sql(leaves_sql: str, layers: int = 40) -> str:
    parts = [f"L0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS i, h AS d FROM ({leaves_sql}))",
             "N0 AS (SELECT count(*) AS n FROM L0)"]
    for k in range(layers):
        parts.append(
            f"L{k + 1} AS (SELECT g AS i, CASE WHEN (SELECT n FROM N{k}) <= 1 THEN max(d) ELSE "
            f"sha256(unhex(max(d) FILTER (WHERE s = 0)) || unhex(coalesce(max(d) FILTER (WHERE s = 1), "
            f"max(d) FILTER (WHERE s = 0)))) END AS d "
            f"FROM (SELECT i // 2 AS g, i % 2 AS s, d FROM L{k}) GROUP BY g)")
        parts.append(f"N{k + 1} AS (SELECT count(*) AS n FROM L{k + 1})")
    parts.append(f"R AS (SELECT coalesce((SELECT max(d) FROM L{layers}), sha256('')) AS merkle_root, "
                 f"(SELECT n FROM N0) AS n_leaves)")
    return "WITH " + ",\n".join(parts)


_MERKLE = _merkle_sql(_DOC_DIGESTS)


@register("merkle_root", _MERKLE + "\nSELECT n_leaves, merkle_root FROM R")
def merkle_root_q(spark, sf):
    d = dt.read(spark, sf, "documents").where("text is not null").select(F.sha2("text", 256).alias("sha256"))
    return pv.merkle_root(d)


_IPAD, _OPAD = pv._hmac_pads(pv.HMAC_LOCAL_KEY)


@register("root_stamp", _MERKLE + f"""
SELECT merkle_root,
       sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || unhex(merkle_root)))) AS signature,
       'hmac-sha256' AS algorithm, false AS signed FROM R""")
def root_stamp_q(spark, sf):
    d = dt.read(spark, sf, "documents").where("text is not null").select(F.sha2("text", 256).alias("sha256"))
    return pv.stamp(pv.merkle_root(d)).select("merkle_root", "signature", "algorithm", "signed")


@register("file_hashes")
def file_hashes_q(spark, sf):
    """K12 (rows-only): SHA-256 of every input table file, on executors."""
    return pv.file_hashes(spark, f"{sf}/*.parquet")


@register("source_hashes")
def source_hashes_q(spark, sf):
    """A7 (rows-only): each event session's source file digests, sorted."""
    ev = dt.read(spark, sf, "events")
    # each session's source files, as recorded by the scan itself
    src = ev.select(dt._session_col("day").alias("session_id"),
                    F.col("_metadata.file_path").alias("path")).distinct()
    h = pv.file_hashes(spark, f"{sf}/events.parquet").select("path", "sha256")
    return pv.source_hashes(src.join(h, "path"))


@register("provenance")
def provenance_q(spark, sf):
    """K16 (rows-only): per session, Merkle root over Silver chunk digests,
    HMAC stamp, dataset id, content hash."""
    e = _ev(spark, sf)
    chunks = pv.silver_chunk_digests(e["silver"])
    roots = pv.merkle_root(chunks, keys=["session_id"])
    ids = e["session_meta"].select("session_id", pv.dataset_id("session_id").alias("dataset_id"))
    rec = pv.provenance_records(ids, roots, version="0.1.0", schema_version="1.0")
    return rec.join(pv.content_hash_tree(chunks, keys=["session_id"]).drop("n_leaves"), "session_id")


# ---------------------------------------------------------------------------
# I1–I3 summaries and diff (B7: second version renames one device, 20 min tolerance)
# ---------------------------------------------------------------------------
_SUMMARY_CTES = """
stats AS (SELECT session_id, device_id, stream_id, avg(valid::INT) AS coverage,
                 avg(CASE WHEN valid THEN confidence END) AS cm FROM {p}sl GROUP BY ALL),
rng AS (SELECT session_id, device_id, stream_id, min(x) AS vmin, max(x) AS vmax FROM
        (SELECT session_id, device_id, stream_id, unnest(value) AS x FROM {p}sl WHERE valid)
        WHERE NOT isnan(x) GROUP BY ALL),
{p}summ AS (SELECT f.session_id, f.feature AS stream, f.device_id, f.payload_kind, f.shape, f.units, f.kernel,
                round(coalesce(s.coverage, 0.0), 6) AS coverage, round(coalesce(s.cm, 0.0), 6) AS confidence_mean,
                r.vmin::DOUBLE AS value_min, r.vmax::DOUBLE AS value_max
         FROM {p}feat f LEFT JOIN stats s USING (session_id, device_id, stream_id)
         LEFT JOIN rng r USING (session_id, device_id, stream_id))"""


@register("summary", q.with_more(_SUMMARY_CTES.format(p=""), "SELECT * FROM summ"))
def summary_q(spark, sf):
    e = _ev(spark, sf)
    return insp.summarize_streams(e["silver"], e["streams"])


@register("session_summary", q.with_more(_SUMMARY_CTES.format(p=""), """
SELECT m.session_id, m.reference_clock_id, m.grid_rate_hz, coalesce(g.n, 0) AS n_grid,
       round(coalesce(c.cm, 1.0), 6) AS coverage_min
FROM meta m LEFT JOIN (SELECT session_id, count(*) AS n FROM grid GROUP BY 1) g USING (session_id)
LEFT JOIN (SELECT session_id, min(coverage) AS cm FROM summ GROUP BY 1) c USING (session_id)"""))
def session_summary_q(spark, sf):
    e = _ev(spark, sf)
    return insp.summarize_sessions(e["silver"], e["streams"], e["grid"], e["session_meta"])


_B_DEVICE = "CASE WHEN event_type = 'error' THEN 'fault' ELSE event_type END"
_B_TOL = 1_200_000_000
_DIFF_SUMMARIES = (_SUMMARY_CTES.format(p="").strip() + ",\n"
             + _SUMMARY_CTES.format(p="b_").strip().replace("stats AS", "b_stats AS")
             .replace("rng AS", "b_rng AS").replace("JOIN stats s", "JOIN b_stats s")
             .replace("JOIN rng r", "JOIN b_rng r") + "\n")
_DIFF_SQL = "WITH " + q.ctes() + ",\n" + q.ctes(pre="b_", device=_B_DEVICE, tol=_B_TOL) + ",\n" + _DIFF_SUMMARIES
_RENAME_SQL = "WITH " + q.ctes() + ",\n" + q.ctes(pre="b_", device=_B_DEVICE) + ",\n" + _DIFF_SUMMARIES


def _versions(spark, sf, reuse):
    a = _ev(spark, sf, reuse=reuse)
    b = _ev(spark, sf, reuse=reuse, device_map={"error": "fault"}, tolerance_us=_B_TOL)
    return a, b


_DIFF_ROWS = """
SELECT coalesce(a.session_id, b.session_id) AS session_id, coalesce(a.stream, b.stream) AS stream,
       CASE WHEN a.stream IS NULL THEN 'added' WHEN b.stream IS NULL THEN 'removed'
            WHEN a.device_id IS NOT DISTINCT FROM b.device_id AND a.payload_kind IS NOT DISTINCT FROM b.payload_kind
             AND a.shape IS NOT DISTINCT FROM b.shape AND a.units IS NOT DISTINCT FROM b.units
             AND a.kernel IS NOT DISTINCT FROM b.kernel AND a.coverage IS NOT DISTINCT FROM b.coverage
             AND a.confidence_mean IS NOT DISTINCT FROM b.confidence_mean THEN 'same' ELSE 'changed' END AS status,
       round(b.coverage - a.coverage, 6) AS coverage_delta,
       round(b.confidence_mean - a.confidence_mean, 6) AS confidence_delta
FROM summ a FULL OUTER JOIN b_summ b ON a.session_id = b.session_id AND a.stream = b.stream"""


@register("dataset_diff", _DIFF_SQL + _DIFF_ROWS)
def dataset_diff_q(spark, sf):
    a, b = _versions(spark, sf, reuse=False)     # one Silver consumer per version
    return insp.diff_streams(insp.summarize_streams(a["silver"], a["streams"]),
                             insp.summarize_streams(b["silver"], b["streams"]))


@register("dataset_diff_renamed", _RENAME_SQL + _DIFF_ROWS)
def dataset_diff_renamed_q(spark, sf):
    """I3 of two versions that differ in one device's name: streams added, removed and the same."""
    a = _ev(spark, sf)
    b = _ev(spark, sf, device_map={"error": "fault"})
    return insp.diff_streams(insp.summarize_streams(a["silver"], a["streams"]),
                             insp.summarize_streams(b["silver"], b["streams"]))


@register("diff_summary", _DIFF_SQL + """
, sa AS (SELECT m.session_id, g.n AS n_grid, round(coalesce(c.cm, 1.0), 6) AS coverage_min FROM meta m
         JOIN (SELECT session_id, count(*) AS n FROM grid GROUP BY 1) g USING (session_id)
         LEFT JOIN (SELECT session_id, min(coverage) AS cm FROM summ GROUP BY 1) c USING (session_id)),
  sb AS (SELECT m.session_id, g.n AS n_grid, round(coalesce(c.cm, 1.0), 6) AS coverage_min FROM b_meta m
         JOIN (SELECT session_id, count(*) AS n FROM b_grid GROUP BY 1) g USING (session_id)
         LEFT JOIN (SELECT session_id, min(coverage) AS cm FROM b_summ GROUP BY 1) c USING (session_id))
SELECT coalesce(sa.session_id, sb.session_id) AS session_id, false AS content_hash_identical,
       sb.n_grid - sa.n_grid AS n_grid_delta, sa.coverage_min AS a_coverage_min, sb.coverage_min AS b_coverage_min
FROM sa FULL OUTER JOIN sb ON sa.session_id = sb.session_id""".replace("\n, sa AS", "SELECT 1 AS _x) , sa AS", 0))
def diff_summary_q(spark, sf):
    a, b = _versions(spark, sf, reuse=True)      # Silver feeds grid and stream summaries
    sa = insp.summarize_sessions(a["silver"], a["streams"], a["grid"], a["session_meta"])
    sb = insp.summarize_sessions(b["silver"], b["streams"], b["grid"], b["session_meta"])
    return insp.diff_sessions(sa, sb)


# ---------------------------------------------------------------------------
# S1–S5 payload scans over lineitem as a wide sensor table
# ---------------------------------------------------------------------------
B9_COLUMNS = {  # wide sensor column ← lineitem column
    "mag.bmm_0.bx_uT": "l_quantity", "mag.bmm_0.by_uT": "l_extendedprice",
    "mag.bmm_0.bz_uT": "l_discount", "dyn.lis_0.temp_c": "l_tax",
    "dyn.thumb.temp_degC": "l_quantity", "dyn.index.temp_degC": "l_discount",
    "dyn.middle.temp_degC": "l_tax",
}


# (l_orderkey, l_linenumber) is not unique in the test tables: the remaining
# columns break ties, so equal positions can only hold identical payloads.
B9_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax"]


def _wide(spark, sf):
    li = dt.read(spark, sf, "lineitem").select(*B9_ORDER)
    li = number_rows(li, [], B9_ORDER, t="l_orderkey", cell=1 << 12)
    return li.select("row", *[F.col(src).alias(dst) for dst, src in B9_COLUMNS.items()])


_ROWNUM = f"row_number() OVER (ORDER BY {', '.join(B9_ORDER)}) - 1 AS \"row\""


def _wide_sql(cols):
    vals = ", ".join(f"{c}::FLOAT" for c in cols)
    return f"[{vals}]"


@register("payload_scan", f"""
SELECT 'lineitem' AS session_id, 'glove_L' AS device_id, 'tactile_field' AS stream_id, {_ROWNUM},
       {_wide_sql(['l_quantity', 'l_extendedprice', 'l_discount'])} AS value FROM lineitem""")
def payload_scan_q(spark, sf):
    w = _wide(spark, sf)
    cols = pl.element_columns(MAG_KIND, "canonical", ["bmm_0"])
    return w.select(F.lit("lineitem").alias("session_id"), F.lit("glove_L").alias("device_id"),
                    F.lit("tactile_field").alias("stream_id"), "row", pl.stack_columns(w, cols).alias("value"))


@register("wide_to_payload", f"""
SELECT 'lineitem' AS session_id, 'glove_L' AS device_id, 'tactile_field' AS stream_id, 'canonical' AS layout,
       {_ROWNUM}, {_wide_sql(['l_quantity', 'l_extendedprice', 'l_discount'])} AS value FROM lineitem
UNION ALL
SELECT 'lineitem', 'glove_L', 'dynamics_temp', 'canonical', {_ROWNUM.split(' AS ')[0]},
       {_wide_sql(['l_tax'])} FROM lineitem""")
def wide_to_payload_q(spark, sf):
    w = _wide(spark, sf)
    out = None
    for kind, stream, ids in ((MAG_KIND, "tactile_field", ["bmm_0"]), (TEMP_KIND, "dynamics_temp", ["lis_0"])):
        layout, cols = pl.choose_layout(kind, w.columns, ids)
        part = w.select(F.lit("lineitem").alias("session_id"), F.lit("glove_L").alias("device_id"),
                        F.lit(stream).alias("stream_id"), F.lit(layout).alias("layout"), "row",
                        pl.stack_columns(w, cols).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@register("legacy_payload", f"""
SELECT 'lineitem' AS session_id, 'glove_L' AS device_id, 'dynamics_temp' AS stream_id, 'legacy' AS layout,
       {_ROWNUM}, {_wide_sql(['l_quantity', 'l_discount', 'l_tax'])} AS value FROM lineitem""")
def legacy_payload_q(spark, sf):
    w = _wide(spark, sf)
    layout, cols = pl.choose_layout(TEMP_KIND, w.columns)
    return w.select(F.lit("lineitem").alias("session_id"), F.lit("glove_L").alias("device_id"),
                    F.lit("dynamics_temp").alias("stream_id"), F.lit(layout).alias("layout"), "row",
                    pl.stack_columns(w, cols).alias("value"))


# ---------------------------------------------------------------------------
# S6 message log (B5: events as messages, field k)
# ---------------------------------------------------------------------------
@register("message_log_scan", f"""
WITH m AS (SELECT {q.DAY} AS session_id, event_type AS topic, epoch_us(ts) * 1000 AS log_time,
                  event_id AS seq, props AS data FROM events)
SELECT session_id, topic, row_number() OVER (PARTITION BY session_id, topic ORDER BY log_time, seq) - 1 AS "row",
       log_time, list_transform(regexp_extract_all(json_extract(data, '$.k')::VARCHAR, '{msg.JSON_NUMBER}'),
                                lambda x: x::FLOAT) AS value
FROM m""")
def message_log_scan_q(spark, sf):
    m = msg.events_as_messages(dt.read(spark, sf, "events"), dt._session_col("day"))
    return msg.scan_topics(m, "k")


# ---------------------------------------------------------------------------
# S7–S9, S11 over stream references derived from the event sessions
# ---------------------------------------------------------------------------
_REFS_SQL = """
refs AS (SELECT DISTINCT session_id, device_id, stream_id, CASE device_id
           WHEN 'click' THEN 'parquet:///lake/' || session_id || '/click.parquet#stream=value&row=0'
           WHEN 'view' THEN session_id || '/view.PARQUET'
           WHEN 'purchase' THEN '/abs/' || session_id || '/purchase.parquet'
           WHEN 'signup' THEN 'mcap:///logs/' || session_id || '.mcap'
           ELSE 'store/' || session_id || '/error' END AS uri FROM ev),
nrm AS (SELECT session_id, device_id, stream_id, uri,
               CASE WHEN strpos(uri, '://') > 0 THEN uri
                    WHEN lower(uri) LIKE '%.parquet' THEN 'parquet://' ||
                         CASE WHEN uri LIKE '/%' THEN uri ELSE '/lake/' || uri END
                    ELSE uri END AS normalized FROM refs)"""


def _refs(spark, sf):
    s = dt.event_streams(spark, sf).select(*KEYS)
    sid, dev = F.col("session_id"), F.col("device_id")
    uri = (F.when(dev == "click", F.concat(F.lit("parquet:///lake/"), sid, F.lit("/click.parquet#stream=value&row=0")))
            .when(dev == "view", F.concat(sid, F.lit("/view.PARQUET")))
            .when(dev == "purchase", F.concat(F.lit("/abs/"), sid, F.lit("/purchase.parquet")))
            .when(dev == "signup", F.concat(F.lit("mcap:///logs/"), sid, F.lit(".mcap")))
            .otherwise(F.concat(F.lit("store/"), sid, F.lit("/error"))))
    return s.withColumn("uri", uri)


@register("normalize_uri", q.with_more(_REFS_SQL, "SELECT * FROM nrm"))
def normalize_uri_q(spark, sf):
    r = _refs(spark, sf)
    return r.withColumn("normalized", normalize_uri("uri", "/lake"))


@register("parse_uri", q.with_more(_REFS_SQL, """
SELECT session_id, device_id, stream_id, normalized,
       CASE WHEN strpos(normalized, '://') > 0 THEN split_part(normalized, '://', 1) END AS scheme,
       CASE WHEN strpos(normalized, '://') > 0 THEN substr(normalized, strpos(normalized, '://') + 3) END AS rest,
       split_part(normalized, '#', 1) AS base
FROM nrm"""))
def parse_uri_q(spark, sf):
    r = _refs(spark, sf).withColumn("normalized", normalize_uri("uri", "/lake"))
    return r.select(*KEYS, "normalized", uri_scheme("normalized").alias("scheme"),
                    uri_rest("normalized").alias("rest"), strip_fragment("normalized").alias("base"))


@register("source_map", q.with_more(_REFS_SQL + """,
sref AS (SELECT session_id, device_id || '::' || stream_id AS key, normalized AS uri FROM nrm
         WHERE device_id <> 'signup'),
ovr AS (SELECT DISTINCT session_id, 'error::value' AS key,
               'parquet:///override/' || session_id || '/error.parquet' AS uri FROM ev
        UNION ALL SELECT DISTINCT session_id, 'value', 'parquet:///fallback/' || session_id || '.parquet' FROM ev),
merged AS (SELECT * FROM sref WHERE (session_id, key) NOT IN (SELECT session_id, key FROM ovr)
           UNION ALL SELECT * FROM ovr)""", """
SELECT s.session_id, s.device_id, s.stream_id, coalesce(q.uri, b.uri) AS uri
FROM streams s
LEFT JOIN merged q ON q.session_id = s.session_id AND q.key = s.device_id || '::' || s.stream_id
LEFT JOIN merged b ON b.session_id = s.session_id AND b.key = s.stream_id"""))
def source_map_q(spark, sf):
    r = _refs(spark, sf).withColumn("uri", normalize_uri("uri", "/lake"))
    sref = r.where(F.col("device_id") != "signup")
    sess = dt.event_session_meta(spark, sf).select("session_id")
    ovr = (sess.select("session_id", F.lit("error::value").alias("key"),
                       F.concat(F.lit("parquet:///override/"), "session_id", F.lit("/error.parquet")).alias("uri"))
           .unionByName(sess.select("session_id", F.lit("value").alias("key"),
                                    F.concat(F.lit("parquet:///fallback/"), "session_id", F.lit(".parquet"))
                                    .alias("uri"))))
    return pl.source_map(sref, ovr, dt.event_streams(spark, sf))


@register("stream_dim_join", q.with_("""
SELECT a.session_id, a.device_id, a.stream_id, s.payload_kind, count(*) AS n_frames,
       s.device_id IS NOT NULL AS has_descriptor
FROM al a LEFT JOIN (SELECT * FROM streams WHERE device_id <> 'view') s USING (session_id, device_id, stream_id)
GROUP BY ALL"""))
def stream_dim_join_q(spark, sf):
    """Aligned streams against a descriptor table that lacks one device;
    the ``has_descriptor = false`` rows are what the assertion reports."""
    e = dt.event_inputs(spark, sf)
    desc = e["streams"].where(F.col("device_id") != "view")
    cnt = e["alignment"].groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_frames"))
    miss = pl.missing_descriptors(e["alignment"], desc).withColumn("_m", F.lit(True))
    return (cnt.join(desc.select(*KEYS, "payload_kind"), KEYS, "left").join(miss, KEYS, "left")
            .select(*KEYS, "payload_kind", "n_frames", F.col("_m").isNull().alias("has_descriptor")))


# ---------------------------------------------------------------------------
# P10 topology rows, P15 session identity, B2 clock models
# ---------------------------------------------------------------------------
def _topo_streams(spark, sf):
    s = dt.event_streams(spark, sf)
    d = F.col("device_id")
    return (s.withColumn("topology_ref", F.when(d.isin("error", "signup"), F.lit("EvTopo_v1")))
             .withColumn("topology_hash", F.when(d == "signup", F.concat(F.lit("sha256:"), F.sha2(d, 256)))))


@register("topology_rows", q.with_("""
SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY device_id) - 1 AS ord, device_id,
       topology_ref, topology_hash
FROM (SELECT DISTINCT session_id, device_id,
             CASE WHEN device_id IN ('error', 'signup') THEN 'EvTopo_v1' END AS topology_ref,
             CASE WHEN device_id = 'signup' THEN 'sha256:' || sha256(device_id) END AS topology_hash
      FROM streams) WHERE topology_ref IS NOT NULL OR topology_hash IS NOT NULL"""))
def topology_rows_q(spark, sf):
    t = sv.topology_rows(_topo_streams(spark, sf))
    return t.select("session_id", F.posexplode("topology").alias("ord", "t")).select(
        "session_id", F.col("ord").cast("long").alias("ord"), "t.device_id", "t.topology_ref", "t.topology_hash")


_DAYNUM = "CAST(substr(session_id, 11, 2) AS INT)"


@register("session_identity", q.with_(f"""
SELECT session_id, coalesce(nullif(metric_session_id, ''), nullif(own_id, ''), 'sess_' || reference_clock_id)
       AS resolved_session_id
FROM (SELECT session_id, reference_clock_id,
             CASE WHEN {_DAYNUM} % 3 = 0 THEN 'metric_' || session_id WHEN {_DAYNUM} % 3 = 1 THEN '' END
             AS metric_session_id,
             CASE WHEN {_DAYNUM} % 2 = 0 THEN session_id WHEN {_DAYNUM} % 4 = 1 THEN '' END AS own_id
      FROM meta)"""))
def session_identity_q(spark, sf):
    m = dt.event_session_meta(spark, sf)
    day = F.substring("session_id", 11, 2).cast("int")
    m = m.select(F.col("session_id").alias("_sid"), "reference_clock_id",
                 F.when(day % 3 == 0, F.concat(F.lit("metric_"), "session_id")).when(day % 3 == 1, F.lit(""))
                 .alias("metric_session_id"),
                 F.when(day % 2 == 0, F.col("session_id")).when(day % 4 == 1, F.lit("")).alias("session_id"))
    r = sv.session_identity(m)
    return r.select(F.col("_sid").alias("session_id"), "resolved_session_id")


CLOCK_MODELS = {  # device → (offset µs, skew ppm); the multi-device scenario's clocks
    "error": (5000.0, 40.0), "purchase": (-12000.0, -25.0), "signup": (8000.0, 60.0), "click": (0.0, 0.0),
}


def _clock_sql():
    a = " ".join(f"WHEN '{d}' THEN {repr(1.0 + ppm * 1e-6)}::DOUBLE" for d, (_o, ppm) in CLOCK_MODELS.items())
    b = " ".join(f"WHEN '{d}' THEN {repr(o)}::DOUBLE" for d, (o, _p) in CLOCK_MODELS.items())
    return q.with_(f"""
SELECT session_id, device_id, event_id, t_us,
       round(CASE device_id {a} ELSE 1.0::DOUBLE END * t_us::DOUBLE + CASE device_id {b} ELSE 0.0::DOUBLE END)::BIGINT
       AS t_ref_us
FROM ev""")


@register("apply_clock", _clock_sql())
def apply_clock_q(spark, sf):
    s = dt.event_samples(spark, sf)
    models = spark.createDataFrame([(d, 1.0 + ppm * 1e-6, o) for d, (o, ppm) in CLOCK_MODELS.items()],
                                   "device_id string, alpha double, beta double")
    return apply_clock(s, models).select("session_id", "device_id", "event_id", "t_us", "t_ref_us")

