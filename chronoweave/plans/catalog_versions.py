"""Catalog, part 5: packaged versions (K12, K17, K19, I3) and the topology's clusters (S13), with
their DuckDB oracles."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import checkpoint_dir
from ..operators import derived as dv
from ..operators import inspect as insp
from ..operators import provenance as pv
from ..operators import version_diff as vd
from ..schemas import ENGINE_VERSION, SCHEMA_VERSION
from ..sources import driver_tables as dt
from . import sql_events as q
from .catalog import _ev, register
from .catalog_lineage import _DIFF_SQL, _DSID, _SUMMARY_CTES, _versions

FILES_A_TASK = 500  # a file costs a task its creation and its move
DIFF_CHUNK = 16  # frames a leaf, so that the test tables have trees of more than one layer


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# Changed frames, and the hash flag with both outcomes
# ---------------------------------------------------------------------------
_ROWS = "list((frame_index, t_ref_us, value, valid, confidence, conf_source, conf_clock, conf_interp) ORDER BY frame_index)"


@register("changed_frames", _DIFF_SQL + f"""
, x AS (SELECT session_id, device_id, stream_id, frame_index // {DIFF_CHUNK} AS idx, {_ROWS} AS v FROM sl GROUP BY ALL),
y AS (SELECT session_id, device_id, stream_id, frame_index // {DIFF_CHUNK} AS idx, {_ROWS} AS v FROM b_sl GROUP BY ALL),
d AS (SELECT session_id, device_id, stream_id, idx,
             CASE WHEN x.v IS NULL THEN 'added' WHEN y.v IS NULL THEN 'removed' ELSE 'changed' END AS status
      FROM x FULL JOIN y USING (session_id, device_id, stream_id, idx) WHERE x.v IS DISTINCT FROM y.v),
r AS (SELECT *, idx - row_number() OVER (PARTITION BY session_id, device_id, stream_id, status ORDER BY idx) AS run FROM d)
SELECT session_id, device_id, stream_id, status, min(idx) * {DIFF_CHUNK} AS first_frame, (max(idx) + 1) * {DIFF_CHUNK} AS end_frame
FROM r GROUP BY session_id, device_id, stream_id, status, run""")
def changed_frames_q(spark, sf):
    """Frames that differ between two versions, by descent through their hash layers."""
    a, b = (vd.hash_layers(pv.silver_chunk_digests(v["silver"], DIFF_CHUNK)) for v in _versions(spark, sf, reuse=False))
    return vd.changed_ranges(vd.changed_chunks(a, b), DIFF_CHUNK)


@register("diff_hashes", q.with_more(
    "v AS (SELECT session_id, count(*) FILTER (WHERE valid) AS n FROM sl GROUP BY 1), g AS (SELECT session_id, count(*) AS n FROM grid GROUP BY 1)", """
SELECT session_id, v.n = 0 OR CAST(right(session_id, 1) AS INTEGER) % 2 = 1 AS content_hash_identical, 0::BIGINT AS n_grid_delta
FROM v JOIN g USING (session_id)"""))
def diff_hashes_q(spark, sf):
    """Content hashes of two versions, the second with other values on even days: same and changed."""
    e = _ev(spark, sf, reuse=True)
    even = F.substring("session_id", -1, 1).cast("int") % 2 == 0
    other = e["silver"].withColumn("value", F.when(even, F.transform("value", lambda x: x + F.lit(1000).cast("float"))).otherwise(F.col("value")))

    def sessions(silver):
        n = silver.groupBy("session_id").agg(F.countDistinct("frame_index").alias("n_grid"), F.lit(1.0).alias("coverage_min"))
        return n.join(pv.silver_content_hash(silver).drop("n_leaves"), "session_id")
    return insp.diff_sessions(sessions(e["silver"]), sessions(other)).select("session_id", "content_hash_identical", "n_grid_delta")


# ---------------------------------------------------------------------------
# Digests of files whose bytes the tables give
# ---------------------------------------------------------------------------
@register("row_file_hashes", """
SELECT s_suppkey, CAST(strlen(s_name) + 1 AS BIGINT) AS length, sha256(s_name || chr(10)) AS sha256 FROM supplier""")
def row_file_hashes_q(spark, sf):
    """Every supplier's name written as a file of its own, and the files' digests."""
    root = _scratch(spark, "supplier-files")
    s = dt.read(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("value"))
    # a given number of tasks, as the rows are too small for their bytes to tell; a task moves its own
    # files into place, the folder being read only if all have
    tasks = max(spark.sparkContext.defaultParallelism, -(-s.count() // FILES_A_TASK))
    (s.repartition(tasks, "s_suppkey").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy("s_suppkey").text(root))
    h = pv.file_hashes(spark, root)
    return h.select(F.regexp_extract("path", r"s_suppkey=(-?\d+)/", 1).cast("long").alias("s_suppkey"), "length", "sha256")


# ---------------------------------------------------------------------------
# Sensors of the topology and their clusters
# ---------------------------------------------------------------------------
@register("cluster_map", f"""
WITH n AS (SELECT greatest(1, (coalesce(max(len(embedding)), 0) + 2) // 3) AS n FROM embeddings),
k AS (SELECT unnest(range(0, n)) AS k FROM n),
c AS (SELECT k, least(k // 4, 4) AS c FROM k)
SELECT '{dt.EMB_TOPOLOGY}' AS topology_ref, ['thumb', 'index', 'middle', 'ring', 'palm'][c + 1] AS cluster_id, c AS cluster_ord,
       'bmm_' || ['thumb', 'index', 'middle', 'ring', 'palm'][c + 1] || '_' || (k - 4 * c) AS sensor_id, k AS ord,
       0.01 * k AS x_m, 0.01 * (k % 4) AS y_m FROM c""")
def cluster_map_q(spark, sf):
    return dv.cluster_map(*dt.synthetic_topology(spark, dt.embedding_sensors(spark, sf)))


# ---------------------------------------------------------------------------
# What the job packages
# ---------------------------------------------------------------------------
def _packaged(spark, sf):
    from .materialize import materialize
    from .versions import read_table
    root = _scratch(spark, "packaged")
    materialize(spark, dt.event_inputs(spark, sf), root, formats=("parquet",))
    return lambda name: read_table(spark, root, name)


_COUNTS = """
cnt AS (SELECT session_id, count(*) AS frames FROM grid GROUP BY 1),
smp AS (SELECT session_id, sum(valid::BIGINT)::BIGINT AS samples FROM sl GROUP BY 1)"""


@register("manifest", q.with_more(_COUNTS, f"""
SELECT {_DSID} AS dataset_id, '0.1.0' AS version, '{ENGINE_VERSION}' AS engine_version, '{SCHEMA_VERSION}' AS schema_version,
       'default' AS profile, session_id AS source_session_id, reference_clock_id, round(grid_rate_hz, 6) AS grid_rate_hz,
       'BLOCKED' AS qa_verdict, 'parquet' AS format, frames AS frame_count, samples AS sample_count
FROM meta JOIN cnt USING (session_id) JOIN smp USING (session_id)"""))
def manifest_q(spark, sf):
    """Manifests of a version that the job has packaged, read back through its commit."""
    return (_packaged(spark, sf)("manifest").withColumn("f", F.explode("formats"))
            .select("dataset_id", "version", "engine_version", "schema_version", "profile", "source_session_id", "reference_clock_id",
                    F.round("grid_rate_hz", 6).alias("grid_rate_hz"), "qa_verdict", "f.format", "f.frame_count", "f.sample_count"))


@register("dataset_card", q.with_more(_SUMMARY_CTES.format(p=""), """
SELECT session_id, 'streams' AS section,
       format('| {} | {} | {} | [{}] | {} | {} | {:.3f} |', stream, device_id, payload_kind, array_to_string(shape, ', '), units, kernel, coverage) AS line
FROM summ"""))
def dataset_card_q(spark, sf):
    """The stream lines of every session's card."""
    return _packaged(spark, sf)("datacard").where("section = 'streams'").select("session_id", "section", "line")


