"""Tiny in-memory inputs mirroring the reference's fixtures."""
from __future__ import annotations

import numpy as np

from chronoweave.schemas import MAG_KIND


def single_device(spark, n=16, step=625, valid=None, session="01J9SYNTH0001", values=None):
    """A1: 16 frames at 625 µs of a (21, 3) magnetic stream, all valid;
    identity alignment (frame k ← payload row k), confidence components absent."""
    rng = np.random.default_rng(0)
    vals = values if values is not None else rng.standard_normal((n, 63)).astype(np.float32)
    valid = valid if valid is not None else [True] * n
    payload = spark.createDataFrame(
        [(session, "glove_L", "tactile_field", i, i * step, [float(x) for x in vals[i]]) for i in range(n)],
        "session_id string, device_id string, stream_id string, row long, t_us long, value array<float>")
    grid = spark.createDataFrame([(session, i, i * step) for i in range(n)],
                                 "session_id string, frame_index long, t_ref_us long")
    alignment = spark.createDataFrame(
        [(session, "glove_L", "tactile_field", i, i, -1, 0.0, valid[i], None, None, None) for i in range(n)],
        "session_id string, device_id string, stream_id string, frame_index long, source_index long, "
        "next_index long, weight float, valid boolean, conf_source double, conf_clock double, "
        "conf_interp double")
    streams = spark.createDataFrame(
        [(session, "glove_L", "tactile_field", MAG_KIND, "uT", "continuous", [21, 3], None, None)],
        "session_id string, device_id string, stream_id string, payload_kind string, units string, "
        "kernel string, shape array<int>, topology_ref string, topology_hash string")
    meta = spark.createDataFrame(
        [(session, "glove_L", 1600.0, 0.0, None, "1.0")],
        "session_id string, reference_clock_id string, grid_rate_hz double, sync_resid_us double, "
        "sync_verdict string, schema_version string")
    return {"payload": payload, "grid": grid, "alignment": alignment, "streams": streams,
            "session_meta": meta, "values": vals}
