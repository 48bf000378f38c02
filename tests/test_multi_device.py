"""Multi-device scenario (A6): 4 devices, mixed rates, clock offsets and skews,
dropout on one device; name collisions, negative reference times, gaps."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import align, checks as ck, silver as sv
from chronoweave.operators.asof import align_samples
from chronoweave.operators.grid import apply_clock
from chronoweave.operators.subframe import compute_R, subframes
from chronoweave.schemas import ACCEL_KIND, MAG_KIND

DEVICES = {  # device: (rate Hz, stream, kind, width, offset µs, skew ppm, drop fraction)
    "A": (1000, "tactile_field", MAG_KIND, 63, 0.0, 0.0, 0.0),
    "B": (1000, "tactile_field", MAG_KIND, 63, 5000.0, 40.0, 0.0),
    "C": (200, "dynamics", ACCEL_KIND, 9, -12000.0, -25.0, 0.0),
    "D": (500, "tactile_field", MAG_KIND, 63, 8000.0, 60.0, 0.05),
}
S = "scenario"


@pytest.fixture(scope="module")
def scenario(spark):
    rng = np.random.default_rng(7)
    rows, models, streams = [], [], []
    for dev, (rate, stream, kind, width, off, ppm, drop) in DEVICES.items():
        n = 2 * rate
        keep = rng.random(n) >= drop
        start = {"B": -3000, "D": -7000}.get(dev, 0)      # recording starts before A's clock zero
        t_true = start + np.arange(n) * (1_000_000 // rate)
        t_dev = np.round(t_true * (1 + ppm * 1e-6) + off).astype(np.int64)
        vals = rng.standard_normal((n, width)).astype(np.float32)
        for i in np.nonzero(keep)[0]:
            rows.append((S, dev, stream, int(t_dev[i]), int(i), [float(x) for x in vals[i]]))
        models.append((S, dev, 1.0 / (1 + ppm * 1e-6), -off / (1 + ppm * 1e-6)))
        shape = [21, 3] if width == 63 else [3, 3]
        streams.append((S, dev, stream, kind, "u", "continuous", shape, None, None))
    samples = spark.createDataFrame(rows, "session_id string, device_id string, stream_id string, "
                                          "t_us long, seq long, value array<float>")
    m = spark.createDataFrame(models, "session_id string, device_id string, alpha double, beta double")
    st = spark.createDataFrame(streams, "session_id string, device_id string, stream_id string, "
                                        "payload_kind string, units string, kernel string, shape array<int>, "
                                        "topology_ref string, topology_hash string")
    ref = apply_clock(samples, m).drop("t_us").withColumnRenamed("t_ref_us", "t_us")
    bounds = ref.groupBy("session_id").agg(F.min("t_us").alias("lo_us"), F.max("t_us").alias("hi_us"))
    out = align_samples(ref, bounds, st, step_us=1000, tolerance_us=6000, order="seq",
                        cell_us=250_000, target_rows=50)
    out["streams"] = st
    out["silver"] = align.project(out["alignment"], out["payload"], st)
    out["meta"] = spark.createDataFrame([(S, "A", 1000.0, 36.8, "NEEDS_REVIEW", "1.0")],
                                        "session_id string, reference_clock_id string, grid_rate_hz double, "
                                        "sync_resid_us double, sync_verdict string, schema_version string")
    return out


def test_names_collide_only_where_needed(scenario):
    names = {r.feature for r in sv.feature_names(scenario["streams"]).collect()}
    assert names == {"A.tactile_field", "B.tactile_field", "D.tactile_field", "dynamics"}


def test_negative_reference_times_and_grid(scenario):
    g = scenario["grid"].agg(F.min("t_ref_us"), F.count("*")).collect()[0]
    assert g[0] < 0                       # B and D start before A's clock zero
    assert 2000 <= g[1] <= 2020           # ~2 s at 1 kHz over the union span


def test_gaps_are_nan_and_checks_pass(scenario):
    s = scenario["silver"]
    for r in s.where("not valid").limit(50).collect():
        assert all(math.isnan(x) for x in r.value)
    cov = {r.device_id: r.coverage for r in sv.stream_coverage(s).collect()}
    assert cov["A"] > 0.99 and cov["C"] > 0.99 and 0.9 < cov["D"] <= 1.0
    st = {r.name: r.status for r in ck.run_checks(s, scenario["grid"], scenario["streams"],
                                                  scenario["meta"]).collect()}
    assert st["no_fabricated_gaps"] == "pass" and st["stream_shapes_consistent"] == "pass"
    assert st["grid_monotonic"] == "pass" and st["bounded_step"] == "pass"


def test_subframe_tensor_shape(scenario, spark):
    """A's 1000 Hz samples into 200 Hz anchors (every 5th grid point): R = 5."""
    R = compute_R(1000, 200)
    assert R == 5
    anchors = (scenario["grid"].where(F.col("frame_index") % 5 == 0)
               .select("session_id", (F.col("frame_index") / 5).cast("long").alias("anchor_index"),
                       F.col("t_ref_us").alias("t_anchor_us")))
    a_payload = scenario["payload"].where("device_id = 'A'")
    sub = subframes(anchors, a_payload, scenario["streams"].where("device_id = 'A'"), R)
    n_anchors = anchors.count()
    rows = sub.collect()
    assert len(rows) == n_anchors - 1
    assert all(len(r.samples) == 5 and len(r.samples[0]) == 63 for r in rows)
    full = sum(r.m_k == 5 for r in rows)
    assert full >= len(rows) - 3          # edges may be short where A's clock starts/ends
