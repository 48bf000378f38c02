"""Nothing is lost, doubled or invented without an error."""
import hashlib
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from chronoweave.operators import align, gate, subframe
from chronoweave.operators import provenance as pv
from chronoweave.operators.asof import asof_neighbors
from chronoweave.plans.materialize import materialize
from chronoweave.plans.versions import read_table
from chronoweave.sources import messages as msg
from helpers import single_device

GATE = ("session_id string, coverage_min double, label_confidence double, sync_resid_us double, sync_verdict string, "
        "critical_failed boolean, any_failed boolean")


def test_nan_is_never_certified(spark):
    nan = float("nan")
    rows = [("ok", 1.0, 0.99, 0.0, None, False, False), ("conf", 1.0, nan, 0.0, None, False, False),
            ("resid", 1.0, 0.99, nan, None, False, False), ("cover", nan, 0.99, 0.0, None, False, False)]
    out = gate.release_gate(spark.createDataFrame(rows, GATE), lineage_signed=True)
    assert {r.session_id: r.gate_verdict for r in out.collect()} == {
        "ok": "CERTIFIED", "conf": "NEEDS_REVIEW", "resid": "NEEDS_REVIEW", "cover": "NEEDS_REVIEW"}


def test_message_numbers_keep_their_positions(spark):
    km = {"k": ("t", "f")}

    def scan(data):
        m = spark.createDataFrame([("s", "t", 1, 1, data)], "session_id string, topic string, log_time long, seq long, data string")
        return msg.scan_messages(m, "k", km).collect()[0].value
    got = scan('{"f": [[null, 2, 3], [4.5, -1e2, 0]]}')
    assert math.isnan(got[0]) and got[1:] == [2.0, 3.0, 4.5, -100.0, 0.0]
    assert scan('{"f": 7}') == [7.0] and scan('{"f": [1, 2]}') == [1.0, 2.0] and scan('{"g": 1}') is None
    with pytest.raises(Exception, match="not a number"):
        scan('{"f": ["a1", 2, 3]}')


def test_subframe_ranks_rows_with_holes(spark):
    keys = "session_id string, device_id string, stream_id string, "
    anchors = spark.createDataFrame([("s", 0, 0), ("s", 1, 100)], "session_id string, anchor_index long, t_anchor_us long")
    samples = spark.createDataFrame([("s", "d", "x", t, r, [float(r)]) for r, t in ((0, 1), (1, 2), (5, 30))],
                                    keys + "t_us long, row long, value array<float>")
    streams = spark.createDataFrame([("s", "d", "x", 1)], keys + "width int")
    r = subframe.subframes(anchors, samples, streams, 4).collect()[0]
    assert r.m_k == 3 and [v[0] for v in r.samples] == [0.0, 1.0, 5.0, 5.0]


def test_projection_raises_where_rows_would_go(spark):
    inp = single_device(spark)
    with pytest.raises(Exception, match="without a descriptor"):
        align.project(inp["alignment"], inp["payload"], inp["streams"].where("false"), inp["grid"]).collect()
    late = inp["alignment"].withColumn("source_index", F.col("source_index") + 10_000)
    with pytest.raises(Exception, match="past the payload"):
        align.project(late, inp["payload"], inp["streams"], inp["grid"]).collect()
    for value in ("slice(value, 1, size(value) - 1)", "concat(value, value)"):
        with pytest.raises(Exception, match="payload width differs"):
            align.project(inp["alignment"], inp["payload"].withColumn("value", F.expr(value)), inp["streams"], inp["grid"]).collect()


def test_asof_with_large_ids(spark):
    big = 1 << 41
    left = spark.createDataFrame([("k", 5)], "g string, t long")
    right = spark.createDataFrame([("k", 3, big), ("k", 4, big + 1), ("k", 9, -big)], "g string, u long, id long")
    r = asof_neighbors(left, right, ["g"], left_t="t", right_t="u", right_cols=["id"], cell_us=1, target_rows=1).collect()[0]
    assert tuple(r.prev) == (4, big + 1) and tuple(r.next) == (9, -big)


def test_merkle_root_of_nothing(spark):
    r = pv.merkle_root(spark.createDataFrame([], "sha256 string")).collect()
    assert [x.merkle_root for x in r] == [hashlib.sha256(b"").hexdigest()]


def _tables(spark, out):
    names = ["silver", "gold/format=lerobot", "qa_report", "manifest", "provenance", "datacard"]
    read = lambda t: read_table(spark, out, t)
    return {t: sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in read(t).collect()) for t in names}


def test_second_run_and_second_batch_leave_one_copy(spark, tmp_dir):
    a = single_device(spark)
    tables = ("payload", "alignment", "streams", "session_meta", "grid")
    named = lambda s: {t: a[t].withColumn("session_id", F.lit(s)) for t in tables}
    x, y = named("sess_a"), named("sess_b")
    both = {t: x[t].unionByName(y[t]) for t in tables}
    run = lambda inp, out: materialize(spark, inp, out, formats=("lerobot",), lineage_signed=True)
    one, two = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    run(both, one)
    first = _tables(spark, one)
    run(both, one)
    assert _tables(spark, one) == first
    run(x, two)
    run(y, two)
    got = {t: [r.replace(two, one) for r in rows] for t, rows in _tables(spark, two).items()}
    assert got == first
    lerobot = read_table(spark, two, "gold/format=lerobot")
    assert lerobot.groupBy("session_id").agg(F.min("index").alias("i")).where("i <> 0").count() == 0
    assert read_table(spark, two, "export_records").count() == 2
