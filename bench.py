"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed in full (``noop`` sink: no collect to the
driver) after a warm-up of every query on the smallest scale; then the whole
``materialize()`` job runs once (``materialize_e2e``). Prints ONE JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["silver_long", "silver_wide", "release_gate", "lerobot_frames", "trainer_batches",
            "subframe", "derived_features", "summary", "dataset_diff", "merkle_root", "message_log_scan",
            "payload_scan"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from chronoweave.config import local_session
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="chronoweave-bench")
    from chronoweave.config import checkpoint_dir
    checkpoint_dir(spark)  # the configured folder; a scratch one only when unset
    from chronoweave.plans.catalog import QUERIES
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # JVM warm-up (class loading, JIT) on the smallest scale, not on the measured data
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for n in names:
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    if os.environ.get("BENCH_E2E", "1") == "1":
        # the whole job: Silver write + read-back, five Gold formats, checks, gate,
        # provenance, manifest, export records, data card (under the shared folder)
        import uuid
        from chronoweave.plans.materialize import materialize
        from chronoweave.sources import driver_tables as dt
        out = f"{checkpoint_dir(spark).rstrip('/')}/bench-e2e-{uuid.uuid4().hex}"
        t0 = time.perf_counter()
        materialize(spark, dt.event_inputs(spark, sf_dir), out,
                    formats=("parquet", "lerobot", "rlds", "messages", "trainer_batches"))
        times["materialize_e2e"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
