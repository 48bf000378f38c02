import os

from chronoweave.sources import driver_tables as dt
from chronoweave.streaming import materialize_arrivals


def test_arrivals_are_materialized_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    out = os.path.join(tmp_dir, "out")
    arrivals = spark.createDataFrame([("day_20240105", None), ("day_20240106", None)],
                                     "session_id string, arrived_at timestamp")
    arrivals.write.parquet(landing)
    build = lambda s: dt.event_inputs(s, "/root/testdata/sf0.001")
    ck = os.path.join(tmp_dir, "stream-ck")
    materialize_arrivals(spark, landing, out, build, stream_checkpoint=ck, formats=("parquet",))
    qa = spark.read.parquet(os.path.join(out, "qa_report"))
    assert sorted(r.session_id for r in qa.collect()) == ["day_20240105", "day_20240106"]
    # re-running with no new arrivals does nothing
    materialize_arrivals(spark, landing, out, build, stream_checkpoint=ck, formats=("parquet",))
    assert spark.read.parquet(os.path.join(out, "qa_report")).count() == 2
