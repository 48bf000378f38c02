"""Physical-plan properties of the catalog queries (static plans, AQE off):
no cartesian / nested-loop joins, no row-at-a-time Python, pruned scans,
pushed filters."""
import re

import pytest

from chronoweave.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_OK = set()
LITERAL_KEY_OK: set = set()


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    p = _plan(spark, name)
    if name not in LITERAL_KEY_OK:
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p
    if name not in PYTHON_OK:
        assert "MapInPandas" not in p and "ArrowEvalPython" not in p
    # the events scans never read columns no event query uses
    for schema in re.findall(r"events\.parquet\], PartitionFilters: \[\], PushedFilters: \[[^\]]*\], "
                             r"ReadSchema: (struct<[^>]*>)", p):
        assert "user_id" not in schema


def test_sync_filter_is_pushed_down(spark):
    p = _plan(spark, "silver_long")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in p


def test_silver_plan_reuses_the_payload_exchange(spark):
    assert "ReusedExchange" in _plan(spark, "silver_long")
