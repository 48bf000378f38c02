"""Every catalog query against its DuckDB oracle (row multiset equality after
normalisation), and every rows-only query runs."""
import pytest

from chronoweave.plans.catalog import ORACLE, QUERIES
from chronoweave.plans.oracle_compare import compare, duck
from conftest import SF_ORACLE

_con = None


def _duck():
    global _con
    if _con is None:
        _con = duck(SF_ORACLE)
    return _con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    if name in ORACLE:
        ok, msg = compare(df, _duck(), ORACLE[name])
        assert ok, msg
    else:
        assert df.count() >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_checks_and_gate_have_every_outcome(spark):
    import chronoweave.operators.checks as ck
    checks = QUERIES["checks_lines"](spark, SF_ORACLE).toPandas()
    for c in ck.CHECK_ORDER:
        assert set(checks[c]) == {"pass", "fail"}, c
    g = QUERIES["gate_orders"](spark, SF_ORACLE).toPandas()
    assert set(g.gate_verdict) == set(g.uncapped_verdict) == {"BLOCKED", "NEEDS_REVIEW", "RELEASE", "CERTIFIED"}
    assert set(g.ok_to_publish) == {True, False}
    assert (g.gate_verdict != g.uncapped_verdict).any() and {"UNHEARD_OF", "CERTIFIED"} <= set(g.sync_ceiling)


def test_other_queries_have_every_outcome(spark):
    def values(name, col):
        return {r[0] for r in QUERIES[name](spark, SF_ORACLE).select(col).distinct().collect()}
    assert values("dataset_diff_renamed", "status") == {"same", "added", "removed"}
    assert values("trainer_batches_long", "batch_id") == {0, 1}
    assert {n > 0 for n in values("payload_width_mismatch", "n_bad")} == {True, False}
    assert {"." in f for f in values("feature_names_mixed", "feature")} == {True, False}
