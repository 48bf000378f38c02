"""Hard negatives against brute force, and the bounds of segment summaries."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import negatives as hn
from chronoweave.plans.oracle_compare import compare, duck
from llm_helpers import SF_SMALL

ROWS = "vec_id long, embedding array<float>, label int, i string, a string, v string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], ROWS).repartition(3)


def brute(rows, every=5, flip=7, positives=5, negatives=3):
    good = []
    for i, v, lab in rows:
        if i is None or lab is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = np.floor(256 * np.array(v, np.float32).astype(np.float64))
        if (np.abs(x) < hn.LARGEST).all():
            good.append((i, (lab + 1) % 10 if i % flip == 0 else lab, x.astype(np.int64)))
    out = []
    for i, lab, x in good:
        if i % every:
            continue
        s = sorted((-int(y @ x), j, m) for j, m, y in good if len(y) == len(x))
        for ps, pid, _ in [t for t in s if t[2] == lab and t[1] != i][:positives]:
            inside = [t for t in s if t[2] != lab and 50 * -ps <= 100 * -t[0] <= 95 * -ps][:negatives]
            out += [(i, pid, r + 1, j, -ps, -n) for r, (n, j, _) in enumerate(inside)]
    return sorted(out)


def run(df, **kw):
    got = hn.hard_negatives(df, F.col("vec_id") % 5 == 0, flip=F.col("vec_id") % 7 == 0, **kw)
    return sorted(map(tuple, got.collect()))


def clustered(n, dims, labels, seed):
    r = np.random.default_rng(seed)
    centre = r.normal(0, 1, (labels, dims))
    lab = r.integers(0, labels, n)
    v = centre[lab] + r.normal(0, 0.8, (n, dims)) + 0.3
    return [(i, v[i].astype(np.float32).tolist(), int(lab[i])) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"rows_per_block": 20, "anchors_per_block": 7}])
def test_against_brute_force(spark, kw):
    rows = clustered(120, 21, 4, 1)
    got = run(frame(spark, rows), **kw)
    assert got == brute(rows) and got


def test_edges(spark):
    r = np.random.default_rng(2)
    rows = [(i, np.round(r.normal(0, 1, 3), 1).tolist(), i % 3) for i in range(60)]  # many ties
    rows += [(5, [1.0, 1.0, 1.0], 0), (5, [1.0, 1.0, 1.0], 0), (5, [9.0, 0.0, 1.0], 1)]  # repeated ids
    rows += [(7, [0.5, 0.5, 0.5], 2)] * 40  # a third of all rows
    rows += [(100, None, 1), (101, [], 1), (105, [1.0, None, 2.0], 1), (110, [float("nan"), 1.0, 1.0], 1), (115, [float("inf"), 1.0, 1.0], 1),
             (120, [1.0, 2.0, 3.0], None), (None, [1.0, 2.0, 3.0], 1), (125, [1e30, 0.0, 0.0], 1), (130, [1.0, 2.0], 1),
             (131, [1.0, 2.0], 1), (132, [0.5, 1.0], 2), (135, [0.0, 0.0, 0.0], 0), (-140, [-1.0, 2.0, -3.0], 1)]
    got = run(frame(spark, rows), rows_per_block=16)
    assert got == brute(rows) and any(x[0] == 130 for x in got)


def test_empty_and_lonely(spark):
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(0, [1.0], 1)])) == []
    assert run(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)])) == []


def test_bounds_hold_and_narrow():
    r = np.random.default_rng(3)
    for dims in (1, 3, 8, 50, 64):
        v = r.integers(-4000, 4000, (40, dims)) + r.integers(-2000, 2000, (40, 1))
        s, slack = hn.Summaries.of(v), hn.slack(v)
        length = np.sqrt((v.astype(float) ** 2).sum(1)) + 1.0
        exact = v @ v.T
        before = None
        for m, d in zip(s.means, s.deviations):
            middle, spread = m @ m.T, d @ d.T + slack[:, None] * length
            assert (exact <= middle + spread).all() and (exact >= middle - spread).all()
            assert before is None or (spread <= before + 1e-3 * np.abs(before) + 1).all()
            before = spread


def test_summaries_spare_exact_scores():
    r = np.random.default_rng(4)
    # rows that differ by their segments' means: what the summaries can tell apart
    v = np.repeat(r.normal(0, 2000, (4000, 8)), 8, axis=1).astype(np.int64) + r.integers(-40, 40, (4000, 64))
    b = hn.Block(np.arange(4000), np.zeros(4000, np.int64), v)
    q = v[:20]
    exact = q @ v.T
    ranges = [[(-hn.NO_LIMIT, hn.NO_LIMIT, 5), (*hn.score_range(int(np.sort(exact[i])[-2])), 3)] for i in range(20)]
    # most rows are beyond a range or below its best; the exact ones are few
    for i, results in enumerate(b.best(np.ones((20, 4000), bool), q, ranges)):
        for (least, most, k), (at, score) in zip(ranges[i], results):
            inside = [j for j in np.lexsort((np.arange(4000), -exact[i])) if least <= exact[i][j] <= most][:k]
            assert at.tolist() == inside and score.tolist() == exact[i][inside].tolist()
    assert b.scored < 0.2 * 20 * 4000


def test_score_range():
    for p in range(-40, 300):
        least, most = hn.score_range(p)
        assert [n for n in range(-60, 300) if 50 * p <= 100 * n <= 95 * p] == list(range(least, most + 1))


def test_query_and_sql(spark):
    from chronoweave.llm.queries import ORACLE, QUERIES
    ok, why = compare(QUERIES["op12_hard_negatives"](spark, SF_SMALL), duck(SF_SMALL), ORACLE["op12_hard_negatives"])
    assert ok, why
