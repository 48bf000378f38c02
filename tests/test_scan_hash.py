"""Prefix sums in two levels, counted Merkle trees, converging medians and streamed file digests."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import provenance as pv
from chronoweave.operators.exports import episodes
from chronoweave.operators.scan import sums_before
from chronoweave.operators.stats import exact_median


def sha(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def plain_root(leaves):
    level = [bytes.fromhex(x) for x in sorted(leaves)]
    if not level:
        return hashlib.sha256(b"").hexdigest()
    while len(level) > 1:
        if len(level) % 2:
            level.append(level[-1])
        level = [hashlib.sha256(a + b).digest() for a, b in zip(level[::2], level[1::2])]
    return level[0].hex()


def brute_sums(rows):
    total, out = 0, []
    for o, v in sorted(rows):
        out.append((o, v, total))
        total += v or 0
    return out


@pytest.mark.parametrize("ranges", [1, 2, 9, None])
def test_sums_before(spark, ranges):
    r = random.Random(ranges)
    rows = [(f"s{i:04d}", r.choice([None, 1, 5, -2, 10**12])) for i in r.sample(range(3000), 400)]
    df = spark.createDataFrame(rows, "o string, v long").repartition(5)
    got = sums_before(df, ["o"], {"before": "v"}, ranges=ranges).collect()
    assert sorted((x.o, x.v, x.before) for x in got) == brute_sums(rows)


def test_sums_before_by_key_and_bucket(spark):
    r = random.Random(3)
    rows = [(k, sha((k, i)), r.randint(0, 9)) for k, n in (("a", 300), ("b", 1), ("c", 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, o string, v long").repartition(4)
    want = sorted((k, *x) for k in "abc" for x in brute_sums([(o, v) for kk, o, v in rows if kk == k]))
    for bucket in (None, F.substring("o", 1, 1)):
        got = sums_before(df, ["o"], {"before": "v"}, keys=["k"], bucket=bucket).collect()
        assert sorted((x.k, x.o, x.v, x.before) for x in got) == want
    got = sums_before(df, ["o"], {"before": "v"}, bucket=F.substring("o", 1, 1)).collect()
    assert sorted((x.o, x.v, x.before) for x in got) == brute_sums([(o, v) for _, o, v in rows])
    assert sums_before(df.limit(0), ["o"], {"before": "v"}).count() == 0


def test_no_window_without_partitions():
    import pathlib
    import chronoweave
    for f in pathlib.Path(chronoweave.__file__).parent.rglob("*.py"):
        if "llm" not in f.parts:
            assert "Window.orderBy(" not in f.read_text(), f


def test_episodes_are_numbered_across_sessions(spark):
    rows = [(f"s{i:03d}", f) for i in range(50) for f in range(i % 7 + 1)]
    got = sorted(map(tuple, episodes(spark.createDataFrame(rows, "session_id string, frame_index long")).collect()))
    at, want = 0, []
    for i in range(50):
        want.append((f"s{i:03d}", i, i % 7 + 1, at))
        at += i % 7 + 1
    assert got == want


@pytest.mark.parametrize("counts", [[1], [2], [3], [17], [5, 1, 40], [1] * 33, [100, 3, 1, 1, 257, 16, 15], [31, 33]])
def test_counted_merkle_equals_plain_rule(spark, counts):
    leaves = [sha(i) for i, n in enumerate(counts) for _ in range(n)]
    df = spark.createDataFrame([(x,) for x in leaves], "sha256 string").repartition(3)
    for levels in ((2, 4) if len(leaves) < 40 else (4,)):
        got = pv.merkle_root(df, fan_in_levels=levels).collect()[0]
        assert (got.n_leaves, got.merkle_root) == (len(leaves), plain_root(leaves))


def test_merkle_per_key_with_runs(spark):
    r = random.Random(8)
    rows = [(k, sha(r.choice([1, 2, 3, 1000 + i]))) for k, n in (("a", 211), ("b", 1), ("c", 64)) for i in range(n)]
    got = {x.k: x.merkle_root for x in pv.merkle_root(spark.createDataFrame(rows, "k string, sha256 string"), keys=["k"]).collect()}
    assert got == {k: plain_root([d for kk, d in rows if kk == k]) for k in "abc"}


def test_a_million_copies_are_a_few_rows(spark):
    n = 10**6
    df = spark.range(n).select(F.lit(sha("x")).alias("sha256")).unionByName(spark.createDataFrame([(sha("y"),)], "sha256 string"))
    got = pv.merkle_root(df).collect()[0]
    assert (got.n_leaves, got.merkle_root) == (n + 1, plain_root([sha("x")] * n + [sha("y")]))
    layer = spark.createDataFrame([(0, 0, n, sha("x"), n)], "_all int, i long, c long, d string, _n long")
    for _ in range(5):
        layer = pv._merkle_round(layer, ["_all"], 4)
        assert layer.count() <= 3


def test_median_of_equal_and_adversarial_values(spark):
    rng = np.random.default_rng(7)
    groups = {"equal": np.full(30_000, 2.5), "two": np.array([1.0] * 10_000 + [2.0] * 10_000), "odd": np.array([1.0] * 9_999 + [2.0] * 10_000),
              "wide": np.exp(rng.uniform(-700, 700, 20_001)) * rng.choice([-1, 1], 20_001),
              "close": 1.0 + np.arange(20_000) * 2.0**-52, "skew": np.concatenate([np.zeros(15_000), rng.random(14_000)]),
              "inf": np.array([-np.inf] * 3 + [1.0, 2.0] + [np.inf] * 3)}
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame([(k, float(x)) for k, v in groups.items() for x in v], columns=["g", "x"])).repartition(7)
    got = {r.g: r.median for r in exact_median(df, ["g"], "x").collect()}
    assert got == {k: float(np.median(v)) for k, v in groups.items()}
    assert exact_median(df.limit(0), ["g"], "x").count() == 0


def test_files_hash_in_chunks(spark, tmp_dir):
    sizes = {"small": 3, "chunk": 1 << 12, "more": (1 << 14) + 5, "sub dir/space %20": 77}
    import os
    want = {}
    for name, n in sizes.items():
        data = random.Random(name).randbytes(n)
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
        want[name] = (n, hashlib.sha256(data).hexdigest())
    got = pv.file_hashes(spark, tmp_dir, chunk=1 << 10).collect()
    assert {r.path.split(tmp_dir.lstrip("/") + "/")[1]: (r.length, r.sha256) for r in got} == want
