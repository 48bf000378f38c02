"""The prefix trie against a plain one, with containers of every size."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from chronoweave.llm import prefix_trie as pt
from chronoweave.plans.oracle_compare import compare, duck
from llm_helpers import SF_SMALL

COLS = "conv_id long, turn long, role string, text string, c string, k string, n string, keys string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], COLS).repartition(3)


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    seqs = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        m = c % 20 if c >= 0 else -(-c % 20)
        seqs[c] = own.get(c - m, [])[:h] + x[h:]
    members = defaultdict(list)
    for c, x in seqs.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        w = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * w
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df, rebuild=True, **kw):
    lists = pt.turn_lists(df)
    got = pt.prefix_trie(pt.with_shared_heads(lists) if rebuild else lists, **kw)
    return sorted(map(tuple, got.collect()), key=repr)


def random_rows(n, seed, words=3, turns=6):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, turns)):
            rows.append((c * (1 if c % 9 else 70_000), t, r.choice(["user", "assistant"]), r.choice(["a", "a b", "ä  c\nd", ""][:words])))
    return rows


@pytest.mark.parametrize("kw", [{}, {"container_sequences": 4}, {"container_sequences": 1, "container_turns": 1}, {"container_turns": 20}])
def test_against_plain_trie(spark, kw):
    rows = random_rows(150, 1)
    assert run(frame(spark, rows), **kw) == brute(rows)


def test_long_shared_beginning_bursts_at_once(spark):
    rows = []
    for c in range(1, 30):
        rows += [(c, t, "user", f"turn {t}") for t in range(40)]
        rows += [(c, 40 + t, "user", f"turn {c % 7 if t == 0 else c} x") for t in range(c % 3)]
    got = run(frame(spark, rows), rebuild=False, container_sequences=2)
    assert got == brute(rows, rebuild=False)


def test_edges(spark):
    rows = [(None, 0, "user", "lost"), (None, 1, "user", "lost"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, None, None),
            (3, 1, "", ""), (4, 1, "user", "tie b"), (4, 1, "user", "tie a"), (4, 1, "user", "tie a"), (-7, 0, "user", "neg"),
            (-20, 0, "system", "base"), (60, 0, "system", "base"), (61, 0, "x", "long " * 50_000), (41, 5, "user", "no base"),
            (2**60, 3, "user", "far")]
    rows += [(c, 0, "user", "one") for c in range(100, 140)]  # many lose all turns
    for kw in ({}, {"container_sequences": 1}):
        assert run(frame(spark, rows), **kw) == brute(rows)
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(None, 1, "a", "b")])) == []


def test_a_third_of_all_conversations_equal(spark):
    rows = random_rows(60, 4)
    rows += [(1_000_000 + 4096 * c, t, "user", f"same {t}") for c in range(120) for t in range(3)]
    assert run(frame(spark, rows), rebuild=False, container_sequences=8) == brute(rows, rebuild=False)


def test_query_and_sql(spark):
    from chronoweave.llm.queries import ORACLE, QUERIES
    ok, why = compare(QUERIES["op13_prefix_trie"](spark, SF_SMALL), duck(SF_SMALL), ORACLE["op13_prefix_trie"])
    assert ok, why
