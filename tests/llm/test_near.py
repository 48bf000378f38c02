"""Near-duplicate classes, line removal, token counts, packing and top-k against plain Python."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronoweave.llm import line_dedup, near_dedup, packing, token_counts, tokens, topk
from chronoweave.plans.oracle_compare import compare, duck
from llm_helpers import SF_SMALL, make_docs  # noqa: F401


def brute_classes(rows, least=0.8, w=5):
    def sh(t):
        x = (t or "").encode().split()
        return Counter(tuple(x[i:i + w]) for i in range(len(x) - w + 1)) if len(x) >= w else Counter([tuple(x)] if x else [])

    def similarity(a, b):  # probability Jaccard, by its definition
        if not a.keys() & b.keys():
            return 0
        return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
    sets = [sh(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            # it is at most the share of the weights in common
            if a and b and sum(min(a[e] / a.total(), b[e] / b.total()) for e in a.keys() & b.keys()) >= least - 1e-9 \
                    and similarity(a, b) >= least - 1e-9:
                parent[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), k), k)
    return Counter((k, low[root(i)]) for i, (k, _) in enumerate(rows))


def variants(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeñ") for _ in range(5))
    rows, k = [], 0
    for g in range(12):
        base = [word() for _ in range(r.choice([3, 8, 60, 200]))]
        for _ in range(r.randint(1, 6)):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 60))):
                t[r.randrange(len(t))] = word()
            rows.append((k, " ".join(t)))
            k += 1
    rows += [(k, ""), (k + 1, None), (k + 2, rows[0][1]), (k + 3, rows[4][1] + " "), (k + 4, "same " * 500), (k + 5, "same " * 700)]
    return rows


@pytest.mark.parametrize("bounds", [{}, {"docs_per_task": 3}, {"bytes_per_task": 2000}])
def test_near_classes(spark, make_docs, bounds):
    rows = variants()
    got = near_dedup.near_classes(make_docs(rows), **bounds).collect()
    assert Counter(map(tuple, got)) == brute_classes(rows)


def test_near_classes_edges(spark, make_docs):
    assert near_dedup.near_classes(make_docs([])).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s t u v"), (3, "q r s t u v")]
    got = Counter(map(tuple, near_dedup.near_classes(make_docs(rows)).collect()))
    assert got == Counter([(None, None), (1, 1), (1, 1), (1, 1), (3, 1)])


def test_near_classes_where_one_text_repeats_a_block(spark, make_docs):
    """Pairs with a set similarity just over 0.8, of which one text holds a block 50 times: linked if
    the other does, too, and not if it holds the block once."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(7))
    rows = []
    for k in range(0, 60, 2):
        block, rest = [word() for _ in range(60)], [word() for _ in range(140)]
        rows.append((k, " ".join(block * (50 if k % 4 else 1) + rest)))
        rows.append((k + 1, " ".join(block * 50 + rest[:120] + [word() for _ in range(10)])))
    want = brute_classes(rows)
    assert want == Counter((k, k - k % 2 if k % 4 > 1 else k) for k in range(60))
    assert Counter(map(tuple, near_dedup.near_classes(make_docs(rows)).collect())) == want


def test_near_classes_of_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = Counter(map(tuple, near_dedup.near_classes(docs).collect()))
    assert got == brute_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_prob_min_hash_estimates_probability_jaccard():
    ids = np.random.default_rng(1).integers(1, 2 ** 62, 300).astype(np.uint64)
    wa, wb = np.ones(300), np.ones(300)
    wa[:50], wb[50:100], wb[100:150] = 4.0, 0.0, 3.0
    keep = wb > 0
    both_ids, both_w = np.concatenate((ids, ids[keep])), np.concatenate((wa, wb[keep]))
    a, b = near_dedup.prob_min_hash(both_ids, both_w, np.repeat([0, 1], [300, keep.sum()]), 2, 4096)
    x, y = wa / wa.sum(), wb / wb.sum()
    both = (x > 0) & (y > 0)
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(both))
    assert abs((a == b).mean() - want) < 0.04


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 400)]
    parent = list(range(500))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {x.v: x.c for x in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root(v) for e in edges for v in e}


def test_line_dedup(spark, make_docs):
    rows = [(i, f"own {i}\nshared line\n\n shared line \nfew", f"s{i % 9}") for i in range(20)]
    rows += [(50, None, "s1"), (51, "", None), (None, "shared line\nx", "s3"), (0, "shared line\nown 0", "s0"), (52, "\n".join(["shared line"] * 3000), None)]
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(make_docs(rows), sites=9).collect())
    # "shared line" stays at position 0 of the second row of document 0, "few" at position 4 of its first
    want = [(i, f"own {i}\n" if i else "own 0\n\nfew", 5, 3 if i else 2) for i in range(20)]
    want += [(50, None, 0, 0), (51, "", 1, 0), (None, "x", 2, 1), (0, "shared line\nown 0", 2, 0), (52, "", 3000, 3000)]
    assert got == Counter(want)
    assert line_dedup.line_dedup(make_docs([])).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, make_docs, rule):
    rows = [(1, "The cat\nsat on\n\n the mat ñandú\n日本"), (2, ""), (3, None), (None, "a\nb"), (4, "\n\n"), (5, "x " * 3000 + "\n" + "y" * 9)]
    out = token_counts.token_counts(make_docs(rows), rule=rule).collect()
    enc = tokens.encoder()
    want = []
    for k, t in rows:
        t = t or ""
        off = enc.tokenizer.encode(t, add_special_tokens=False).offsets
        s = [0] + [i + 1 for i, c in enumerate(t) if c == "\n" and i + 1 < len(t)]
        e = s[1:] + [len(t)]
        n = defaultdict(float)
        for a, b in off:
            held = [max(0, min(b, y) - max(a, x)) for x, y in zip(s, e)]
            if rule == "share":
                for i, h in enumerate(held):
                    n[i] += h / sum(held)
            else:
                hit = [i for i, h in enumerate(held) if h]
                n[{"first": hit[0], "last": hit[-1], "most": held.index(max(held))}[rule]] += 1
        want += [(k, i, x, y, round(n[i], 6)) for i, (x, y) in enumerate(zip(s, e))]
    assert Counter((r.doc_id, r.section, r.start, r.end, round(float(r.n_tokens), 6)) for r in out) == Counter(want)


def test_token_counts_add_up(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r[0]: r[1] for r in token_counts.token_counts(docs).groupBy("doc_id").sum("n_tokens").collect()}
    enc = tokens.encoder()
    rows = docs.collect()
    want = {r.doc_id: len(enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    assert got == want


def slow_pack(sizes, lengths, cost=packing.open_cost):
    """The same rules by linear search: (length opened, tokens held) of every bin in order."""
    bins, free, promised = [], Counter(sizes), Counter()
    for k in sorted(sizes, reverse=True):
        if promised[k]:
            promised[k] -= 1
        else:
            free[k] -= 1
        fit = [b for b in bins if b[0] - b[1] >= k]
        if fit:
            b = min(fit, key=lambda b: b[0] - b[1])
        else:
            options = []
            for c in sorted(c for c in lengths if c >= k):
                room, filling, rest = c - k, Counter(), Counter(free)
                while any(0 < s <= room and m > 0 for s, m in rest.items()):
                    s = max(s for s, m in rest.items() if 0 < s <= room and m > 0)
                    room, filling[s], rest[s] = room - s, filling[s] + 1, rest[s] - 1
                options.append((cost(c) / (c - room), -c, filling))
            _, c, filling = min(options, key=lambda o: o[:2])
            free -= filling
            promised += filling
            b = [-c, 0]
            bins.append(b)
        b[1] += k
    return bins


def final_cost(held, lengths, cost):
    return sum(cost(min(c for c in lengths if c >= h)) for h in held)


def least_cost(sizes, lengths, cost):
    """Least cost of any packing, by trying all."""
    def rest(i, held):
        if i == len(sizes):
            return final_cost(held, lengths, cost)
        own = [rest(i + 1, held + [sizes[i]])]
        return min(own + [rest(i + 1, held[:j] + [h + sizes[i]] + held[j + 1:])
                          for j, h in enumerate(held) if h + sizes[i] <= max(lengths)])
    return rest(0, [])


def tokens_held(bins, sizes):
    held = Counter()
    for b, n in zip(bins.tolist(), sizes):
        held[b] += n
    return held


def test_lengths_are_chosen_jointly():
    """Several lengths open all through a group; the total is under that of any one length."""
    r = random.Random(8)
    sizes = [min(8192, int(r.lognormvariate(6.3, 1.0)) + 1) for _ in range(4000)]
    opened = [c for c, _ in slow_pack(sizes, packing.LENGTHS)]
    middle = opened[len(opened) // 4: 3 * len(opened) // 4]
    assert len(set(middle)) >= 2
    held = tokens_held(packing.pack_group(np.array(sizes, np.int64), packing.LENGTHS)[0], sizes)
    joint = final_cost(held.values(), packing.LENGTHS, packing.open_cost)
    for one in packing.LENGTHS:
        cut = [p for n in sizes for p in [one] * (n // one) + [n % one] * (n % one > 0)]
        if one < 8192 and max(sizes) > one:
            continue  # its pieces are not the same
        alone = tokens_held(packing.pack_group(np.array(cut, np.int64), (one,))[0], cut)
        assert joint < final_cost(alone.values(), (one,), packing.open_cost)
        assert joint < final_cost(alone.values(), packing.LENGTHS, packing.open_cost)


def test_fewer_padded_positions_than_one_length():
    """Cost is positions only: pieces of 6 have nothing to fill 10 with once the 4s are promised."""
    sizes = [6] * 30 + [4] * 10 + [9] * 5
    bins, _, final = packing.pack_group(np.array(sizes, np.int64), (6, 10), cost=float)
    held = tokens_held(bins, sizes)
    length = dict(zip(bins.tolist(), final.tolist()))
    assert sum(length.values()) - sum(sizes) == 5  # one for each 9
    assert set(length.values()) == {6, 10}
    assert sum(10 for _ in tokens_held(packing.pack_group(np.array(sizes, np.int64), (10,), cost=float)[0], sizes)) > sum(length.values())


def test_packing_is_near_the_least_cost():
    r = random.Random(5)
    worst, total, least_total = 1.0, 0.0, 0.0
    for _ in range(40):
        lengths = (5, 8, 13)
        cost = lambda c: c + 1.0 + c * c / 20
        sizes = [r.randint(1, 13) for _ in range(r.randint(1, 7))]
        held = tokens_held(packing.pack_group(np.array(sizes, np.int64), lengths, cost)[0], sizes)
        got, least = final_cost(held.values(), lengths, cost), least_cost(sizes, lengths, cost)
        assert got >= least - 1e-9
        worst, total, least_total = max(worst, got / least), total + got, least_total + least
    assert worst <= 1.5 and total / least_total <= 1.08, (worst, total / least_total)


def test_a_hot_key_is_spread(spark, make_docs):
    """A third of all rows under one key with one text, another third under null: groups stay even."""
    rows = [(7, "same words")] * 300 + [(None, None)] * 300 + [(1000 + i, "w " * i) for i in range(300)]
    out = packing.best_fit_packing(make_docs(rows), docs_per_group=90).collect()
    per = Counter(r.bin_group for r in out)
    assert len(out) == 900 and len(per) == 10 and max(per.values()) <= 2 * 90
    assert Counter(r.doc_id for r in out)[7] == 300 and Counter(r.doc_id for r in out)[None] == 300


def test_pack_group_follows_the_rules():
    r = random.Random(4)
    for _ in range(20):
        sizes = [r.randint(1, 64) for _ in range(r.randint(0, 80))]
        bins, off, final = packing.pack_group(np.array(sizes, np.int64), (8, 16, 64))
        held = defaultdict(list)
        for b, o, n, f in zip(bins, off, sizes, final):
            held[b].append((o, n, f))
        for b, x in held.items():
            x.sort()
            assert all(p[0] + p[1] == q[0] for p, q in zip(x, x[1:])) and x[0][0] == 0
            total = sum(n for _, n, _ in x)
            assert {f for *_, f in x} == {min(c for c in (8, 16, 64) if c >= total)}
        # which of several equal gaps is taken may differ, but not how full the bins get
        assert sorted(sum(n for _, n, _ in x) for x in held.values()) == sorted(h for _, h in slow_pack(sizes, (8, 16, 64)))


def test_packing(spark, make_docs):
    rows = [(i, "w " * (i * 7 % 900)) for i in range(120)] + [(200, None), (None, "a"), (201, "long " * 30000), (5, "w " * 35)]
    out = packing.best_fit_packing(make_docs(rows), docs_per_group=40).collect()
    enc = tokens.encoder()
    n = Counter()
    for k, t in rows:
        n[k] += len(enc.tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    got, held = Counter(), defaultdict(list)
    for r in out:
        got[r.doc_id] += r.n_tokens
        held[r.bin_group, r.bin].append((r.offset, r.n_tokens, r.seq_len))
    assert got == n
    for x in held.values():
        x.sort()
        assert len({c for *_, c in x}) == 1 and x[0][2] in packing.LENGTHS
        assert all(a[0] + a[1] == b[0] for a, b in zip(x, x[1:]))
        total = sum(m for _, m, _ in x)
        assert x[0][2] == min(c for c in packing.LENGTHS if c >= total)
    assert packing.best_fit_packing(make_docs([])).count() == 0


def test_topk(spark):
    r = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(400, 6)).round(1))]
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (450, [float("nan")] * 6), (500, [float("inf")] * 6), (None, [1.0] * 6), (550, [0.0] * 6),
             (600, rows[0][1]), (600, rows[0][1]), (650, []), (700, rows[1][1]), (700, rows[2][1])]
    rows += [(701, [9.0] * 6), (701, [3.0] * 6), *[(702, [8.0] * 6)] * 150]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS c", "3 AS rank")
    out = topk.exact_topk(df, df.vec_id % 50 == 0, rows_per_block=64, queries_per_block=3)
    v = [(i, np.floor(256 * np.array(x, np.float32).astype(np.float64)).astype(int)) for i, x in rows
         if i is not None and x and all(y is not None and np.isfinite(y) for y in x)]
    want = []
    for q in {i for i, _ in v if i % 50 == 0}:
        s = sorted((-int(x @ y), i) for j, x in v if j == q for i, y in v if i != q)[:5]
        want += [(q, k + 1, i, -m) for k, (m, i) in enumerate(s)]
    assert Counter(map(tuple, out.collect())) == Counter(want)
    assert topk.exact_topk(df.limit(0), df.vec_id % 50 == 0).count() == 0


def test_threshold_walk_stops_early():
    r = np.random.default_rng(1)
    m = (r.zipf(1.6, size=(5000, 4)) % 10_000).astype(np.int64)
    order = np.argsort(m, axis=0)
    rows, score, depth = topk.threshold_topk(m, np.arange(5000), np.array([5, 1, 0, 2]), None, 5, order, np.take_along_axis(m, order, 0))
    assert depth < 2500 and sorted(score)[::-1] == sorted(m @ np.array([5, 1, 0, 2]))[::-1][:5]


def test_line_dedup_against_sql(spark):
    from chronoweave.llm.queries import ORACLE, QUERIES
    for name in ORACLE:
        ok, msg = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])
        assert ok, (name, msg)


def test_a_large_group_has_few_edges(spark):
    """Members that meet in 32 bands keep about one edge each; the components stay the same."""
    import random
    from chronoweave.llm.near_dedup import components, fewer_edges
    rnd = random.Random(8)
    heads = list(range(-40, 0))
    rows = [(rnd.choice(heads), v) for v in range(1500) for _ in range(32)]          # one large group
    rows += [(10_000 + rnd.randrange(300), 10_000 + rnd.randrange(300)) for _ in range(160)]   # many small ones
    edges = spark.createDataFrame([r for r in rows if r[0] != r[1]], "a long, b long")
    few = fewer_edges(edges)
    assert edges.distinct().count() > 20_000 and few.where("a < 0").count() < 2 * (1500 + 40 * 40 / 2)
    assert few.where("b >= 0 AND b < 10000").count() == 1500
    assert {(r.v, r.c) for r in components(few).collect()} == {(r.v, r.c) for r in components(edges).collect()}
