"""Toxicity, decontamination and the pipeline against plain Python."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import decontamination, toxicity
from llm_helpers import DOCS, SF_SMALL, make_docs  # noqa: F401


# ---- toxicity ----

def small_model(words):
    total = np.zeros(toxicity.SYMBOLS ** toxicity.ORDER, np.int64)
    toxicity._add(total, Counter(words))
    return toxicity.CharModel(total), total


def test_gram_counts_by_hand(spark, make_docs):
    rows = [(1, "Idiot. idiot, ñu über-x\n日本 a1b"), (2, None), (3, "the the the" * 3)]
    want = Counter()
    for _, t in rows:
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            want.update(toxicity.grams(w))
    got = {r.code: r.n for r in toxicity.gram_counts(make_docs(rows)).collect()}
    assert got == dict(want)


def test_char_model_is_a_distribution():
    m, _ = small_model(["idiot", "the", "then", "moron"])
    p = np.exp(-np.array(m.cost)).reshape(-1, toxicity.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_viterbi_finds_the_cheapest_path():
    m, _ = small_model(["idiot"] * 9 + ["the"] * 30 + ["moron"] * 5 + ["good"] * 8 + ["so", "on"])

    def brute(stretch):
        best = (math.inf, "")
        for path in product(*toxicity.lattice(stretch)):
            words = [w for w in "".join(c for c, _ in path).split(" ") if w]
            cost = sum(x for _, x in path) + sum(m.word_cost(w) for w in words)
            best = min(best, (cost, " ".join(words)))
        return best[1]
    for s in ("1d10t", "i d i o t", "i.d.i.0.t", "m0rooon", "g00d", "th3", "goood", "s o", "1!1"):
        assert toxicity.decode(s, m) == brute(s)
    for s in ("1d10t", "i d i o t", "i-d-i-o-t", "idiooot", "!d!0t"):
        assert toxicity.decode(s, m) == "idiot"
    r = toxicity.Restorer(m)
    assert "idiot" in r.words("you are an 1D10T, really") and "idiot" in r.words("an i d i o t here")
    assert r.words("the good moron") == {"the", "good", "moron"}
    assert r.text("an i d i o t") == "an idiot"


def test_long_stretches_are_read_whole():
    m, _ = small_model(["idiot"] * 9 + ["the"] * 30 + ["good"] * 8 + ["so", "on"])
    r = toxicity.Restorer(m)
    for before in range(30, 80):  # the word moves over 400 characters
        assert "idiot" in r.text(" ".join("the" * before + "idiot" + "the" * 20)).split()
    assert toxicity.decode(" ".join("good" * 5000), m).split() == ["good"] * 5000


def brute_choose_covers(rows, chance):
    return [any(f in chance for f in fs) for _, fs in rows]


def test_choose_leaves_companions_out():
    rows = [(1, [0, 1])] * 20 + [(1, [2, 1])] * 10 + [(0, [3])] * 200 + [(0, [1])] * 3
    base, chance = toxicity.choose(rows, ["scum", "near", "moro*", "fine"])
    assert set(chance) == {"scum", "moro*"} and base < 0.1


@pytest.fixture(scope="module")
def toxic_world(spark):
    r = random.Random(9)
    syl = ["ta", "re", "no", "mi", "sel", "du", "kor", "an", "it"]
    word = lambda: "".join(r.choice(syl) for _ in range(r.randint(1, 3)))
    bad = ["idiot", "scum", "moron"]
    rows, labels = [], []
    for i in range(900):
        t = [word() for _ in range(r.randint(3, 60))]
        y = int(r.random() < 0.25)
        if y:
            t.insert(r.randrange(len(t)), r.choice(bad))
        rows.append((i, " ".join(t), "en", "s", 0))
        if i % 3:
            labels.append((i, 1, y))
    extra = [(2000, None), (2001, ""), (2002, "ta re 1d10t mi"), (2003, "no m o r o n du"), (None, "ta scuuum"), (2004, "ta " * 30000 + "$cum"), (2005, "re mi")]
    rows += [(i, t, "en", "s", 0) for i, t in extra]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score", "2 AS y", "3 AS label").repartition(4)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5000, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    return docs, lab, rows


def test_toxicity(spark, toxic_world):
    docs, labels, rows = toxic_world
    out = toxicity.toxicity(docs, labels).select("doc_id", "text", "held_out", "score", "predicted", "label").collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert r.label == 3
    by = {r.doc_id: r.predicted for r in out}
    assert [by[i] for i in (2000, 2001, 2002, 2003, None, 2004, 2005)] == [0, 0, 1, 1, 1, 1, 0]
    held = [r for r in out if r.held_out and r.text]
    right = sum(r.predicted == int(any(w in r.text for w in ("idiot", "scum", "moron"))) for r in held)
    assert len(held) > 100 and right / len(held) > 0.98


def test_toxicity_edges(spark, toxic_world):
    docs, labels, _ = toxic_world
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    alone = toxicity.toxicity(docs.limit(5), labels.limit(0)).collect()
    assert {r.predicted for r in alone} == {0}


# ---- decontamination ----

def brute_pairs(rows, items, n=8):
    def words(t):
        return [x for x in (w.strip(decontamination.PUNCTUATION) for w in re.split(r"[ \t\n\x0b\f\r]+", t or "")) if x]

    def typed(w):
        if "0" <= w[0] <= "9":
            return "<num>"
        if w.lower() in decontamination.UNITS:
            return "<unit>"
        return "<name>" if w[0].lower() != w[0] else w.lower()
    out = set()
    for k, t in rows:
        d = words(t)
        dt = [typed(w) for w in d]
        for i, x in items:
            w = words(x)
            wt = [typed(v) for v in w]
            m = min(n, len(w))
            use = [p for p in range(len(w) - m + 1) if m and sum(v[0] != "<" for v in wt[p:p + m]) >= min(4, m)]
            diag = defaultdict(list)
            for p in use:
                for q in range(len(d) - m + 1):
                    if dt[q:q + m] == wt[p:p + m]:
                        diag[q - p].append(p)
            hit, run = set(), 0
            for g, ps in diag.items():
                pairs = {(wt[p + j], w[p + j], d[p + g + j]) for p in ps for j in range(m) if wt[p + j][0] == "<"}
                if not pairs or len({a[:2] for a in pairs}) / len(pairs) >= 0.8:
                    hit.update(ps)
                    run = max(run, len(set(ps)) + m - 1)
            if hit and (len(hit) / len(use) >= 0.5 or run >= 13):
                out.add((k, i, len(hit), len(use)))
    return out


QUESTION = "if Tom has 12 apples and gives 5 km of them to Anna how many apples does Tom have left over in the end of day 3"


def doc_rows():
    moved = QUESTION.replace("Tom", "Rob").replace("12", "99").replace("Anna", "Eve").replace("km", "miles")
    mixed = "if Tom has 12 apples and gives 5 km of them to Anna how many apples does Rob have left over in the end"
    r = random.Random(1)
    noise = lambda n: " ".join(r.choice(["the", "of", "Cat", "7", "run", "day", "-", "is"]) for _ in range(n))
    rows = [(1, noise(30) + " " + QUESTION + " " + noise(30)), (2, noise(9) + " " + moved + "."), (3, mixed), (4, noise(500)),
            (5, None), (6, ""), (None, QUESTION), (7, " ".join(QUESTION.split()[:13])), (8, " ".join(QUESTION.split()[:9])),
            (9, moved + " " + QUESTION), (1, "nothing here"), (10, noise(30000)), (11, "short, plain item!"), (12, "Tom Tom Tom Tom Tom Tom Tom Tom Tom Tom")]
    return rows


def test_decontamination(spark, make_docs):
    rows = doc_rows()
    items = [(1, QUESTION), (2, "short plain item"), (3, None), (4, ""), (5, "Tom Ann Bob Tim Kim Dan Joe Max Sam Ron"), (6, QUESTION[3:])]
    bench = spark.createDataFrame(items + [items[0]], "item_id long, text string").selectExpr("*", "'x' AS doc_id", "1 AS n", "2 AS h", "3 AS pos")
    out = decontamination.contaminated(make_docs(rows), bench)
    got = {(r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in out.collect()}
    want = brute_pairs(rows, items)
    assert got == want
    assert {(1, 1), (2, 1), (None, 1), (7, 1), (9, 1), (11, 2)} <= {x[:2] for x in got}
    assert not {k for k, *_ in got} & {4, 5, 6, 8, 10, 12}
    assert decontamination.contaminated(make_docs([]), bench).count() == 0
    assert decontamination.contaminated(make_docs(rows), bench.limit(0)).count() == 0


def test_decontamination_of_the_small_table(spark):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == brute_pairs([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])


def overlap_pairs(rows, items, n=8):
    """Pairs by windows of equal words, letter case aside."""
    def words(t):
        return [x.lower() for x in (w.strip(decontamination.PUNCTUATION) for w in re.split(r"[ \t\n\x0b\f\r]+", t or "")) if x]
    out = set()
    for k, t in rows:
        d = words(t)
        for i, x in items:
            w = words(x)
            m = min(n, len(w))
            diag = defaultdict(set)
            for p in range(len(w) - m + 1 if m else 0):
                for q in range(len(d) - m + 1):
                    if d[q:q + m] == w[p:p + m]:
                        diag[q - p].add(p)
            hit = set().union(*diag.values())
            run = max((len(s) + m - 1 for s in diag.values()), default=0)
            if hit and (len(hit) / (len(w) - m + 1) >= 0.5 or run >= 13):
                out.add((k, i))
    return out


def test_decontamination_whatever_the_letter_case(spark, make_docs):
    title = " ".join(w.capitalize() for w in "the long road that went over seven old hills and then came down".split())
    digits = " ".join(str(n) for n in range(2, 40, 3))
    items = [(1, QUESTION), (2, title), (3, digits), (4, QUESTION.upper().replace("TOM", "JOE")), (5, "plain words that hold no name or number at all in here")]
    copies = [f(x) for _, x in items for f in (str.upper, str.lower, str.title, lambda t: " ".join(t.split()[:9]))]
    rows = [(k, f"before it. {t} AND after") for k, t in enumerate(copies)] + [(90, "1 2 3 4 5 6 7 8 9 10 11 12"), (91, "A B C D E F G H I J K"), (92, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.contaminated(make_docs(rows), bench).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    templates = {x[:2] for x in brute_pairs(rows, items)}
    literal = overlap_pairs(rows, items)
    assert got == templates | literal and literal - templates
    assert {(4 * i + j, i + 1) for i in range(5) for j in range(3)} <= got
    whole = {(r.doc_id, r.item_id): r for r in out}[0, 1]
    assert (whole.coverage, whole.exact, whole.first, whole.last) == (1.0, True, 2, 1 + len(QUESTION.split()))


# ---- pipeline ----

def test_pipeline_stages(spark, tmp_dir):
    import corpus_pipeline as cp
    from chronoweave.llm import line_dedup, near_dedup, packing
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols = docs.columns
    now = docs
    for i, (name, stage) in enumerate(cp.STAGES):
        before = now
        stage(spark, before, SF_SMALL).write.parquet(f"{tmp_dir}/{i}")
        now = spark.read.parquet(f"{tmp_dir}/{i}")
        ids, kept = {r.doc_id for r in before.select("doc_id").collect()}, {r.doc_id for r in now.select("doc_id").collect()}
        assert kept <= ids
        if name != "packing":
            assert now.columns == cols
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
            bad = {r.doc_id for r in toxicity.toxicity(before, labels).where("predicted = 1").collect()}
            assert ids - kept == bad
        if name == "line_dedup":
            assert ids == kept
            want = {(r.doc_id, r.text) for r in line_dedup.line_dedup(before, sites=cp.LINE_SITES).collect()}
            assert {(r.doc_id, r.text) for r in now.collect()} == want
        if name == "near_dedup":
            classes = {r.doc_id: r.class_id for r in near_dedup.near_classes(before).collect()}
            assert kept == {k for k, c in classes.items() if k == c}
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            hit = brute_pairs([(r.doc_id, r.text) for r in before.collect()], [(r.item_id, r.text) for r in bench.collect()])
            assert ids - kept == {x[0] for x in hit}
        if name == "packing":
            assert kept == ids
            assert {r.seq_len for r in now.collect()} <= set(packing.LENGTHS)
    again = cp.run(spark, SF_SMALL)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, now.collect()))


def test_pipeline_keeps_columns_of_any_name(spark):
    """Columns named like the operators' own, or with a dot, and null keys and repeated rows."""
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    docs = docs.union(docs.where("doc_id < 5")).union(docs.limit(2).selectExpr("null", "text", "lang", "source", "n_chars"))
    names = ("score", "predicted", "held_out", "n_lines", "n_removed", "k", "class_id", "a.b")
    docs = docs.select("*", *[F.concat_ws("-", F.lit(n), "doc_id").alias(n) for n in names])
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        for row in out.select("doc_id", *[f"`{n}`" for n in names]).distinct().collect():
            assert all(row[n] == (n if row.doc_id is None else f"{n}-{row.doc_id}") for n in names), name
    assert cp.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()


def test_pipeline_of_no_documents(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0
