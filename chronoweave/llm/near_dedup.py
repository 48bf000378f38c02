"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Rolling, WordHashes, cut, mix64, stored, utf8

_U = np.uint64


def shingle_hashes(words: list[bytes], hashes: WordHashes, roll: Rolling) -> np.ndarray:
    """Hashes of all runs of ``roll.width`` words; of the whole text if it has fewer."""
    if not words:
        return np.zeros(0, _U)
    h = hashes.of(words)
    if len(h) < roll.width:
        h = Rolling(len(h))(h)
    else:
        h = roll(h)
    return h


def prob_min_hash(ids: np.ndarray, weights: np.ndarray, of: np.ndarray, n: int, m: int) -> np.ndarray:
    """ProbMinHash signatures of ``n`` weighted sets, an ``n`` by ``m`` array: per register the
    element whose arrival there came first. ``of`` is the set of each element.

    Every element is a Poisson process of rate ``weight``; each arrival falls on a random
    register. An element stops once its next arrival is later than the latest register of its
    set (early termination): later arrivals can change nothing. The share of equal registers of
    two signatures estimates their probability Jaccard similarity. The sets go through their
    arrivals together, so that each turn is a few operations on long arrays.
    """
    first = np.full(n * m, np.inf)
    out = np.zeros(n * m, _U)
    time, turn = np.zeros(len(ids)), 0
    worst = np.full(n, np.inf)
    while len(ids):
        r = mix64(ids, 11 + turn)
        time = time - np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weights
        ok = time < worst[of]
        ids, weights, of, time = ids[ok], weights[ok], of[ok], time[ok]
        slot = of * m + (mix64(ids, 1_000_003 + turn) % _U(m)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        out[slot[won]] = ids[won]
        left = np.flatnonzero(np.bincount(of, minlength=n))
        worst[left] = first.reshape(n, m)[left].max(axis=1)
        turn += 1
    return out.reshape(n, m)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted elements, their weights): the
    chance that registers of their ProbMinHash signatures are equal. An element ``i`` of both adds
    one over the sum, over all elements ``j``, of ``max(wa[j] / wa[i], wb[j] / wb[i])``."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    x, y = wa[both].astype(np.float64), wb[at[both]].astype(np.float64)
    if not len(x):
        return 0.0
    only_a, only_b = float(wa.sum(dtype=np.int64)) - x.sum(), float(wb.sum(dtype=np.int64)) - y.sum()
    if (x == y).all():
        return float(x.sum() / (only_a + only_b + x.sum()))
    # elements whose ratio is at least that of i count by their weight in a, the others by that in b
    by = np.argsort(x / y, kind="stable")
    x, y = x[by], y[by]
    return float((1 / ((only_a + np.cumsum(x[::-1])[::-1]) / x + (only_b + np.cumsum(y) - y) / y)).sum())


def text_id(text: bytes) -> int:
    """64 bits of a digest of the text: equal texts are one vertex."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, *, width: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """key, ``v`` (64-bit digest of the text), ``size`` (its UTF-8 bytes), ``bands`` (64-bit key of
    each band); texts without words give no row."""
    m = bands * rows

    def sign_sets(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        ids, weights = (np.concatenate(x) for x in zip(*sets))
        of = np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
        s = prob_min_hash(ids, weights, of, len(sets), m).reshape(len(sets), bands, rows)
        code = np.zeros((len(sets), bands), _U)
        for j in range(rows):
            code = mix64(code ^ s[:, :, j], j)
        return code.view(np.int64)

    def sign(batches):
        hashes, roll = WordHashes(), Rolling(width)

        def out(keys, same, sizes, sets):
            codes = np.zeros((len(keys), bands), np.int64)
            # turns go with the largest share of an element
            order = np.argsort([-(w.max() / w.sum()) for _, w in sets], kind="stable")
            for lo in range(0, len(order), 256):
                part = order[lo:lo + 256]
                codes[part] = sign_sets([sets[i] for i in part])
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(same, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * bands, pa.int32()), pa.array(codes.reshape(-1)))],
                names=["k", "v", "size", "bands"])

        for b in batches:
            keys, same, sizes, sets, held = [], [], [], [], 0
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                h = shingle_hashes(t.split(), hashes, roll)
                if not len(h):
                    continue
                ids, counts = np.unique(h, return_counts=True)
                keys.append(k)
                same.append(text_id(t))
                sizes.append(len(t))
                sets.append((ids, counts.astype(np.float64)))
                held += len(ids)
                if held > 3_000_000:
                    yield out(keys, same, sizes, sets)
                    keys, same, sizes, sets, held = [], [], [], [], 0
            if keys:
                yield out(keys, same, sizes, sets)

    return (docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), utf8(text).alias("t"))
            .mapInArrow(sign, "k long, v long, size long, bands array<long>"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph (columns ``a``, ``b``): ``v``, ``c`` = the
    smallest vertex of v's component.

    Labels fall along edges, then each label jumps to its label's label, until nothing changes;
    every round is a few grouped joins on narrow rows, and its result is written, so a lost
    executor costs one round.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")))
    while True:
        seen = both.join(label.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("near"))
        step = label.join(seen, "v").select("v", "c", F.least("c", "near").alias("low"))
        # a vertex also tells its old label's vertex, so long chains halve
        told = step.where("low < c").groupBy(F.col("c").alias("v")).agg(F.min("low").alias("told"))
        step = step.join(told, "v", "left").select("v", "c", F.least("low", F.coalesce("told", "low")).alias("low"))
        jump = step.select(F.col("v").alias("low"), F.col("low").alias("next"))
        after = cut(step.join(jump, "low").select("v", F.col("c").alias("old"), F.least("low", "next").alias("c")))
        changed = after.where("old <> c").limit(1).count()
        label = after.select("v", "c")
        if not changed:
            return label


def fewer_edges(edges: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) of a graph with the components of ``edges``: each ``b`` keeps one to the
    least of its neighbours ``a`` and itself, and that one has edges to the others. A large group's
    members share their neighbours, so those edges are the same for all, and about one a member is left."""
    of = edges.groupBy("b").agg(F.collect_set("a").alias("all"))
    low = F.least(F.array_min("all"), F.col("b"))
    return (of.select(low.alias("a"), F.explode(F.array_append("all", F.col("b"))).alias("b"))
            .where("a <> b").distinct())


class _Sets:
    """Sorted shingle hashes of some texts with their weights, and the links among them, by prefix
    filtering."""

    def __init__(self, keys: list[int], sets: list[tuple[np.ndarray, np.ndarray]], least: float):
        self.keys, self.least = keys, least
        self.sets, self.weights = [s for s, _ in sets], [w for _, w in sets]
        self.parent = list(range(len(keys)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def alike(self, i: int, j: int) -> bool:
        if len(self.sets[i]) > len(self.sets[j]):
            i, j = j, i
        return probability_jaccard(self.sets[i], self.weights[i], self.sets[j], self.weights[j]) >= self.least - 1e-9

    def link(self) -> None:
        """Join all texts with probability Jaccard >= least. Weights as shares of their text, two
        such texts have at least ``least`` of them in common, so what stands in either before their
        first common element, in one order of all elements (rarest first), is at most the rest: that
        element is among the beginnings of both. Texts that are joined already are not compared. Texts that matched last are tried
        first, so a text that many others resemble is found at once."""
        sizes = np.array([len(s) for s in self.sets])
        flat = np.concatenate(self.sets)
        value, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(value), np.int64)
        rank[np.lexsort((value, count))] = np.arange(len(value))
        ranks = rank[inverse]
        ends = np.cumsum(sizes)
        holders: dict[int, dict[int, list[int]]] = {}  # element -> class -> texts
        for i in np.argsort(sizes, kind="stable").tolist():
            mine, w = ranks[ends[i] - sizes[i]:ends[i]], self.weights[i]
            by = np.argsort(mine)
            before = np.cumsum(w[by], dtype=np.float64) - w[by]
            head = mine[by[before <= (1 - self.least + 1e-9) * w.sum(dtype=np.int64)]].tolist()
            tried: set[int] = set()
            for e in head:
                groups = holders.get(e)
                if groups is None:
                    continue
                for old in list(groups):
                    r = self.root(old)
                    if r != old:  # classes that have met since
                        groups.setdefault(r, []).extend(groups.pop(old))
                for r in list(groups):
                    if r not in groups or self.root(i) == self.root(r):
                        continue
                    at = groups[r]
                    for p in range(len(at) - 1, -1, -1):
                        j = at[p]
                        if j in tried:
                            continue
                        tried.add(j)
                        if self.alike(i, j):
                            x, y = self.root(i), self.root(j)
                            self.parent[max(x, y)] = min(x, y)
                            at.append(at.pop(p))
                            break
            for e in head:
                holders.setdefault(e, {}).setdefault(self.root(i), []).append(i)


def near_classes(docs: DataFrame, *, least: float = 0.8, width: int = 5, bands: int = 32, rows: int = 6,
                 key: str = "doc_id", text: str = "text", docs_per_task: int = 4000,
                 bytes_per_task: int = 128 << 20) -> DataFrame:
    """Classes of near-duplicate documents: key, class_id (the smallest key of the class).

    Two texts are linked if the probability Jaccard similarity of their ``width``-word shingles,
    weighted by how often the text holds them (words: runs of bytes other than space and 0x09-0x0D),
    is ``least`` or more; where no text repeats a shingle, that is the Jaccard similarity of the
    sets. Classes are the connected components of links and of equal texts. Equal texts collapse
    first. The others get ProbMinHash signatures of their weighted shingles, whose registers
    estimate the very similarity that decides, and meet in band buckets; buckets send each member to their smallest member (no pairs), and the components of
    that graph hold all candidate links: with 32 bands of 6 registers a pair at similarity 0.8
    meets with probability 0.9999. Each component's texts then come together once, and the exact
    similarity decides each link that could still join two classes. A component of more than
    ``docs_per_task`` texts or ``bytes_per_task`` bytes is dealt into blocks of about half as
    much; every two blocks meet in a task of their own, and components of the links found give
    the classes, so no task holds more than two blocks and no link between blocks is lost.

    Null and empty texts take no part (each is its own class). Null keys give rows with a null
    class. Rows that share a key
    get the smallest class of their texts. Empty table: no rows. Other columns are ignored.
    """
    sig = stored(signatures(docs, width=width, bands=bands, rows=rows, key=key, text=text), "signatures")
    reps = sig.groupBy("v").agg(F.min("k").alias("rep"), F.max("size").alias("size"))
    band = (sig.join(reps, "v").where("k = rep").select("v", "bands").dropDuplicates(["v"])
            .select("v", F.posexplode("bands").alias("band", "code")))
    head = band.groupBy("band", "code").agg(F.min("v").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = band.join(head, ["band", "code"]).where("v <> a").select("a", F.col("v").alias("b"))
    coarse = components(fewer_edges(edges))
    of_text = coarse.join(reps, "v")
    load = of_text.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    whole = (F.col("n") <= docs_per_task) & (F.col("bytes") <= bytes_per_task)
    blocks = F.when(whole, 1).otherwise(F.ceil(F.greatest(
        F.col("n") / max(1, docs_per_task // 2), F.col("bytes") / max(1, bytes_per_task // 2)))).cast("int")
    placed = of_text.join(load, "c").select("v", "rep", "c", blocks.alias("nb"))
    placed = placed.withColumn("x", F.pmod(F.xxhash64("v"), F.col("nb")).cast("int"))
    # a block meets every block of its component
    meet = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda y: F.struct(
        F.least("x", y).alias("lo"), F.greatest("x", y).alias("hi")))
    tasks = (placed.select("v", "rep", "c", F.explode(meet).alias("p"))
             .select("v", "rep", "c", "p.lo", "p.hi"))
    texts = docs.select(F.col(key).cast("long").alias("rep"), utf8(text).alias("t"))

    def verify(t: pa.Table) -> pa.Table:
        hashes, roll = WordHashes(), Rolling(width)
        sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for v, x in zip(t.column("v").to_pylist(), t.column("t")):
            x = x.as_py()
            if v not in sets and text_id(x) == v:  # rows with an equal key may hold other texts
                ids, counts = np.unique(shingle_hashes(x.split(), hashes, roll), return_counts=True)
                sets[v] = ids, counts.astype(np.int32)
        ids = sorted(sets)
        s = _Sets(ids, [sets[v] for v in ids], least)
        s.link()
        pairs = [(ids[s.root(i)], v) for i, v in enumerate(ids) if s.root(i) != i]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    links = texts.join(tasks, "rep").groupBy("c", "lo", "hi").applyInArrow(verify, "a long, b long")
    of = components(links)
    members = reps.join(of, "v", "left").select("v", "rep", F.coalesce("c", "v").alias("c"))
    least_key = members.groupBy("c").agg(F.min("rep").alias("class_id"))
    found = (sig.select("k", "v").join(members.select("v", "c"), "v").join(least_key, "c")
             .groupBy("k").agg(F.min("class_id").alias("class_id")))
    return (docs.select(F.col(key).cast("long").alias("k")).join(found, "k", "left")
            .select(F.col("k").alias(key), F.coalesce("class_id", "k").alias("class_id")))
