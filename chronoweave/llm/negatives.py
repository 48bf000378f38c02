"""Hard negatives of anchors by segment summaries: bounds first, exact scores for what is left.

A vector is cut into segments; of each its mean and its deviation are stored. For one segment of
``m`` components the product of two vectors is ``m * mean * mean`` plus or minus at most
``m * deviation * deviation`` (Cauchy-Schwarz), and the sums over segments bound the score.
Segments are halved from one level to the next, for the candidates that the level before left
open; only what the finest level leaves is scored exactly.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut

NO_LIMIT = np.iinfo(np.int64).max
#: Scaled components that may take part: products of vectors of fewer than 2**11 of them fit a long.
LARGEST = 1 << 26


def segment_edges(dims: int, least: int = 8) -> list[np.ndarray]:
    """Where segments start, by level: one segment, then halves, down to ``least`` components."""
    levels, edges = [], np.array([0, dims])
    while True:
        levels.append(edges)
        if (np.diff(edges) < 2 * least).any():
            return levels
        edges = np.sort(np.concatenate((edges, (edges[:-1] + edges[1:]) // 2)))


@dataclass
class Summaries:
    """Per level, each row's segment means and deviations, both times the root of the segment's length."""
    means: list[np.ndarray]
    deviations: list[np.ndarray]

    @classmethod
    def of(cls, v: np.ndarray) -> "Summaries":
        """``v``: rows of integers. Sums are exact in float64; the rest is rounded (see ``slack``)."""
        x = v.astype(np.float64)
        means, deviations = [], []
        for edges in segment_edges(v.shape[1]):
            size = np.diff(edges)
            total = np.add.reduceat(x, edges[:-1], axis=1)
            squares = np.add.reduceat(x * x, edges[:-1], axis=1)
            means.append(total / np.sqrt(size))
            deviations.append(np.sqrt(np.maximum(0.0, squares - total * total / size)))
        return cls(means, deviations)


def slack(v: np.ndarray) -> np.ndarray:
    """What rounding can move a row's bounds by, for each unit of the other row's length."""
    x = v.astype(np.float64)
    return 1e-6 * (np.sqrt((x * x).sum(axis=1)) + 1.0)


class Block:
    """Candidates of one task: ids, labels, integer vectors of one length, and their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.floats = self.vectors.astype(np.float64)
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.summaries, self.slack = Summaries.of(self.vectors), slack(self.vectors)
        self.scored = 0  # exact scores so far

    def best(self, open_: np.ndarray, queries: np.ndarray, limits: list[list[tuple[int, int, int]]]
             ) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """For each query and each (least, most, k) of its ``limits``, the k best scores from least
        to most among the rows that ``open_`` (queries by rows) marks, ties to smaller ids:
        (rows, scores), best first. ``open_`` is used up.

        A level's bounds close a row for a query if they lie outside of all its ranges, or if in
        each range k rows that are surely inside have lower bounds above its upper bound. Equal
        scores stay: an id may decide. Closed rows are not refined.
        """
        q = Summaries.of(queries)
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)) + 1.0
        for mean, dev, qm, qd in zip(self.summaries.means, self.summaries.deviations, q.means, q.deviations):
            rows = np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                break
            rows = slice(None) if 2 * len(rows) > len(self.ids) else rows
            middle = qm @ mean[rows].T
            spread = qd @ dev[rows].T + np.outer(lengths, self.slack[rows])
            low, high = middle - spread, np.add(middle, spread, out=middle)
            for n, ranges in enumerate(limits):
                if not ranges:
                    continue
                lo, hi, o = low[n], high[n], open_[n, rows]
                floor = min(_threshold(lo, hi, o, 2 * spread[n].min(), *r) for r in ranges)
                open_[n, rows] = o & (hi >= floor) & (lo <= max(r[1] for r in ranges))
        rows = np.flatnonzero(open_.any(axis=0))
        if not len(rows):
            return [[(rows, rows)] * len(r) for r in limits]
        # whole numbers below 2**53 are exact in float64
        exact = self.largest * int(np.abs(queries).max()) * queries.shape[1] < 1 << 53
        at = slice(None) if 2 * len(rows) > len(self.ids) else rows
        scores = (queries.astype(np.float64) @ self.floats[at].T).astype(np.int64) if exact else queries @ self.vectors[at].T
        out = []
        for n, ranges in enumerate(limits):
            live = np.flatnonzero(open_[n, at])
            self.scored += len(live)
            s = scores[n, live]
            live = live if isinstance(at, slice) else rows[live]
            out.append([_top(live, s, self.ids, *r) for r in _sorted_ranges(s, ranges)])
        return out


def _threshold(lo: np.ndarray, hi: np.ndarray, open_: np.ndarray, width: float, least: int, most: int, k: int) -> float:
    """A score that the k best of a range surely reach."""
    if width > most - least:
        return least  # no bounds fit inside
    sure = lo[(lo >= least) & (hi <= most) & open_]
    return max(least, np.partition(sure, len(sure) - k)[len(sure) - k]) if len(sure) >= k else least


def _sorted_ranges(s: np.ndarray, ranges: list[tuple[int, int, int]]):
    """Each range narrowed to its k best scores."""
    ordered = np.sort(s)
    for least, most, k in ranges:
        end = int(np.searchsorted(ordered, most, "right"))
        yield max(least, int(ordered[max(0, end - k)])) if end else 1, most if end else 0, k


def _top(rows: np.ndarray, s: np.ndarray, ids: np.ndarray, least: int, most: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    inside = np.flatnonzero((s >= least) & (s <= most))
    o, t = rows[inside], s[inside]
    first = np.lexsort((ids[o], -t))[:k]
    return o[first], t[first]


def score_range(positive: int, least_percent: int = 50, most_percent: int = 95) -> tuple[int, int]:
    """Least and greatest integer negative score: least_percent * p <= 100 * n <= most_percent * p."""
    return -(-least_percent * positive // 100), most_percent * positive // 100


def _vectors(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A column of integer lists as one flat array and the lists' lengths."""
    a = col.combine_chunks()
    a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(a.offsets.to_numpy())


def _by_length(t: pa.Table, column: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of a table and their vectors, for each vector length."""
    flat, lengths = _vectors(t.column(column))
    starts = np.cumsum(lengths) - lengths
    out = {}
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        out[d] = rows, flat[starts[rows][:, None] + np.arange(d)]
    return out


def _search(rows: pa.Table, asks: pa.Table, eligible, limits, columns, step: int = 32):
    """Output columns of a block of candidates and a block of anchors, some anchors at a time.
    ``eligible(block, ask rows)`` marks candidates, ``limits(ask row)`` are its ranges, and
    ``columns(block, ask row, results)`` yields the columns of its results."""
    out: list = []
    if len(rows) and len(asks):
        ids, labels = rows.column("i").to_numpy(), rows.column("label").to_numpy()
        wanted = _by_length(asks, "query")
        for d, (at, vectors) in _by_length(rows, "v").items():
            if d not in wanted:
                continue
            block = Block(ids[at], labels[at], vectors)
            ask_rows, queries = wanted[d]
            for n in range(0, len(ask_rows), step):
                some = ask_rows[n:n + step]
                found = block.best(eligible(block, some), queries[n:n + step], [limits(r) for r in some.tolist()])
                for r, results in zip(some.tolist(), found):
                    out.extend(columns(block, r, results))
    return [np.concatenate(c) for c in zip(*out)] if out else None


def prepared(vectors: DataFrame, *, id_col: str, vec_col: str, label_col: str, flip: Column, anchors: Column,
             scale: int, labels: int) -> DataFrame:
    """Rows that take part, as (i, label, v, anchor)."""
    x = F.col(vec_col)
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    good = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)
            & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * scale >= LARGEST)))
    label = F.col(label_col).cast("long")
    return vectors.where(good).select(
        F.col(id_col).cast("long").alias("i"),
        F.when(flip, (label + 1) % labels).otherwise(label).alias("label"),
        scaled.cast("array<int>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))


def hard_negatives(vectors: DataFrame, anchors: Column, *, flip: Column | None = None, id_col: str = "vec_id",
                   vec_col: str = "embedding", label_col: str = "label", scale: int = 256, labels: int = 10,
                   positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95,
                   rows_per_block: int = 8192, anchors_per_block: int = 4096) -> DataFrame:
    """For each row that ``anchors`` selects and each of its best ``positives`` other rows of the
    same label, the best ``negatives`` rows of other labels whose score is between ``least_percent``
    and ``most_percent`` of the positive's: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score.

    Scores are integer inner products of ``floor(scale * x)``; ties go to smaller ids. ``flip``
    selects rows whose label first becomes ``(label + 1) % labels``. Rows with a null id, label or
    vector, an empty vector, a null or non-finite component, or one so large that scaled it has 2**26
    or more (a score might exceed a long) take no part; a row with another vector length than an
    anchor's has no product with it. Rows that share the anchor's id are the anchor itself, for its
    positives; a repeated row is a positive or a negative as often as it is there, and a repeated
    anchor row searches as often. Anchors without positives, and positives without negatives in
    range, give no row; nor does an empty table. Other columns are ignored.

    Candidates and anchors are dealt into blocks (by a hash of the whole row and its place, so that
    no id, label or vector is a hot block); a task compares one block of candidates with one of
    anchors. The first pass finds positives, the second the negatives of all ranges of an anchor;
    block winners are merged per anchor. Candidates are copied once per ``anchors_per_block`` anchors.
    """
    base = cut(prepared(vectors, id_col=id_col, vec_col=vec_col, label_col=label_col, flip=F.lit(False) if flip is None else flip,
                        anchors=anchors, scale=scale, labels=labels).withColumn("a", F.monotonically_increasing_id()))
    size = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("anchor").cast("long")).alias("q")).first()
    cb = max(1, -(-int(size["n"]) // rows_per_block))
    qb = max(1, -(-int(size["q"] or 0) // anchors_per_block))
    block = lambda n: F.pmod(F.xxhash64("a"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = base.select("i", "label", "v", block(cb).alias("c"), every(qb).alias("q")).groupBy("q", "c")
    # under names of their own: both sides of a cogroup come from one table
    asks = base.where("anchor").select(block(qb).alias("aq"), F.col("a").alias("ask"), F.col("i").alias("id"),
                                       F.col("label").alias("own"), F.col("v").alias("query"))

    def table(names: str, cols) -> pa.Table:
        names = names.split()
        return pa.table({n: pa.array(c if cols else [], pa.int64()) for n, c in zip(names, cols or [()] * len(names))})

    def find_positives(rows: pa.Table, anchors_: pa.Table) -> pa.Table:
        a, i, label = (anchors_.column(c).to_numpy() for c in ("ask", "id", "own"))

        def own(b: Block, r: np.ndarray):
            return (b.labels == label[r][:, None]) & (b.ids != i[r][:, None])

        def columns(b: Block, r: int, results):
            for at, s in results:
                yield np.full(len(at), a[r]), b.ids[at], s
        return table("a positive_id positive_score",
                     _search(rows, anchors_, own, lambda r: [(-NO_LIMIT, NO_LIMIT, positives)], columns))

    first = Window.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")
    found = (candidates.cogroup(asks.withColumn("ac", every(cb)).groupBy("aq", "ac"))
             .applyInArrow(find_positives, "a long, positive_id long, positive_score long")
             .withColumn("p", F.row_number().over(first)).where(F.col("p") <= positives))
    # at most ``positives`` of each anchor
    wanted = cut(found.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("p", "positive_id", "positive_score"))).alias("ps")))

    def find_negatives(rows: pa.Table, anchors_: pa.Table) -> pa.Table:
        a, i, label = (anchors_.column(c).to_numpy() for c in ("ask", "id", "own"))
        ps = anchors_.column("ps").to_pylist()

        def other(b: Block, r: np.ndarray):
            return b.labels != label[r][:, None]

        def limits(r: int):
            return [(*score_range(x["positive_score"], least_percent, most_percent), negatives) for x in ps[r]]

        def columns(b: Block, r: int, results):
            for x, (at, s) in zip(ps[r], results):
                n = len(at)
                yield (np.full(n, a[r]), np.full(n, x["p"]), np.full(n, i[r]), np.full(n, x["positive_id"]),
                       np.full(n, x["positive_score"]), b.ids[at], s)
        return table("a p anchor_id positive_id positive_score negative_id negative_score",
                     _search(rows, anchors_, other, limits, columns))

    asked = asks.join(wanted.withColumnRenamed("a", "ask"), "ask").withColumn("ac", every(cb))
    out = candidates.cogroup(asked.groupBy("aq", "ac")).applyInArrow(
        find_negatives, "a long, p long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("a", "p").orderBy(F.desc("negative_score"), "negative_id")
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


ORACLE = """
WITH g AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, a.label = c.label AS same,
             CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM g a JOIN g c ON len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS n FROM s WHERE same AND vec_id <> anchor_id),
x AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
      WHERE p.n <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM x WHERE rank <= 3
"""
