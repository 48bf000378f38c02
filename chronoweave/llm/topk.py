"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def threshold_topk(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, query_id: int | None, k: int,
                   lists: np.ndarray, sorted_values: np.ndarray, step: int = 32) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best rows of one block for one query: (rows, scores, depth reached).

    ``lists[:, j]`` are the rows in ascending order of dimension j and ``sorted_values[:, j]``
    their values. Each list is walked from the end that scores most for the query's sign; rows
    seen for the first time are scored whole; the walk stops when the bound, the sum of the
    products at the current depth, is below the kth best score (a row with an equal score could
    still win by its id).
    """
    n, dims = lists.shape
    seen = np.zeros(n, bool)
    if query_id is not None:
        seen[ids == query_id] = True  # the query's own row takes no part
    weight = query != 0
    used = np.flatnonzero(weight)
    best_rows, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth = 0
    down = query < 0
    if not len(used):  # every score is 0: any walk sees all rows
        used = np.zeros(1, np.int64)
    while depth < n:
        to = min(n, depth + step)
        fresh = np.zeros(n, bool)
        for j in used.tolist():
            fresh[lists[depth:to, j] if down[j] else lists[n - to:n - depth, j]] = True
        new = np.flatnonzero(fresh & ~seen)
        seen[new] = True
        if len(new):
            rows = np.concatenate((best_rows, new))
            score = np.concatenate((best, vectors[new] @ query))
            if len(rows) > k:
                # everything at or above the kth best score, then ties by id
                kth = np.partition(score, len(score) - k)[len(score) - k]
                keep = np.flatnonzero(score >= kth)
                keep = keep[np.lexsort((ids[rows[keep]], -score[keep]))[:k]]
                rows, score = rows[keep], score[keep]
            best_rows, best = rows, score
        depth, step = to, step * 2
        edge = np.where(down, sorted_values[depth - 1], sorted_values[n - depth])
        if len(best) >= k and int(edge @ query) < int(best.min()):
            break
    return best_rows, best, depth


def exact_topk(vectors: DataFrame, queries: Column, *, k: int = 5, scale: int = 256, id_col: str = "vec_id",
               vec_col: str = "embedding", rows_per_block: int = 8192, queries_per_block: int = 4096) -> DataFrame:
    """For each row that ``queries`` selects, the ``k`` other rows with the highest integer inner
    product of ``floor(scale * x)``: query_id, rank (from 1), vec_id, score; ties to smaller ids.

    Candidates and queries are dealt into blocks by a hash of the row; a task gets one block of
    candidates with one of queries, sorts its per-dimension lists once and runs the threshold
    algorithm for each query; the block winners are merged per query. Blocks, not rows, are
    copied: once per 4096 queries. Vectors that are null or hold null or non-finite components
    (or have another length than a query's: no product) take no part. A row with the query's id
    is the query itself; rows repeated under one id are candidates of their own, and the queries of
    a repeated id share one list of ``k``. Null ids take no part. Empty table: no rows. Other columns are ignored.
    """
    x = F.col(vec_col)
    good = (F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)
            & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    base = vectors.where(good).select(
        F.col(id_col).cast("long").alias("i"), queries.alias("is_query"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"))
    # equal rows beyond the kth can't be among the k best of any query
    base = (base.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"), F.max("is_query").alias("is_query"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")))))
    size = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("long")).alias("q")).first()
    cb = max(1, -(-int(size["n"]) // rows_per_block))
    qb = max(1, -(-int(size["q"] or 0) // queries_per_block))
    block = lambda n: F.pmod(F.xxhash64("i", "v", "copy"), F.lit(n)).cast("int")
    cand = base.select("i", "v", block(cb).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("q"))
    asks = (base.where("is_query").select("i", "v", block(qb).alias("q"),
                                          F.explode(F.sequence(F.lit(0), F.lit(cb - 1))).alias("c")))

    def search(rows: pa.Table, qs: pa.Table) -> pa.Table:
        out = ([], [], [])
        by_len: dict[int, list[int]] = {}
        cv = rows.column("v").to_pylist() if len(rows) and len(qs) else []
        for r, v in enumerate(cv):
            by_len.setdefault(len(v), []).append(r)
        all_ids = rows.column("i").to_numpy() if len(rows) else np.zeros(0, np.int64)
        ready = {}
        for d, at in by_len.items():
            m = np.array([cv[r] for r in at], np.int64)
            order = np.argsort(m, axis=0, kind="stable")
            ready[d] = (m, all_ids[at], order, np.take_along_axis(m, order, 0))
        if cv:
            for qi, qv in zip(qs.column("i").to_pylist(), qs.column("v").to_pylist()):
                if len(qv) in ready:
                    m, ids, order, values = ready[len(qv)]
                    rows_, score, _ = threshold_topk(m, ids, np.array(qv, np.int64), qi, k, order, values)
                    out[0].extend([qi] * len(rows_))
                    out[1].extend(ids[rows_].tolist())
                    out[2].extend(score.tolist())
        return pa.table({c: pa.array(o, pa.int64()) for c, o in zip(("query_id", "vec_id", "score"), out)})

    found = (cand.groupBy("q", "c").cogroup(asks.groupBy("q", "c"))
             .applyInArrow(search, "query_id long, vec_id long, score long"))
    # at most k rows of each block; the rank limit is applied before the shuffle, too
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
