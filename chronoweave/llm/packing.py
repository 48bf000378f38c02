"""Best-fit packing of token sequences into bins of several permitted lengths."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

LENGTHS = (512, 1024, 2048, 4096, 8192)

#: Fixed positions' worth of work that each sequence costs, whatever its length.
PER_SEQUENCE = 64.0
#: Width of the model that reads the sequences; causal attention over c positions costs c / (12 * width)
#: of the rest of a position's work.
MODEL_WIDTH = 4096


def open_cost(length: int) -> float:
    """Cost of one sequence of ``length`` positions, in positions: the positions, attention (which
    grows with the square of the length) and a fixed part per sequence. Long bins are cheaper by
    the fixed part, short ones by attention, and either may be harder to fill."""
    return PER_SEQUENCE + length + length * length / (12.0 * MODEL_WIDTH)


class _Gaps:
    """Bins by free room, with the smallest room that is at least ``n`` found by bit tricks."""

    def __init__(self, most: int):
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]
        self.mask = 0

    def add(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self.mask |= 1 << room

    def take(self, n: int) -> tuple[int, int] | None:
        rest = self.mask >> n
        if not rest:
            return None
        room = n + (rest & -rest).bit_length() - 1
        bin_ = self.bins[room].pop()
        if not self.bins[room]:
            self.mask &= ~(1 << room)
        return room, bin_


class _Unpromised:
    """Sizes of the pieces that are neither placed nor counted on by an open bin."""

    def __init__(self, n: np.ndarray, most: int):
        self.count = np.bincount(n, minlength=most + 1).tolist()
        self.promised = [0] * (most + 1)
        self.mask = 0
        for k in np.unique(n[n > 0]).tolist():
            self.mask |= 1 << k

    def _less(self, size: int, by: int) -> None:
        self.count[size] -= by
        if not self.count[size]:
            self.mask &= ~(1 << size)

    def placed(self, size: int) -> None:
        if self.promised[size]:
            self.promised[size] -= 1
        elif size:
            self._less(size, 1)

    def completion(self, room: int) -> list[tuple[int, int]]:
        """(size, how many) of the pieces that would fill ``room``, the largest that fit first."""
        out = []
        mask = self.mask & ((1 << (room + 1)) - 1)
        while mask:
            size = mask.bit_length() - 1
            by = min(self.count[size], room // size)
            out.append((size, by))
            room -= size * by
            mask &= (1 << min(size, room + 1)) - 1
        return out

    def promise(self, pieces: list[tuple[int, int]]) -> None:
        for size, by in pieces:
            self._less(size, by)
            self.promised[size] += by


def pack_group(n: np.ndarray, lengths: tuple[int, ...], cost=open_cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in it, and the bin's final length for pieces of ``n`` tokens (each at most
    the longest length).

    Pieces come in descending size. A piece goes to the open bin it fills best. Where none has
    room, every permitted length is weighed with what could really fill it: the largest pieces
    that fit, one after the other, of those not yet placed and not counted on by a bin that
    opened before. The length opens whose cost per token so held is least (ties: the longest),
    and its filling is promised to it, so that no two bins count on one piece. Promises only
    steer the choice of lengths; pieces are placed by best fit. Last, each bin shrinks to the
    shortest permitted length that holds its contents.
    """
    lengths = tuple(sorted(lengths))
    order = np.argsort(-n, kind="stable")
    bins, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    gaps, used = _Gaps(lengths[-1]), []
    free = _Unpromised(n, lengths[-1])
    for i in order.tolist():
        k = int(n[i])
        free.placed(k)
        got = gaps.take(k)
        if got is None:
            best = None
            for c in lengths:
                if c >= k:
                    filling = free.completion(c - k)
                    each = cost(c) / max(1, k + sum(size * by for size, by in filling))
                    if best is None or each <= best[0]:
                        best = each, c, filling
            free.promise(best[2])
            got = best[1], len(used)
            used.append(0)
        room, b = got
        bins[i], offset[i] = b, used[b]
        used[b] += k
        gaps.add(room - k, b)
    final = np.array(lengths)[np.searchsorted(lengths, np.array(used, np.int64))] if used else np.zeros(0, np.int64)
    return bins, offset, final[bins] if len(n) else final


def best_fit_packing(docs: DataFrame, *, lengths: tuple[int, ...] = LENGTHS, tokenizer: str | None = None,
                     key: str = "doc_id", text: str = "text", docs_per_group: int = 16_384, end_ids: int = 1) -> DataFrame:
    """Pack the token sequences of all texts into bins: key, piece, start (token of the text where
    the piece starts), n_tokens, bin_group, bin, offset, seq_len.

    A text's tokens and ``end_ids`` end tokens are cut into pieces of at most the longest length,
    so nothing is lost. Texts of equal key and number of tokens are counted; the counts are dealt into
    groups of about ``docs_per_group`` by a hash, a count over several groups in equal shares, so
    that a key on any share of the rows is spread (a group is what one task packs, and holds
    thousands of bins, so the loss at its border is small); a bin is (bin_group, bin). Null and
    empty texts: one piece of the end tokens. Null keys and repeated rows: packed like others.
    Empty table: no rows. Other columns are ignored.
    """
    lengths = tuple(sorted(lengths))
    most = lengths[-1]
    groups = max(1, -(-docs.count() // docs_per_group))

    def measure(batches):
        enc = encoder(tokenizer, count=True)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            n = np.array(enc.encode_many(texts), np.int64) + end_ids
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n)], names=["k", "n"])
        enc.forget()

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("k", "ascending"), ("n", "ascending")])
        t = t.take(pa.array(np.repeat(np.arange(len(t)), t.column("c").to_numpy())))
        n = t.column("n").to_numpy()
        pieces = np.maximum(1, -(-n // most))
        row = np.repeat(np.arange(len(n)), pieces)
        no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(n[row] - no * most, most)
        bins, offset, final = pack_group(size, lengths)
        return pa.table({"k": t.column("k").take(pa.array(row)), "piece": pa.array(no.astype(np.int32)),
                         "start": pa.array(no * most), "n_tokens": pa.array(size), "bin_group": t.column("g").take(pa.array(row)),
                         "bin": pa.array(bins), "offset": pa.array(offset), "seq_len": pa.array(final.astype(np.int32))})

    sized = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
             .mapInArrow(measure, "k long, n long"))
    alike = sized.groupBy("k", "n").agg(F.count(F.lit(1)).alias("c"))
    dealt = alike.withColumn("j", F.explode(F.expr(f"sequence(0L, least(c, {groups}L) - 1)"))).select(
        "k", "n", F.expr(f"c div {groups}L + IF(j < c % {groups}L, 1L, 0L)").alias("c"),
        F.expr(f"CAST((pmod(xxhash64(k, n), {groups}L) + j) % {groups}L AS INT)").alias("g"))
    return dealt.groupBy("g").applyInArrow(
        pack, "k long, piece int, start long, n_tokens long, bin_group int, bin long, offset long, seq_len int"
    ).withColumnRenamed("k", key)
