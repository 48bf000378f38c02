"""Removal of word sequences that an earlier document already holds."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Rolling, WordHashes, power_of_two, spark_xxhash64, text_bytes, utf8

_U = np.uint64
_PACKED = "bucket int, n int, hashes binary, seconds binary, ranks binary, ids binary, n_own int"
#: Bytes kept of each window's second hash.
_SECOND = 4


def _planes(x: np.ndarray, width: int) -> bytes:
    """Little-endian bytes of sorted numbers, plane by plane (the upper planes compress away)."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(raw: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def _squeezed(x: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of each number: whole bytes plane by plane, then the other bits plane by plane."""
    raw = x.astype("<u4").view(np.uint8).reshape(-1, 4)
    rest = (x >> np.arange(bits & ~7, bits)[:, None]) & 1
    return np.ascontiguousarray(raw[:, :bits >> 3].T).tobytes() + np.packbits(rest.astype(bool), axis=1).tobytes()


def _unsqueezed(raw: bytes, n: int, bits: int) -> np.ndarray:
    a, whole = np.frombuffer(raw, np.uint8), bits >> 3
    out = np.zeros((n, 4), np.uint8)
    out[:, :whole] = a[:whole * n].reshape(whole, n).T
    x = out.view("<u4").reshape(-1).astype(np.int64)
    if bits & 7:
        rest = np.unpackbits(a[whole * n:].reshape(bits & 7, -1), axis=1)[:, :n].astype(np.int64)
        x |= (rest << np.arange(bits & ~7, bits)[:, None]).sum(axis=0)
    return x


class _WordPairs(WordHashes):
    """bytes → two hashes by different functions, side by side."""

    def __missing__(self, word: bytes) -> bytes:
        h = self[word] = (xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
                          + xxhash.xxh64_intdigest(word).to_bytes(8, "little"))
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8").reshape(-1, 2)


class _Windows:
    def __init__(self, width: int):
        self.words, self.roll, self.width = _WordPairs(), Rolling(width), width

    def both(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second hash of every window of a row of words."""
        return self.roll(pairs[:, 0]), self.roll(pairs[:, 1]) & _U((1 << 8 * _SECOND) - 1)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Both hashes of all windows of some texts, the text each starts in, words of each text."""
        hashed = [self.words.of(t.split()) for t in texts]
        n = [len(h) for h in hashed]
        flat, second = self.both(np.concatenate(hashed) if hashed else np.zeros((0, 2), _U))
        of = np.repeat(np.arange(len(n)), n)
        starts = np.concatenate(([0], np.cumsum(n)))[of] if len(of) else of
        inside = np.arange(len(of)) - starts + self.width <= np.array(n, np.int64)[of]
        inside = inside[: len(flat)]
        return flat[inside], second[inside], of[: len(flat)][inside], n


def _differ(h: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whether each window of a sorted row is another one than that before it."""
    return np.concatenate(([True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])))


def _order(h: np.ndarray, s: np.ndarray, d: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The order by window (both hashes), then owner, from that by first hash, then owner."""
    x, y = h[by], s[by]
    if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():  # first hashes that agree by accident
        return np.lexsort((d, s, h))
    return by


def substring_dedup(docs: DataFrame, *, window: int = 13, key: str = "doc_id", text: str = "text",
                    windows_per_bucket: int = 1 << 20, bytes_per_group: int = 6 << 20,
                    windows_per_batch: int = 2_000_000, bytes_per_bundle: int = 16 << 20) -> DataFrame:
    """Remove every word covered by a window of ``window`` consecutive words that also starts in
    a document with a smaller key; windows are judged on the input.

    Words are maximal runs of bytes other than space and 0x09-0x0D. Every window of every text
    gets a Rabin-Karp hash; each batch keeps, per hash, its smallest key (so a window that a
    third of all documents hold sends one entry per batch), and sends them to the hash's bucket
    as packed arrays; a bucket finds the smallest key of each hash and sends later documents
    their repeated hashes. Each document then marks these windows, whose union are maximal
    removal intervals. Texts travel to their documents' groups in compressed bundles. Hashes keep 48 bits beside the bucket number's, and a window is only taken
    for another if 32 bits of a second hash, from other hashes of the words, agree too.

    Returns key, n_words, n_removed, kept (remaining words joined by one space), removed (array
    of word intervals ``start, end``). Null text: no words. Null key: neither loses words nor
    takes them from others. Rows with equal keys take no words from each other. Texts shorter
    than a window lose nothing. Empty table: no rows. Other columns are ignored.
    """
    rows, size = text_bytes(docs, text)
    nb = power_of_two(size / 6 / windows_per_bucket)
    kb = nb.bit_length() - 1
    groups = max(1, -(-size // bytes_per_group))
    bits = min(48, 64 - kb)  # kept of each hash beside the bucket's
    low, shift = _U((1 << bits) - 1), _U(64 - kb - bits)

    def pack(batches):
        win = _Windows(window)

        def flush(keys: list[int], texts: list[bytes]):
            order = np.argsort(np.array(keys, np.int64), kind="stable")
            ids, rank = np.unique(np.array(keys, np.int64), return_inverse=True)
            h, s, of, _ = win.of([texts[i] for i in order])
            if not len(h):
                return
            r = rank[order][of]
            by = _order(h, s, r, np.argsort(h, kind="stable"))  # within a hash: ascending key
            h, s, r = h[by], s[by], r[by]
            first = _differ(h, s)
            lead = r[first][np.cumsum(first) - 1]
            late = ~first & (r > lead)
            late &= first | np.concatenate(([True], r[1:] != r[:-1]))
            own, later = (h[first], r[first], s[first]), (h[late], r[late], s[late])
            cut = [np.searchsorted(x[0], (np.arange(1, nb, dtype=_U) << _U(64 - kb))) if kb else np.zeros(0, np.int64) for x in (own, later)]
            edges = [np.concatenate(([0], c, [len(x[0])])) for c, x in zip(cut, (own, later))]
            out = []
            for b in range(nb):
                (a, z), (c, y) = ((e[b], e[b + 1]) for e in edges)
                if a == z:
                    continue
                hs = np.concatenate((own[0][a:z], later[0][c:y]))
                rs = np.concatenate((own[1][a:z], later[1][c:y]))
                seconds = _planes(np.concatenate((own[2][a:z], later[2][c:y])), _SECOND)
                used, at = np.unique(rs, return_inverse=True)
                out.append((b, len(hs), _planes((hs >> shift) & low, 6), seconds, _squeezed(at, (len(used) - 1).bit_length()), _planes(ids[used].view(_U), 8), int(z - a)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))],
                names=["bucket", "n", "hashes", "seconds", "ranks", "ids", "n_own"])

        keys, texts, held = [], [], 0
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                keys.append(k)
                texts.append(t)
                held += len(t) // 6
                if held >= windows_per_batch:
                    yield from flush(keys, texts)
                    keys, texts, held = [], [], 0
        if keys:
            yield from flush(keys, texts)

    def judge(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        hs, ss, ds, late = [], [], [], []
        for n, h, s, r, i, own in zip(*(t.column(c).to_pylist() for c in ("n", "hashes", "seconds", "ranks", "ids", "n_own"))):
            ids = _unplanes(i, len(i) // 8, 8).view(np.int64)
            hs.append(_unplanes(h, n, 6))
            ss.append(_unplanes(s, n, _SECOND))
            ds.append(ids[_unsqueezed(r, n, (len(ids) - 1).bit_length())])
            late.append(np.arange(n) >= own)
        h, s, d, late = np.concatenate(hs), np.concatenate(ss), np.concatenate(ds), np.concatenate(late)
        by = _order(h, s, d, np.lexsort((d, h)))
        h, s, d, late = h[by], s[by], d[by], late[by]
        first = _differ(h, s)
        lead = d[first][np.cumsum(first) - 1]
        hit = late | (d > lead)
        h, s, d = h[hit], s[hit], d[hit]
        g = np.mod(spark_xxhash64(d), groups)
        by = np.argsort(g, kind="stable")
        h, s, d, g = h[by], s[by], d[by], g[by]
        at = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
        ends = np.concatenate((at[1:], [len(g)])) if len(g) else at
        full = h | (_U(bucket) << _U(bits)) if kb else h
        return pa.table({"g": pa.array(g[at].astype(np.int32)),
                         "hashes": pa.array([_planes(full[a:z], 8) for a, z in zip(at, ends)], pa.binary()),
                         "seconds": pa.array([_planes(s[a:z], _SECOND) for a, z in zip(at, ends)], pa.binary()),
                         "ids": pa.array([_planes(d[a:z].view(_U), 8) for a, z in zip(at, ends)], pa.binary())})

    def bundle(batches):
        """Rows of each group as one compressed row, as often as ``bytes_per_bundle`` are held."""
        squeeze = zstandard.ZstdCompressor(level=3).compress
        held: dict[int, tuple[list[int | None], list[bytes]]] = {}
        size = 0

        def out():
            gs = sorted(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(gs, pa.int32()), pa.array([held[g][0] for g in gs], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in held[g][1]] for g in gs], pa.list_(pa.int64())),
                 pa.array([squeeze(b"".join(held[g][1])) for g in gs], pa.binary())], names=["g", "ks", "lens", "ts"])

        for b in batches:
            for g, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = t.as_py()
                keys, texts = held.setdefault(g, ([], []))
                keys.append(k)
                texts.append(t)
                size += len(t) + 16
                if size >= bytes_per_bundle:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    def unbundle(t: pa.Table):
        """Keys and texts of bundles, one bundle unpacked at a time."""
        expand = zstandard.ZstdDecompressor().decompress
        for ks, lens, ts in zip(*(t.column(c) for c in ("ks", "lens", "ts"))):
            raw, at = expand(ts.as_py()), 0
            for k, n in zip(ks.as_py(), lens.as_py()):
                yield k, raw[at:at + n]
                at += n

    def mark(bundles: pa.Table, hits: pa.Table) -> pa.Table:
        roll = _Windows(window)
        h, s, d = (np.concatenate([np.zeros(0, "<u8"), *(_unplanes(x, len(x) // width, width) for x in hits.column(c).to_pylist())]) if len(hits) else np.zeros(0, "<u8")
                   for c, width in (("hashes", 8), ("seconds", _SECOND), ("ids", 8)))
        d = d.view(np.int64)
        by = np.lexsort((h, d))
        h, s, d = h[by], s[by], d[by]
        keys, n_words, n_removed, kept, removed = [], [], [], [], []
        for k, x in unbundle(bundles):
            words = x.split()
            a, z = (0, 0) if k is None else (np.searchsorted(d, k), np.searchsorted(d, k, "right"))
            spans = []
            if a < z:
                own, second = roll.both(roll.words.of(words))
                own, mine, theirs = own >> shift, h[a:z], s[a:z]
                p, q = np.searchsorted(mine, own), np.searchsorted(mine, own, "right")
                at = np.flatnonzero(p < q)
                gone = np.zeros(len(own), bool)
                while len(at):  # more than once only for a hit of several batches or two windows of one first hash
                    gone[at] = theirs[p[at]] == second[at]
                    p[at] += 1
                    at = at[~gone[at] & (p[at] < q[at])]
                starts = np.flatnonzero(gone)
                if len(starts):
                    edge = np.flatnonzero(np.diff(starts) > window)
                    lo = starts[np.concatenate(([0], edge + 1))]
                    hi = starts[np.concatenate((edge, [len(starts) - 1]))] + window
                    spans = list(zip(lo.tolist(), hi.tolist()))
            keys.append(k)
            n_words.append(len(words))
            n_removed.append(sum(z - a for a, z in spans))
            at, parts = 0, []
            for a, z in spans:
                parts += words[at:a]
                at = z
            kept.append(b" ".join(parts + words[at:] if spans else words))
            removed.append([{"start": a, "end": z} for a, z in spans])
        return pa.table({
            "k": pa.array(keys, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()),
            "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))})

    base = docs.select(F.col(key).cast("long").alias("k"), utf8(text).alias("t"))
    packed = base.where("k is not null").mapInArrow(pack, _PACKED)
    hits = packed.groupBy("bucket").applyInArrow(judge, "g int, hashes binary, seconds binary, ids binary")
    # rows without a key are spread by their text
    placed = base.withColumn("g", F.pmod(F.when(F.col("k").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("k")),
                                         F.lit(groups)).cast("int"))
    bundles = placed.select("g", "k", "t").mapInArrow(bundle, "g int, ks array<long>, lens array<long>, ts binary")
    out = bundles.groupBy("g").cogroup(hits.groupBy("g")).applyInArrow(
        mark, "k long, n_words long, n_removed long, kept binary, removed array<struct<start:int,end:int>>")
    return out.withColumn("kept", F.col("kept").cast("string")).withColumnRenamed("k", key)
