"""Helpers shared by the operators of this package."""
from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.config import checkpoint_dir

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back; lineage ends here."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder (for tables whose columns are read apart)."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def power_of_two(n: float) -> int:
    """Smallest power of two that is at least ``n``."""
    return 1 << max(0, int(np.ceil(n)) - 1).bit_length()


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of a table: two scalars that size partitions."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def key64(col: Column | str) -> Column:
    return F.xxhash64(col)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64), vectorised."""
    with np.errstate(over="ignore"):
        z = x.astype(U64) + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


_P1, _P2, _P3, _P4, _P5 = (U64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def spark_xxhash64(longs: np.ndarray, seed: int = 42) -> np.ndarray:
    """What ``F.xxhash64`` gives for one non-null long column."""
    def rot(x, r):
        return (x << U64(r)) | (x >> U64(64 - r))
    with np.errstate(over="ignore"):
        k = longs.astype(np.int64).view(U64)
        h = np.full(k.shape, U64(seed) + _P5 + U64(8), U64)
        h ^= rot(k * _P2, 31) * _P1
        h = rot(h, 27) * _P1 + _P4
        h = (h ^ (h >> U64(33))) * _P2
        h = (h ^ (h >> U64(29))) * _P3
        return (h ^ (h >> U64(32))).view(np.int64)


class WordHashes(dict):
    """bytes → 64-bit hash, remembered; emptied by :meth:`trim` when it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


#: Base of the polynomial window hashes (odd, so it has an inverse modulo 2**64).
BASE = 0xD1342543DE82EF95
_BASE_INV = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base), U64)
    if n:
        out[0] = U64(1)
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out) if n else out


class Rolling:
    """Rabin-Karp hashes of every ``width``-word window, from prefix sums modulo 2**64."""

    def __init__(self, width: int):
        self.width = width
        self._up = self._down = np.zeros(0, U64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        n, w = len(h), self.width
        if n < w:
            return np.zeros(0, U64)
        if len(self._up) < n:
            m = max(n, 4096)
            self._up, self._down = _powers(BASE, m), _powers(_BASE_INV, m)
        with np.errstate(over="ignore"):
            p = np.zeros(n + 1, U64)
            np.cumsum(h * self._down[:n], out=p[1:])
            # sum of h[i+j] * BASE**(-j): independent of i
            return mix64((p[w:] - p[:-w]) * self._up[: n - w + 1], 7)


def utf8(col: str = "text") -> Column:
    """Text as UTF-8 bytes for the workers; null becomes empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")
