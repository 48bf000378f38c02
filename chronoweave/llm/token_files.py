"""Token-id files with a minimal perfect hash index from document keys to places.

Layout under one root folder, written and committed by Spark (a lost executor's task is
simply run again):

``shards/``  one row per block: ``part, seq, first, last, payload, lens, ats, keys`` — ``payload``
             holds the raw ids of up to ``block_ids`` ids as little-endian unsigned 32-bit
             integers, documents one after the other in ascending key order, each with its end
             id; ``first`` and ``last`` number the block's documents in their part, ``ats`` has
             the ids before each in the block. Parts hold ascending key ranges. A page holds one
             block, and its column index names it, so that a filter on part and number reads
             the payloads of the blocks it names only.
``index/``   one row per key bucket: a minimal perfect hash of the bucket's distinct keys
             (levels of bits; a key's slot is the rank of its bit) and, by slot, a 32-bit
             fingerprint and the place of the key's first document: part, number there, offset
             in its block's ids, number of ids; and how many documents have that key.

:func:`lookup` gives the ids of a request's keys in time that doesn't grow with the table but for
listing files and their footers; :func:`read_documents` reads any set of keys by one scan.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import mix64, spark_xxhash64
from .tokens import encoder

SHARD_SCHEMA = ("part int, seq int, first long, last long, n_ids long, payload binary, lens array<int>, "
                "ats array<int>, keys array<long>")
#: What a slot holds of a key: the place of its first document, and how many there are.
PLACE = ("part", "number", "at", "n_tokens", "copies")
INDEX_SCHEMA = "bucket int, sizes array<int>, bits binary, prints binary, " + ", ".join(f"{c} binary" for c in PLACE)


def write_shards(docs: DataFrame, root: str, *, tokenizer: str | None = None, key: str = "doc_id",
                 text: str = "text", end_id: int = 0, block_ids: int = 1 << 20) -> None:
    """Encode every text and write ``root/shards``.

    Null text counts as empty (only the end id); null keys come first; rows that share a key
    stand next to each other, ordered by text. A text longer than a block is a block.
    """
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches):
        from pyspark import TaskContext
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        held: list[bytes] = []
        keys: list[int | None] = []
        size = 0
        enc = encoder(tokenizer)

        def out():
            lens = np.array([len(b) // 4 for b in held], np.int32)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()),
                pa.array([first + len(keys) - 1], pa.int64()), pa.array([size], pa.int64()),
                pa.array([b"".join(held)], pa.binary()), pa.array([lens], pa.list_(pa.int32())),
                pa.array([np.cumsum(lens, dtype=np.int32) - lens], pa.list_(pa.int32())),
                pa.array([keys], pa.list_(pa.int64()))],
                names=["part", "seq", "first", "last", "n_ids", "payload", "lens", "ats", "keys"])

        for b in batches:
            ids = enc.encode_many([t or "" for t in b.column(1).to_pylist()])
            for k, x in zip(b.column(0).to_pylist(), ids):
                if held and size + len(x) // 4 + 1 > block_ids:
                    yield out()
                    seq, first = seq + 1, first + len(keys)
                    held, keys, size = [], [], 0
                held.append(x + end)
                keys.append(k)
                size += len(x) // 4 + 1
        if held:
            yield out()
        enc.forget()

    rows = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
            .repartitionByRange("k").sortWithinPartitions("k", "t"))
    (rows.mapInArrow(blocks, SHARD_SCHEMA).write.option("compression", "zstd")
     .option("parquet.block.size", str(32 << 20)).option("parquet.page.row.count.limit", "1")
     .option("parquet.page.size.row.check.min", "1").parquet(f"{root}/shards"))


def _hash_levels(keys: np.ndarray, gamma: float = 1.7) -> tuple[list[int], np.ndarray]:
    """Levels of a minimal perfect hash: at each level the keys alone on their bit keep it."""
    sizes, levels, rest = [], [], keys
    while len(rest):
        size = max(8, int(gamma * len(rest)))
        pos = (mix64(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(pos, minlength=size)[pos] == 1
        bits = np.zeros(size, bool)
        bits[pos[alone]] = True
        sizes.append(size)
        levels.append(bits)
        rest = rest[~alone]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def _slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where no level has its bit (certainly not a member)."""
    rank = np.cumsum(bits) - 1
    out = np.full(len(keys), -1, np.int64)
    open_ = np.arange(len(keys))
    base = 0
    for level, size in enumerate(sizes):
        pos = base + (mix64(keys[open_], level) % np.uint64(size)).astype(np.int64)
        hit = bits[pos]
        out[open_[hit]] = rank[pos[hit]]
        open_ = open_[~hit]
        base += size
        if not len(open_):
            break
    return out


def _print32(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 99) >> np.uint64(32)).astype("<u4")


def _build_bucket(t: pa.Table) -> pa.Table:
    bucket = t.column("bucket")[0].as_py()
    if bucket < 0:  # the null key has a bucket to itself
        sizes, bits, order, prints = [], np.zeros(0, bool), np.zeros(1, np.int64), np.zeros(1, "<u4")
    else:
        keys = t.column("k").to_numpy().astype(np.int64).view(np.uint64)
        sizes, bits = _hash_levels(keys)
        order = np.argsort(_slots(keys, sizes, bits))
        prints = _print32(keys)[order]
    return pa.table({
        "bucket": pa.array([bucket], pa.int32()), "sizes": pa.array([sizes], pa.list_(pa.int32())),
        "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
        "prints": pa.array([prints.tobytes()], pa.binary()),
        **{c: pa.array([t.column(c).to_numpy()[order].astype("<i8").tobytes()], pa.binary()) for c in PLACE}})


def _with_bucket(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.when(F.col("k").isNull(), -1).otherwise(
        F.pmod(F.xxhash64("k"), F.lit(buckets))).cast("int"))


def write_index(spark: SparkSession, root: str, keys_per_bucket: int = 4096) -> int:
    """Write ``root/index`` from the shards' keys (payloads are not read); returns its buckets."""
    shards = spark.read.parquet(f"{root}/shards")
    n = shards.select(F.sum(F.size("keys"))).first()[0] or 0
    buckets = max(1, -(-n // keys_per_bucket))
    docs = shards.select("part", "first", F.posexplode(F.arrays_zip("keys", "ats", "lens")).alias("i", "d"))
    place = F.struct("part", (F.col("first") + F.col("i")).alias("number"), F.col("d.ats").alias("at"),
                     F.col("d.lens").alias("n_tokens"))
    firsts = docs.groupBy(F.col("d.keys").alias("k")).agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("copies"))
    firsts = _with_bucket(firsts.select("k", "p.*", "copies"), buckets)
    (firsts.groupBy("bucket").applyInArrow(_build_bucket, INDEX_SCHEMA)
     .write.option("compression", "zstd").parquet(f"{root}/index"))
    return buckets


def find(spark: SparkSession, root: str, keys: DataFrame, buckets: int, only: list[int] | None = None) -> DataFrame:
    """Places of ``keys`` (one long column, each value once): key, part, number, at, n_tokens, copies.

    Keys that the files don't hold give no row (but for one in 2**32 by the fingerprint).
    ``only`` names the buckets to read, where they are known.
    """
    name = keys.columns[0]

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({c: pa.array([], pa.int64()) for c in ("k", *PLACE)})
        if not len(left) or not len(right):
            return none
        get = lambda c, kind: np.frombuffer(right.column(c)[0].as_py(), kind)
        k = left.column("k")
        if right.column("bucket")[0].as_py() < 0:
            slot, ok = np.zeros(len(left), np.int64), np.ones(len(left), bool)
        else:
            sizes = right.column("sizes")[0].as_py()
            bits = np.unpackbits(get("bits", np.uint8))[: sum(sizes)].astype(bool)
            u = k.to_numpy().astype(np.int64).view(np.uint64)
            slot = _slots(u, sizes, bits)
            ok = slot >= 0
            ok[ok] = get("prints", "<u4")[slot[ok]] == _print32(u[ok])
        slot = slot[ok]
        return pa.table({"k": k.filter(pa.array(ok)).combine_chunks().cast(pa.int64()),
                         **{c: pa.array(get(c, "<i8")[slot]) for c in PLACE}})

    asked = _with_bucket(keys.select(F.col(name).cast("long").alias("k")), buckets)
    index = spark.read.parquet(f"{root}/index")
    if only is not None:
        index = index.where(F.col("bucket").isin(only))
    return (asked.groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInArrow(look, "k long, " + ", ".join(f"{c} long" for c in PLACE))
            .withColumnRenamed("k", name))


def scan(spark: SparkSession, root: str) -> DataFrame:
    """Every document of the shards, from their payloads: part, number, start (ids of all
    documents before it), n_tokens, ids_crc32."""
    shards = spark.read.parquet(f"{root}/shards")
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    blocks = shards.select("part", "seq", "n_ids")
    blocks = blocks.withColumn("before", F.sum("n_ids").over(in_part) - F.col("n_ids"))
    # one row per part (a write task), so this window stays small
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("all"))
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("all")).alias("base"))
    bases = blocks.join(parts, "part").select("part", "seq", (F.col("base") + F.col("before")).alias("base"))

    def read(batches):
        for b in batches:
            out = []
            for part, seq, first, payload, lens in zip(*(b.column(c) for c in ("part", "seq", "first", "payload", "lens"))):
                raw = memoryview(payload.as_py())
                n = np.array(lens.as_py(), np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
                out.append(pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), part.as_py(), np.int32)), pa.array(np.full(len(n), seq.as_py(), np.int32)),
                    pa.array(first.as_py() + np.arange(len(n))), pa.array(ends - n), pa.array(n),
                    pa.array(crc, pa.int64())], names=["part", "seq", "number", "at", "n_tokens", "ids_crc32"]))
            yield from out

    docs = shards.select("part", "seq", "first", "payload", "lens").mapInArrow(
        read, "part int, seq int, number long, at long, n_tokens long, ids_crc32 long")
    return docs.join(bases, ["part", "seq"]).select(
        "part", "number", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, root: str, keys: DataFrame, buckets: int) -> DataFrame:
    """Documents of ``keys`` found through the index and read from the payloads."""
    name = keys.columns[0]
    at = find(spark, root, keys, buckets)
    at = at.select(name, "part", F.explode(F.sequence("number", F.col("number") + F.col("copies") - 1)).alias("number"))
    return at.join(scan(spark, root), ["part", "number"]).select(name, "start", "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, root: str, keys: list[int | None], buckets: int) -> DataFrame:
    """Ids of the documents of a request's keys: key, copy (from 0), ids.

    The index buckets of the keys are read, and of the shards the blocks that the found places
    name. Places come to the driver, one per asked key; for keys by the million use
    :func:`read_documents`. Null is a key; a key asked for twice counts once; absent keys give
    no row. A key's documents follow one another, into the next blocks if need be.
    """
    asked = list(dict.fromkeys(keys))
    known = np.array([k for k in asked if k is not None], np.int64)
    only = np.unique(np.mod(spark_xxhash64(known), buckets)).tolist() + [-1] * (None in asked)
    request = spark.createDataFrame([(k,) for k in asked], "k long")
    places = [tuple(r) for r in find(spark, root, request, buckets, only).select("k", *PLACE).collect()]
    named = [(F.col("part") == part) & (F.col("first") < number + copies) & (F.col("last") >= number)
             for _, part, number, _, _, copies in places] or [F.lit(False)]
    while len(named) > 1:  # a flat tree: a chain of many keys would be too deep for the planner
        named = [a | b for a, b in zip(named[::2], named[1::2])] + named[len(named) & ~1:]

    def cut(batches):
        for b in batches:
            for part, first, last, payload, lens, ats in zip(*(b.column(c) for c in b.schema.names)):
                part, first, last = part.as_py(), first.as_py(), last.as_py()
                raw = np.frombuffer(payload.as_buffer(), "<u4")
                for k, p, number, at, n, copies in places:
                    if p != part:
                        continue
                    for d in range(max(first, number), min(last, number + copies - 1) + 1):
                        if d > number:
                            at, n = ats[d - first].as_py(), lens[d - first].as_py()
                        yield pa.RecordBatch.from_arrays([
                            pa.array([k], pa.int64()), pa.array([d - number], pa.int64()),
                            pa.array([raw[at:at + n].astype(np.int64)], pa.list_(pa.int64()))], names=["key", "copy", "ids"])

    blocks = spark.read.parquet(f"{root}/shards").where(named[0])
    return blocks.select("part", "first", "last", "payload", "lens", "ats").mapInArrow(cut, "key long, copy long, ids array<long>")
