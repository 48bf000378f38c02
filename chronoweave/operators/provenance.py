"""Identity, reproducible hashing and provenance.

Files written by Spark have partition-dependent bytes, so reproducibility is
defined on *rows*: each row gets a SHA-256 of a fixed serialization, rows are
folded into chunk digests in a fixed order, and content hash / Merkle root
are taken over those digests. No group ever holds more than one chunk or one
digest-prefix bucket.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DATASET_ID_PREFIX, HMAC_LOCAL_KEY, STREAM_KEYS
from ..sources.file_stream import STREAMED, list_files, open_file, scheme
from .scan import sums_before, written

ROW_CHUNK = 4096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def dataset_id(session) -> Column:
    """``ds_<session>_<sha256(prefix + session)[:12]>``."""
    s = F.col(session) if isinstance(session, str) else session
    return F.concat(F.lit("ds_"), s, F.lit("_"),
                    F.substring(F.sha2(F.concat(F.lit(DATASET_ID_PREFIX), s), 256), 1, 12))


def file_hashes(spark, paths: list[str] | str, chunk: int = 1 << 20) -> DataFrame:
    """(path, length, sha256) of every file under ``paths`` that isn't empty, hashed on executors.

    A task reads its files one after the other in chunks, so a file may have any size. Stores that
    tasks can't open themselves are read by Spark, which takes a file as one value (up to 2 GB)."""
    first = paths if isinstance(paths, str) else next(iter(paths), "")
    if scheme(first) not in STREAMED:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        return df.select("path", "length", F.sha2("content", 256).alias("sha256"))

    def digest(batches):
        import pyarrow as pa
        for b in batches:
            found = []
            for path in b.column(0).to_pylist():
                h = hashlib.sha256()
                with open_file(path) as f:
                    while data := f.read(chunk):
                        h.update(data)
                found.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string())],
                                             names=["path", "length", "sha256"])
    return list_files(spark, paths).mapInArrow(digest, "path string, length long, sha256 string")


def content_hash_flat(digests: DataFrame, col: str = "sha256", keys: list[str] | None = None) -> DataFrame:
    """K13 over a *bounded* set of digests (files or chunk digests of one
    dataset): sha256 of the concatenated sorted hex digests; duplicates kept."""
    keys = keys or []
    agg = F.sha2(F.concat_ws("", F.array_sort(F.collect_list(col))), 256)
    return digests.groupBy(*keys).agg(agg.alias("content_hash"))


def content_hash_tree(digests: DataFrame, col: str = "sha256", keys: list[str] | None = None,
                      prefixes: tuple[int, ...] = (4, 2)) -> DataFrame:
    """K13 over an unbounded digest set, as a tree of the flat rule.

    Digests are grouped by their first ``prefixes[0]`` hex chars (contiguous
    ranges of the sorted order); each group folds to sha256(concat(sorted
    digests)). Each further level regroups the previous digests by a shorter
    prefix of their bucket and folds them in prefix order; the last fold is
    over at most 16^prefixes[-1] digests. With (4, 2) a group holds n/65536
    leaves, then ≤ 256, then ≤ 256."""
    keys = keys or []
    lvl = (digests.withColumn("_p", F.substring(col, 1, prefixes[0]))
           .groupBy(*keys, "_p").agg(
               F.sha2(F.concat_ws("", F.array_sort(F.collect_list(col))), 256).alias("_d"),
               F.count(col).alias("_n")))

    def fold(df, by):
        return df.groupBy(*by).agg(
            F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("_p", "_d"))),
                                               lambda x: x["_d"])), 256).alias("_d"),
            F.sum("_n").alias("_n"))
    for p in prefixes[1:]:
        lvl = fold(lvl.withColumn("_q", F.substring("_p", 1, p)), [*keys, "_q"]) \
            .withColumnRenamed("_q", "_p")
    out = fold(lvl, keys)
    return out.select(*keys, F.col("_d").alias("content_hash"), F.col("_n").alias("n_leaves"))


def _pair_hash(left: Column, right: Column) -> Column:
    return F.sha2(F.concat(F.unhex(left), F.unhex(F.coalesce(right, left))), 256)


def _merkle_levels(nodes: Column, n: Column, m: int):
    """Apply up to ``m`` Merkle levels to an array of consecutive nodes that
    starts at a multiple of 2^m (so pairs never cross groups, and an odd
    last node can only be the layer's last). ``n`` is the layer size: a layer
    of one node is the root and is not hashed again. The levels iterate in
    an ``aggregate`` so the expression does not grow with ``m``."""
    def step(acc, _):
        a, nn = acc["a"], acc["n"]
        half = F.ceil(F.size(a) / 2).cast("int")
        paired = F.transform(
            F.sequence(F.lit(0), half - 1),
            lambda j: _pair_hash(F.try_element_at(a, j * 2 + 1), F.try_element_at(a, j * 2 + 2)))
        return F.struct(F.when(nn > 1, paired).otherwise(a).alias("a"),
                        F.when(nn > 1, F.ceil(nn / 2)).otherwise(nn).cast("long").alias("n"))
    res = F.aggregate(F.sequence(F.lit(1), F.lit(m)),
                      F.struct(nodes.alias("a"), n.cast("long").alias("n")), step)
    return res["a"], res["n"]


def merkle_root(digests: DataFrame, col: str = "sha256", keys: list[str] | None = None,
                fan_in_levels: int = 4, checkpoint_every: int = 8) -> DataFrame:
    """Leaves sorted by digest; each layer hashes pairs (an odd layer
    duplicates its last node) until one node remains; empty → sha256("").

    A layer is kept as runs (first place, length, digest), so equal leaves are counted and never
    expanded: of a run, whole groups of 2^``fan_in_levels`` nodes become a run of one digest, and
    only what is left at its two ends meets its neighbours' nodes. A tree of n leaves takes
    log2(n)/fan_in_levels shuffles, no group exceeds 2^levels nodes, and a million copies of one
    digest are one row throughout. Leaves are numbered by prefix sums over ranges of digests.
    Layer sizes are tracked arithmetically; lineage is cut with ``checkpoint()`` every few rounds."""
    keys = keys or []
    counted = digests.select(*keys, F.col(col).alias("d")).groupBy(*keys, "d").agg(F.count(F.lit(1)).alias("c"))
    k = keys or ["_all"]
    if not keys:
        counted = counted.withColumn("_all", F.length("d") * 0)  # not a constant: joins stay equi-joins
    # the numbered runs feed both the size probe and the rounds
    layer = written(sums_before(counted, ["d"], {"i": "c"}, keys=k, bucket=F.substring("d", 1, 3)).select(*k, "i", "c", "d"))
    sizes = layer.groupBy(*k).agg(F.sum("c").alias("n_leaves"))
    nmax = sizes.agg(F.max("n_leaves")).collect()[0][0] or 0
    if not nmax and not keys:
        return digests.sparkSession.range(1).select(F.lit(0).cast("long").alias("n_leaves"),
                                                    F.lit(EMPTY_SHA256).alias("merkle_root"))
    layer = layer.join(sizes.select(*k, F.col("n_leaves").alias("_n")), k)
    group = 1 << fan_in_levels
    rounds, size = 0, nmax
    while size > 1:
        layer = _merkle_round(layer, k, fan_in_levels)
        size = (size + group - 1) // group
        rounds += 1
        if checkpoint_every and rounds % checkpoint_every == 0 and size > 1:
            layer = written(layer)
    # after the last round each key holds exactly one node, index 0
    root = layer.where(F.col("i") == 0).select(*k, F.col("d").alias("merkle_root"))
    out = sizes.join(root, k, "left").select(
        *k, "n_leaves", F.coalesce("merkle_root", F.lit(EMPTY_SHA256)).alias("merkle_root"))
    return out.drop("_all") if not keys else out


def _merkle_round(layer: DataFrame, k: list[str], m: int) -> DataFrame:
    """``m`` levels up: runs (k…, i, c, d, _n) of a layer of ``_n`` nodes → those of the layer above."""
    g = 1 << m
    first = F.ceil(F.col("i") / g).cast("long")          # whole groups of the run: first …
    past = F.floor((F.col("i") + F.col("c")) / g).cast("long")  # … and one past the last
    end = F.col("i") + F.col("c")

    def part(kind, a, b):
        return F.struct(F.lit(kind).alias("kind"), a.cast("long").alias("i"), (b - a).cast("long").alias("c"))
    start = F.greatest(F.col("i"), first * g)
    inside = past > first
    # what lies in groups with other nodes (kind 0), and the whole groups (kind 1, from the first on)
    parts = F.when(inside, F.array(part(0, F.col("i"), first * g), part(1, first * g, past * g), part(0, past * g, end))).otherwise(
        # no whole group: the run lies in one group, or in two beside one border
        F.when(first * g < end, F.array(part(0, F.col("i"), start), part(0, start, end))).otherwise(F.array(part(0, F.col("i"), end))))
    nodes = (layer.select(*k, "d", "_n", F.explode(F.filter(parts, lambda x: x["c"] > 0)).alias("x"))
             .select(*k, "d", "_n", "x.kind", "x.i", "x.c"))
    nodes = nodes.groupBy(*k, F.floor(F.col("i") / g).alias("i"), "kind").agg(
        F.max("_n").alias("_n"), F.array_sort(F.collect_list(F.struct(F.col("i").alias("_i"), "c", "d"))).alias("_x"))
    single = F.col("kind") == 1
    spread = F.flatten(F.transform("_x", lambda x: F.array_repeat(x["d"], x["c"].cast("int"))))
    arr, n2 = _merkle_levels(F.when(single, F.array(F.col("_x")[0]["d"])).otherwise(spread), F.col("_n"), m)
    doubled = F.aggregate(F.sequence(F.lit(1), F.lit(m)), F.col("_x")[0]["d"], lambda d, _: _pair_hash(d, d))
    return nodes.select(*k, "i", F.when(single, F.col("_x")[0]["c"] / g).otherwise(1).cast("long").alias("c"),
                        F.when(single, doubled).otherwise(F.element_at(arr, 1)).alias("d"), n2.cast("long").alias("_n"))


def _hmac_pads(key: bytes) -> tuple[str, str]:
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return (bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex())


def hmac_sha256(msg_hex, key: bytes = HMAC_LOCAL_KEY) -> Column:
    """HMAC-SHA256 over the bytes of a hex string, as nested ``sha2``
    (RFC 2104); equals Python's ``hmac.new(key, bytes.fromhex(m), sha256)``."""
    ipad, opad = _hmac_pads(key)
    m = F.col(msg_hex) if isinstance(msg_hex, str) else msg_hex
    inner = F.sha2(F.concat(F.unhex(F.lit(ipad)), F.unhex(m)), 256)
    return F.sha2(F.concat(F.unhex(F.lit(opad)), F.unhex(inner)), 256)


def stamp(roots: DataFrame, root_col: str = "merkle_root") -> DataFrame:
    """K15 fallback stamp: HMAC signature, algorithm, ``signed = false``."""
    return roots.withColumn("signature", hmac_sha256(root_col)) \
                .withColumn("algorithm", F.lit("hmac-sha256")) \
                .withColumn("signed", F.lit(False))


def row_digest(cols: list[str]) -> Column:
    """SHA-256 of a fixed serialization of a row: ``-0.0`` normalised to
    ``0.0`` in float arrays and scalars, fields joined with ``\\u001f``."""
    parts = []
    for c in cols:
        x = F.col(c)
        parts.append(F.coalesce(x.cast("string"), F.lit("␀")))
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def normalize_zero(silver: DataFrame) -> DataFrame:
    return silver.withColumn("value", F.transform("value", lambda v: F.when(v == 0, F.lit(0.0).cast("float"))
                                                  .otherwise(v)))


def silver_chunk_digests(silver: DataFrame, chunk: int = ROW_CHUNK) -> DataFrame:
    """Per (session, device, stream, frame_index div chunk): SHA-256 of the
    chunk's row digests in frame order — independent of partitioning."""
    cols = ["session_id", "device_id", "stream_id", "frame_index", "t_ref_us", "value", "valid",
            "confidence", "conf_source", "conf_clock", "conf_interp"]
    s = normalize_zero(silver).withColumn("_h", row_digest(cols)) \
        .withColumn("chunk", F.floor(F.col("frame_index") / chunk))
    return s.groupBy(*STREAM_KEYS, "chunk").agg(
        F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("frame_index", "_h"))),
                                           lambda x: x["_h"])), 256).alias("sha256"))


def silver_content_hash(silver: DataFrame) -> DataFrame:
    """Per session content hash over the chunk digests (tree-folded)."""
    return content_hash_tree(silver_chunk_digests(silver), keys=["session_id"])


def provenance_records(ids: DataFrame, roots: DataFrame, *, version: str, schema_version: str,
                       customer_id: str | None = None, topology: DataFrame | None = None,
                       source_hashes: DataFrame | None = None) -> DataFrame:
    """One provenance row per (session, dataset version)."""
    p = stamp(roots).join(ids, "session_id")
    if topology is not None:
        p = p.join(topology, "session_id", "left")
    if source_hashes is not None:
        p = p.join(source_hashes, "session_id", "left")
    return p.select("session_id", "dataset_id", F.lit(version).alias("version"),
                    F.lit(schema_version).alias("schema_version"),
                    F.lit(customer_id).cast("string").alias("customer_id"),
                    *([F.col("source_episode_hashes")] if source_hashes is not None else []),
                    *([F.col("topology")] if topology is not None else []),
                    "merkle_root", "signature", "algorithm", "signed")


def source_hashes(hashes: DataFrame) -> DataFrame:
    """Distinct source-file digests per session, sorted."""
    return hashes.groupBy("session_id").agg(F.array_sort(F.collect_set("sha256")).alias("source_episode_hashes"))


__all__ = ["dataset_id", "file_hashes", "content_hash_flat", "content_hash_tree", "merkle_root",
           "hmac_sha256", "stamp", "silver_chunk_digests", "silver_content_hash",
           "provenance_records", "source_hashes"]
