"""Proportional stratified interleaving into shards, in DataFrame operations only."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, power_of_two


def interleave_shards(docs: DataFrame, n_shards: int, *, seed: int = 20, key: str = "doc_id",
                      stratum: str = "source", text: str = "text",
                      rows_per_bucket: int = 20_000, least_buckets: int = 64) -> DataFrame:
    """Put every row into one of ``n_shards`` shards whose sizes in rows differ by one at most
    and whose mixture of strata is that of the table.

    Rows are shuffled by an md5 of seed and key within their stratum and ranked; row ``r`` of
    ``n`` gets the fraction ``(2r+1)/2n``; all rows are ordered by fraction and cut into equal
    runs. Ranks come from bucket counts plus a rank inside each bucket, so no stratum and no
    cut is one task: a stratum with a third of all rows is spread over all buckets of the hash.

    Returns key, size (UTF-8 bytes + 16), text_crc32, law, shard, slot, grown_shard, stratum.
    Null text: size 16, crc 0. Null stratum: a stratum of its own. Null keys and repeated rows
    are rows like others (equal rows are interchangeable). Fewer rows than shards: some shards
    stay empty. Empty table: no rows. Other columns are ignored.
    """
    n = docs.count()
    buckets = max(least_buckets, power_of_two(n / rows_per_bucket))
    bits = buckets.bit_length() - 1
    utf8 = F.coalesce(F.col(text), F.lit("")).cast("binary")
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
                                      .cast("string")), 1, 15), 16, 10).cast("long")
    strat = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("null"))
    ids = docs.select(F.col(key).alias("k"), strat.alias("s"), hashed.alias("h"))
    per_bucket = (ids.withColumn("b", F.shiftright("h", 60 - bits)).groupBy("s", "b")
                  .agg(F.count(F.lit(1)).alias("c")))
    by_s = Window.partitionBy("s")
    offsets = per_bucket.select(
        "s", "b", (F.sum("c").over(by_s.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
                   - F.col("c")).alias("before"), F.sum("c").over(by_s).alias("n_s"))
    rows = docs.select(F.col(key).alias("k"), strat.alias("s"), hashed.alias("h"),
                       F.octet_length(utf8).cast("long").alias("bytes"), F.crc32(utf8).alias("crc"))
    rows = rows.withColumn("b", F.shiftright("h", 60 - bits)).join(offsets, ["s", "b"])
    in_bucket = Window.partitionBy("s", "b").orderBy("h", "k", "crc", "bytes")
    ranked = rows.withColumn("r", F.col("before") + F.row_number().over(in_bucket) - 1)
    # bucket of the fraction, in integers: floor((2r+1) * buckets / 2n)
    ranked = cut(ranked.select("k", "s", "bytes", "crc", "r", "n_s",
                               F.expr(f"((2 * r + 1) * {buckets}L) div (2 * n_s)").alias("j")))
    cuts = ranked.groupBy("j").agg(F.count(F.lit(1)).alias("c"))
    # one row per bucket: N / rows_per_bucket rows in this window
    cuts = cuts.select("j", (F.sum("c").over(Window.orderBy("j").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("c")).alias("before"))
    fraction = (2 * F.col("r") + 1) / (2 * F.col("n_s"))
    order = Window.partitionBy("j").orderBy(fraction, "s", "r")
    placed = (ranked.join(cuts, "j")
              .withColumn("g", F.col("before") + F.row_number().over(order) - 1)
              .withColumn("shard", F.expr(f"(g * {n_shards}L) div {max(n, 1)}L")))
    # first position of a shard: ceil(shard * n / n_shards)
    first = F.expr(f"(shard * {n}L + {n_shards - 1}L) div {n_shards}L")
    return placed.select(
        F.col("k").alias(key), (F.col("bytes") + 16).alias("size"), F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("g") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.when(F.col("s") != "null", F.expr("substring(s, 2)")).alias("stratum"))


def shard_sizes(n: int, n_shards: int) -> list[int]:
    """Rows of each shard."""
    return [math.ceil((s + 1) * n / n_shards) - math.ceil(s * n / n_shards) for s in range(n_shards)]
