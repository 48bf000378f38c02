"""Prefix sums over any number of rows.

A window without partitions sorts everything in one task, and one over a hot key most of it. Here
rows are dealt into ranges of their order, each range is summed in its own task, and the totals of
the ranges before it, a few numbers, are carried in.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import checkpoint_dir


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_sampled_ranges(df: DataFrame, order: list[str], ranges: int, out: str = "_range") -> DataFrame:
    """``df`` with the number of the range that a row belongs to, of at most ``ranges`` of about equal size.

    Ranges begin at the rows whose hashes are smallest: a sample that depends on the values only,
    so every use of the number agrees, also in a task that runs again.
    """
    firsts = (df.select(F.struct(*order).alias("x")).orderBy(F.xxhash64("x"), "x").limit(ranges - 1)
              .agg(F.sort_array(F.collect_list("x"))))
    number = F.size(F.filter("_firsts", lambda x: x <= F.struct(*order)))
    return df.withColumn("_firsts", firsts.scalar()).withColumn(out, number).drop("_firsts")


def sums_before(df: DataFrame, order: list[str], values: dict[str, str], *, keys: list[str] | None = None,
                bucket: Column | None = None, ranges: int | None = None) -> DataFrame:
    """``df`` with, for each ``out: column`` of ``values``, the sum of that column over the rows
    before (0 for the first), in ``order`` (unique values, or equal rows in any order).

    ``bucket`` numbers ranges of the order (a value that never falls along it, of a bounded number
    of values); sums are taken within a range and the totals of earlier ranges are added. With
    ``keys`` all of this is per key; with keys and no bucket, a key's rows are one range, so they
    must be few. With neither, ranges are sampled (:func:`with_sampled_ranges`). Null values count as 0.
    """
    keys = keys or []
    value = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in values.values()}

    def before(part, by, cols):
        w = part.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return {out: F.coalesce(F.sum(c).over(w), F.lit(0)) for out, c in cols.items()}

    if keys and bucket is None:
        return df.withColumns(before(Window.partitionBy(*keys), order, {o: value[c] for o, c in values.items()}))
    if bucket is None:
        d = with_sampled_ranges(df, order, ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    else:
        d = df.withColumn("_range", bucket)
    totals = d.groupBy(*keys, "_range").agg(*[F.sum(value[c]).alias(o) for o, c in values.items()])
    if keys:
        carried = totals.select(*keys, "_range", *[x.alias(f"_{o}") for o, x in before(
            Window.partitionBy(*keys), ["_range"], {o: F.col(o) for o in values}).items()])
    else:
        # one entry a range, summed up along the array
        def add(acc, x):
            last = F.element_at(acc, -1)
            return F.concat(acc, F.array(F.struct(x["_range"].alias("r"), *[(last["n" + o] + x[o]).alias("n" + o) for o in values])))
        start = F.array(F.struct(F.col("_all")[0]["_range"].alias("r"), *[F.lit(0).cast("long").alias("n" + o) for o in values]))
        sums = totals.agg(F.sort_array(F.collect_list(F.struct("_range", *values))).alias("_all")).select("_all", F.aggregate("_all", start, add).alias("_s"))
        carried = sums.select(F.posexplode(F.transform("_all", lambda x: x["_range"])).alias("_i", "_range"), "_s").select(
            "_range", *[F.col("_s")[F.col("_i")]["n" + o].alias(f"_{o}") for o in values])
    inner = d.withColumns(before(Window.partitionBy(*keys, "_range"), order, {o: value[c] for o, c in values.items()}))
    return (inner.join(carried, [*keys, "_range"])
            .withColumns({o: F.col(o) + F.col(f"_{o}") for o in values}).drop("_range", *[f"_{o}" for o in values]))
