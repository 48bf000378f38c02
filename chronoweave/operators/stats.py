"""Distributed exact order statistics.

``exact_median`` returns numpy's (interpolating) median per group in two passes, all groups at
once: a mergeable sketch narrows each group to a thin band of values around its middle, and one
aggregate counts what is below the band and each distinct value inside it. No group is sorted.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sketch accuracy: rank error ≤ n / ACCURACY, so a band of ±2·n / ACCURACY ranks holds the middle
# and about 4·n / ACCURACY values.
ACCURACY = 10000


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """(keys…, out) with the exact median of the non-null values of ``value``.

    Rows whose value is NaN must be filtered by the caller (nanmedian). Values outside the band
    leave one count a group and task; inside, equal values leave one count, so heavily tied data
    (a regular grid's Δt) shrinks to a handful of rows whatever its size. The counts prove the
    result: should a band not hold its middle, which the sketch rules out, the query fails.
    """
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    d = 2.0 / ACCURACY
    band = v.groupBy(*keys).agg(F.percentile_approx("_v", [0.5 - d, 0.5 + d], ACCURACY).alias("_q"))
    band = band.select(*keys, F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    side = F.when(F.col("_v") < F.col("_lo"), -1).when(F.col("_v") > F.col("_hi"), 1).otherwise(0)
    counts = (v.join(band, keys).select(*keys, side.alias("_side"), F.when(side == 0, F.col("_v")).alias("_v"))
              .groupBy(*keys, "_side", "_v").agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*keys)
    ranked = counts.select(
        *keys, "_side", "_v", F.sum("_c").over(w).alias("_n"),
        F.sum("_c").over(w.orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, 0)).alias("_end"), "_c")
    # ranks (0-based) of the two middle elements
    first, second = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)

    def at(k):
        here = (F.col("_end") - F.col("_c") <= k) & (k < F.col("_end"))
        return F.max(F.when(here & (F.col("_side") == 0), F.col("_v")))
    found = ranked.groupBy(*keys).agg(((at(first) + at(second)) / 2.0).alias(out))
    missed = F.raise_error(F.lit("a sketch band does not hold its median")).cast("double")
    return found.withColumn(out, F.when(F.col(out).isNotNull(), F.col(out)).otherwise(missed))
