"""Windows that hold about the same number of rows, whatever the rows' times.

Time is counted in fine cells. Runs of sparse cells are merged until they hold ``target`` rows; a
cell that holds more is cut by rank, at places found from a sample of its rows. A window is an
interval of the order (time, tie-breaker), so what crosses windows is carried by one header each.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import sums_before, written

#: Width of a counting cell, in the unit of the time column (1 h of microseconds).
CELL_US = 3600 * 1_000_000
#: Rows of a window. A window holds fewer than twice as many, but for equal (time, tie-breaker).
TARGET_ROWS = 1 << 18
_PIECES = 1 << 20   # windows that one cell can be cut into
_SAMPLED = 64       # sampled rows per target


def cell_of(t: str | Column, cell: int) -> Column:
    return F.floor((F.col(t) if isinstance(t, str) else t) / F.lit(cell)).cast("long")


class DepthWindows:
    """The windows of some rows: ``cells(keys…, _c, _n)`` counts all rows of a cell once, and
    ``rows(keys…, _t, _o)`` are those rows, or the ones whose number per cell has no bound.

    ``marks(keys…, _c, _marks array<bigint>)`` may add times to cut dense cells at (rows on a
    regular grid need no sampling). The table of cells is small: one row per key and cell that
    holds rows. Cells of one key are summed by one task.
    """

    def __init__(self, cells: DataFrame, rows: DataFrame, keys: list[str], *, cell: int, target: int,
                 marks: DataFrame | None = None):
        self.keys, self.cell, self.target = keys, cell, target
        self.cells = written(sums_before(cells, ["_c"], {"_before": "_n"}, keys=keys))
        self.run = F.floor(F.col("_before") / target) * _PIECES
        dense = self.cells.where(F.col("_n") > target).select(*keys, "_c")
        self.dense = bool(dense.limit(1).count())
        table = self.cells.select(*keys, "_c", self.run.alias("_run"))
        self.cuts = None
        if self.dense:
            share = min(1.0, _SAMPLED / target)
            step = max(1, round(share * target / 2))
            own = rows.select(*keys, "_t", "_o", cell_of("_t", cell).alias("_c")).join(dense, [*keys, "_c"], "left_semi")
            # drawn at random, so that many equal rows are as rare in the sample as any; written once
            sample = own.where(F.rand(11) < share).groupBy(*keys, "_c").agg(
                F.sort_array(F.collect_list(F.struct("_t", "_o"))).alias("_s"))
            cut = F.filter("_s", lambda x, i: (i > 0) & (i % step == 0))
            cuts = sample.select(*keys, "_c", cut.alias("_cuts"))
            if marks is not None:
                kind = cuts.schema["_cuts"].dataType.simpleString()
                o = rows.schema["_o"].dataType
                at = F.transform("_marks", lambda x: F.struct(x.alias("_t"), F.lit(None).cast(o).alias("_o"))).cast(kind)
                more = marks.join(dense, [*keys, "_c"], "left_semi").select(*keys, "_c", at.alias("_more"))
                none = F.array().cast(kind)
                cuts = cuts.join(more, [*keys, "_c"], "full").select(
                    *keys, "_c", F.concat(F.coalesce("_cuts", none), F.coalesce("_more", none)).alias("_cuts"))
            self.cuts = written(cuts.select(*keys, "_c", F.array_sort(F.array_distinct("_cuts")).alias("_cuts"))
                                .where(F.size("_cuts") > 0))
            table = table.join(self.cuts, [*keys, "_c"], "left")
        self.table = table

    def assign(self, df: DataFrame, t: str, o: str | None = None) -> DataFrame:
        """``df`` with its window ``_b``. Rows without a tie-breaker come after all rows of their time."""
        out = df.withColumn("_c", cell_of(t, self.cell)).join(self.table, [*self.keys, "_c"])
        piece = F.lit(0)
        if self.dense:
            def reached(x):
                same = F.lit(True) if o is None else F.coalesce(x["_o"] <= F.col(o), F.lit(True))
                return (x["_t"] < F.col(t)) | ((x["_t"] == F.col(t)) & same)
            piece = F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", reached))).otherwise(0)
        return out.withColumn("_b", (F.col("_run") + piece).cast("long")).drop("_c", "_run", "_cuts")

    def all_windows(self) -> DataFrame:
        """(keys…, _b) of every window that may hold rows."""
        n = F.coalesce(F.size("_cuts"), F.lit(0)) if self.dense else F.lit(0)
        n = F.greatest(n, F.lit(0))
        return self.table.select(*self.keys, F.explode(F.sequence(F.lit(0), n)).alias("_i"), "_run").select(
            *self.keys, (F.col("_run") + F.col("_i")).cast("long").alias("_b")).distinct()

    def summaries(self, by_cell: DataFrame, rows: DataFrame, of_rows: list[Column], merge: list[Column], t: str, o: str | None = None) -> DataFrame:
        """Aggregates per window: cells that are not cut bring theirs from ``by_cell(keys…, _c,
        columns)``; only rows of cut cells are aggregated again (``of_rows``). ``merge`` combines."""
        columns = [c for c in by_cell.columns if c not in (*self.keys, "_c")]
        parts = by_cell.join(self.table, [*self.keys, "_c"])
        if self.dense:
            parts = parts.where("_cuts IS NULL")
        parts = parts.select(*self.keys, F.col("_run").cast("long").alias("_b"), *columns)
        if self.dense:
            own = rows.withColumn("_c", cell_of(t, self.cell)).join(self.cuts.select(*self.keys, "_c"), [*self.keys, "_c"], "left_semi").drop("_c")
            again = self.assign(own, t, o).groupBy(*self.keys, "_b").agg(*of_rows)
            parts = parts.unionByName(again)
        return parts.groupBy(*self.keys, "_b").agg(*merge)
