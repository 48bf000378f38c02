"""As-of neighbours, distributed row numbering and the as-of alignment adapter.

Both as-of and row numbering are windows over a time order. A window over a
whole stream puts the stream in one task, so the order is cut into windows of
about ``target_rows`` rows each (:mod:`.depth`) and what crosses them is carried:

* row numbering: rows of the windows before;
* as-of: the last sample of the nearest earlier window that has one and the
  first of the nearest later one, injected as virtual samples, so a window per
  (stream, interval) is exact.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.expr import clip_unit
from .depth import CELL_US, TARGET_ROWS, DepthWindows, cell_of


def number_rows(df: DataFrame, keys: list[str], order: list[str], *, t: str, cell: int = CELL_US,
                target_rows: int = TARGET_ROWS, out: str = "row") -> DataFrame:
    """0-based position of each row within ``keys`` in ``order`` (``order[0]``
    must be the time column ``t``), without a window over whole groups. Null times come first."""
    d = df.withColumn("_t", F.coalesce(F.col(t).cast("long"), F.lit(-(1 << 62)))).withColumn("_o", F.struct(*order[1:]) if order[1:] else F.lit(0))
    cells = d.groupBy(*keys, cell_of("_t", cell).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    w = DepthWindows(cells, d, keys, cell=cell, target=target_rows)
    counts = w.cells.select(*keys, "_c", F.col("_n").alias("_cnt"), F.col("_before").alias("_first"))
    if w.dense:  # windows of cut cells: their counts, added up from the cell's first row
        cut = w.assign(d, "_t", "_o").where(F.col("_b") % (1 << 20) > 0).groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_m"))
        piece = Window.partitionBy(*keys, "_run").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, 0)
        # a cut cell ends its run: the last piece ends where the cell ends
        ends = (w.cells.join(w.cuts, [*keys, "_c"]).select(*keys, w.run.alias("_run"), (F.col("_before") + F.col("_n")).alias("_end")))
        pieces = (cut.withColumn("_run", F.col("_b") - F.col("_b") % (1 << 20)).join(ends, [*keys, "_run"])
                  .select(*keys, "_b", (F.col("_end") - F.sum("_m").over(piece)).alias("_off")))
    offs = counts.join(w.table.select(*keys, "_c", F.col("_run").alias("_b")), [*keys, "_c"]).groupBy(*keys, "_b").agg(F.min("_first").alias("_off"))
    if w.dense:
        offs = offs.unionByName(pieces)
    inner = Window.partitionBy(*keys, "_b").orderBy(*order)
    return (w.assign(d, "_t", "_o").join(offs, [*keys, "_b"])
            .withColumn(out, (F.row_number().over(inner) - 1 + F.col("_off")).cast("long"))
            .drop("_b", "_off", "_t", "_o"))


# What follows a row is what precedes it in the reverse order. Spark keeps a running value over a
# frame that begins where the partition does; one that ends there is read again for every row.
def _upto(part: WindowSpec, *order: str) -> WindowSpec:
    return part.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _upto_back(part: WindowSpec, *order: str) -> WindowSpec:
    return part.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(ordered: WindowSpec) -> WindowSpec:
    return ordered.rowsBetween(Window.unboundedPreceding, -1)


def _edges(cells_or_rows: DataFrame, keys: list[str], r: str = "_r") -> DataFrame:
    return cells_or_rows.groupBy(*keys, "_c").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min(r).alias("_first"), F.max(r).alias("_last"))


def asof_neighbors(left: DataFrame, right: DataFrame, keys: list[str], *, left_t: str,
                   right_t: str, right_cols: list[str], cell_us: int = CELL_US, target_rows: int = TARGET_ROWS,
                   prev: str = "prev", nxt: str = "next") -> DataFrame:
    """For every left row: ``prev`` = the right row with the greatest
    (t, right_cols) where ``t ≤ left_t``; ``nxt`` = the smallest with
    ``t > left_t``. Both are structs ``(t, *right_cols)`` or NULL.

    Exact for any gap length. One large shuffle: left ∪ right ∪ one header
    row per window; the headers carry the edges of the neighbouring windows
    that hold right rows, computed on the small table of windows. A left row
    without a time has no neighbours; a right row without one is none.
    """
    lcols = left.columns
    right = right.where(F.col(right_t).isNotNull())
    rs = F.struct(F.col("_t").alias("t"), *[F.col(c) for c in right_cols])
    r = right.select(*keys, F.col(right_t).cast("long").alias("_t"), *right_cols).select(*keys, "_t", rs.alias("_r"))
    lf = left.withColumn("_t", F.coalesce(F.col(left_t).cast("long"), F.lit(-(1 << 62))))
    rtype = r.schema["_r"].dataType
    redges = _edges(r.withColumn("_c", cell_of("_t", cell_us)), keys)
    lcells = lf.groupBy(*keys, cell_of("_t", cell_us).alias("_c")).agg(F.count(F.lit(1)).alias("_ln"))
    cells = redges.join(lcells, [*keys, "_c"], "full").withColumn(
        "_n", F.coalesce("_cnt", F.lit(0)) + F.coalesce("_ln", F.lit(0)))
    both = r.select(*keys, "_t", F.col("_r").alias("_o")).unionByName(lf.select(*keys, "_t", F.lit(None).cast(rtype).alias("_o")))
    w = DepthWindows(cells, both, keys, cell=cell_us, target=target_rows)
    per = w.summaries(w.cells.select(*keys, "_c", "_first", "_last"), r, [F.min("_r").alias("_first"), F.max("_r").alias("_last")],
                      [F.min("_first").alias("_first"), F.max("_last").alias("_last")], "_t", "_r")
    wk = Window.partitionBy(*keys)
    hdr = w.all_windows().join(per, [*keys, "_b"], "left").select(
        *keys, "_b", F.last("_last", True).over(_before(wk.orderBy("_b"))).alias("_cin"),
        F.last("_first", True).over(_before(wk.orderBy(F.desc("_b")))).alias("_cout"))
    ltype = F.struct(*[F.col(c) for c in lcols])
    lrows = w.assign(lf, "_t").select(
        *keys, "_b", "_t", F.lit(1).alias("_side"), ltype.alias("_l"), F.lit(None).cast(rtype).alias("_r"),
        F.lit(None).cast(rtype).alias("_cin"), F.lit(None).cast(rtype).alias("_cout"))
    lt = lrows.schema["_l"].dataType
    rrows = w.assign(r, "_t", "_r").select(
        *keys, "_b", "_t", F.lit(0).alias("_side"), F.lit(None).cast(lt).alias("_l"),
        "_r", F.lit(None).cast(rtype).alias("_cin"), F.lit(None).cast(rtype).alias("_cout"))
    hrows = hdr.select(*keys, "_b", F.lit(None).cast("long").alias("_t"), F.lit(-1).alias("_side"),
                       F.lit(None).cast(lt).alias("_l"), F.lit(None).cast(rtype).alias("_r"),
                       "_cin", "_cout")
    u = lrows.unionByName(rrows).unionByName(hrows)
    part = Window.partitionBy(*keys, "_b")
    upto, back = _upto(part, "_t", "_side", "_r"), _upto_back(part, "_t", "_side", "_r")
    out = u.select(
        "_side", "_l",
        F.coalesce(F.last("_r", True).over(upto), F.max("_cin").over(part)).alias(prev),
        F.coalesce(F.last("_r", True).over(back), F.max("_cout").over(part)).alias(nxt),
    ).where("_side = 1")
    timed = F.col("_l")[left_t].isNotNull()
    return out.select(*[F.col("_l")[c].alias(c) for c in lcols], F.when(timed, F.col(prev)).alias(prev), F.when(timed, F.col(nxt)).alias(nxt))


def sample_edges(samples: DataFrame, cell_us: int = CELL_US,
                 keys: tuple[str, ...] = ("session_id", "device_id", "stream_id")) -> DataFrame:
    """Per (stream, time cell): sample count and first/last sample time —
    a small table (one row per non-empty cell) from one partial aggregate."""
    s = samples.select(*keys, F.col("t_us").alias("_r"), cell_of("t_us", cell_us).alias("_c"))
    return _edges(s, list(keys))


def bounds_from_edges(edges: DataFrame) -> DataFrame:
    """Session time span (all streams) from the cell edges — no extra scan."""
    return edges.groupBy("session_id").agg(F.min("_first").alias("lo_us"), F.max("_last").alias("hi_us"))


def align_samples(samples: DataFrame, bounds: DataFrame | None, streams: DataFrame, *,
                  step_us: int, tolerance_us: int, order: str,
                  sync: DataFrame | None = None, tau_us: float | None = None, cell_us: int = CELL_US,
                  target_rows: int = TARGET_ROWS, edges: DataFrame | None = None) -> dict:
    """Fused B1 grid + row numbering + B3/B4 as-of alignment in one windowed pass.

    ``samples(session_id, device_id, stream_id, t_us, <order>, value)``,
    ``bounds(session_id, lo_us, hi_us)`` (default: the sample span) → ``grid``,
    ``payload`` (0-based ``row`` in (t_us, order) order per stream) and
    ``alignment`` (indices into those rows, confidence components).
    ``sync(session_id, t_us)`` are the session's sync events: conf_clock =
    exp(−d/τ) with d the distance to the nearest one (1.0 without any).
    Samples without a time take no part.

    One large shuffle: samples ∪ sync events ∪ grid×streams ∪ one header per
    window, in windows of about ``target_rows`` of these rows per stream. Headers carry
    the row offset and the neighbouring windows' edges, computed on small
    tables, so no window ever spans a whole stream. ``edges`` (from
    :func:`sample_edges`, same ``cell_us``) can be passed in when the caller
    already derived its stream list or bounds from them.
    """
    from .grid import grid_from_bounds
    keys = ["session_id", "device_id", "stream_id"]
    if edges is None:
        edges = sample_edges(samples, cell_us)
    if bounds is None:
        bounds = bounds_from_edges(edges)
    grid = grid_from_bounds(bounds, step_us)
    st = streams.select(*keys, "kernel")
    s = samples.select(*keys, "t_us", F.col(order).alias("_o"), "value", F.lit(0).alias("_kind"))
    # grid points of each cell of a session's span, by arithmetic
    span = bounds.select("session_id", "lo_us", "hi_us", F.explode(F.sequence(
        cell_of("lo_us", cell_us), cell_of("hi_us", cell_us))).alias("_c"))
    points = F.floor((F.col("hi_us") - F.col("lo_us")) / step_us) + 1

    def until(t):
        return F.least(F.greatest(F.ceil((t - F.col("lo_us")) / step_us), F.lit(0)), points)
    start, end = F.col("_c") * cell_us, (F.col("_c") + 1) * cell_us
    jump = step_us * max(1, target_rows // 2)
    cells = span.select("session_id", "_c", (until(end) - until(start)).cast("long").alias("_frames"))
    if sync is not None:
        # sync events are per session and copied to each of its streams
        sy = sync.select("session_id", "t_us")
        per_cell = sy.groupBy("session_id", cell_of("t_us", cell_us).alias("_c")).agg(
            F.count(F.lit(1)).alias("_sn"), F.min("t_us").alias("_sfirst"), F.max("t_us").alias("_slast"))
        cells = cells.join(per_cell, ["session_id", "_c"], "full")
        s = s.unionByName(sy.join(st, "session_id").select(
            *keys, "t_us", F.lit(None).cast(s.schema["_o"].dataType).alias("_o"),
            F.lit(None).cast(s.schema["value"].dataType).alias("value"), F.lit(2).alias("_kind")))
    else:
        cells = cells.withColumns({"_sn": F.lit(0), "_sfirst": F.lit(None).cast("long"), "_slast": F.lit(None).cast("long")})
    cells = edges.join(cells.join(st.select(*keys), "session_id"), [*keys, "_c"], "full").withColumn(
        "_n", F.coalesce("_cnt", F.lit(0)) + F.coalesce("_frames", F.lit(0)) + F.coalesce("_sn", F.lit(0)))
    marks = F.when(F.col("_frames") > target_rows // 2, F.sequence(F.col("_c") * cell_us, (F.col("_c") + 1) * cell_us - 1, F.lit(jump)))
    windows = DepthWindows(cells, s.withColumnRenamed("t_us", "_t"), keys, cell=cell_us, target=target_rows,
                           marks=cells.where(F.col("_frames") > target_rows // 2).select(*keys, "_c", marks.alias("_marks")))
    smp, syn = F.col("_kind") == 0, F.col("_kind") == 2
    per = windows.summaries(
        windows.cells.select(*keys, "_c", "_cnt", "_first", "_last", "_sfirst", "_slast"), s,
        [F.sum(smp.cast("long")).alias("_cnt"), F.min(F.when(smp, F.col("t_us"))).alias("_first"),
         F.max(F.when(smp, F.col("t_us"))).alias("_last"), F.min(F.when(syn, F.col("t_us"))).alias("_sfirst"),
         F.max(F.when(syn, F.col("t_us"))).alias("_slast")],
        [F.sum("_cnt").alias("_cnt"), F.min("_first").alias("_first"), F.max("_last").alias("_last"),
         F.min("_sfirst").alias("_sfirst"), F.max("_slast").alias("_slast")], "t_us", "_o")
    wk = Window.partitionBy(*keys)
    before, later = _before(wk.orderBy("_b")), _before(wk.orderBy(F.desc("_b")))
    hdr = windows.all_windows().join(per, [*keys, "_b"], "left").select(
        *keys, "_b", F.coalesce("_cnt", F.lit(0)).alias("_hcnt"),
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_hoff"),
        F.last("_last", True).over(before).alias("_cin"), F.last("_first", True).over(later).alias("_cout"),
        F.last("_slast", True).over(before).alias("_scin"), F.last("_sfirst", True).over(later).alias("_scout"))
    s = windows.assign(s, "t_us", "_o")
    left = windows.assign(grid.join(st, "session_id"), "t_ref_us")

    common = {"_t": "long", "_o": s.schema["_o"].dataType.simpleString(),
              "value": s.schema["value"].dataType.simpleString(), "_kind": "int",
              "frame_index": "long", "kernel": "string", "_hcnt": "long", "_hoff": "long",
              "_cin": "long", "_cout": "long", "_scin": "long", "_scout": "long"}

    def rows(df, side, have):
        cols = [*keys, "_b", F.lit(side).alias("_side")]
        for c, t in common.items():
            cols.append(F.col(c).cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c))
        return df.select(*cols)

    u = (rows(s.withColumnRenamed("t_us", "_t"), 0, {"_t", "_o", "value", "_kind"})
         .unionByName(rows(left.withColumnRenamed("t_ref_us", "_t"), 1, {"_t", "frame_index", "kernel"}))
         .unionByName(rows(hdr, -1, {"_hcnt", "_hoff", "_cin", "_cout", "_scin", "_scout"})))
    part = Window.partitionBy(*keys, "_b")
    upto, back = _upto(part, "_t", "_side", "_kind", "_o"), _upto_back(part, "_t", "_side", "_kind", "_o")
    smp, syn = (F.col("_side") == 0) & smp, (F.col("_side") == 0) & syn
    out = u.select(
        *keys, "_side", "_kind", "_t", "value", "frame_index", "kernel",
        F.sum(smp.cast("long")).over(upto).alias("_k"),
        F.last(F.when(smp, F.col("_t")), True).over(upto).alias("_pt"),
        F.last(F.when(smp, F.col("_t")), True).over(back).alias("_nt"),
        F.last(F.when(syn, F.col("_t")), True).over(upto).alias("_spt"),
        F.last(F.when(syn, F.col("_t")), True).over(back).alias("_snt"),
        F.max("_hoff").over(part).alias("_off"), F.max("_hcnt").over(part).alias("_cnt"),
        F.max("_cin").over(part).alias("_ci"), F.max("_cout").over(part).alias("_co"),
        F.max("_scin").over(part).alias("_sci"), F.max("_scout").over(part).alias("_sco"))

    payload = out.where("_side = 0 and _kind = 0").select(
        *keys, (F.col("_off") + F.col("_k") - 1).alias("row"), F.col("_t").alias("t_us"), "value")

    a = out.where("_side = 1")
    src_row = (F.when(F.col("_k") > 0, F.col("_off") + F.col("_k") - 1)
                .when(F.col("_ci").isNotNull(), F.col("_off") - 1))
    src_t = F.coalesce(F.col("_pt"), F.col("_ci"))
    nxt_row = (F.when(F.col("_nt").isNotNull(), F.col("_off") + F.col("_k"))
                .when(F.col("_co").isNotNull(), F.col("_off") + F.col("_cnt")))
    nxt_t = F.coalesce(F.col("_nt"), F.col("_co"))
    if sync is not None:
        d = F.least(F.col("_t") - F.coalesce("_spt", "_sci"), F.coalesce("_snt", "_sco") - F.col("_t"))
        clock = F.coalesce(F.exp(-d.cast("double") / F.lit(float(tau_us))), F.lit(1.0))
    else:
        clock = F.lit(1.0)
    a = a.select(*keys, "frame_index", F.col("_t").alias("t_ref_us"), "kernel",
                 clock.alias("conf_clock"),
                 src_row.alias("_sr"), src_t.alias("_st"), nxt_row.alias("_nr"), nxt_t.alias("_ntt"))
    return {"grid": grid, "payload": payload, "alignment": _indices_to_alignment(a, tolerance_us)}


def _indices_to_alignment(a: DataFrame, tolerance_us: int) -> DataFrame:
    """(… t_ref_us, _sr, _st, _nr, _ntt) → alignment columns (B3/B4 rules)."""
    back = F.col("t_ref_us") - F.col("_st")
    fwd = F.col("_ntt") - F.col("t_ref_us")
    gap = F.least(back, F.coalesce(fwd, back))
    has_src = F.col("_st").isNotNull()
    valid = has_src & (gap <= F.lit(tolerance_us))
    weight = F.when(has_src & F.col("_ntt").isNotNull(),
                    (back.cast("double") / (F.col("_ntt") - F.col("_st")).cast("double")).cast("float")
                    ).otherwise(F.lit(0.0).cast("float"))
    interp = F.when(valid, clip_unit(F.lit(1.0) - gap.cast("double") / F.lit(float(tolerance_us)))) \
              .otherwise(F.lit(0.0))
    return a.select(
        "session_id", "device_id", "stream_id", "frame_index", "t_ref_us", "kernel",
        F.coalesce(F.col("_sr"), F.lit(-1)).cast("long").alias("source_index"),
        F.coalesce(F.col("_nr"), F.lit(-1)).cast("long").alias("next_index"),
        weight.alias("weight"), valid.alias("valid"),
        F.lit(1.0).alias("conf_source"), F.coalesce(F.col("conf_clock").cast("double"), F.lit(1.0))
        .alias("conf_clock"), interp.alias("conf_interp"))


def asof_alignment(grid: DataFrame, streams: DataFrame, payload: DataFrame, *,
                   tolerance_us: int, target_rows: int = TARGET_ROWS,
                   clock: DataFrame | None = None) -> DataFrame:
    """B3 + B4: alignment indices and confidence components from sample times.

    * source = latest sample with ``t ≤ t_ref``, next = earliest with ``t > t_ref``
      (−1 when none);
    * valid = a source exists and the nearest sample is within tolerance;
    * weight = (t_ref − t_src)/(t_next − t_src) in float32, 0 without a next;
    * conf_interp = clip(1 − gap/tol, 0, 1), 0 at gaps; conf_source = 1;
      conf_clock from ``clock(session_id, frame_index, conf_clock)`` or 1.

    Keeps ``t_ref_us`` and ``kernel`` on the rows so the projection needs no
    second join with the grid.
    """
    g = grid
    if clock is not None:
        g = g.join(clock.select("session_id", "frame_index", "conf_clock"),
                   ["session_id", "frame_index"], "left")
    else:
        g = g.withColumn("conf_clock", F.lit(1.0))
    st = streams.select("session_id", "device_id", "stream_id", "kernel")
    left = g.join(st, "session_id")
    keys = ["session_id", "device_id", "stream_id"]
    nb = asof_neighbors(left, payload.select(*keys, "t_us", "row"), keys,
                        left_t="t_ref_us", right_t="t_us", right_cols=["row"],
                        target_rows=target_rows, prev="_p", nxt="_x")
    a = nb.select(*keys, "frame_index", "t_ref_us", "kernel", "conf_clock",
                  F.col("_p.row").alias("_sr"), F.col("_p.t").alias("_st"),
                  F.col("_x.row").alias("_nr"), F.col("_x.t").alias("_ntt"))
    return _indices_to_alignment(a, tolerance_us)


def sync_clock_confidence(grid: DataFrame, sync_events: DataFrame, *, tau_us: float,
                          target_rows: int = TARGET_ROWS) -> DataFrame:
    """B4 clock component: ``exp(−d/τ)`` with d the distance from each frame to
    the session's nearest sync event; 1.0 when the session has none."""
    nb = asof_neighbors(grid.select("session_id", "frame_index", "t_ref_us"),
                        sync_events.select("session_id", "t_us"), ["session_id"],
                        left_t="t_ref_us", right_t="t_us", right_cols=[],
                        target_rows=target_rows, prev="_p", nxt="_x")
    d = F.least(F.col("t_ref_us") - F.col("_p.t"), F.col("_x.t") - F.col("t_ref_us"))
    return nb.select("session_id", "frame_index",
                     F.coalesce(F.exp(-d.cast("double") / F.lit(float(tau_us))),
                                F.lit(1.0)).alias("conf_clock"))
