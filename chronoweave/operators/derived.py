"""Topology-derived cluster features.

From a magnetic stream's raw field B[t, k, axis] and the topology's sensor
positions and clusters: per-sensor baseline (NaN-skipping median over time),
ΔB = B − B0, response r = ‖ΔB‖, and per cluster and frame the normal proxy
(mean r), shear (mean ΔB x/y and its norm) and the response-weighted centroid.
Everything is computed in double and written as float32, as the formulas
recorded with the output say. Silver stays raw.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import nan_d, safe_div, shape_width
from ..schemas import DERIVED_FEATURES, DERIVED_FORMULAS, DERIVED_VERSION, MAG_KIND, STREAM_KEYS
from .exports import register_export
from .stats import exact_median

KEYS = STREAM_KEYS


class DerivedError(ValueError):
    pass


def magnetic_streams(streams: DataFrame, kind: str = MAG_KIND) -> DataFrame:
    """Streams of the magnetic payload kind (callers assert non-empty)."""
    return streams.where(F.col("payload_kind") == kind)


def cluster_map(sensors: DataFrame, members: DataFrame) -> DataFrame:
    """(topology_ref, cluster_id, cluster_ord, ord, sensor_id, x_m, y_m)
    for the magnetic sensors; members unknown to the topology are dropped and
    a topology without clusters gets one cluster per sensor."""
    mag = sensors.where(F.col("modality") == "magnetic").select(
        "topology_ref", "sensor_id", "ord", "x_m", "y_m")
    # magnetic-sensor position among magnetic sensors = payload index
    from pyspark.sql import Window
    w = Window.partitionBy("topology_ref").orderBy("ord")
    mag = mag.withColumn("ord", (F.row_number().over(w) - 1).cast("int"))
    m = members.join(mag, ["topology_ref", "sensor_id"])
    has = m.select("topology_ref").distinct()
    solo = (mag.join(has, "topology_ref", "left_anti")
               .select("topology_ref", F.col("sensor_id").alias("cluster_id"),
                       F.col("ord").alias("cluster_ord"), "sensor_id", "ord", "x_m", "y_m"))
    return m.select("topology_ref", "cluster_id", "cluster_ord", "sensor_id", "ord", "x_m", "y_m") \
            .unionByName(solo)


def topology_size_mismatch(streams: DataFrame, sensors: DataFrame) -> DataFrame:
    """S13 assertion: streams whose payload dim 0 ≠ number of magnetic sensors."""
    n = (sensors.where(F.col("modality") == "magnetic").groupBy("topology_ref")
         .agg(F.count(F.lit(1)).alias("n_mag")))
    return (streams.join(n, "topology_ref", "left")
            .where(F.coalesce(F.col("n_mag"), F.lit(-1)) != F.col("shape")[0]))


def baseline(silver: DataFrame) -> DataFrame:
    """(session, device, stream, pos, b0) nanmedian over time per flat
    element (pos = 3·sensor + axis); exact median, no group collected whole."""
    ex = silver.select(*KEYS, F.posexplode("value").alias("pos", "v")).where(~F.isnan("v"))
    return exact_median(ex, KEYS + ["pos"], "v", out="b0")


def baseline_arrays(silver: DataFrame, streams: DataFrame) -> DataFrame:
    """B0 back as one array<double> of ``width`` per stream (NaN where a
    position never had a finite value)."""
    b = baseline(silver)
    st = streams.select(*KEYS, shape_width("shape").alias("width"))
    g = b.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("pos", "b0"))).alias("_m"))
    return (st.join(g, KEYS, "left")
            .select(*KEYS, F.transform(F.sequence(F.lit(0), F.col("width") - 1),
                                       lambda i: F.coalesce(F.element_at(F.col("_m"), i), nan_d()))
                    .alias("b0")))


def delta_rows(silver: DataFrame, streams: DataFrame) -> DataFrame:
    """Per frame ΔB (array<double>) and r per sensor (array<double>)."""
    b0 = baseline_arrays(silver, streams)
    j = silver.join(b0, KEYS)
    db = F.zip_with("value", "b0", lambda v, b: v.cast("double") - b)
    j = j.select(*KEYS, "frame_index", "t_ref_us", db.alias("db"))
    r = F.transform(F.sequence(F.lit(0), (F.size("db") / 3).cast("int") - 1),
                    lambda k: F.sqrt(F.col("db")[k * 3] * F.col("db")[k * 3]
                                     + F.col("db")[k * 3 + 1] * F.col("db")[k * 3 + 1]
                                     + F.col("db")[k * 3 + 2] * F.col("db")[k * 3 + 2]))
    return j.withColumn("r", r)


def cluster_features(silver: DataFrame, streams: DataFrame, sensors: DataFrame,
                     members: DataFrame) -> DataFrame:
    """D4–D7 long form: (session, device, stream, frame_index, t_ref_us,
    cluster_id, normal_proxy, shear_x, shear_y, shear_mag, centroid_x_m,
    centroid_y_m) in double."""
    mags = magnetic_streams(streams)
    s = silver.join(mags.select(*KEYS), KEYS, "left_semi")
    d = delta_rows(s, mags)
    cm = cluster_map(sensors, members)
    cl = cm.groupBy("topology_ref", "cluster_id", "cluster_ord").agg(
        F.array_sort(F.collect_list(F.struct("ord", "x_m", "y_m"))).alias("_mem"))
    # Stream → topology by device (streams carry the device's topology_ref), one row per
    # stream; frames meet it on the stream key they are already dealt by
    per = (mags.select(*KEYS, "topology_ref").join(cl, "topology_ref")
           .groupBy(*KEYS).agg(F.collect_list(F.struct("cluster_id", "cluster_ord", "_mem")).alias("_clusters")))
    j = d.join(per, KEYS).select(*d.columns, F.inline("_clusters"))
    mem = F.col("_mem")
    n = F.size(mem).cast("double")

    def total(f):
        return F.aggregate(mem, F.lit(0.0).cast("double"), lambda acc, m: acc + f(m))

    r_of = lambda m: F.col("r")[m["ord"]]
    dx = lambda m: F.col("db")[m["ord"] * 3]
    dy = lambda m: F.col("db")[m["ord"] * 3 + 1]
    sx, sy = total(dx) / n, total(dy) / n
    sr = total(r_of)
    return j.select(
        *KEYS, "frame_index", "t_ref_us", "cluster_id", "cluster_ord",
        (sr / n).alias("normal_proxy"), sx.alias("shear_x"), sy.alias("shear_y"),
        F.sqrt(sx * sx + sy * sy).alias("shear_mag"),
        safe_div(total(lambda m: r_of(m) * m["x_m"]), sr).alias("centroid_x_m"),
        safe_div(total(lambda m: r_of(m) * m["y_m"]), sr).alias("centroid_y_m"))


_FORMULA_KEY = {"normal_proxy": "normal_proxy", "shear_x": "shear_x/shear_y", "shear_y": "shear_x/shear_y",
                "shear_mag": "shear_mag", "centroid_x_m": "centroid_x_m/centroid_y_m",
                "centroid_y_m": "centroid_x_m/centroid_y_m"}
_UNITS = {"normal_proxy": "uT", "shear_x": "uT", "shear_y": "uT", "shear_mag": "uT",
          "centroid_x_m": "m", "centroid_y_m": "m"}


def derived_table(long: DataFrame, clusters: list[str]) -> DataFrame:
    """Per (stream, frame): ``t_ref_us``, ``frame_index`` and six float32
    columns ``derived.<cluster>.<feature>`` per cluster (explicit pivot list).

    Each feature column carries its formula, units and the derived version as
    column metadata (kept in the Parquet footer), and ``t_ref_us`` carries the
    baseline method, the formula registry and the cluster list, so the output
    is reproducible and never mistaken for measured truth."""
    aggs = []
    for c in clusters:
        hit = F.col("cluster_id") == c
        for f in DERIVED_FEATURES:
            meta = {"formula": DERIVED_FORMULAS[_FORMULA_KEY[f]], "units": _UNITS[f],
                    "derived_version": DERIVED_VERSION, "cluster": c}
            aggs.append(F.first(F.when(hit, F.col(f)), True).cast("float")
                        .alias(f"derived.{c}.{f}", metadata=meta))
    out = long.groupBy(*KEYS, "frame_index", "t_ref_us").agg(*aggs)
    tmeta = {"derived_version": DERIVED_VERSION, "baseline_method": "per_sensor_median_over_valid",
             "formulas": json.dumps(DERIVED_FORMULAS), "clusters": json.dumps(clusters)}
    return out.withColumn("t_ref_us", F.col("t_ref_us").alias("t_ref_us", metadata=tmeta))


def derived_export(silver, streams, sensors, members) -> DataFrame:
    """K9: the derived table for every magnetic stream (keyed by device and
    stream, so two magnetic streams of one device never overwrite)."""
    if sensors is None or members is None:
        raise DerivedError("derived features need a topology: its sensors and its cluster members")
    if not magnetic_streams(streams).limit(1).collect():
        raise DerivedError(f"no stream of kind {MAG_KIND!r} to derive features from")
    no_topo = magnetic_streams(streams).where("topology_ref is null").limit(1).collect()
    if no_topo:
        raise DerivedError(f"device {no_topo[0].device_id!r} has no topology")
    odd = topology_size_mismatch(magnetic_streams(streams), sensors).limit(1).collect()
    if odd:
        raise DerivedError(f"stream {odd[0].stream_id!r} of {odd[0].device_id!r} and its topology differ in sensors")
    clusters = [r.cluster_id for r in cluster_map(sensors, members)
                .select("cluster_id", "cluster_ord").distinct().orderBy("cluster_ord", "cluster_id")
                .collect()]
    return derived_table(cluster_features(silver, streams, sensors, members), clusters)


@register_export("derived")
def derived_rows(silver, streams, meta=None, *, sensors=None, members=None, **_) -> DataFrame:
    """K9 as a format: sessions without a magnetic stream have no rows."""
    return derived_export(silver, streams, sensors, members)
