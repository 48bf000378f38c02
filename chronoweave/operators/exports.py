"""Gold exporters (K2–K8, P11–P13) — pure projections of ``silver_long``.

Every exporter is a DataFrame function ``fn(silver, streams, meta, **opts)``
returning the rows of its format. Formats are registered by name; some have
metadata tables besides (:func:`export_metadata`).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LEROBOT_DATA_PATH, ROBOT_TYPE, STREAM_KEYS, TRAINER_BATCH_FRAMES
from .scan import sums_before, written
from .silver import feature_list, feature_names, silver_wide, with_feature

KEYS = STREAM_KEYS
_REGISTRY: dict[str, Callable[..., DataFrame]] = {}
# fixed values of the format: its index columns (name, type, units)
LEROBOT_INDEX_FEATURES = [("timestamp", "float32", "s"), ("frame_index", "int64", None), ("episode_index", "int64", None),
                          ("index", "int64", None), ("task_index", "int64", None)]


def register_export(name: str, fn: Callable[..., DataFrame] | None = None):
    """Register an exporter; usable as a decorator. Empty names are refused."""
    if not name:
        raise ValueError("an exporter needs a non-empty name")

    def deco(f):
        _REGISTRY[name] = f
        return f
    return deco(fn) if fn is not None else deco


def get_export(name: str) -> Callable[..., DataFrame]:
    if name not in _REGISTRY:
        raise KeyError(f"unknown exporter {name!r}; registered: {sorted(_REGISTRY)}")
    return _REGISTRY[name]


def registered_exports() -> list[str]:
    return sorted(_REGISTRY)


def seconds(t_us) -> F.Column:
    """µs → seconds as float32."""
    return (F.col(t_us) / F.lit(1e6)).cast("float")


def episodes(silver: DataFrame) -> DataFrame:
    """One episode per session: ``episode_index`` = rank of the session id,
    ``length`` = frames, ``index_offset`` = frames of the earlier episodes.
    Prefix sums over the per-session aggregate, in ranges of session ids."""
    # a column of its own: Silver's would stand on both sides of a join with Silver's frames
    per = silver.groupBy(F.col("session_id").alias("session_id")).agg(
        F.countDistinct("frame_index").cast("long").alias("length"), F.lit(1).alias("_one"))
    # a row per session, which the sums read three times
    out = sums_before(written(per), ["session_id"], {"episode_index": "_one", "index_offset": "length"})
    return out.select("session_id", "episode_index", "length", "index_offset")


def _array_pivot(silver: DataFrame, features) -> DataFrame:
    """(session, frame, t_ref) → ``observation.<f>`` array<float> and
    ``observation.<f>.confidence`` float32 per feature (no valid column).

    Elements are pivoted as scalars (hash aggregate, codegen) and re-assembled
    into arrays afterwards; a feature the session lacks stays NULL."""
    aggs, post = [], []
    named = "feature" in silver.columns
    for i, (dev, sid, feat, width) in enumerate(features):
        hit = (F.col("device_id") == dev) & (F.col("stream_id") == sid)
        if named:
            hit = hit & (F.col("feature") == feat)
        aggs.append(F.max(F.when(hit, F.lit(1))).alias(f"_h{i}"))
        for j in range(width):
            aggs.append(F.first(F.when(hit, F.col("value")[j]), True).alias(f"_v{i}_{j}"))
        aggs.append(F.first(F.when(hit, F.col("confidence")), True).cast("float").alias(f"_c{i}"))
        arr = F.array(*[F.col(f"_v{i}_{j}") for j in range(width)])
        post.append(F.when(F.col(f"_h{i}").isNotNull(), arr).alias(f"observation.{feat}"))
        post.append(F.col(f"_c{i}").alias(f"observation.{feat}.confidence"))
    g = silver.groupBy("session_id", "frame_index", "t_ref_us").agg(*aggs)
    return g.select("session_id", "frame_index", "t_ref_us", *post)


@register_export("parquet")
def parquet_rows(silver: DataFrame, streams: DataFrame, meta=None, **_) -> DataFrame:
    """K2: the wide Silver projection as-is."""
    return silver_wide(with_feature(silver, streams), feature_list(streams))


@register_export("lerobot")
def lerobot_frames(silver: DataFrame, streams: DataFrame, meta=None, *,
                   dataset_per_session: bool = False, **_) -> DataFrame:
    """K3: LeRobot frame rows; one session = one episode, task = its session. With
    ``dataset_per_session`` episodes and rows are numbered within each session's own dataset."""
    ep = episodes(silver)
    if dataset_per_session:
        zero = F.lit(0).cast("long")
        ep = ep.withColumn("episode_index", zero).withColumn("index_offset", zero)
    p = _array_pivot(with_feature(silver, streams), feature_list(streams)).join(ep, "session_id")
    obs = [c for c in p.columns if c.startswith("observation.")]
    return p.select("session_id", *[F.col(f"`{c}`") for c in obs],
                    seconds("t_ref_us").alias("timestamp"), "frame_index", "episode_index",
                    (F.col("index_offset") + F.col("frame_index")).alias("index"),
                    F.col("episode_index").alias("task_index"))


def lerobot_features(streams: DataFrame) -> DataFrame:
    """K4: feature descriptors (feature, dtype, shape, units); ``[]`` → ``[1]``."""
    fn = feature_names(streams).select("feature", "shape", "units").distinct()
    one = F.array(F.lit(1))
    obs = fn.select(F.concat(F.lit("observation."), "feature").alias("feature"),
                    F.lit("float32").alias("dtype"),
                    F.when(F.size("shape") > 0, F.col("shape")).otherwise(one).alias("shape"),
                    F.col("units"))
    conf = fn.select(F.concat(F.lit("observation."), "feature", F.lit(".confidence")).alias("feature"),
                     F.lit("float32").alias("dtype"), one.alias("shape"), F.lit("none").alias("units"))
    fixed = streams.sparkSession.createDataFrame([(f, t, [1], u) for f, t, u in LEROBOT_INDEX_FEATURES],
                                                 "feature string, dtype string, shape array<int>, units string")
    return obs.unionByName(conf).unionByName(fixed)


def lerobot_info(silver: DataFrame, meta: DataFrame, layout: str = "v3") -> DataFrame:
    """K4 info record: totals, fps, data path template for the layout."""
    if layout not in LEROBOT_DATA_PATH:
        raise ValueError(f"lerobot layout must be 'v2' or 'v3' (got {layout!r})")
    ep = episodes(silver).join(meta.select("session_id", "grid_rate_hz"), "session_id", "left")
    return (ep.agg(F.count(F.lit(1)).alias("total_episodes"), F.sum("length").alias("total_frames"),
                   F.max("grid_rate_hz").alias("fps"))
            .select(F.lit(f"{layout}.0-chronoweave").alias("codebase_version"),
                    F.lit(ROBOT_TYPE).alias("robot_type"), "total_episodes", "total_frames",
                    F.lit(1).alias("total_chunks"), F.lit(1).alias("chunks_size"), "fps",
                    F.lit(LEROBOT_DATA_PATH[layout]).alias("data_path"), F.lit(layout).alias("layout")))


def lerobot_episodes(silver: DataFrame) -> DataFrame:
    """K5: {episode_index, tasks: [session], length} per session."""
    return episodes(silver).select("session_id", "episode_index",
                                   F.array("session_id").alias("tasks"), "length")


@register_export("rlds")
def rlds_steps(silver: DataFrame, streams: DataFrame, meta=None, **_) -> DataFrame:
    """K6: RLDS steps with neutral reward/discount and boundary flags.

    First/last come from the per-session frame bounds (a small aggregate
    joined back), not from a window over the whole episode (W3)."""
    p = _array_pivot(with_feature(silver, streams), feature_list(streams))
    b = p.groupBy("session_id").agg(F.min("frame_index").alias("_f0"), F.max("frame_index").alias("_f1"))
    obs = [c for c in p.columns if c.startswith("observation.")]
    j = p.join(b, "session_id")
    last = F.col("frame_index") == F.col("_f1")
    return j.select("session_id", *[F.col(f"`{c}`") for c in obs],
                    F.lit(0.0).cast("float").alias("reward"), F.lit(1.0).cast("float").alias("discount"),
                    (F.col("frame_index") == F.col("_f0")).alias("is_first"),
                    last.alias("is_last"), last.alias("is_terminal"), "frame_index")


def rlds_episodes(silver: DataFrame, dataset_ids: DataFrame | None = None,
                  version: str = "0.1.0") -> DataFrame:
    """K6 episode metadata: episode_id, outcome unknown, num_steps."""
    n = silver.groupBy("session_id").agg(F.countDistinct("frame_index").alias("num_steps"))
    out = n.select(F.col("session_id").alias("episode_id"), F.lit("unknown").alias("outcome"),
                   F.col("num_steps").cast("long").alias("num_steps"), F.lit(version).alias("version"),
                   "session_id")
    if dataset_ids is not None:
        out = out.join(dataset_ids.select("session_id", "dataset_id"), "session_id", "left")
    return out


@register_export("messages")
def message_log(silver: DataFrame, streams: DataFrame, meta=None, **_) -> DataFrame:
    """One topic per feature, valid frames only, ``log_time`` ns
    relative to the session's first grid time (true time kept in the
    message), JSON data ``{t_ref_us, value, confidence}``."""
    fn = feature_names(streams).select(*KEYS, "feature")
    t0 = silver.groupBy("session_id").agg(F.min("t_ref_us").alias("_t0"))
    v = silver.where("valid").join(fn, KEYS).join(t0, "session_id")
    log_ns = (F.col("t_ref_us") - F.col("_t0")) * F.lit(1000)
    msg = F.struct("t_ref_us", F.col("value").cast("array<double>").alias("value"), "confidence")
    return v.select("session_id", F.col("feature").alias("topic"), log_ns.alias("log_time_ns"),
                    log_ns.alias("publish_time_ns"), "t_ref_us", "value", "confidence",
                    F.to_json(msg).alias("data"))


@register_export("trainer_batches")
def trainer_batches(silver: DataFrame, streams: DataFrame, meta=None, *,
                    batch_frames: int = TRAINER_BATCH_FRAMES, **_) -> DataFrame:
    """K8 (HDF5 re-aimed): per stream, appended chunks of ``batch_frames``
    frames: flat values, confidence, valid as uint8 and timestamps, in frame
    order. A group never exceeds ``batch_frames`` rows."""
    fn = feature_names(streams).select(*KEYS, "feature")
    s = silver.join(fn, KEYS).withColumn("batch_id", F.floor(F.col("frame_index") / batch_frames))
    g = s.groupBy("session_id", "feature", "batch_id").agg(
        F.array_sort(F.collect_list(F.struct(
            "frame_index", "value", F.col("confidence").cast("float").alias("c"),
            F.col("valid").cast("tinyint").alias("v"), seconds("t_ref_us").alias("ts")))).alias("_r"))
    # the HDF5 layout's num_samples / total attributes: frames of the session
    n = silver.groupBy("session_id").agg(F.countDistinct("frame_index").alias("num_samples"))
    return g.join(n, "session_id").select(
                    "session_id", "feature", "batch_id", "num_samples",
                    F.col("_r")[0]["frame_index"].alias("frame_start"),
                    F.size("_r").alias("n_frames"),
                    F.transform("_r", lambda x: x["value"]).alias("values"),
                    F.transform("_r", lambda x: x["c"]).alias("confidence"),
                    F.transform("_r", lambda x: x["v"]).alias("valid"),
                    F.transform("_r", lambda x: x["ts"]).alias("timestamp"))


# ---- what a format has besides its rows ----------------------------------------------------

def _lerobot_metadata(silver: DataFrame, streams: DataFrame, meta: DataFrame, *, layout: str = "v3", **_) -> dict[str, DataFrame]:
    """Episodes, feature descriptors and info record of each session's own dataset."""
    zero = F.lit(0).cast("long")
    eps = silver.groupBy("session_id").agg(F.countDistinct("frame_index").alias("length")).select(
        "session_id", zero.alias("episode_index"), F.array("session_id").alias("tasks"), "length")
    names = feature_names(streams).select("session_id", "feature", "shape", "units")
    one = F.array(F.lit(1))
    obs = names.select("session_id", F.concat(F.lit("observation."), "feature").alias("feature"), F.lit("float32").alias("dtype"),
                       F.when(F.size("shape") > 0, F.col("shape")).otherwise(one).alias("shape"), "units")
    conf = names.select("session_id", F.concat(F.lit("observation."), "feature", F.lit(".confidence")).alias("feature"),
                        F.lit("float32").alias("dtype"), one.alias("shape"), F.lit("none").alias("units"))
    fixed = eps.select("session_id", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(t).alias("dtype"), one.alias("shape"),
                       F.lit(u).cast("string").alias("units")) for f, t, u in LEROBOT_INDEX_FEATURES])).alias("x")).select("session_id", "x.*")
    info = eps.join(meta.select("session_id", "grid_rate_hz"), "session_id", "left").select(
        "session_id", F.lit(f"{layout}.0-chronoweave").alias("codebase_version"), F.lit(ROBOT_TYPE).alias("robot_type"),
        F.lit(1).cast("long").alias("total_episodes"), F.col("length").alias("total_frames"), F.col("grid_rate_hz").alias("fps"),
        F.lit(LEROBOT_DATA_PATH[layout]).alias("data_path"), F.lit(layout).alias("layout"))
    return {"episodes": eps, "features": obs.unionByName(conf).unionByName(fixed), "info": info}


def _rlds_metadata(silver: DataFrame, streams: DataFrame, meta: DataFrame, *, version: str = "0.1.0", **_) -> dict[str, DataFrame]:
    # the layout has the version already
    return {"episodes": rlds_episodes(silver, version=version).drop("version")}


_METADATA: dict[str, Callable[..., dict[str, DataFrame]]] = {"lerobot": _lerobot_metadata, "rlds": _rlds_metadata}


def export_metadata(fmt: str, silver: DataFrame, streams: DataFrame, meta: DataFrame, **opts) -> dict[str, DataFrame]:
    """Metadata tables of a format by name, keyed by session; none for most formats."""
    return _METADATA[fmt](silver, streams, meta, **opts) if fmt in _METADATA else {}
