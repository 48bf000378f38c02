"""LeRobot dataset directory (K3–K5 on disk): frame files named by the
layout's path template plus ``meta/info.json`` and ``meta/episodes.jsonl``.

Spark writes the frame files; their final names are set afterwards with the
Hadoop FileSystem API (works on any cluster file system). ``v3`` packs
episodes into ``data/chunk-CCC/file-FFF.parquet``; ``v2`` writes one file per
episode, ``data/chunk-CCC/episode_EEEEEE.parquet``.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import exports as ex
from ..schemas import LEROBOT_DATA_PATH

CHUNKS_SIZE = 1000     # files (v3) or episodes (v2) per chunk directory


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _parts(fs, Path, d: str) -> list[str]:
    return sorted(s.getPath().toString() for s in fs.listStatus(Path(d))
                  if s.getPath().getName().startswith("part-"))


def _move(fs, Path, src: str, dst: str) -> None:
    """``src`` becomes ``dst``, in place of a file of an earlier run; raises where it can't."""
    fs.mkdirs(Path(dst).getParent())
    if fs.exists(Path(dst)):
        fs.delete(Path(dst), False)
    if not fs.rename(Path(src), Path(dst)):
        raise OSError(f"could not move {src} to {dst}")


def _write_text(fs, Path, p: str, text: str) -> None:
    out = fs.create(Path(p), True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def write_lerobot(spark: SparkSession, silver: DataFrame, streams: DataFrame, meta: DataFrame,
                  root: str, layout: str = "v3", files: int | None = None) -> dict:
    """Write a LeRobot dataset for every session of ``silver`` (one session =
    one episode). Returns the info record. v3 files hold consecutive frames by
    their global ``index``; ``files`` sets how many (by default Spark's
    shuffle partitions). v2 files hold one whole episode each and keep its
    ``episode_index``; an episode in several parts raises, nothing is dropped."""
    if layout not in LEROBOT_DATA_PATH:
        raise ValueError(f"lerobot layout must be 'v2' or 'v3' (got {layout!r})")
    fs, Path = _fs(spark, root)
    tmp = f"{root}/_staging"
    frames = ex.lerobot_frames(silver, streams).drop("session_id")
    template = LEROBOT_DATA_PATH[layout]
    if layout == "v3":
        df = frames.repartitionByRange(files, "index") if files else frames.repartitionByRange("index")
        df.sortWithinPartitions("index").write.mode("overwrite").option("compression", "zstd").parquet(tmp)
        for i, src in enumerate(_parts(fs, Path, tmp)):
            dst = f"{root}/" + template.format(chunk_index=i // CHUNKS_SIZE, file_index=i % CHUNKS_SIZE)
            _move(fs, Path, src, dst)
    else:
        # v2 is one file per episode by definition: one writer per episode, of unlimited length;
        # the partition column is a copy, so that the files keep theirs
        (frames.withColumn("_episode", F.col("episode_index"))
         .repartition("_episode").sortWithinPartitions("_episode", "frame_index")
         .write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", 0)
         .partitionBy("_episode").parquet(tmp))
        for st in fs.listStatus(Path(tmp)):
            name = st.getPath().getName()
            if not name.startswith("_episode="):
                continue
            e = int(name.split("=", 1)[1])
            parts = _parts(fs, Path, st.getPath().toString())
            if len(parts) != 1:
                raise ValueError(f"episode {e} was written in {len(parts)} parts; a v2 file holds a whole episode")
            dst = f"{root}/" + template.format(chunk_index=e // CHUNKS_SIZE, episode_index=e)
            _move(fs, Path, parts[0], dst)
    fs.delete(Path(tmp), True)

    # meta/episodes.jsonl and meta/tasks.jsonl: one small record per episode
    # (session), written by Spark — session ids never gather on the driver
    eps = ex.lerobot_episodes(silver)
    fs.mkdirs(Path(f"{root}/meta"))
    for name, df in (("episodes", eps.select("episode_index", "tasks", "length")),
                     ("tasks", eps.select(F.col("episode_index").alias("task_index"),
                                          F.col("session_id").alias("task")))):
        etmp = f"{root}/_staging_{name}"
        df.orderBy(df.columns[0]).coalesce(1).write.mode("overwrite").json(etmp)
        _move(fs, Path, _parts(fs, Path, etmp)[0], f"{root}/meta/{name}.jsonl")
        fs.delete(Path(etmp), True)

    info = ex.lerobot_info(silver, meta, layout).collect()[0].asDict()
    n_ep = info["total_episodes"]
    info["total_chunks"] = max(1, -(-n_ep // CHUNKS_SIZE)) if layout == "v2" else None
    info["chunks_size"] = CHUNKS_SIZE
    info["features"] = {r.feature: {"dtype": r.dtype, "shape": list(r.shape),
                                    **({"units": r.units} if r.units is not None else {})}
                        for r in ex.lerobot_features(streams).distinct().collect()}
    info["total_tasks"] = n_ep          # one task per episode, listed in meta/tasks.jsonl
    if info["total_chunks"] is None:
        data_dirs = [s.getPath().toString() for s in fs.listStatus(Path(f"{root}/data"))]
        n_files = sum(len(fs.listStatus(Path(d))) for d in data_dirs)
        info["total_chunks"] = len(data_dirs)
        info["total_files"] = n_files
    _write_text(fs, Path, f"{root}/meta/info.json", json.dumps(info, indent=2, default=str))
    return info
