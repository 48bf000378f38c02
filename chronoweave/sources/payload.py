"""Payload sources.

A payload is ``(session_id, device_id, stream_id, row, value array<float>)``
where ``row`` is the sample's position in its episode file. Producer files
are wide tables with one column per payload element. The columns follow from
the payload kind and a layout: ``canonical`` names the file's sensors (their
order is an input, ``sensor_ids``), ``legacy`` has fixed names.
"""
from __future__ import annotations

import json
import re
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.uri import normalize_uri, strip_fragment, uri_rest, uri_scheme
from ..schemas import (ACCEL_AXES, ACCEL_KIND, LEGACY_TACTILE_CLUSTERS, LEGACY_TRIPOD, MAG_KIND,
                       STREAM_KEYS, TACTILE_AXES, TEMP_KIND)

KEYS = STREAM_KEYS


class SourceError(ValueError):
    pass


# --------------------------------------------------------------------------- S3 / S4
class Family(NamedTuple):
    """Column names of a payload kind: a template per layout, filled for every sensor and axis."""
    canonical: str
    legacy: str
    axes: tuple[str, ...]
    legacy_ids: tuple[str, ...]


# The producers' column names.
FAMILIES = {
    MAG_KIND: Family("mag.{id}.{axis}_uT", "tactile.{id}.{axis}_uT", TACTILE_AXES,
                     tuple(f"b{i:02d}" for i in range(LEGACY_TACTILE_CLUSTERS))),
    ACCEL_KIND: Family("dyn.{id}.{axis}_g", "dyn.{id}.{axis}_g", ACCEL_AXES, LEGACY_TRIPOD),
    TEMP_KIND: Family("dyn.{id}.temp_c", "dyn.{id}.temp_degC", ("",), LEGACY_TRIPOD),
}


def element_columns(kind: str, layout: str, sensor_ids=None, n: int | None = None) -> list[str]:
    """The columns of one payload in element order. ``legacy`` takes its own sensor names
    (the first ``n`` of them, if given); unknown kinds raise."""
    if kind not in FAMILIES:
        raise SourceError(f"unknown payload kind {kind!r}")
    f = FAMILIES[kind]
    if layout == "legacy":
        known = f.legacy_ids
        if n is not None and kind == MAG_KIND:
            known = tuple(f"b{i:02d}" for i in range(n))
        sensor_ids = known
    template = getattr(f, layout)
    return [template.format(id=i, axis=a) for i in sensor_ids or () for a in f.axes]


def choose_layout(kind: str, names, sensor_ids=None, shape=None) -> tuple[str, list[str]]:
    """The first layout whose columns a table has in full, as (layout, columns); if neither
    is there, the one that the declared sensors point to (reading it then names what is missing)."""
    options = [("canonical", element_columns(kind, "canonical", sensor_ids)),
               ("legacy", element_columns(kind, "legacy", n=shape[0] if shape else None))]
    have = set(names)
    for layout, cols in options:
        if cols and have.issuperset(cols):
            return layout, cols
    return options[0] if options[0][1] else options[1]


def stack_columns(df: DataFrame, cols: list[str]) -> F.Column:
    """The columns (back-quoted; names contain dots) as array<float>."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise SourceError(f"payload columns missing: {missing[:5]}")
    return F.array(*[F.col(f"`{c}`").cast("float") for c in cols])


# --------------------------------------------------------------------------- S1 / S10
_SCHEME = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?")


def _path_key(c) -> F.Column:
    """A file's path without scheme and host, unescaped: the same for a reference and a scan."""
    plain = F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, _SCHEME.pattern, "")


def scan_parquet_payload(spark: SparkSession, refs: DataFrame, kind: str, shape=None) -> DataFrame:
    """Payload rows for ``refs(session_id, device_id, stream_id, uri[, sensor_ids])``
    (``parquet://`` or ``file://…parquet``), all of one payload kind.

    ``sensor_ids`` (S2) is the order of a file's sensors, from an input dimension table; files
    without it have the legacy layout. One scan per distinct sensor order reads only its columns,
    paths go through Spark's file systems, and the row position comes from
    ``_metadata.row_index`` (no sort). The driver gets one path per file, never data. A reference
    that matches no file raises."""
    r = refs if "sensor_ids" in refs.columns else refs.withColumn("sensor_ids", F.lit(None).cast("array<string>"))
    r = r.select(*KEYS, "sensor_ids", strip_fragment("uri").alias("base"))
    r = r.select(*KEYS, "sensor_ids", uri_scheme("base").alias("scheme"), uri_rest("base").alias("path"))
    bad = r.where(~F.col("scheme").isin("parquet", "file") | F.col("scheme").isNull()).limit(1).collect()
    if bad:
        raise SourceError(f"scheme {bad[0].scheme!r} is not read as Parquet")
    badf = r.where((F.col("scheme") == "file") & ~F.lower("path").endswith(".parquet")).limit(1).collect()
    if badf:
        raise SourceError(f"not a .parquet file: {badf[0].path!r}")
    by_order: dict[tuple, list[str]] = {}
    for row in r.select("path", "sensor_ids").distinct().collect():
        by_order.setdefault(tuple(row.sensor_ids or ()), []).append(row.path)
    out = None
    for ids, paths in by_order.items():
        df = spark.read.parquet(*paths)
        seen = {_SCHEME.sub("", unquote(f)) for f in df.inputFiles()}
        lost = [p for p in paths if _SCHEME.sub("", p) not in seen]
        if lost:
            raise SourceError(f"references that name no file: {lost[:5]}")
        _, cols = choose_layout(kind, df.columns, ids, shape)
        part = df.select(F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.row_index").alias("row"), stack_columns(df, cols).alias("value"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise SourceError("no payload files")
    keyed = r.select(*KEYS, F.regexp_replace("path", _SCHEME.pattern, "").alias("_key"))
    return out.withColumn("_key", _path_key("_file")).join(keyed, "_key").select(*KEYS, "row", "value")


# --------------------------------------------------------------------------- S7–S9, S11
def normalized_refs(refs: DataFrame, base_dir: str | None = None) -> DataFrame:
    """``stream_refs`` with normalised URIs."""
    return refs.withColumn("uri", normalize_uri("uri", base_dir))


def source_map(session_refs: DataFrame, overrides: DataFrame | None, aligned: DataFrame) -> DataFrame:
    """The payload source of every aligned stream.

    ``session_refs(session_id, device_id, stream_id, uri)``; ``overrides(session_id,
    key, uri)`` where key is ``device::stream`` or a bare stream id, and wins
    over the session's refs; lookup by qualified key, then by bare stream id.
    ``aligned(session_id, device_id, stream_id)``. ``uri`` is NULL where
    nothing matches (see :func:`missing_sources`)."""
    s = session_refs.select("session_id", F.concat_ws("::", "device_id", "stream_id").alias("key"), "uri")
    if overrides is not None:
        o = overrides.select("session_id", "key", "uri")
        s = s.join(o.select("session_id", "key"), ["session_id", "key"], "left_anti").unionByName(o)
    q = s.select("session_id", F.col("key").alias("_qk"), F.col("uri").alias("_qu"))
    b = s.select("session_id", F.col("key").alias("_bk"), F.col("uri").alias("_bu"))
    a = aligned.select(*KEYS).withColumn("_qk", F.concat_ws("::", "device_id", "stream_id")) \
                             .withColumn("_bk", F.col("stream_id"))
    return (a.join(q, ["session_id", "_qk"], "left").join(b, ["session_id", "_bk"], "left")
            .select(*KEYS, F.coalesce("_qu", "_bu").alias("uri")))


def missing_sources(resolved: DataFrame) -> DataFrame:
    return resolved.where("uri is null")


def assert_sources(resolved: DataFrame) -> DataFrame:
    """Raise ``KeyError`` naming a stream without a payload source."""
    row = missing_sources(resolved).limit(1).collect()
    if row:
        r = row[0]
        raise KeyError(f"no payload source for stream {r.device_id}::{r.stream_id} "
                       f"in session {r.session_id!r}")
    return resolved


def assert_uris(refs: DataFrame, col: str = "uri") -> DataFrame:
    """Raise for a reference that is not ``scheme://rest``."""
    row = refs.where(uri_scheme(col).isNull()).limit(1).collect()
    if row:
        raise SourceError(f"not a payload URI: {row[0][col]!r}")
    return refs


def missing_descriptors(aligned: DataFrame, streams: DataFrame) -> DataFrame:
    """Aligned streams without a descriptor row (must be empty)."""
    return aligned.select(*KEYS).distinct().join(streams.select(*KEYS), KEYS, "left_anti")


# --------------------------------------------------------------------------- S12 / S14
BUNDLE_TABLES = ("grid", "alignment", "streams", "session_meta")


def _existing(spark: SparkSession, path: str, **options) -> DataFrame:
    """A Parquet table on any of Spark's file systems; FileNotFoundError if it is not there."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def load_bundle(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Persisted sync bundle → the four input tables; every session of
    the alignment must have a ``session_meta`` row."""
    out = {t: _existing(spark, f"{root.rstrip('/')}/{t}") for t in BUNDLE_TABLES}
    orphan = (out["alignment"].select("session_id").distinct()
              .join(out["session_meta"].select("session_id"), "session_id", "left_anti").limit(1).collect())
    if orphan:
        raise SourceError(f"session {orphan[0].session_id!r} has no session_meta row")
    return out


def read_packaged_silver(spark: SparkSession, root: str, dataset_id: str | None = None,
                         version: str | None = None) -> DataFrame:
    """Silver of packaged datasets (hive layout ``dataset=/version=``), as last committed;
    filters on dataset/version prune partitions; absent ``valid`` /
    ``confidence`` columns default to true / 1.0."""
    from ..plans.versions import read_table
    df = read_table(spark, root, "silver")
    if dataset_id is not None:
        df = df.where(F.col("dataset") == dataset_id)
    if version is not None:
        df = df.where(F.col("version") == version)
    if "valid" not in df.columns:
        df = df.withColumn("valid", F.lit(True))
    if "confidence" not in df.columns:
        df = df.withColumn("confidence", F.lit(1.0))
    return df


# --------------------------------------------------------------------------- S10
def scan_message_payload(spark: SparkSession, refs: DataFrame, kind: str, shape=None) -> DataFrame:
    """``messages://<message table>`` references: the table
    ``(session_id, topic, log_time, seq, data)`` is read once per distinct
    path and scanned for the kind's topic (S6)."""
    from .messages import scan_messages
    r = refs.select(*KEYS, uri_rest(strip_fragment("uri")).alias("path"))
    out = None
    for row in r.select("path").distinct().collect():   # one row per table, not per sample
        m = spark.read.parquet(row.path)
        part = (scan_messages(m, kind).join(r.where(F.col("path") == row.path), "session_id")
                .select(*KEYS, "row", "value"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise SourceError("no message tables referenced")
    return out


_SOURCES = {"parquet": scan_parquet_payload, "file": scan_parquet_payload,
            "messages": scan_message_payload}


def register_source(scheme: str, reader) -> None:
    """Add a reader ``reader(spark, refs, kind, shape) -> payload DataFrame``."""
    if not scheme:
        raise SourceError("a source needs a non-empty scheme")
    _SOURCES[scheme] = reader


def registered_sources() -> list[str]:
    return sorted(_SOURCES)


def resolve_payload(spark: SparkSession, refs: DataFrame, kind: str, shape=None) -> DataFrame:
    """Dispatch every reference to the reader of its URI scheme (the
    distinct schemes are collected, never the references themselves) and
    union the payloads. Unknown schemes and non-URIs raise."""
    r = refs.withColumn("_scheme", uri_scheme(strip_fragment("uri")))
    schemes = [x._scheme for x in r.select("_scheme").distinct().collect()]
    bad = [s for s in schemes if s not in _SOURCES]
    if bad:
        raise SourceError(f"no reader registered for scheme(s) {bad}; known: {registered_sources()}")
    out = None
    for s in schemes:
        part = _SOURCES[s](spark, r.where(F.col("_scheme") == s).drop("_scheme"), kind, shape)
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------- S15
def load_thresholds(path: str | None = None) -> dict:
    """Gate threshold bands from a YAML (or JSON) file; the built-in bands
    when no path is given. Missing bands fall back to the built-in ones."""
    from ..schemas import THRESHOLDS
    if path is None:
        return {k: dict(v) for k, v in THRESHOLDS.items()}
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    try:
        import yaml
        doc = yaml.safe_load(text)
    except ImportError:  # pragma: no cover
        doc = json.loads(text)
    out = {k: dict(v) for k, v in THRESHOLDS.items()}
    for band in ("hard_fail", "release", "certified"):
        if band in (doc or {}):
            out[band].update(doc[band])
    return out
