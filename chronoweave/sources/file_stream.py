"""Whole files as streams: listed by Spark, opened in the task that reads them.

A file is one unit of work and may have any size: it is read in chunks, so a task holds a buffer
and not the file. Stores that pyarrow can't open are read by Spark itself, as one value a file.
"""
from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

#: URI schemes that tasks open themselves.
STREAMED = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def list_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, length) of every file under ``paths`` that isn't empty; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
            .select("path", "length"))


def scheme(uri: str) -> str:
    head = uri.split(":", 1)[0]
    return head if ":" in uri and "/" not in head else "file"


def open_file(uri: str):
    """A seekable binary file object for a path as Spark lists it."""
    from pyarrow import fs
    kind = scheme(uri)
    if kind == "file":
        path = uri[len("file:"):] if uri.startswith("file:") else uri
        return fs.LocalFileSystem().open_input_file("/" + path.lstrip("/"))
    rest = uri.split(":", 1)[1]
    store, path = fs.FileSystem.from_uri(("s3" if kind == "s3a" else kind) + ":" + quote(rest, safe="/@:"))
    return store.open_input_file(path)
