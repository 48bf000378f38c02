"""URI expressions for payload references (scheme split, fragment strip,
normalisation of bare ``.parquet`` paths)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def strip_fragment(uri) -> Column:
    """Drop a trailing ``#stream=..&row=..`` fragment → stream base URI."""
    return F.substring_index(_c(uri), "#", 1)


def uri_scheme(uri) -> Column:
    """Scheme before ``://``; NULL when the value is not a URI."""
    u = _c(uri)
    return F.when(F.instr(u, "://") > 0, F.substring_index(u, "://", 1))


def uri_rest(uri) -> Column:
    """Everything after the first ``://`` (keeps any fragment)."""
    u = _c(uri)
    return F.when(F.instr(u, "://") > 0, F.substr(u, F.instr(u, "://") + 3))


def split_scheme(uri) -> Column:
    """struct(scheme, rest); rows that are not URIs yield NULL (see
    :func:`chronoweave.sources.payload.assert_uris` for the raising form)."""
    return F.struct(uri_scheme(uri).alias("scheme"), uri_rest(uri).alias("rest"))


def normalize_uri(ref, base_dir: str | None = None) -> Column:
    """``x.parquet`` → ``parquet://<abs path>``; values with a scheme untouched.

    ``base_dir`` resolves relative paths (the working directory of the job).
    """
    import os
    base = (base_dir or os.getcwd()).rstrip("/")
    r = F.regexp_replace(_c(ref), r"\\", "/")
    absolute = F.when(r.startswith("/"), r).otherwise(F.concat(F.lit(base + "/"), r))
    return (F.when(F.instr(_c(ref), "://") > 0, _c(ref))
             .when(F.lower(_c(ref)).endswith(".parquet"), F.concat(F.lit("parquet://"), absolute))
             .otherwise(_c(ref)))
