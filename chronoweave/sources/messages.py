"""Message-log source (S6), re-aimed from a container file at a message
table ``(session_id, topic, log_time, seq, data JSON)``."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MESSAGE_KIND_MAP
from ..operators.depth import CELL_US, TARGET_ROWS
from .payload import SourceError

# JSON number literal (the oracle's reading of plain numeric fields)
JSON_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"


_JSON = {"allowNonNumericNumbers": "true"}


def flatten_numbers(data: str, field: str, depth: int = 3) -> F.Column:
    """Field of a JSON text, a number or lists of numbers nested up to ``depth`` deep → flat
    array<float> in document order. A JSON null keeps its position as NaN; any other value that
    is no number raises; a missing field is NULL."""
    top = F.from_json(F.col(data), f"`{field}` string", _JSON)[field]
    leaves = F.when(top.isNotNull(), F.array(top))
    for _ in range(depth):
        leaves = F.flatten(F.transform(leaves, lambda x: F.when(
            x.startswith("["), F.from_json(x, "array<string>", _JSON)).otherwise(F.array(x))))
    return F.transform(leaves, lambda x: F.when(x.isNull(), F.lit(float("nan")).cast("float")).otherwise(
        F.coalesce(x.try_cast("float"), F.raise_error(F.concat(F.lit("not a number in a message: "), x)).cast("float"))))


def scan_messages(messages: DataFrame, payload_kind: str, kind_map: dict | None = None,
                  target_rows: int = TARGET_ROWS) -> DataFrame:
    """One topic's messages in log order → payload rows
    ``(session_id, topic, row, log_time, value array<float>)``; no message → no
    rows. Unknown kinds raise before planning."""
    km = kind_map or MESSAGE_KIND_MAP
    if payload_kind not in km:
        raise SourceError(f"message reader does not know payload_kind {payload_kind!r}")
    topic, field = km[payload_kind]
    return scan_topics(messages.where(F.col("topic") == topic), field, target_rows)


def scan_topics(messages: DataFrame, field: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """S6 for every topic of a message table in one scan: the topics that read ``field`` need not
    be known beforehand."""
    m = messages.select("session_id", "topic", "log_time", "seq",
                 flatten_numbers("data", field).alias("value"))
    from ..operators.asof import number_rows
    return number_rows(m, ["session_id", "topic"], ["log_time", "seq"], t="log_time", cell=CELL_US * 1000,
                       target_rows=target_rows) \
        .select("session_id", "topic", "row", "log_time", "value")


def events_as_messages(events: DataFrame, session_col: F.Column) -> DataFrame:
    """Events → message table (topic = event type, log_time in ns)."""
    return events.select(session_col.alias("session_id"), F.col("event_type").alias("topic"),
                         (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("log_time"),
                         F.col("event_id").alias("seq"), F.col("props").alias("data"))


__all__ = ["scan_messages", "scan_topics", "events_as_messages", "flatten_numbers"]
