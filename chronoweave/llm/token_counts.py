"""Token counts of sections: encode whole documents once, attribute tokens by their offsets."""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

RULES = ("most", "first", "last", "share")


def line_sections(text: str) -> np.ndarray:
    """Start of each line (a line feed belongs to the line that it ends); always a first one."""
    starts = [0]
    at = text.find("\n")
    while at >= 0:
        if at + 1 < len(text):
            starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(starts, np.int64)


def attribute(start: np.ndarray, end: np.ndarray, sections: np.ndarray, length: int, rule: str) -> np.ndarray:
    """Tokens of each section, for token spans ``[start, end)`` and sections that begin at
    ``sections`` (ascending, the first at 0) and end where the next begins.

    ``first`` / ``last``: a token counts where its first / last character is. ``most``: where
    most of its characters are, the earlier of equals. ``share``: each section gets the part
    of its characters that it holds. Every token counts once in all.
    """
    edges = np.append(sections, max(length, 1))
    n = len(sections)
    a = np.searchsorted(sections, start, "right") - 1
    z = np.searchsorted(sections, np.maximum(end - 1, start), "right") - 1
    if rule == "first":
        return np.bincount(a, minlength=n).astype(float)
    if rule == "last":
        return np.bincount(z, minlength=n).astype(float)
    out = np.bincount(a[a == z], minlength=n).astype(float)
    for i in np.flatnonzero(a != z).tolist():  # the few that cross a boundary
        s = np.arange(a[i], z[i] + 1)
        held = np.minimum(edges[s + 1], end[i]) - np.maximum(edges[s], start[i])
        if rule == "most":
            out[s[np.argmax(held)]] += 1
        else:
            out[s] += held / held.sum()
    return out


def token_counts(docs: DataFrame, *, sections: Callable[[str], np.ndarray] = line_sections, rule: str = "most",
                 tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every section of every text: key, section (from 0), start, end (characters),
    n_tokens (double for ``share``, else long).

    A document is encoded once, whole; ``sections`` gives the starts of its sections. The join
    of token spans and sections is a sorted search inside the document's row: no shuffle, and
    what a task holds is one batch. Null and empty texts: one section without tokens. Null keys
    and repeated rows: counted like others. Empty table: no rows. Other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    kind = (pa.float64(), "double") if rule == "share" else (pa.int64(), "long")

    def count(batches):
        enc = encoder(tokenizer)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo in range(0, len(texts), 512):
                part = texts[lo:lo + 512]
                ks, no, at, to, n = [], [], [], [], []
                for k, t, raw in zip(keys[lo:lo + 512], part, enc.encode_many(part)):
                    ids = np.frombuffer(raw, "<u4")
                    s = sections(t)
                    if len(s) == 1:
                        c = np.array([len(ids)], float)
                    else:
                        c = attribute(*enc.spans(t, ids), s, len(t), rule)
                    ks += [k] * len(s)
                    no.append(np.arange(len(s), dtype=np.int32))
                    at.append(s)
                    to.append(np.append(s[1:], len(t)))
                    n.append(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ks, pa.int64()), *(pa.array(np.concatenate(x)) for x in (no, at, to)),
                     pa.array(np.concatenate(n)).cast(kind[0])], names=["k", "section", "start", "end", "n_tokens"])
        enc.forget()

    return (docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
            .mapInArrow(count, f"k long, section int, start long, end long, n_tokens {kind[1]}")
            .withColumnRenamed("k", key))
