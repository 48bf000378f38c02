"""Removal of boilerplate lines that many sites share."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a HyperLogLog sketch; its relative standard error is about
#: 1.04 / sqrt(2**LG_K) = 1.6 %.
LG_K = 12


def line_key(line: Column) -> Column:
    """128 bits of the line without surrounding blanks (two hashes of different families);
    null for a blank line."""
    kept = F.trim(line)
    return F.when(kept != "", F.struct(F.xxhash64(kept).alias("a"), F.xxhash64(F.reverse(kept)).alias("b")))


def boilerplate_lines(lines: DataFrame, *, sites: int, band: float = 0.05) -> DataFrame:
    """Keys of the lines on at least ``sites`` distinct sites, and the place each stays at.

    ``lines``: ``line`` (:func:`line_key`), ``site``, ``at`` (struct of key and position). One
    HyperLogLog sketch of sites per line, built before the shuffle and merged by aggregation.
    An estimate at least ``band`` below or above the threshold decides by itself (three standard
    errors); lines between get an exact distinct count.
    """
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("est"),
        F.min("at").alias("stays"))
    maybe = sketched.where(F.col("est") >= sites * (1 - band))
    near = maybe.where(F.col("est") <= sites * (1 + band)).select("line")
    exact = (lines.join(near, "line", "left_semi").select("line", "site").distinct()
             .groupBy("line").agg(F.count(F.lit(1)).alias("exact")))
    return (maybe.join(exact, "line", "left")
            .where(F.coalesce(F.col("exact"), F.col("est")) >= sites).select("line", "stays"))


def line_dedup(docs: DataFrame, *, sites: int = 8, key: str = "doc_id", site: str = "source",
               text: str = "text") -> DataFrame:
    """Remove lines that stand on ``sites`` or more distinct sites, but for their first place
    (smallest key, then position), so that no content goes from the corpus altogether.

    Lines are compared without surrounding blanks; blank lines are no lines of this sense and
    stay. Returns key, text (remaining lines joined by line feeds; null stays null), n_lines,
    n_removed and all other columns of ``docs``. Null site: no site. Null key: its lines count,
    and may go, but none stays there if the line has a keyed place. Rows with an equal key are
    copies of one document: a line may stay in each. Empty texts: one blank line. Empty table:
    no rows.

    Only narrow rows are shuffled for the counts; texts move once, in the join with the
    positions to remove.
    """
    def lined(cols: list[Column]) -> DataFrame:
        return docs.where(F.col(text).isNotNull()).select(
            *cols, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "raw"))

    at = F.struct(F.col("id").isNull().alias("no"), F.col("id"), F.col("pos"))
    lines = (lined([F.col(key).alias("id"), F.col(site).cast("string").alias("site")])
             .select(line_key(F.col("raw")).alias("line"), "site", at.alias("at"))
             .where(F.col("line").isNotNull()))
    gone = (lines.join(boilerplate_lines(lines, sites=sites), "line")
            .where(~F.col("at").eqNullSafe(F.col("stays"))))
    # positions of one document, at most its number of lines
    # (with the line's hash: rows that share a key may differ in text)
    by_doc = (gone.groupBy(F.col("at.id").alias("__id"))
              .agg(F.collect_set(F.struct(F.col("at.pos").alias("i"), F.col("line.a").alias("a"))).alias("__gone")))
    parts = F.split(F.col(text), "\n")
    keep = F.filter(parts, lambda x, i: ~F.array_contains(
        F.col("__gone"), F.struct(i.alias("i"), F.xxhash64(F.trim(x)).alias("a"))))
    others = [c for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    joined = docs.join(by_doc, docs[key].eqNullSafe(by_doc["__id"]), "left")
    return joined.select(
        *[docs[c] for c in others],
        F.when(F.col("__gone").isNull(), docs[text]).otherwise(F.array_join(keep, "\n")).alias(text),
        F.coalesce(F.size(parts), F.lit(0)).alias("n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size(parts) - F.size(keep)).alias("n_removed"))


#: The same by exact distinct counts.
ORACLE = """
WITH l AS (
  SELECT doc_id, source, p.i - 1 AS pos, trim(p.x, ' ') AS line
  FROM (SELECT doc_id, source, unnest(list_transform(string_split(text, chr(10)),
               lambda x, i: {{'x': x, 'i': i}})) AS p FROM documents)
  WHERE trim(p.x, ' ') <> ''),
b AS (SELECT line, min((doc_id, pos)) AS stays FROM l GROUP BY line HAVING count(DISTINCT source) >= {sites}),
g AS (SELECT l.doc_id, list(l.pos) AS gone FROM l JOIN b USING (line) WHERE (l.doc_id, l.pos) <> b.stays GROUP BY l.doc_id)
SELECT d.doc_id,
       CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(list_filter(string_split(text, chr(10)),
            lambda x, i: NOT list_contains(gone, i - 1)), chr(10)), '') END AS text,
       coalesce(len(string_split(text, chr(10))), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed
FROM documents d LEFT JOIN g USING (doc_id)
"""
