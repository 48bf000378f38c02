"""A corpus pipeline over ``documents``: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``, whatever their names (``score`` or ``a.b``, too). Null keys: such rows belong to no group and no pair, and stay (but for toxicity,
which reads texts). Empty tables pass through.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import decontamination, line_dedup, near_dedup, packing
from chronoweave.llm import toxicity as toxic
from chronoweave.llm._common import stored, table
from chronoweave.llm.queries import LINE_SITES


#: Columns that the stages read; the others travel under names of their own, so that none clashes.
USED = ("doc_id", "text", "source", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[c if c in USED else f"__column_{i}" for i, c in enumerate(docs.columns)])


def _as(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in ``out``, made of :func:`_apart`."""
    return out.select(*_apart(docs).columns).toDF(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    out = toxic.toxicity(_apart(docs), table(spark, sf_dir, "labels"))
    return _as(out.where("predicted = 0"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; every document stays, n_chars follows."""
    out = line_dedup.line_dedup(_apart(docs), sites=LINE_SITES)
    cut = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return _as(cut, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that with the smallest doc_id. Documents
    without words are in no class and stay."""
    gone = near_dedup.near_classes(docs).where("doc_id <> class_id").select("doc_id").distinct()
    return _as(_apart(docs).join(gone, "doc_id", "left_anti"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item's passage."""
    gone = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _as(_apart(docs).join(gone, "doc_id", "left_anti"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's tokens in sequences of permitted lengths."""
    return packing.best_fit_packing(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontaminate), ("packing", pack)]

#: Learned scores and sketches can't be stated in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
