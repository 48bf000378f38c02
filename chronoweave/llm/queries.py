"""The queries of this package: one per operator, with production parameters, over whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, line_dedup, near_dedup, negatives, packing, prefix_trie, sharding, substring_dedup,
               token_counts, token_files, topk, toxicity, warc)
from ._common import scratch, table

N_SHARDS = 40


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards, counts at most one apart, each with the mixture of sources."""
    return sharding.interleave_shards(table(spark, sf_dir, "documents"), N_SHARDS)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back through their perfect-hash index."""
    docs = table(spark, sf_dir, "documents")
    root = scratch(spark, "token-files")
    token_files.write_shards(docs, root)
    buckets = token_files.write_index(spark, root)
    return token_files.read_documents(spark, root, docs.select("doc_id").distinct(), buckets)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document when repeated 13-word windows go."""
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token that crosses lines counts where most of it is."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 8192 tokens."""
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items whose passages they hold, also re-parameterised."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best integer inner products of every 50th vector with all others."""
    return topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


LINE_SITES = 8


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that eight or more sources share."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"), sites=LINE_SITES)
    return out.select("doc_id", "text", "n_lines", "n_removed")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from the labels outside the held-out fold."""
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives that it was written to."""
    root = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), root)
    return warc.page_records(warc.read_archives(spark, root, payload=False))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five best positives of every 50th vector."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0,
                                    flip=F.col("vec_id") % 7 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt with shared beginnings."""
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(lists))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_token_files, op3_substring_dedup, op4_token_counts, op5_best_fit_packing,
    op6_decontamination, op7_exact_topk, op8_line_dedup, op9_near_dedup, op10_toxicity, op11_warc,
    op12_hard_negatives, op13_prefix_trie)}

ORACLE: dict[str, str] = {
    "op7_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_warc": warc.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op6_decontamination": decontamination.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE.format(sites=LINE_SITES),
}
