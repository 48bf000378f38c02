"""Tables for the tests of this folder."""
import pytest

SF_SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text[, source]) as a table of documents with clashing extra columns."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(partitions)
        for c in ("n", "k", "h", "start", "label", "size", "part", "shard", "item_id"):
            df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return make
