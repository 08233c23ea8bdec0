"""Corpus pipeline: quality rules, near-duplicate removal, decontamination, personal data, tokenization.

Each stage works on all that its predecessor kept. Rows are told apart by id and text, so rows that share an id are
judged one by one; rows equal in both are copies, of which the near-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm import chunks, decontaminate, jaccard_join, pieces, pii, quality
from goldleaf.llm.text import table
from goldleaf.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _key() -> Column:
    """A row's id, ordered as numbers are, and the digest of its text."""
    return F.concat_ws(":", F.lpad(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 20, "0"), F.sha2(F.coalesce("text", F.lit("")), 256))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    NULL and empty texts have too few words and go. Repeated rows are judged alike. An empty table stays empty; columns other than
    those of documents are dropped. A long text is judged whole, in its own task.
    """
    return quality.kept_rows(docs, COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each component of documents alike in 0.8 of their five-word shingles.

    A NULL id comes before all others; rows of one id are ordered by the digest of their text, and of rows equal in both one stays.
    NULL, empty and blank texts link with nothing and all stay, but for equal rows. An empty table stays empty; columns other than
    those of documents are dropped. A long text is one set of shingles.
    """
    keyed = docs.select(_key().alias("key"), *COLUMNS)
    linked = jaccard_join.jaccard_components(keyed, k=5, percent=80, id_col="key")
    stays = linked.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(stays, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window alike to a benchmark item.

    NULL and empty texts hold no window and stay. Repeated rows go or stay together. Without documents there are no rows, without items
    all documents stay; columns other than those of documents are dropped. All windows of a long text count.
    """
    keyed = docs.select(_key().alias("key"), *COLUMNS)
    leaks = decontaminate.find_leaks(keyed, table(spark, sf_dir, "benchmark"), id_col="key").where("contaminated")
    return keyed.join(leaks.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced, with the new number of characters.

    NULL and empty texts, and texts without spans, are passed on with the ``n_chars`` they had. Repeated rows all stay and are changed
    alike. An empty table stays empty; columns other than those of documents are dropped. A long text is cut in blocks, never shortened.
    """
    keyed = docs.select(_key().alias("key"), *COLUMNS)
    found = pii.personal_data(keyed, id_col="key").where(F.size("spans") > 0).select(F.col("doc_id").alias("key"), "spans")
    joined = keyed.join(found, "key", "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(pii.redacted(F.col("text"), F.col("spans")))
    done = joined.select("doc_id", text.alias("text"), "lang", "source", F.col("n_chars").alias("n"), "spans")
    return done.select("doc_id", "text", "lang", "source", F.when(F.col("spans").isNull(), F.col("n")).otherwise(F.length("text")).cast("bigint").alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document.

    NULL ids and repeated rows stay, one row each; rows equal in id and text get the same ids. A NULL text is coded as ``pieces.encode``
    says. An empty table gives no rows; other columns are dropped. A long text is encoded whole.
    """
    coded = pieces.encode(docs.select("doc_id", "text"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [("quality rules", rules), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", clean_of_benchmarks),
          ("personal data", without_personal_data), ("piece encoding", tokens)]
#: SQL cannot express the sampled pieces; tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written as Parquet and reread as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with chunks.shuffles_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
