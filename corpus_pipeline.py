"""Training data from raw documents: quality, near-duplicates, personal data, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewatch.llm.bpe import bpe_round_trip
from scorewatch.llm.common import table
from scorewatch.llm.mixing import mixed_documents
from scorewatch.llm.pii import with_pseudonyms
from scorewatch.llm.quality import keep_good
from scorewatch.llm.queries import PII_KEY, WORD_BPE
from scorewatch.llm.simhash import simhash_components
from scorewatch.session import fresh_path, materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null or empty text has no words and goes. Repeated rows are judged alike."""
    return keep_good(docs, COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest doc_id, null last; of several such rows one.

    Rows are told apart by a number of their own, so rows of equal or null
    doc_id with different texts are groups of their own.
    """
    rows = materialise(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = simhash_components(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row").alias("order")
    first = groups.join(rows.select("row", "doc_id"), "row").select("component_id", order).groupBy("component_id").agg(F.min("order").alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in the place of personal data."""
    return with_pseudonyms(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them; a text without words is taken not at all or once."""
    return mixed_documents(docs, COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of each document of the mix."""
    return bpe_round_trip(docs, WORD_BPE)


STAGES = [
    ("quality rules", quality), ("SimHash near-dedup", near_duplicates), ("PII", personal_data), ("mixing sources", mixture),
    ("BPE encoding", tokens),
]
#: SQL has neither the fingerprints nor the tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written to the shared folder and read again.

    Columns beyond those of documents are ignored; an empty table gives an empty one.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
