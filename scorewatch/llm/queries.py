"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_round_trip
from .common import table
from .exact import ORACLE as EXACT_SQL, exact_groups
from .html_text import extract_pages
from .mixing import ORACLE as MIX_SQL, mix
from .pii import pseudonymise
from .quality import ORACLE as QUALITY_SQL, quality_rules
from .ranked import ORACLE as SEARCH_SQL, ranked_search
from .resampling import ORACLE as RESAMPLE_SQL, resample
from .simhash import simhash_components
from .substrings import repeated_passages
from .token_counts import token_counts
from .token_files import token_files
from .vectors import near_vectors

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: For these queries over made-up data; real runs pass a key of their own.
PII_KEY = "scorewatch-example-key"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), WORD_BPE, digests=True)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("row")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_quality_rules, op3_embedding_near_dedup, op4_bpe_round_trip, op5_substring_dedup, op6_pii,
    op7_simhash, op8_mixing, op9_token_counts, op10_token_files,
    op11_ranked_search, op12_exact_dedup, op13_importance_resampling,
)}
ORACLES = {
    "op2_quality_rules": QUALITY_SQL.strip(), "op8_mixing": MIX_SQL.strip(), "op11_ranked_search": SEARCH_SQL.strip(),
    "op12_exact_dedup": EXACT_SQL.strip(), "op13_importance_resampling": RESAMPLE_SQL.strip(),
}
