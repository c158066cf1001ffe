"""From raw documents to token ids: quality rules, near-duplicates, decontamination, personal data, BPE.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before kept and returns
a DataFrame; all but the last return the columns of documents. No SQL expresses the stages
from the second on, so ORACLE_SQL is None and tests hold them against plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.llm import bpe, decontamination, pii, quality_rules, simhash
from excursio.llm.queries import bpe_digests
from excursio.llm.shared import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least doc_id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.masked(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and digests of the ids and of the text decoded from them."""
    new = ("n_tokens", "ids_sha256", "decoded_sha256", "token_ids")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    df = bpe.encoded(docs, path=public_tokenizers.path("word_bpe_49k.json"), out="token_ids")
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], *bpe_digests("token_ids"), F.col("token_ids.ids").alias("token_ids"))


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("bpe_encoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
