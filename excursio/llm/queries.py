"""Queries opN_<name> that apply each operator to its whole table, and the oracle SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.llm import (
    alignment, bpe, decontamination, lm_scoring, mixing, oracles, pii, prefix_trie, quality_classifier, quality_rules, simhash, substring_dedup, token_counts,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_rules", oracles.QUALITY_RULES)
def op1(spark, sf_dir):
    q = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), keep_text=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return q.select("doc_id", *[F.col(f"quality.{c}") for c in names])


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = quality_classifier.fitted(docs, table(spark, sf_dir, "labels"), may_learn=~quality_classifier.held_out(F.col("doc_id")))
    df = quality_classifier.scored(docs, learnt)
    return df.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
                     F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op3_lm_scoring")
def op3(spark, sf_dir):
    """Target: documents that labels call good and not toxic; background: all documents."""
    good = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(
        F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).where("good")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    models = lm_scoring.fitted(lm_scoring.marked(docs, good), F.col("target"))
    return lm_scoring.scored(docs, models).select("doc_id", "lm.*")


@query("op4_token_counts")
def op4(spark, sf_dir):
    df = token_counts.counted(table(spark, sf_dir, "documents").select("doc_id", "text"), path=public_tokenizers.path("piece_bpe_32k.model"))
    return df.select("doc_id", "tokens.*")


@query("op5_bootstrapped_pii")
def op5(spark, sf_dir):
    df = pii.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*map(F.lit, pii.KINDS))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["begin"], x["end"])), ",")

    counts = [F.expr(f"CAST(size(filter(pii.base, x -> x.kind = {k})) AS BIGINT)").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return df.select("doc_id", *counts, F.sha2(joined("pii.base"), 256).alias("base_sha256"), joined("pii.spans").alias("spans"))


@query("op6_benchmark_decontamination", oracles.DECONTAMINATION)
def op6(spark, sf_dir):
    df = decontamination.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return df.select(
        "doc_id", "hits.n_words", F.size("hits.words").cast("long").alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"), decontamination.is_contaminated().alias("contaminated"))


#: Host, path and verdict of the rules of op7.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


@query("op7_url_filters", oracles.URL_FILTERS)
def op7(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    df = url_filters.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return df.select("page_id", "filter.*")


@query("op8_substring_dedup")
def op8(spark, sf_dir):
    return substring_dedup.passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_simhash_near_duplicates")
def op9(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_bpe_encoding")
def op10(spark, sf_dir):
    df = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path=public_tokenizers.path("word_bpe_49k.json"))
    return df.select("doc_id", *bpe_digests("encoding"))


@query("op11_source_mixing")
def op11(spark, sf_dir):
    df = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep=["doc_id"])
    return df.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


@query("op12_conversation_trie", oracles.CONVERSATION_TRIE)
def op12(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


@query("op13_token_alignment")
def op13(spark, sf_dir):
    df = alignment.aligned(table(spark, sf_dir, "documents").select("doc_id", "text"), path_a=public_tokenizers.path("byte_bpe_50k.json"),
                           path_b=public_tokenizers.path("piece_bpe_32k.model"))
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    digest = F.when(F.col("alignment.n_a") > 0, F.sha2("alignment.groups", 256)).otherwise("")
    return df.select("doc_id", *[F.col(f"alignment.{n}") for n in names], digest.alias("groups_sha256"))


def bpe_digests(encoding: str) -> list:
    """Number of tokens and digests of the ids and of the decoded text."""
    return [F.size(f"{encoding}.ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(f"{encoding}.ids", " "), 256).alias("ids_sha256"),
            F.sha2(f"{encoding}.decoded", 256).alias("decoded_sha256")]
