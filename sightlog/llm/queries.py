"""One query per operator over the given tables, with the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sightlog.llm import (
    decontaminate, divergence, importance, kneser_ney, langid, lexical, licenses, mixing, quotes, recurrent,
    secrets as secret_scan, simhash, substring,
)
from sightlog.llm.common import read
from sightlog.llm.oracle import ORACLE  # noqa: F401


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return found.select(
        "doc_id",
        *[secret_scan.of_kind(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(secret_scan.KINDS[:3])],
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.array_sort(F.concat("base", "extra"))).alias("spans"),
        "n_live", "n_copied",
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence.judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance",
    )


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.removed_repeats(read(spark, sf_dir, "documents", "doc_id", "text"), digest=True)
    return kept.withColumnRenamed("kept", "kept_sha256")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learnable = langid.learned(F.col("doc_id"))
    named = langid.identify(docs.select("doc_id", "text"), docs.where(learnable))
    return named.select("doc_id", F.coalesce(~learnable, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op7_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(
        read(spark, sf_dir, "documents", "doc_id", "text", "lang"),
        read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.hits(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = decontaminate.hit_words(F.col("hits.spans"))
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licenses(read(spark, sf_dir, "documents", "doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["name"])))
    return found.select(
        "doc_id", F.size("findings").cast("bigint").alias("n_windows"), F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f["share"])), F.lit(0.0)).alias("share"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "text"))


def op12_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.score(read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_substring": op3_substring,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_quotes": op6_quotes,
    "op7_perplexity": op7_perplexity,
    "op8_decontamination": op8_decontamination,
    "op9_licenses": op9_licenses,
    "op10_simhash": op10_simhash,
    "op11_importance": op11_importance,
    "op12_recurrent_lm": op12_recurrent_lm,
    "op13_lexical_search": op13_lexical_search,
}
