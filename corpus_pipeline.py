"""A corpus from raw documents to a training mix, in stages that each write a table.

A stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a frame; all but
the last return the columns of ``docs``, extra ones included.  Columns the stages add for their
own use start with ``__``; documents must not have such columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sightlog.llm import decontaminate, langid, mixing, secrets, simhash
from sightlog.llm.common import read, scratch_folder, stored, text_or_empty, word_count


def _changed(docs: DataFrame, text: Column, when: Column) -> DataFrame:
    """``docs`` with another text, and n_chars in step where there is one."""
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias(name))
        elif name == "n_chars":
            columns.append(F.when(when, F.length(text)).otherwise(F.col(name)).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return docs.select(columns)


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without any letter go, whether or not a language could be learned."""
    labelled = docs.where(langid.learned(F.col("doc_id"))).select("doc_id", "text", "lang")
    named = langid.identify(docs, labelled, language="__lang", score="__score")
    return named.where(F.col("__lang") != langid.UNKNOWN).select(_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document that names it, once."""
    folder = scratch_folder(spark)
    key = F.struct("doc_id", "__fp").alias("__key")
    whole = stored(simhash.fingerprints(docs, "__fp"), folder, "whole")
    own = whole.select("doc_id", F.col("__fp").alias("fp"))
    found = own.join(simhash.groups(own, folder), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keepers = found.groupBy("root").agg(F.min(F.struct("doc_id", F.col("fp").alias("__fp"))).alias("__key"))
    kept = whole.select(*_columns(docs), key).join(keepers.select("__key"), "__key", "left_semi")
    once = kept.groupBy("__key").agg(F.min_by(F.struct(_columns(docs)), F.xxhash64("text")).alias("__row"))
    return once.select("__row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark passages; those that are nothing else go."""
    found = decontaminate.hits(docs, read(spark, sf_dir, "benchmark", "item_id", "text"), "__hits")
    n_hit = decontaminate.hit_words(F.col("__hits.spans"))
    left = found.where((n_hit == 0) | (n_hit < F.col("__hits.n_words")))
    cut = decontaminate.removed(left, "__hits")
    return _changed(cut, F.col("text"), n_hit > 0).select(_columns(docs))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    keyed = docs.select(*_columns(docs), F.struct("doc_id", F.xxhash64("text").alias("h")).alias("__key"))
    found = secrets.secrets(keyed.select("__key", "doc_id", "text", "source"), keep="__key")
    spans = (
        found.select("__key", F.array_sort(F.concat("base", "extra")).alias("__spans"))
        .where(F.size("__spans") > 0).dropDuplicates(["__key"])
    )
    joined = keyed.join(spans, "__key", "left").withColumn("__spans", F.coalesce("__spans", F.array().cast(secrets.SPANS)))
    text = secrets.redacted(F.col("text"), F.col("__spans"))
    return _changed(joined, text, F.size("__spans") > 0).select(_columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies and the words they add to it."""
    size = word_count(text_or_empty())
    mixed = mixing.mix(docs.select("doc_id", "text", "source")).where("taken > 0").select(
        F.struct("doc_id", "source", "size").alias("__key"), F.expr("taken div size").alias("__copies"), "taken"
    ).dropDuplicates(["__key"])
    keyed = docs.select(*_columns(docs), F.struct("doc_id", "source", size.alias("size")).alias("__key"))
    taken = mixed.select("__key", "__copies", F.col("taken").alias("__taken"))
    joined = keyed.join(taken, "__key")
    named = {"__copies": "mix_copies", "__taken": "mix_words"}
    return joined.select(*_columns(docs), *[F.col(k).alias(v) for k, v in named.items()])


STAGES = [
    ("language ID", language),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secret_redaction),
    ("mixing", mixture),
]

#: The stages compute fingerprints, automata and random draws that SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage-{i}")
    return docs
