"""Readers for landed JSON pages and for the Parquet files of an input folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LANDING_SCHEMA = "appid bigint, payload string, fetched_at timestamp"


def read_landing(spark: SparkSession, path: str, schema: str = LANDING_SCHEMA) -> DataFrame:
    """JSON-lines landing files: one response per line, the payload kept as text."""
    return spark.read.schema(schema).json(path)


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw response files, one JSON document per file: (payload, source_file)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file")
    )


def read_table_file(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One Parquet table of a folder.

    Files written without a time zone read as UTC timestamps, so a date never depends on the
    machine's zone.
    """
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
