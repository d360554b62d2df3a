"""Session defaults and the shared folder used for checkpoints and staged files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"


def build_session(app: str = "sightlog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE, dynamic overwrite."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are UTC dates everywhere; make a session built elsewhere agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one in the warehouse, which
    the session's executors share as well."""
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def scratch_dir(spark: SparkSession, prefix: str = "run") -> str:
    """A new folder under the shared one, removed when the session's JVM ends."""
    folder = f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder
