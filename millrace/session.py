"""Session settings for large inputs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "millrace", **conf: str) -> SparkSession:
    """A session with adaptive execution; conf (dots as __) overrides. spark.checkpoint.dir should name a folder that all executors share."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all machines share. Where that is unset, a local session gets one for itself; a cluster's raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def written(df: DataFrame, where: str, name: str) -> DataFrame:
    """df, written to the folder `where` and read back: computed once for all who read it, and its plan ends there."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{where}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{where}/{name}")
