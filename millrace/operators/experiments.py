"""An experiment log that appends, reads back and merges."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.setops import keep_one

COLUMNS = [
    "experiment_id", "timestamp", "worker_id", "task", "model", "parameters", "features", "train_rows", "val_rows", "metric", "train_score", "val_score", "runtime_seconds", "seed", "git_hash", "notes",
]
SCHEMA = ", ".join(f"{c} " + {"train_rows": "long", "val_rows": "long", "train_score": "double", "val_score": "double", "runtime_seconds": "double", "seed": "long"}.get(c, "string") for c in COLUMNS)


def log(spark: SparkSession, path: str, **values) -> None:
    """Appends one row; unknown names raise ValueError, `parameters` may be a dict."""
    if unknown := set(values) - set(COLUMNS):
        raise ValueError(f"unknown columns {sorted(unknown)}")
    row = dict.fromkeys(COLUMNS) | {"timestamp": datetime.datetime.now(datetime.UTC).isoformat()} | values
    if isinstance(row["parameters"], dict):
        row["parameters"] = json.dumps(row["parameters"], sort_keys=True)
    spark.createDataFrame([tuple(row[c] for c in COLUMNS)], SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("header", True).csv(path)


def merge(logs: list[DataFrame]) -> DataFrame:
    """All rows, the earliest of each experiment_id, by timestamp."""
    out = logs[0]
    for x in logs[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return keep_one(out, ["experiment_id"], ["timestamp", "worker_id"]).orderBy(F.col("timestamp"), "experiment_id")
