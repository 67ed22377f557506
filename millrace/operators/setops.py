"""Deduplication, unions with checks, cache upserts and resumption by anti-join."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame) -> DataFrame:
    """Distinct rows."""
    return df.dropDuplicates()


def keep_one(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in the given order."""
    by = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in order]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")


def union_checked(parts: list[DataFrame], id_column: str, key: bool = True) -> DataFrame:
    """Union of parts with equal column sets (any order); ValueError for other columns or, with key, repeated ids."""
    columns = set(parts[0].columns)
    for i, p in enumerate(parts):
        if set(p.columns) != columns:
            raise ValueError(f"part {i} has columns {sorted(p.columns)}, not {sorted(columns)}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if key and not out.groupBy(id_column).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated values of {id_column}")
    return out


def verify_merge(original: DataFrame, merged: DataFrame, id_column: str) -> DataFrame:
    """One row: original_rows, merged_rows, missing_ids, unexpected_ids."""
    a = original.groupBy(F.col(id_column).cast("string").alias("id")).agg(F.count(F.lit(1)).alias("a"))
    b = merged.groupBy(F.col(id_column).cast("string").alias("id")).agg(F.count(F.lit(1)).alias("b"))
    return a.join(b, "id", "full").agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("original_rows"), F.coalesce(F.sum("b"), F.lit(0)).alias("merged_rows"),
        F.coalesce(F.sum(F.col("b").isNull().cast("long")), F.lit(0)).alias("missing_ids"), F.coalesce(F.sum(F.col("a").isNull().cast("long")), F.lit(0)).alias("unexpected_ids"),
    )


def upsert(old: DataFrame, new: DataFrame, id_column: str) -> DataFrame:
    """new rows, and old rows whose id new lacks."""
    return new.unionByName(old.join(new.select(id_column).distinct(), id_column, "left_anti").select(*new.columns))


def uncached(df: DataFrame, cache: DataFrame, id_column: str) -> DataFrame:
    """Rows of df whose id, as text, the cache lacks."""
    seen = cache.select(F.col(id_column).cast("string").alias("_id")).distinct()
    return df.join(seen, F.col(id_column).cast("string") == F.col("_id"), "left_anti")


def config_hash(config: dict) -> str:
    """First 16 hex digits of the SHA-256 of the sorted-key JSON."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]


class Cache:
    """A versioned Parquet cache: <base>/<key>/<config hash>/v=<n>. Writers add a version and readers take the highest complete
    one, so a lost job leaves the version before intact."""

    def __init__(self, spark: SparkSession, base: str, key: str, config: dict | None = None, id_column: str = "id"):
        self.spark, self.id_column, self.path = spark, id_column, f"{base}/{key}/{config_hash(config or {})}"

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path, jvm

    def _versions(self) -> list[int]:
        fs, path, jvm = self._fs()
        if not fs.exists(path):
            return []
        names = [s.getPath() for s in fs.listStatus(path)]
        return sorted(int(p.getName()[2:]) for p in names if p.getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def read(self) -> DataFrame | None:
        v = self._versions()
        return self.spark.read.parquet(f"{self.path}/v={v[-1]}") if v else None

    def is_valid(self) -> bool:
        return bool(self._versions())

    def filter_uncached(self, df: DataFrame) -> DataFrame:
        have = self.read()
        return df if have is None else uncached(df, have, self.id_column)

    def save(self, new: DataFrame) -> None:
        v, have = self._versions(), self.read()
        out = new if have is None else upsert(have, new, self.id_column)
        out.write.mode("overwrite").parquet(f"{self.path}/v={(v[-1] + 1) if v else 0}")
        if len(v) > 1:  # the version before the last is not read any more
            fs, path, jvm = self._fs()
            fs.delete(jvm.org.apache.hadoop.fs.Path(path, f"v={v[0]}"), True)

    def requested(self, df: DataFrame) -> DataFrame:
        """Cached rows of the ids that df asks for."""
        have = self.read()
        if have is None:
            raise ValueError("empty cache")
        return have.join(df.select(self.id_column).distinct(), self.id_column, "left_semi")

    def clear(self) -> None:
        fs, path, _ = self._fs()
        fs.delete(path, True)


def resume(df: DataFrame, cache: Cache, compute) -> DataFrame:
    """compute(rows not cached) is added to the cache; returns all requested rows, cached before or new."""
    todo = cache.filter_uncached(df)
    if not todo.isEmpty():
        cache.save(compute(todo))
    return cache.requested(df)
