"""Readers and writers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

ENTITY_SCHEMA = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH_SCHEMA = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def _listing(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match, sorted; on any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found else []


def extract(spark: SparkSession, path: str | None = None, folder: str | None = None, max_rows: int = -1, id_column: str | None = None) -> DataFrame:
    """A CSV or Parquet file, or the first *.csv, else *.parquet, of a folder. max_rows > 0 keeps the first rows by id_column."""
    if path is None:
        found = _listing(spark, f"{folder}/*.csv") or _listing(spark, f"{folder}/*.parquet")
        if not found:
            raise FileNotFoundError(f"no CSV or Parquet file in {folder}")
        path = found[0]
    if path.rstrip("/").endswith(".csv"):
        df = spark.read.option("header", True).option("inferSchema", True).option("escape", '"').option("multiLine", True).csv(path)
    elif path.rstrip("/").endswith(".tsv"):
        df = spark.read.option("header", True).option("sep", "\t").csv(path)
    else:
        df = spark.read.parquet(path)
    return row_limit(df, id_column or df.columns[0], max_rows)


def row_limit(df: DataFrame, id_column: str | list[str], max_rows: int) -> DataFrame:
    """The first max_rows rows by id (or ids); all if max_rows is not positive."""
    return df.orderBy(id_column).limit(max_rows) if max_rows > 0 else df


def entities(spark: SparkSession, folder: str, split: str, max_rows: int = -1, sources: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """<split>/<split>_source<i>.tsv as text columns, nulls '', plus source; a file that is missing is left out."""
    out = None
    for i in sources:
        path = f"{folder}/{split}/{split}_source{i}.tsv"
        if _listing(spark, path):
            one = spark.read.schema(ENTITY_SCHEMA).option("sep", "\t").option("header", True).option("quote", "").csv(path).na.fill("")
            one = row_limit(one, "entity_id", max_rows).withColumn("source", F.lit(i))
            out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], StructType([*ENTITY_SCHEMA.fields, StructField("source", IntegerType())])) if out is None else out


def ground_truth(spark: SparkSession, folder: str, required: bool = False) -> DataFrame:
    path = f"{folder}/train/train_ground_truth.tsv"
    if not _listing(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], TRUTH_SCHEMA)
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path).na.fill("")


def predictions(spark: SparkSession, paths: list[str], id_column: str, pred: str) -> list[DataFrame]:
    """The id and prediction columns of every file that exists and has them."""
    out = []
    for p in paths:
        if _listing(spark, p):
            df = extract(spark, p)
            if {id_column, pred} <= set(df.columns):
                out.append(df.select(id_column, pred))
    return out


def worker_outputs(spark: SparkSession, base: str) -> list[str]:
    return _listing(spark, f"{base}/worker_*/output.parquet")


def images(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    """(path, content, ...) of image files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).option("quote", "" if sep == "\t" else '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """The report as one JSON line and as indented text, through Spark, so on any store."""
    def lines(x, depth=0):
        for k, v in x.items() if isinstance(x, dict) else enumerate(x):
            if isinstance(v, (dict, list)):
                yield "  " * depth + f"{k}:"
                yield from lines(v, depth + 1)
            else:
                yield "  " * depth + f"{k}: {v}"

    for kind, rows in (("json", [json.dumps(report, default=str)]), ("txt", list(lines(report)))):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.{kind}")


def write_worker(df: DataFrame, base: str, worker: int, config: dict, metrics: dict, runtime: dict) -> str:
    """worker_<n>/: output.parquet, config, metrics and runtime reports, and a README that names worker, task and seconds; errors.csv if the output has
    errors of its rows (a column `error`), without which it is written."""
    spark, folder = df.sparkSession, f"{base}/worker_{worker}"
    if "error" in df.columns:
        failed = df.where("error is not null")
        if not failed.isEmpty():
            write_delimited(failed.select(*(c for c in df.columns if c in ("error", df.columns[0]))), f"{folder}/errors.csv", ",")
        write_parquet(df.drop("error"), f"{folder}/output.parquet")
    else:
        write_parquet(df, f"{folder}/output.parquet")
    for name, x in (("config", config), ("metrics", metrics), ("runtime", runtime)):
        write_report(spark, x, f"{folder}/{name}")
    lines = [f"Worker {worker}/{config.get('total_workers', 1)}", f"Task: {config.get('task', '')}", f"Runtime: {runtime.get('total_elapsed', 0.0):.2f}s"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/README.txt")
    return folder


def write_failure(spark: SparkSession, base: str, worker: int, error: BaseException) -> None:
    """errors.csv of a worker whose task failed as a whole."""
    write_delimited(spark.createDataFrame([(f"{type(error).__name__}: {error}"[:2000],)], "error string"), f"{base}/worker_{worker}/errors.csv", ",")


def merge_workers(spark: SparkSession, base: str, id_column: str) -> DataFrame:
    from millrace.operators.setops import union_checked

    found = worker_outputs(spark, base)
    if not found:
        raise FileNotFoundError(f"no worker output in {base}")
    return union_checked([spark.read.parquet(p) for p in found], id_column)
