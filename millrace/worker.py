"""Tasks of the command line: python -m millrace.worker --task etl --input-file ... --output-dir ..."""

from __future__ import annotations

import contextlib
import dataclasses
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from millrace import config as C
from millrace.functions.text import batch_clean, text_features
from millrace.operators import features, metrics, models, providers, quality, setops, sharding
from millrace.plans import er
from millrace.session import session
from millrace.sources import readers


def _read(spark: SparkSession, c: C.Config) -> DataFrame:
    return readers.extract(spark, c.input_file, c.input_dir, c.max_rows, c.id_column)


def etl(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    df = _read(spark, c)
    found = quality.validate(df, c.id_column, c.target_column).collect()
    return quality.preprocess(df, c.id_column, c.text_columns), {"findings": [r.asDict() for r in found]}


def nlp(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    df = sharding.get_shard(_read(spark, c), c.id_column, c.worker_id, c.total_workers)
    for t in c.text_columns or ("text",):
        df = text_features(batch_clean(df, t), f"{t}_clean")
    return df, {}


def cv(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    return features.build(_read(spark, c), c.id_column, c.target_column, c.text_columns), {}


def embeddings(spark: SparkSession, c: C.Config, model=None) -> tuple[DataFrame, dict]:
    df = sharding.get_shard(_read(spark, c), c.id_column, c.worker_id, c.total_workers)
    if not c.enable_embeddings:
        return df.select(c.id_column), {}
    cache = setops.Cache(spark, c.cache_dir, "embeddings", {"model": c.embedding_model, "dim": c.embedding_dim}, c.id_column)
    return setops.resume(df, cache, lambda d: providers.text_embeddings(d, c.id_column, (c.text_columns or ("text",))[0], c.embedding_dim, model)), {}


def ocr(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    df = sharding.get_shard(readers.images(spark, c.input_dir).withColumnRenamed("path", c.id_column), c.id_column, c.worker_id, c.total_workers)
    cache = setops.Cache(spark, c.cache_dir, "ocr", {"backend": c.ocr_backend}, c.id_column)
    return setops.resume(df, cache, lambda d: providers.ocr(d, c.id_column, "content", c.ocr_backend)), {}


def baseline(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    built = features.build(_read(spark, c), c.id_column, c.target_column, c.text_columns)
    parts = sharding.split(built, c.id_column, c.split_method, c.val_fraction, c.target_column, c.group_column, c.seed)
    model, _ = models.train_baseline(parts.where("split = 'train'").drop("split"), c.id_column, c.target_column, c.model, **dict(c.model_params))
    out = model.predict(parts.where("split = 'val'"))
    scores = metrics.classification(out.withColumn("_y", out[c.target_column].cast("string")), "_y", "prediction").collect()
    model.save(f"{c.output_dir}/worker_{c.worker_id}/model")
    return out.select(c.id_column, "prediction"), {r["metric"]: r["value"] for r in scores}


def inference(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    model = models.Model.load(f"{c.output_dir}/worker_{c.worker_id}/model")
    return models.batch_predict(model, features.build(_read(spark, c), c.id_column, None, c.text_columns), c.id_column), {}


def entity_resolution(spark: SparkSession, c: C.Config) -> tuple[DataFrame, dict]:
    train, test = (readers.entities(spark, c.input_dir, s, c.max_rows) for s in ("train", "test"))
    where = f"{c.output_dir}/worker_{c.worker_id}/er"
    report = er.run(train, readers.ground_truth(spark, c.input_dir), test, where, c.er_profile, c.model if c.model != "logistic" else "gbt", c.er_folds, c.er_block_cap, c.worker_id, c.total_workers)
    return spark.read.parquet(f"{where}/matching_results"), report


class Timer:
    """Seconds of named sections, which add up, and of all since the first began."""

    def __init__(self):
        self.began, self.sections, self.open = None, {}, {}

    @contextlib.contextmanager
    def section(self, name: str):
        self.open[name] = time.time()
        self.began = self.began or self.open[name]
        try:
            yield self
        finally:
            self.sections[name] = self.sections.get(name, 0.0) + time.time() - self.open.pop(name)

    def elapsed(self, name: str) -> float:
        return self.sections.get(name, 0.0) + (time.time() - self.open[name] if name in self.open else 0.0)

    def summary(self) -> dict[str, float]:
        return {**{k: round(v, 3) for k, v in self.sections.items()}, "total_elapsed": round(time.time() - self.began, 3) if self.began else 0.0}

    def eta(self, done: int, total: int, name: str) -> float:
        """Seconds that are left at the section's rate so far."""
        return self.elapsed(name) / done * (total - done) if done > 0 else float("inf")


TASKS = {"etl": etl, "ocr": ocr, "cv": cv, "nlp": nlp, "embeddings": embeddings, "baseline": baseline, "inference": inference, "entity_resolution": entity_resolution}


def run(c: C.Config, spark: SparkSession | None = None) -> str | None:
    """Runs the task and writes the worker's output folder; a dry run only reports the configuration."""
    if c.task not in TASKS:
        raise ValueError(f"unknown task {c.task}")
    if c.dry_run:
        return None
    spark = spark or session(f"millrace-{c.task}", **({"spark__sql__shuffle__partitions": str(c.shuffle_partitions)} if c.shuffle_partitions else {}))
    timer = Timer()
    try:
        with timer.section(c.task):
            out, report = TASKS[c.task](spark, c)
        with timer.section("write"):
            folder = readers.write_worker(out, c.output_dir, c.worker_id, dataclasses.asdict(c), report, timer.summary())
    except Exception as e:
        readers.write_failure(spark, c.output_dir, c.worker_id, e)
        raise
    readers.write_report(spark, timer.summary(), f"{folder}/runtime")
    return folder


if __name__ == "__main__":
    print(run(C.load(sys.argv[1:])))
