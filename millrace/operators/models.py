"""Training and inference on pyspark.ml pipelines."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import metrics, sharding
from millrace.operators.features import cast_features
from millrace.operators.quality import numeric_columns

#: Boosted trees by any of the usual names; pyspark.ml's serve for two classes, a forest for more.
BOOSTED = ("gbt", "lightgbm", "xgboost", "catboost")


def estimator(kind: str, classes: int, seed: int = 42, rounds: int = 100, trees: int = 100):
    if kind == "logistic":
        return LogisticRegression(maxIter=1000, featuresCol="_features", labelCol="_label", probabilityCol="_probability")
    if kind in BOOSTED and classes <= 2:
        return GBTClassifier(maxIter=rounds, seed=seed, featuresCol="_features", labelCol="_label")
    if kind in BOOSTED or kind == "random_forest":
        return RandomForestClassifier(numTrees=trees, seed=seed, featuresCol="_features", labelCol="_label", probabilityCol="_probability")
    raise ValueError(f"unknown model {kind}")


class Model:
    """Numeric features to a label of any type: fit, predict, predict_proba, save, load."""

    def __init__(self, kind: str = "logistic", seed: int = 42, **options):
        self.kind, self.seed, self.options, self.fitted, self.features = kind, seed, options, None, []

    def fit(self, df: DataFrame, target: str, skip: tuple[str, ...] = ()) -> Model:
        self.features = [c for c in numeric_columns(df, (*skip, target))]
        if not self.features:
            raise ValueError("no numeric feature")
        classes = df.select(target).distinct().count()
        indexer = StringIndexer(inputCol="_target", outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip").fit(df.select(F.col(target).cast("string").alias("_target")))
        stages = [VectorAssembler(inputCols=self.features, outputCol="_features"), estimator(self.kind, classes, self.seed, **self.options), IndexToString(inputCol="prediction", outputCol="_named", labels=indexer.labels)]
        train = indexer.transform(cast_features(df, self.features).withColumn("_target", F.col(target).cast("string")))
        self.fitted = Pipeline(stages=stages).fit(train)
        return self

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.fitted is None:
            raise ValueError("not fitted")
        own = cast_features(df.select(*(F.col(c).alias(f"_f_{c}") for c in self.features), F.struct("*").alias("_row")).select("_row", *(F.col(f"_f_{c}").alias(c) for c in self.features)), self.features)
        return self.fitted.transform(own)

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """df plus the predicted label as text."""
        return self._transform(df).select("_row.*", F.col("_named").alias(name))

    def predict_proba(self, df: DataFrame, name: str = "proba") -> DataFrame:
        """df plus the probability of the last label."""
        out = self._transform(df)
        p = vector_to_array("_probability" if "_probability" in out.columns else "probability")
        return out.select("_row.*", F.element_at(p, -1).alias(name))

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> Model:
        m = cls()
        m.fitted = PipelineModel.load(path)
        m.features = m.fitted.stages[0].getInputCols()
        return m


def train_baseline(df: DataFrame, id_column: str, target: str, kind: str = "logistic", **options) -> tuple[Model, DataFrame]:
    """The model, and (id, target, prediction) of the training rows."""
    if target not in df.columns:
        raise ValueError(f"no target {target}")
    m = Model(kind, **options).fit(df, target, (id_column,))
    return m, m.predict(df).select(id_column, target, "prediction")


def batch_predict(model: Model, df: DataFrame, id_column: str) -> DataFrame:
    """(id, prediction) of every row; ValueError for repeated ids."""
    if not df.groupBy(id_column).count().where("count > 1").isEmpty():
        raise ValueError("repeated ids")
    return model.predict(df).select(id_column, "prediction")


def validate_predictions(predictions: DataFrame, expected: DataFrame, id_column: str, pred: str = "prediction") -> DataFrame:
    """One row: rows, expected_rows, missing_ids, duplicate_ids, null_predictions."""
    p = predictions.groupBy(id_column).agg(F.count(F.lit(1)).alias("c"), F.sum(F.col(pred).isNull().cast("long")).alias("nulls"))
    e = expected.select(id_column).distinct().withColumn("_e", F.lit(1))
    out = p.join(e, id_column, "full").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), F.count("_e").alias("expected_rows"), F.coalesce(F.sum(F.col("c").isNull().cast("long")), F.lit(0)).alias("missing_ids"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_ids"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_predictions"),
    )
    return out


def screen(train: DataFrame, val: DataFrame, id_column: str, target: str, max_rows: int = 5000, kind: str = "logistic") -> DataFrame:
    """A quick model on at most max_rows rows (by hash); accuracy and F1 on both sides: (part, metric, value)."""
    small = sharding.sample_rows(train, id_column, max_rows) if max_rows > 0 else train
    m = Model(kind).fit(small, target, (id_column,))
    out = None
    for name, d in (("train", small), ("val", val)):
        one = metrics.classification(m.predict(d).withColumn("_y", F.col(target).cast("string")), "_y", "prediction").select(F.lit(name).alias("part"), "metric", "value")
        out = one if out is None else out.unionByName(one)
    return out


def group_cross_validate(df: DataFrame, group: str, target: str, folds: int, kind: str = "gbt", skip: tuple[str, ...] = (), where: str | None = None, **options) -> tuple[DataFrame, dict]:
    """Out-of-fold probabilities (df plus fold, proba) and a report: macro F0.5 per fold at 0.5, mean, std (population), the tuned
    threshold, singleton errors and false merges at it. `where`: a folder in which folded rows are kept between fits."""
    folded = sharding.balanced_folds(df, group, folds)
    if where:
        folded.write.mode("overwrite").parquet(f"{where}/folds")
        folded = df.sparkSession.read.parquet(f"{where}/folds")
    out = None
    for i in range(folds):
        train, val = folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)
        if val.isEmpty() or train.select(target).distinct().count() < 2:
            continue
        one = Model(kind, **options).fit(train, target, (*skip, group, "fold")).predict_proba(val)
        out = one if out is None else out.unionByName(one)
    if where and out is not None:
        out.write.mode("overwrite").parquet(f"{where}/oof")
        out = df.sparkSession.read.parquet(f"{where}/oof")
    hard = out.withColumn("_h", (F.col("proba") >= 0.5).cast("int"))
    scores = [metrics.macro_f05(hard.where(F.col("fold") == r[0]), target, "_h", group).first()[0] for r in out.select("fold").distinct().orderBy("fold").collect()]
    best = metrics.best_threshold(metrics.tune_threshold_f05(out, target, "proba", group)).first()
    errors = metrics.error_analysis(out.withColumn("_h", (F.col("proba") >= best["threshold"]).cast("int")), target, "_h", group).first()
    mean = sum(scores) / len(scores)
    return out, {"fold_scores": scores, "mean": mean, "std": (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5, "threshold": best["threshold"], "macro_f05": best["macro_f05"], **errors.asDict()}
