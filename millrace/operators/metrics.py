"""Classification metrics, threshold searches and ensembles as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Long form over the union of labels: y_true, y_pred, n (0 where none)."""
    counts = df.groupBy(F.col(truth).alias("y_true"), F.col(pred).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))
    labels = counts.select(F.col("y_true").alias("l")).unionByName(counts.select(F.col("y_pred").alias("l"))).distinct()  # classes
    grid = labels.select(F.col("l").alias("y_true")).crossJoin(F.broadcast(labels.select(F.col("l").alias("y_pred"))))
    return grid.join(counts, ["y_true", "y_pred"], "left").select("y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Dense: one row per true label, one column per predicted."""
    return confusion(df, truth, pred).groupBy("y_true").pivot("y_pred").agg(F.sum("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def classification(df: DataFrame, truth: str, pred: str, digits: int = 6) -> DataFrame:
    """(metric, value): accuracy; f1, precision, recall as macro, micro, weighted; f1_binary if the labels are 0 and 1."""
    m = confusion(df, truth, pred)
    per = m.groupBy(F.col("y_true").alias("l")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("tp"))
    per = per.join(m.groupBy(F.col("y_pred").alias("l")).agg(F.sum("n").alias("predicted")), "l")
    per = per.withColumn("p", _ratio(F.col("tp"), F.col("predicted"))).withColumn("r", _ratio(F.col("tp"), F.col("support")))
    per = per.withColumn("f", _ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    total = F.sum("support")
    accuracy = F.sum("tp") / total
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / total
    binary = F.when(F.min(F.col("l").cast("string").isin("0", "1")), F.max(F.when(F.col("l").cast("string") == "1", F.col("f"))))
    one = per.agg(
        accuracy.alias("accuracy"), F.avg("f").alias("f1_macro"), accuracy.alias("f1_micro"), weighted("f").alias("f1_weighted"), binary.alias("f1_binary"),
        F.avg("p").alias("precision_macro"), accuracy.alias("precision_micro"), F.avg("r").alias("recall_macro"), accuracy.alias("recall_micro"),
    )
    rows = F.array(*(F.struct(F.lit(c).alias("metric"), F.round(c, digits).alias("value")) for c in one.columns))
    return one.select(F.explode(rows).alias("x")).select("x.*").where("value is not null")


def format_metrics(metrics: dict[str, float]) -> str:
    return "\n".join(f"{k:>20}: {v:.6f}" for k, v in sorted(metrics.items()))


def _thresholds(n: int) -> Column:
    """n evenly spaced values from 0.01 to 0.99."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(0.01) + i * F.lit(0.98 / (n - 1)))


def search_threshold(df: DataFrame, truth: str, proba: str, n: int = 100) -> DataFrame:
    """One row: threshold, f1 (the first threshold of the greatest binary F1).

    Each row goes to the last threshold that it reaches, one aggregate counts those, and sums from the top give all
    thresholds' counts: the input is read once and makes no row per threshold."""
    step = 0.98 / (n - 1)
    level = F.greatest(F.lit(-1), F.least(F.lit(n - 1), F.floor((F.col(proba) - 0.01) / step + 1e-9))).cast("int")
    # Floating-point edges: a row passes threshold i if proba >= 0.01 + i * step, exactly.
    level = level + F.when((level < n - 1) & (F.col(proba) >= 0.01 + (level + 1) * F.lit(step)), 1).otherwise(0)
    level = F.when((level >= 0) & (F.col(proba) < 0.01 + level * F.lit(step)), level - 1).otherwise(level)
    counts = df.groupBy(level.alias("i")).agg(F.sum((F.col(truth) == 1).cast("long")).alias("pos"), F.sum((F.col(truth) != 1).cast("long")).alias("neg"))
    grid = df.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("i"))
    up = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)  # n + 1 rows
    c = grid.join(counts, "i", "left").na.fill(0).withColumn("tp", F.sum("pos").over(up)).withColumn("fp", F.sum("neg").over(up)).withColumn("p", F.sum("pos").over(Window.partitionBy()))
    f1 = _ratio(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("p"))
    return c.where("i >= 0").select(F.round(0.01 + F.col("i") * F.lit(step), 6).alias("threshold"), F.round(f1, 6).alias("f1")).orderBy(F.desc("f1"), "threshold").limit(1)


def f05(tp: Column, fp: Column, fn: Column) -> Column:
    """F0.5 of one group; 1 for a group without positives of either kind."""
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return F.when(tp + fp + fn == 0, 1.0).otherwise(_ratio(1.25 * p * r, 0.25 * p + r))


def macro_f05(df: DataFrame, truth: str, pred: str, group: str) -> DataFrame:
    """One row: macro_f05 over groups."""
    y, h = F.col(truth), F.col(pred)
    per = df.groupBy(group).agg(F.sum(((y == 1) & (h == 1)).cast("long")).alias("tp"), F.sum(((y != 1) & (h == 1)).cast("long")).alias("fp"), F.sum(((y == 1) & (h != 1)).cast("long")).alias("fn"))
    return per.agg(F.avg(f05(F.col("tp"), F.col("fp"), F.col("fn"))).alias("macro_f05"))


def tune_threshold_f05(df: DataFrame, truth: str, proba: str, group: str, n: int = 200) -> DataFrame:
    """(threshold, macro_f05) of every threshold, from one shuffle by group.

    A group's counts change only where one of its rows drops out, so per (group, level) counts and their sums from the top
    give the group's score at each threshold; groups are dense only over levels, never over rows."""
    step = 0.98 / (n - 1)
    guess = F.floor((F.col(proba) - 0.01) / step + 1e-9)
    level = F.greatest(F.lit(-1), F.least(F.lit(n - 1), guess)).cast("int")
    level = F.when((level < n - 1) & (F.col(proba) >= 0.01 + (level + 1) * F.lit(step)), level + 1).when((level >= 0) & (F.col(proba) < 0.01 + level * F.lit(step)), level - 1).otherwise(level)
    per = df.groupBy(group, level.alias("i")).agg(F.sum((F.col(truth) == 1).cast("long")).alias("pos"), F.sum((F.col(truth) != 1).cast("long")).alias("neg"))
    down = Window.partitionBy(group).orderBy(F.desc("i"))
    whole = Window.partitionBy(group)
    s = per.withColumn("tp", F.sum("pos").over(down)).withColumn("fp", F.sum("neg").over(down)).withColumn("p", F.sum("pos").over(whole)).withColumn("next", F.lag("i").over(down))
    # This row's counts hold for thresholds next-lower .. i: from the following row's level + 1 up to i.
    lower = F.lead("i").over(down)
    s = s.withColumn("low", F.coalesce(lower, F.lit(-1)) + 1)
    score = lambda tp, fp, p: f05(tp, fp, p - tp)
    held = s.where("i >= 0").select("low", F.col("i").alias("high"), score(F.col("tp"), F.col("fp"), F.col("p")).alias("v"))
    # Thresholds above a group's greatest level: nothing is predicted.
    top = per.groupBy(group).agg(F.max("i").alias("m"), F.sum("pos").alias("p")).select((F.col("m") + 1).alias("low"), F.lit(n - 1).alias("high"), F.when(F.col("p") == 0, 1.0).otherwise(0.0).alias("v")).where("low <= high")
    spans = held.unionByName(top)
    # Differences at both ends, summed: rows per group, not groups times thresholds.
    ends = spans.select(F.col("low").alias("i"), F.col("v")).unionByName(spans.select((F.col("high") + 1).alias("i"), (-F.col("v")).alias("v"))).groupBy("i").agg(F.sum("v").alias("v"))
    groups = df.agg(F.countDistinct(group).alias("g"))
    grid = df.sparkSession.range(0, n).select(F.col("id").cast("int").alias("i"))
    run = Window.orderBy("i")  # n rows
    total = grid.join(ends, "i", "left").withColumn("s", F.sum(F.coalesce("v", F.lit(0.0))).over(run))
    return total.crossJoin(F.broadcast(groups)).select(F.round(0.01 + F.col("i") * F.lit(step), 4).alias("threshold"), F.round(F.col("s") / F.col("g"), 9).alias("macro_f05"))


def best_threshold(tuned: DataFrame, score: str = "macro_f05") -> DataFrame:
    return tuned.orderBy(F.desc(score), "threshold").limit(1)


def error_analysis(df: DataFrame, truth: str, pred: str, group: str) -> DataFrame:
    """One row: singleton_errors (groups with a true match and none predicted) and false_merges."""
    per = df.groupBy(group).agg(F.max(truth).alias("y"), F.max(pred).alias("h"), F.sum(((F.col(truth) != 1) & (F.col(pred) == 1)).cast("long")).alias("fp"))
    return per.agg(F.coalesce(F.sum(((F.col("y") == 1) & (F.col("h") != 1)).cast("long")), F.lit(0)).alias("singleton_errors"), F.coalesce(F.sum("fp"), F.lit(0)).alias("false_merges"))


def id_alignment(parts: list[DataFrame], id_column: str) -> DataFrame:
    """Per part: rows, duplicate_ids, missing_ids (of the union of all), in order."""
    tagged = None
    for i, p in enumerate(parts):
        one = p.groupBy(F.col(id_column).alias("id")).agg(F.count(F.lit(1)).alias("c")).withColumn("part", F.lit(i))
        tagged = one if tagged is None else tagged.unionByName(one)
    every = tagged.agg(F.countDistinct("id").alias("ids"))
    per = tagged.groupBy("part").agg(F.sum("c").alias("rows"), F.sum(F.col("c") - 1).alias("duplicate_ids"), F.count(F.lit(1)).alias("own"))
    return per.crossJoin(F.broadcast(every)).select("part", "rows", "duplicate_ids", (F.col("ids") - F.col("own")).alias("missing_ids"))


def ensemble(parts: list[DataFrame], id_column: str, pred: str, weights: list[float] | None = None, check: bool = True) -> DataFrame:
    """(id, prediction): the weighted mean over parts; ValueError if weights or ids don't fit."""
    weights = weights or [1.0] * len(parts)
    if len(weights) != len(parts) or not parts:
        raise ValueError("one weight per part is needed")
    if check and not id_alignment(parts, id_column).where("duplicate_ids > 0 or missing_ids > 0").isEmpty():
        raise ValueError("the parts' ids differ or repeat")
    total = sum(weights)
    rows = None
    for p, w in zip(parts, weights, strict=True):
        one = p.select(F.col(id_column), (F.col(pred).cast("double") * F.lit(w / total)).alias("prediction"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(id_column).agg(F.sum("prediction").alias("prediction"))


def ensemble_with_threshold(parts: list[DataFrame], labels: DataFrame, id_column: str, pred: str, truth: str, weights: list[float] | None = None, n: int = 100) -> tuple[DataFrame, DataFrame]:
    """The (weighted) mean over parts, and the one row of search_threshold over it: threshold, f1. Labels are joined by id."""
    blend = ensemble(parts, id_column, pred, weights)
    return blend, search_threshold(blend.join(labels.select(id_column, truth), id_column), truth, "prediction", n)


def compare_ensemble(parts: list[DataFrame], labels: DataFrame, id_column: str, pred: str, truth: str, threshold: float = 0.5, metric: str = "accuracy", weights: list[float] | None = None) -> DataFrame:
    """(model, <metric>, improves): each part and the (weighted) mean; improves only if over the best part. Predictions become classes by
    the threshold if the labels have two values, else by rounding half to even."""
    blend = ensemble(parts, id_column, pred, weights).withColumnRenamed("prediction", pred)
    two = labels.select(truth).where(F.col(truth).isNotNull()).distinct().limit(3).count() == 2
    rows = None
    for name, p in [*((f"model_{i}", p) for i, p in enumerate(parts)), ("ensemble", blend)]:
        one = p.select(id_column, F.col(pred).alias("_p")).join(labels.select(id_column, truth), id_column)
        one = one.withColumn("_p", (F.col("_p") >= threshold).cast("int") if two else half_even(F.col("_p")))
        if metric == "accuracy":
            one = one.agg(F.round(F.avg((F.col("_p") == F.col(truth)).cast("double")), 6).alias(metric))
        else:
            one = classification(one.withColumn("_y", F.col(truth).cast("int")), "_y", "_p").where(F.col("metric") == metric).select(F.col("value").alias(metric))
        one = one.select(F.lit(name).alias("model"), metric)
        rows = one if rows is None else rows.unionByName(one)
    best = rows.where("model <> 'ensemble'").agg(F.max(metric).alias("best"))
    return rows.crossJoin(F.broadcast(best)).select("model", metric, ((F.col("model") == "ensemble") & (F.col(metric) > F.col("best"))).alias("improves"))


def half_even(prediction: Column) -> Column:
    """Class number of a blended multiclass prediction."""
    return F.bround(prediction).cast("int")
