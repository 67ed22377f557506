"""Feature frames: numeric columns, category codes, text features; merging of feature frames by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import text_features
from millrace.operators.quality import numeric_columns, string_columns


def role_projection(df: DataFrame, id_column: str, target: str | None = None, text_columns: tuple[str, ...] = (), image_column: str | None = None) -> tuple[list[str], list[str]]:
    """Numeric and category columns: all but the id and target; strings also without text and image columns."""
    skip = tuple(c for c in (id_column, target, image_column) if c)
    return numeric_columns(df, skip), string_columns(df, skip + tuple(text_columns))


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): rank of each distinct value from 0. The window runs over the distinct values only."""
    values = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    return values.withColumn("code", F.row_number().over(Window.orderBy("value")) - 1)


def encode(df: DataFrame, column: str, codes: DataFrame | None = None) -> DataFrame:
    """Adds <column>_encoded, int; null and unknown values are -1. Pass codes fitted once to encode other frames alike."""
    codes = category_codes(df, column) if codes is None else codes
    return df.join(codes.withColumnRenamed("value", column), column, "left").withColumn(f"{column}_encoded", F.coalesce(F.col("code"), F.lit(-1)).cast("int")).drop("code")


def build(df: DataFrame, id_column: str, target: str | None = None, text_columns: tuple[str, ...] = (), codes: dict[str, DataFrame] | None = None) -> DataFrame:
    """id, numeric columns, category codes, text features, target."""
    numbers, categories = role_projection(df, id_column, target, text_columns)
    out = df
    for c in categories:
        out = encode(out, c, (codes or {}).get(c))
    made = []
    for c in text_columns:
        before = set(out.columns)
        out = text_features(out, c)
        made += [x for x in out.columns if x not in before]
    return out.select(id_column, *numbers, *(f"{c}_encoded" for c in categories), *made, *([target] if target else []))


def merge(base: DataFrame, parts: list[DataFrame], id_column: str, how: str = "left", order: list[str] | None = None, check: bool = True) -> DataFrame:
    """base joined with each part on the id. Parts without the id column are skipped; a part's repeated ids keep one row (the last by
    `order`); columns that are there already get _feat<i>; ValueError if rows grow by over 1 %."""
    out = base
    for i, p in enumerate(parts):
        if id_column not in p.columns:
            continue
        by = [F.col(c).desc_nulls_last() for c in (order or [c for c in p.columns if c != id_column])]
        if by:
            p = p.withColumn("_n", F.row_number().over(Window.partitionBy(id_column).orderBy(*by))).where("_n = 1").drop("_n")
        clash = {c: f"{c}_feat{i}" for c in p.columns if c != id_column and c in out.columns}
        out = out.join(p.withColumnsRenamed(clash), id_column, how)
    if check and how == "left":
        a, b = base.count(), out.count()
        if b > 1.01 * a:
            raise ValueError(f"{b} rows after merging {a}")
    return out


def cast_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers for a model: float, null and NaN 0."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("float"), F.lit(0.0)), F.lit(0.0)).cast("float") for c in columns})
