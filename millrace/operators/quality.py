"""Inspection, validation, leakage and imputation reports as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from millrace.functions import text as T


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def string_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in skip]


def _long(df: DataFrame, per_column: dict[str, dict[str, Column]], names: list[str]) -> DataFrame:
    """One aggregate over all columns, then a row per column; no scan is repeated."""
    flat = df.agg(*(e.alias(f"{c}\x01{n}") for c, es in per_column.items() for n, e in es.items()))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"`{c}\x01{n}`").alias(n) for n in names)) for c in per_column))
    return flat.select(F.explode(rows).alias("r")).select("r.*")


def null_report(df: DataFrame) -> DataFrame:
    """Per column with nulls: column, nulls, null_pct (two places)."""
    cols = {c: {"nulls": F.sum(F.col(c).isNull().cast("long")), "n": F.count(F.lit(1))} for c in df.columns}
    return _long(df, cols, ["nulls", "n"]).where("nulls > 0").select("column", "nulls", F.round(100.0 * F.col("nulls") / F.col("n"), 2).alias("null_pct"))


def distinct_report(df: DataFrame, count_null: bool = False) -> DataFrame:
    """Per column: column, distinct_values; count_null counts null as a value.

    An aggregate for each column reads that column only and shuffles its distinct values; several distinct counts in one aggregate would make
    a row for each column of each row."""
    out = None
    for c in df.columns:
        one = df.select(F.col(c).alias("v")).distinct().agg((F.count("v") + (F.count(F.lit(1)) - F.count("v") if count_null else 0)).cast("long").alias("distinct_values"))
        one = one.select(F.lit(c).alias("column"), "distinct_values")
        out = one if out is None else out.unionByName(one)
    return out


#: Rows between two bounds that are counted by value to find a quantile, and parts into which more rows are cut.
NEAR_ROWS = 20_000
PARTS = 1024
#: Ranks by which the first bounds may be off, as a share of the rows.
RANK_ERROR = 1e-4


def quantiles(df: DataFrame, values: dict[str, Column], shares: list[float]) -> dict[str, list[float | None]]:
    """Exact quantiles by linear interpolation, for each named value; None without values (nulls and NaN are none).

    No task holds or sorts a whole column: sketches bound each rank, rows below the bounds are counted, and the rows between them
    counted by value; while these are more than NEAR_ROWS, counts over PARTS parts tighten the bounds. All quantiles share the scans."""
    names = list(values)
    of = df.select(*(F.when(~F.isnan(e.cast("double")), e.cast("double")).alias(f"v{i}") for i, e in enumerate(values.values())))
    asked = [min(1.0, max(0.0, q + d)) for q in shares for d in (-2 * RANK_ERROR, 2 * RANK_ERROR)]
    sketch = lambda v: F.percentile_approx(v, asked, int(1 / RANK_ERROR))
    row = of.agg(*(x for i in range(len(names)) for v in [F.col(f"v{i}")] for x in (F.count(v).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}"), sketch(v).alias(f"s{i}")))).first()
    out: dict[str, list[float | None]] = {c: [None] * len(shares) for c in names}
    todo = {}  # (value, share) -> ranks, bounds
    for i in range(len(names)):
        for j, q in enumerate(shares):
            if row[f"n{i}"]:
                at = q * (row[f"n{i}"] - 1)
                todo[i, j] = (int(at), min(int(at) + 1, row[f"n{i}"] - 1), at - int(at), *row[f"s{i}"][2 * j : 2 * j + 2])
    while todo:
        keys = list(todo)
        inside = {k: F.col(f"v{k[0]}").between(todo[k][3], todo[k][4]) for k in keys}
        counts = of.agg(*(x for t, k in enumerate(keys) for x in (F.count_if(F.col(f"v{k[0]}") < todo[k][3]).alias(f"b{t}"), F.count_if(inside[k]).alias(f"m{t}")))).first()
        for t, k in enumerate(keys):
            if not counts[f"b{t}"] <= todo[k][0] or todo[k][1] >= counts[f"b{t}"] + counts[f"m{t}"]:  # the ranks are elsewhere
                todo[k] = (*todo[k][:3], row[f"a{k[0]}"], row[f"z{k[0]}"])
        if any(not counts[f"b{t}"] <= todo[k][0] < todo[k][1] + 1 <= counts[f"b{t}"] + counts[f"m{t}"] for t, k in enumerate(keys)):
            continue
        near = {k: counts[f"m{t}"] <= NEAR_ROWS for t, k in enumerate(keys)}
        part = lambda k: F.col(f"v{k[0]}") if near[k] or todo[k][3] == todo[k][4] else F.floor((F.col(f"v{k[0]}") - todo[k][3]) / (todo[k][4] - todo[k][3]) * (PARTS - 1)).cast("double")
        rows = of.select(F.explode(F.array(*(F.when(inside[k], F.struct(F.lit(t).alias("t"), part(k).alias("p"), F.col(f"v{k[0]}").alias("v"))) for t, k in enumerate(keys)))).alias("x")).where("x is not null").select("x.*")
        found: dict[int, list] = {}
        for r in rows.groupBy("t", "p").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("z")).collect():  # NEAR_ROWS or PARTS a quantile
            found.setdefault(r["t"], []).append((r["a"], r["z"], r["n"]))
        for t, k in enumerate(keys):
            first, last, share, _, _ = todo[k]
            before, low, high = counts[f"b{t}"], None, None
            for a, z, n in sorted(found[t]):
                low = (a, z) if low is None and first < before + n else low
                high = (a, z) if high is None and last < before + n else high
                before += n
            if low[0] == low[1] and high[0] == high[1]:
                out[names[k[0]]][k[1]] = low[0] + (high[0] - low[0]) * share
                del todo[k]
            else:
                todo[k] = (first, last, share, low[0], high[1])
    return out


def numeric_report(df: DataFrame, columns: list[str] | None = None, digits: int = 4) -> DataFrame:
    """count, mean, std (sample), min, quartiles by linear interpolation, max."""
    columns = columns or numeric_columns(df)
    quarts = quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])
    aggs = lambda c: {"count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c).cast("double"), "max": F.max(c).cast("double")} | {f"p{q}": F.lit(x).cast("double") for q, x in zip((25, 50, 75), quarts[c], strict=True)}
    names = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    out = _long(df, {c: aggs(c) for c in columns}, names)
    return out.select("column", "count", *(F.round(n, digits).alias(n) for n in names[1:]))


def text_length_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Of the non-null texts of each column: count, mean_length (two places), min_length, max_length, median_length (cut to whole)."""
    columns = columns or string_columns(df)
    names = ["count", "mean_length", "min_length", "max_length", "median_length"]
    medians = quantiles(df, {c: F.length(c) for c in columns}, [0.5])
    aggs = lambda c: {"count": F.count(c), "mean_length": F.round(F.avg(F.length(c)), 2), "min_length": F.min(F.length(c)), "max_length": F.max(F.length(c)), "median_length": F.lit(medians[c][0]).cast("double").cast("int")}
    return _long(df, {c: aggs(c) for c in columns}, names).where("count > 0")


def text_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: counts, nulls, empties, and statistics of characters and words of the non-null texts."""
    t = F.col(column)
    n, w = F.length(t), F.when(t.isNotNull(), T.word_count(t))
    medians = quantiles(df, {"char": n, "word": w}, [0.5])
    return df.agg(
        F.count(t).alias("count"), F.sum(t.isNull().cast("long")).alias("null_count"), F.sum((t == "").cast("long")).alias("empty_count"),
        F.round(F.avg(n), 4).alias("char_mean"), F.min(n).alias("char_min"), F.max(n).alias("char_max"), F.lit(medians["char"][0]).cast("double").alias("char_median"),
        F.round(F.avg(w), 4).alias("word_mean"), F.min(w).alias("word_min"), F.max(w).alias("word_max"), F.lit(medians["word"][0]).cast("double").alias("word_median"),
    )


def duplicate_report(df: DataFrame, id_column: str | None = None) -> DataFrame:
    """One row: rows, duplicate_rows and duplicate_ids beyond the first of each group."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicate_rows"))
    if id_column is None:
        return groups
    ids = df.groupBy(id_column).agg(F.count(F.lit(1)).alias("_c")).agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicate_ids"))
    return groups.crossJoin(ids)  # one row each


def validate(df: DataFrame, id_column: str | None = None, target: str | None = None, expected: list[str] = ()) -> DataFrame:
    """Findings (level, check, column, value); valid data has no row of level error."""
    out: list[tuple] = [("error", "missing_column", c, 1.0) for c in expected if c not in df.columns]
    spark = df.sparkSession
    have_id, have_target = id_column in df.columns, target in df.columns
    if id_column and not have_id:
        out.append(("warning", "id_column_absent", id_column, 1.0))
    if target and not have_target:
        out.append(("warning", "target_absent", target, 1.0))
    # One value throughout: the least is the greatest; values without an order are compared as JSON.
    value = {f.name: F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("n"), *(F.sum(F.col(c).isNull().cast("long")).alias(f"null_{i}") for i, c in enumerate(df.columns)), *(F.min(value[c]).eqNullSafe(F.max(value[c])).alias(f"same_{i}") for i, c in enumerate(df.columns))]
    if have_id:
        aggs.append(F.countDistinct(id_column).alias("ids"))
    r = df.agg(*aggs).first().asDict()  # one row
    n, nulls = r["n"], [r[f"null_{i}"] or 0 for i in range(len(df.columns))]
    if n == 0:
        out.append(("error", "empty", "", 0.0))
    else:
        at = {c: i for i, c in enumerate(df.columns)}
        if have_id:
            if nulls[at[id_column]]:
                out.append(("error", "null_ids", id_column, float(nulls[at[id_column]])))
            dup = n - r["ids"] - (nulls[at[id_column]] > 0)
            if dup:
                out.append(("warning", "duplicate_ids", id_column, float(dup)))
        if have_target and nulls[at[target]]:
            out.append(("warning", "null_target", target, float(nulls[at[target]])))
        share = sum(nulls) / (n * len(df.columns))
        if share > 0.5:
            out.append(("warning", "mostly_null", "", round(share, 6)))
        out += [("warning", "constant_column", c, 1.0) for c, i in at.items() if r[f"same_{i}"] and nulls[i] in (0, n)]
    return spark.createDataFrame(out, "level string, check string, column string, value double")


def leakage(train: DataFrame, test: DataFrame, id_column: str, group_column: str | None = None) -> DataFrame:
    """Per checked column: distinct values found on both sides (as text)."""
    out = None
    for kind, c in (("id", id_column), ("group", group_column)):
        if c:
            a, b = (d.select(F.col(c).cast("string").alias("v")).where("v is not null").distinct() for d in (train, test))
            one = a.join(b, "v", "left_semi").agg(F.count(F.lit(1)).alias("overlap")).select(F.lit(kind).alias("kind"), F.lit(c).alias("column"), "overlap")
            out = one if out is None else out.unionByName(one)
    return out


def inspect(df: DataFrame, target_words: tuple[str, ...] = ("target", "label", "class", "y", "score", "price")) -> dict:
    """Driver-side report: row and column counts, types, nulls, duplicates, distinct counts, likely id and target columns."""
    rows = df.count()
    distinct = {r["column"]: r["distinct_values"] for r in distinct_report(df).collect()}
    return {
        "rows": rows, "columns": len(df.columns), "dtypes": dict(df.dtypes), "nulls": {r["column"]: r["nulls"] for r in null_report(df).collect()},
        "duplicate_rows": duplicate_report(df).first()["duplicate_rows"], "distinct": distinct,
        "id_candidates": [c for c in df.columns if "id" in c.lower() and rows and distinct[c] / rows > 0.9], "target_candidates": [c for c in df.columns if any(w == c.lower() or w in c.lower().split("_") for w in target_words)],
    }


def impute_medians(df: DataFrame, columns: list[str] | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Nulls of numeric columns filled with the column's median; all medians share their scans."""
    cols = columns or numeric_columns(df, skip)
    if not cols:
        return df
    medians = quantiles(df, {c: F.col(c) for c in cols}, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double")) for c in cols})


def preprocess(df: DataFrame, id_column: str, text_columns: tuple[str, ...] = (), unicode_form: bool = True) -> DataFrame:
    """Distinct rows; text columns cleaned; numbers imputed by median; string columns stripped and lower-cased. The id stays as it is."""
    out = df.dropDuplicates()
    out = out.withColumns({c: T.clean_etl(F.col(c), unicode_form) for c in text_columns if c in df.columns})
    out = impute_medians(out, skip=(id_column,))
    return out.withColumns({c: F.lower(F.trim(c)) for c in string_columns(df, (id_column,))})
