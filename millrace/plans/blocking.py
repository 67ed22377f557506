"""Candidate generation: equi-joins on derived keys with a cap on bucket size, and a TF-IDF top-k join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans import tfidf
from millrace.session import shared_folder, written


def first_word_key(profile: str = "v3") -> Column:
    """First word of the name (two characters or more) and country; null without one."""
    first = F.regexp_extract("business_name_norm", "^ *([^ ]+)", 1)
    return F.when(F.length(first) >= 2, F.concat_ws("|", first, F.col("country_norm")))


def numeric_key() -> Column:
    """First three of the sorted distinct digit runs of the address, and country; null without one."""
    numbers = F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all("business_address_norm", F.lit(r"(\d+)")))), 1, 3)
    return F.when(F.size(numbers) > 0, F.concat_ws("|", F.array_join(numbers, "|"), F.col("country_norm")))


def two_word_key() -> Column:
    """First two words of the name, and country; null for fewer words."""
    word = lambda i: F.regexp_extract("business_name_norm", "^ *([^ ]+) +([^ ]+)", i)
    return F.when(word(2) != "", F.concat_ws("|", F.concat_ws(" ", word(1), word(2)), F.col("country_norm")))


def _keyed(sources: list[DataFrame], keys: list[Column]) -> DataFrame:
    """(entity_id, _source, k0, k1, ...) of all sources."""
    return reduce(DataFrame.unionByName, (d.select("entity_id", F.lit(i).alias("_source"), *(k.alias(f"k{j}") for j, k in enumerate(keys))) for i, d in enumerate(sources)))


def _joined(l: DataFrame, r: DataFrame, n: int, sources: int, cap: int | None, once: bool = False) -> DataFrame:
    """Pairs of keyed sides. once: rows carry their keys of the kinds before, and a pair that those find is left out; ids must be unique then, and
    nothing capped."""
    earlier = [f"e{j}" for j in range(n - 1)] if once else []

    def rows(d: DataFrame, name: str) -> DataFrame:
        x = d.select(F.col("entity_id").alias(name), "_source", *(f"k{j}" for j in range(n)), F.posexplode(F.array(*(f"k{j}" for j in range(n)))).alias("_kind", "_key")).where("_key is not null")
        return x.select(name, "_source", "_kind", "_key", *(F.when(F.col("_kind") > j, F.col(f"k{j}")).alias(e) for j, e in enumerate(earlier)))

    by = ["_source", "_kind", "_key"]
    l, r = rows(l, "source1_entity_id"), rows(r, "source2_entity_id")
    if cap is not None:
        r = r.join(r.groupBy(*by).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") < cap).drop("_c"), by)
    if sources > 1:
        l = l.drop("_source").withColumn("_source", F.explode(F.array(*(F.lit(i) for i in range(sources)))))
    out = l.select(*by, "source1_entity_id", *(F.col(e).alias(f"l{e}") for e in earlier)).join(r, by)
    for e in earlier:
        out = out.where(~F.coalesce(F.col(f"l{e}") == F.col(e), F.lit(False)))
    return out.select("source1_entity_id", "source2_entity_id")


def keys_join(left: DataFrame, sources: list[DataFrame], keys: list[Column], cap: int | None = None) -> DataFrame:
    """Pairs with equal keys of the same kind, one row for each kind that finds them. cap: a key with that many rows of a source or more makes
    none with it.

    A side's keys of all kinds are rows (source, kind, key) of one join. Bucket sizes are a partial aggregate over the right rows as they are
    dealt out for the join, so a hot key is dropped before it meets the left side; without a cap Spark's skew join splits it."""
    return _joined(_keyed([left], keys), _keyed(sources, keys), len(keys), len(sources), cap)


def key_join(left: DataFrame, right: DataFrame, key: Column, cap: int | None = None) -> DataFrame:
    return keys_join(left, [right], [key], cap)


def similar_names(left: DataFrame, right: DataFrame, k: int, floor: float = 0.2) -> DataFrame:
    valid = lambda d: d.where(F.length("business_name_norm") >= 2).select(F.col("entity_id").alias("id"), F.col("business_name_norm").alias("name"))
    return tfidf.top_k(valid(left), valid(right), k, floor).select(F.col("a").alias("source1_entity_id"), F.col("b").alias("source2_entity_id"))


def _unique(keyed: DataFrame) -> bool:
    return keyed.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def candidates(left: DataFrame, sources: list[DataFrame], profile: str = "v3", cap: int | None = 50, k: int | None = None, names: bool = True) -> DataFrame:
    """Distinct union of all passes over all sources. Profile v1/v2: no cap, no two-word pass, k = 10; v3: cap, k = 5.

    Keys are computed once and written. Without a cap pairs can be far more than rows; then each pass leaves out what an earlier one finds, and
    pairs needn't be shuffled to be distinct, unless an id occurs twice."""
    cap, k = (cap if profile == "v3" else None), k or (5 if profile == "v3" else 10)
    keys = [first_word_key(profile), numeric_key(), *([two_word_key()] if profile == "v3" else [])]
    where = shared_folder(left.sparkSession)
    l, r = written(_keyed([left], keys), where, "left_keys"), written(_keyed(sources, keys), where, "right_keys")
    once = cap is None and _unique(l) and _unique(r)
    out = _joined(l, r, len(keys), len(sources), cap, once)
    for i, right in enumerate(sources if names else ()):
        found = similar_names(left, right, k)
        if once:
            mine = l.select(F.col("entity_id").alias("source1_entity_id"), *(F.col(f"k{j}").alias(f"l{j}") for j in range(len(keys))))
            found = found.join(mine, "source1_entity_id").join(r.where(F.col("_source") == i).withColumnRenamed("entity_id", "source2_entity_id"), "source2_entity_id")
            for j in range(len(keys)):
                found = found.where(~F.coalesce(F.col(f"l{j}") == F.col(f"k{j}"), F.lit(False)))
            found = found.select("source1_entity_id", "source2_entity_id")
        out = out.unionByName(found)
    return out if once else out.distinct()


def recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: recall, gt_pairs, found; recall 0 without truth."""
    gt = truth.select("source1_entity_id", "source2_entity_id").distinct().withColumn("_gt", F.lit(1))
    hit = gt.join(pairs.select("source1_entity_id", "source2_entity_id").distinct().withColumn("_hit", F.lit(1)), ["source1_entity_id", "source2_entity_id"], "left")
    out = hit.agg(F.count("_gt").alias("gt_pairs"), F.count("_hit").alias("found"))
    return out.select("gt_pairs", "found", F.when(F.col("gt_pairs") > 0, F.col("found") / F.col("gt_pairs")).otherwise(0.0).alias("recall"))
