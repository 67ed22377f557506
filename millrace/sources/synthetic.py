"""Generators of test inputs, from row numbers and hashes: the same on any cluster, and of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _draw(seed: int, salt: str, n: int, key: Column | None = None) -> Column:
    """A number from 0 to n - 1."""
    return F.pmod(F.xxhash64(F.lit(f"{seed}:{salt}"), F.col("id") if key is None else key), F.lit(n)).cast("int")


def _pick(seed: int, salt: str, values: list[str], key: Column | None = None) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), _draw(seed, salt, len(values), key) + 1)


def tabular(spark: SparkSession, rows: int = 1000, classes: int = 3, seed: int = 42) -> DataFrame:
    """id, text, category, brand, color, price, weight_kg, rating, num_reviews, target; 5 % nulls in text and weight_kg; `part` is train for the first 80 %."""
    kinds = ["audio", "books", "garden", "kitchen", "office", "outdoor", "sports", "toys"]
    sentence = F.concat_ws(" ", F.lit("This"), _pick(seed, "adj", ["sturdy", "light", "simple", "bright", "quiet"]), _pick(seed, "cat", kinds), F.lit("item works well."))
    return spark.range(rows).select(
        F.format_string("SYNTH_%06d", F.col("id")).alias("id"), F.when(_draw(seed, "nt", 20) > 0, F.repeat(F.concat(sentence, F.lit(" ")), F.lit(1) + _draw(seed, "rep", 3))).alias("text"),
        _pick(seed, "cat", kinds).alias("category"), _pick(seed, "brand", ["Alder", "Birch", "Cedar", "Elm", "Fir", "Oak"]).alias("brand"),
        _pick(seed, "color", ["black", "blue", "green", "grey", "red", "white", "yellow"]).alias("color"), (5 + _draw(seed, "price", 49501) / 100).alias("price"),
        F.when(_draw(seed, "nw", 20) > 0, F.round(0.1 + _draw(seed, "w", 4991) / 100, 2)).alias("weight_kg"), (1 + _draw(seed, "rate", 41) / 10).alias("rating"),
        _draw(seed, "rev", 10000).alias("num_reviews"), _draw(seed, "target", classes).alias("target"), F.when(F.col("id") < int(0.8 * rows), "train").otherwise("test").alias("part"),
    )


def entity_resolution(spark: SparkSession, n: int = 50, match: float = 0.6, third: float = 0.3, distractors: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(entities with source and split, ground truth): noisy copies of source 1 in sources 2 and 3, plus records of their own; 70 % of source 1 train."""
    nouns = ["Anchor", "Beacon", "Cobalt", "Delta", "Ember", "Falcon", "Granite", "Harbor", "Iris", "Juniper", "Kestrel", "Lumen"]
    lines = ["Foods", "Logistics", "Marine", "Optics", "Paper", "Textiles", "Tools", "Transit"]
    tails = ["Inc", "LLC", "Ltd", "Corp", "& Co"]
    streets = ["Main Street", "Oak Avenue", "Hill Road", "River Drive", "Rue de Lyon"]
    name = lambda k: F.concat_ws(" ", _pick(seed, "noun", nouns, k), _pick(seed, "line", lines, k), k.cast("string"), _pick(seed, "tail", tails, k))
    address = lambda k: F.concat_ws(" ", (_draw(seed, "no", 900, k) + 1).cast("string"), _pick(seed, "street", streets, k), (10000 + _draw(seed, "zip", 89999, k)).cast("string"))
    country = lambda k: _pick(seed, "country", ["US", "India", "France"], k)
    noisy_name = lambda k, s: F.when(_draw(seed, s + "n", 4, k) == 0, F.upper(name(k))).when(_draw(seed, s + "n", 4, k) == 1, F.replace(name(k), F.lit("&"), F.lit("and"))).when(_draw(seed, s + "n", 4, k) == 2, F.concat(F.lit("  "), F.replace(name(k), F.lit("Inc"), F.lit("Incorporated")))).otherwise(name(k))
    noisy_address = lambda k, s: F.when(_draw(seed, s + "a", 3, k) == 0, F.lower(address(k))).when(_draw(seed, s + "a", 3, k) == 1, F.replace(F.replace(address(k), F.lit("Street"), F.lit("St")), F.lit("Avenue"), F.lit("Ave"))).otherwise(address(k))
    share = lambda s, p: _draw(seed, s, 10000) < int(p * 10000)
    base, k = spark.range(n), F.col("id")
    row = lambda i, idc, nm, ad, ct: (idc.alias("entity_id"), nm.alias("business_name"), ad.alias("business_address"), ct.alias("country"), F.lit(i).alias("source"))
    one = base.select(*row(1, F.format_string("s1_%06d", k), name(k), address(k), country(k)), F.when(k < int(0.7 * n), "train").otherwise("test").alias("split"))
    two, three = base.where(share("m2", match)), base.where(share("m2", match) & share("m3", third))
    copies = two.select(*row(2, F.format_string("s2_%06d", k), noisy_name(k, "2"), noisy_address(k, "2"), country(k))).unionByName(three.select(*row(3, F.format_string("s3_%06d", k), noisy_name(k, "3"), noisy_address(k, "3"), country(k))))
    other = spark.range(distractors)
    for i in (2, 3):
        far = F.col("id") + F.lit(n * i + 1_000_000)
        copies = copies.unionByName(other.select(*row(i, F.format_string(f"s{i}_x%06d", k), name(far), address(far), country(far))))
    both = copies.withColumn("split", F.explode(F.array(F.lit("train"), F.lit("test"))))  # the same in both splits
    truth = base.where(k < int(0.7 * n)).select(
        F.format_string("s1_%06d", k).alias("source1_entity_id"),
        F.array_join(F.filter(F.array(F.when(share("m2", match), F.format_string("s2_%06d", k)), F.when(share("m2", match) & share("m3", third), F.format_string("s3_%06d", k))), lambda x: x.isNotNull()), ",").alias("matched_entity_ids"),
    )
    return one.unionByName(both), truth


def truth_aware_sample(left: DataFrame, right: DataFrame, truth: DataFrame, n: int, negatives: float = 2.5, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """n left entities by hash (the last max(1, 30 %) as test), their true matches, and negatives * as many other right entities."""
    from millrace.operators.submission import explode_truth

    order = lambda c: [F.md5(F.concat(F.lit(f"{seed}:"), F.col(c))), F.col(c)]
    ranked = left.orderBy(*order("entity_id")).limit(n)
    size = ranked.count()
    last = ranked.orderBy(*(x.desc() for x in order("entity_id"))).limit(max(1, int(0.3 * size))).select("entity_id").withColumn("_t", F.lit(1))
    chosen = ranked.join(last, "entity_id", "left").withColumn("split", F.when(F.col("_t") == 1, "test").otherwise("train")).drop("_t")
    gt = explode_truth(truth).join(chosen.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    wanted = gt.select(F.col("source2_entity_id").alias("entity_id")).distinct()
    true = right.join(wanted, "entity_id", "left_semi")
    extra = right.join(wanted, "entity_id", "left_anti").orderBy(*order("entity_id")).limit(int(negatives * true.count()))
    return chosen, true.unionByName(extra), gt
