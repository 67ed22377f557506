"""Stable shards and deterministic splits by md5 of the id: the same on every machine, in Spark and in SQL."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _md5_number(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def shard_of(id_column: str, total: int) -> Column:
    if total < 1:
        raise ValueError("total must be positive")
    return F.pmod(_md5_number(F.col(id_column).cast("string")), F.lit(total))


def get_shard(df: DataFrame, id_column: str, worker: int, total: int) -> DataFrame:
    if id_column not in df.columns:
        raise ValueError(f"no column {id_column}")
    if not 0 <= worker < total:
        raise ValueError(f"worker {worker} is not in 0..{total - 1}")
    return df.where(shard_of(id_column, total) == worker)


def shard_histogram(df: DataFrame, id_column: str, total: int) -> DataFrame:
    return df.select(shard_of(id_column, total).alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))


def verify_shards(df: DataFrame, shards: list[DataFrame], id_column: str) -> DataFrame:
    """One row: total_ids, covered_ids, overlapping_ids, complete."""
    parts = None
    for i, s in enumerate(shards):
        one = s.select(F.col(id_column).cast("string").alias("id"), F.lit(i).alias("shard")).distinct()
        parts = one if parts is None else parts.unionByName(one)
    per = parts.groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    every = df.select(F.col(id_column).cast("string").alias("id")).distinct().withColumn("here", F.lit(1))
    out = every.join(per, "id", "full").agg(F.count("here").alias("total_ids"), F.sum((F.col("here").isNotNull() & F.col("c").isNotNull()).cast("long")).alias("covered_ids"), F.sum((F.col("c") > 1).cast("long")).alias("overlapping_ids"))
    return out.select("total_ids", "covered_ids", F.coalesce("overlapping_ids", F.lit(0)).alias("overlapping_ids"), (F.col("covered_ids") == F.col("total_ids")).alias("complete"))


def _order(id_column: str, seed: int) -> list[Column]:
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))), F.col(id_column)]


def _cut(df: DataFrame, id_column: str, count: int, seed: int, where: Column | str = "true") -> Column:
    """Whether a row is among the `count` first by hash. The bound is found by a distributed top-k, not by a global window."""
    hash_ = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    if count <= 0:
        return F.lit(False)
    # The count-th smallest hash by a search over hash prefixes: counts per prefix are small aggregates.
    prefix, before = "", 0
    while True:
        width = len(prefix) + 3
        rows = df.where(where).where(F.substring(hash_, 1, len(prefix)) == prefix).groupBy(F.substring(hash_, 1, width).alias("p")).agg(F.count(F.lit(1)).alias("c")).orderBy("p").collect()  # 4096 rows at most
        for r in rows:
            if before + r["c"] >= count:
                prefix = r["p"]
                break
            before += r["c"]
        else:
            return F.lit(True)
        if before + r["c"] == count or width >= 30:
            return hash_ < F.lit(prefix + "g")  # all of this prefix


def split_random(df: DataFrame, id_column: str, fraction: float, seed: int = 42) -> DataFrame:
    """df with `split` (train/val): ceil(fraction * rows) rows with the smallest hashes are val. Repeated ids go together."""
    n = df.count()
    if n == 0:
        raise ValueError("empty input")
    count = -(-Fraction(str(fraction)) * n // 1)
    return df.withColumn("split", F.when(_cut(df, id_column, int(count), seed), "val").otherwise("train"))


def split_stratified(df: DataFrame, id_column: str, target: str, fraction: float, seed: int = 42) -> DataFrame:
    """Each class is cut by the fraction (largest remainders make up the total); random if a class has one row or the target is absent."""
    if target not in df.columns:
        return split_random(df, id_column, fraction, seed)
    counts = {r[0]: r[1] for r in df.groupBy(target).count().collect()}  # one row per class
    if not counts:
        raise ValueError("empty input")
    if min(counts.values()) < 2:
        return split_random(df, id_column, fraction, seed)
    f = Fraction(str(fraction))
    want = {c: f * n for c, n in counts.items()}
    take = {c: int(w) for c, w in want.items()}
    rest = int(-(-f * sum(counts.values()) // 1)) - sum(take.values())
    for c in sorted(counts, key=lambda c: (take[c] - want[c], str(c)))[:rest]:
        take[c] += 1
    # Each class by its own bound: no task sorts a class.
    val = F.lit(False)
    for c, n in take.items():
        own = F.col(target).eqNullSafe(F.lit(c))
        val |= own & _cut(df, id_column, n, seed, own)
    return df.withColumn("split", F.when(val, "val").otherwise("train"))


def split_group(df: DataFrame, id_column: str, group: str, fraction: float, seed: int = 42) -> DataFrame:
    """A fraction of the groups is val; no group is on both sides. Random by rows if the group column is absent."""
    if group not in df.columns:
        return split_random(df, id_column, fraction, seed)
    groups = df.select(group).distinct()
    return df.join(split_random(groups, group, fraction, seed), group).select(*df.columns, "split")


def split(df: DataFrame, id_column: str, method: str = "random", fraction: float = 0.2, target: str | None = None, group: str | None = None, seed: int = 42) -> DataFrame:
    if method == "stratified" and target:
        return split_stratified(df, id_column, target, fraction, seed)
    if method == "group" and group:
        return split_group(df, id_column, group, fraction, seed)
    return split_random(df, id_column, fraction, seed)


def hash_folds(df: DataFrame, group: str, folds: int) -> DataFrame:
    """df with `fold`: groups dealt out by hash. For any number of groups."""
    return df.withColumn("fold", shard_of(group, folds))


def _deal(loads: list[int], size: int, n: int) -> list[tuple[int, int, list[int]]]:
    """Deals n groups of one size to the lightest fold each, ties by number, and adds to the loads: (first rank, rank after the
    last, folds in turn). The folds that are lighter than the lightest's next load take turns until another fold is as light,
    so there are at most as many parts as folds."""
    out, at = [], 0
    while at < n:
        order = sorted((load, i) for i, load in enumerate(loads))
        turn = [x for x in order if x < (order[0][0] + size, order[0][1])]
        left, (last, i) = n - at, turn[-1]
        if len(turn) < len(order):
            more, k = order[len(turn)]
            rounds = (more - last) // size + 1 - ((more - last) % size == 0 and i > k)
            left = min(left, rounds * len(turn))
        for place, (_, f) in enumerate(turn):
            loads[f] += size * (left // len(turn) + (place < left % len(turn)))
        out.append((at, at + left, [f for _, f in turn]))
        at += left
    return out


def balanced_folds(df: DataFrame, group: str, folds: int) -> DataFrame:
    """df with `fold`: the largest group goes to the lightest fold, ties by group and by fold, at any number of groups.

    The driver holds the distinct sizes, not the groups: groups of one size are dealt by their rank. Ranks are counted in
    slices of the groups' order, so no task ranks all groups of a size."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_c"))
    counts = [(r[0], r[1]) for r in sizes.groupBy("_c").agg(F.count(F.lit(1))).orderBy(F.desc("_c")).collect()]  # one row per distinct size
    n = sum(x for _, x in counts)
    loads = [0] * min(folds, max(1, n))
    plan = [(c, *x) for c, k in counts for x in _deal(loads, c, k)]
    table = df.sparkSession.createDataFrame(plan, "_c long, _from long, _to long, _turn array<int>")
    few = sorted(r[0] for r in sizes.where(F.col(group).isNotNull()).select(group).sample(min(1.0, 2000 / max(1, n)), seed=1).collect())  # about 2,000 groups
    step = max(1, len(few) // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = F.array(*(F.lit(x).cast(df.schema[group].dataType) for x in few[step::step])).cast(f"array<{df.select(group).schema[0].dataType.simpleString()}>")
    sliced = sizes.withColumn("_s", F.coalesce(F.size(F.filter(bounds, lambda x: x <= F.col(group))), F.lit(-1)))
    before = sliced.groupBy("_c", "_s").agg(F.count(F.lit(1)).alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("_c").orderBy("_s")) - F.col("_n")).drop("_n")
    ranked = sliced.withColumn("_r", F.row_number().over(Window.partitionBy("_c", "_s").orderBy(group)) - 1)
    ranked = ranked.join(before, ["_c", "_s"]).withColumn("_r", F.col("_r") + F.col("_before"))
    dealt = ranked.join(table, "_c").where("_r >= _from and _r < _to").select(group, F.expr("_turn[cast((_r - _from) % size(_turn) as int)]").alias("fold"))
    return df.join(dealt, group)


def sample_rows(df: DataFrame, id_column: str, count: int, seed: int = 42) -> DataFrame:
    """Up to count rows in order of a hash of the id."""
    return df.orderBy(*_order(id_column, seed)).limit(count)


def balanced_sample(df: DataFrame, id_column: str, label: str, most: int, ratio: float, seed: int = 42) -> DataFrame:
    """min(positives, most // 2) rows of label 1 and min(negatives, int(positives taken * ratio)) of label 0, by hash."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    pos = min(counts.get(1, 0), most // 2)
    neg = min(counts.get(0, 0), int(pos * ratio))
    return df.where((F.col(label) == 1) & _cut(df, id_column, pos, seed, F.col(label) == 1) | (F.col(label) == 0) & _cut(df, id_column, neg, seed, F.col(label) == 0))
