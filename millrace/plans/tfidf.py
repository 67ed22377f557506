"""TF-IDF over character 3-grams as relations: postings, pair cosine and top-k similarity join.

weight = tf * (ln((1 + n) / (1 + df)) + 1), rows scaled to length 1, cosine = sum of products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import char_trigrams
from millrace.session import shared_folder, written

#: A right name's heaviest grams by which top_k's first pass finds it, and right names that a block of that pass is made for.
RARE = 3
RARE_ROWS = 1000
#: Grams of a side that a block of the second pass is made for: at least, and at most in parts of the whole up to GRAMS_MOST.
GRAMS_LEAST, PARTS, GRAMS_MOST = 100_000, 4, 2_000_000
#: Sums and bounds are compared with this margin.
NEAR = 1e-7


def postings(names: DataFrame, max_features: int | None = None) -> DataFrame:
    """names (id, name) -> (id, gram, w). Every row counts in n, also one without grams. max_features keeps the grams with
    the most occurrences (ties by gram). A column `docs` says how many documents of the corpus a row stands for, `rows` how many of its rows."""
    names = names.withColumns({c: F.lit(1) for c in ("docs", "rows") if c not in names.columns})
    grams = names.select("id", "docs", F.explode(char_trigrams(F.col("name"))).alias("gram")).groupBy("id", "gram").agg(F.count(F.lit(1)).alias("tf"), F.max("docs").alias("docs"))
    df = grams.groupBy("gram").agg(F.sum("docs").alias("df"), F.sum(F.col("tf") * F.col("docs")).alias("total"))
    if max_features:
        df = df.orderBy(F.desc("total"), "gram").limit(max_features)
    n = names.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))  # one row
    idf = df.crossJoin(F.broadcast(n)).select("gram", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    raw = grams.join(idf, "gram").select("id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    norm = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "id").select("id", "gram", (F.col("w") / F.col("norm")).alias("w"))


def pair_cosine(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """pairs (a, b) -> (a, b, cosine): 0 for pairs without a common gram. A pair makes a row for each gram of a, never more."""
    x, y = weights.select(F.col("id").alias("a"), "gram", F.col("w").alias("x")), weights.select(F.col("id").alias("b"), "gram", F.col("w").alias("y"))
    return pairs.join(x, "a", "left").join(y, ["b", "gram"], "left").groupBy("a", "b").agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0.0)).alias("cosine"))


class _Side:
    """Vectors of a block as arrays: row i has the codes and weights from ptr[i] to ptr[i + 1]."""

    def __init__(self, t: pa.Table, codes: np.ndarray):
        self.sizes = pc.list_value_length(t["grams"]).to_numpy().astype(np.int64)
        self.ptr = np.concatenate([[0], np.cumsum(self.sizes)])
        self.codes, self.w = codes, pc.list_flatten(t["ws"]).to_numpy()
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)


def _nearest(left: pa.Table, right: pa.Table, k: int, floor: float):
    """(i, rows of right, their cosines, bound) for each left row i: all right rows whose cosine is over floor and can be among its k best, and
    the least that can. left: grams, ws, bound; right: grams, ws, copies.

    The grams of a left row are taken rarest first; sums over them find rows, and what the rest can add bounds all others (Cauchy-Schwarz).
    More grams are taken until the rest alone stays under the k-th best cosine found so far."""
    every = pa.concat_arrays([c for t in (left, right) for c in pc.list_flatten(t["grams"]).chunks]).dictionary_encode()
    codes, cut = every.indices.to_numpy(), pc.sum(pc.list_value_length(left["grams"])).as_py()
    l, r = _Side(left, codes[:cut]), _Side(right, codes[cut:])
    order = np.argsort(r.codes, kind="stable")
    rows, ws, at = r.row[order], r.w[order], np.searchsorted(r.codes[order], np.arange(len(every.dictionary) + 1))
    df = np.diff(at)
    order = np.lexsort((df[l.codes], l.row))
    l.codes, l.w = l.codes[order], l.w[order]
    bounds, copies, dense = left["bound"].to_numpy(), right["copies"].to_numpy(), np.zeros(len(df))

    def exact(at: np.ndarray) -> np.ndarray:
        size = r.sizes[at]
        first = np.cumsum(size) - size
        own = np.repeat(r.ptr[at] - first, size) + np.arange(size.sum())
        return np.add.reduceat(dense[r.codes[own]] * r.w[own], first)

    for i in range(left.num_rows):
        g, w = l.codes[l.ptr[i] : l.ptr[i + 1]], l.w[l.ptr[i] : l.ptr[i + 1]]
        g, w = g[keep := df[g] > 0], w[keep]
        rest = np.append(np.sqrt(np.cumsum(w[::-1] ** 2)[::-1]), 0.0)
        bound = max(bounds[i], floor)
        if rest[0] < bound - NEAR:
            continue
        dense[g] = w
        known, p = bounds[i] > floor, 0
        while True:
            # Half of what must be reached stays for the rest; a bound that isn't known yet is taken for 1.
            p = max(p + 1, int(np.searchsorted(-rest, -0.5 * (bound if known else 1.0), "right")))
            p = min(p, len(g))
            parts = [slice(at[x], at[x + 1]) for x in g[:p]]
            sums = np.bincount(np.concatenate([rows[x] for x in parts]), np.concatenate([ws[x] * v for x, v in zip(parts, w[:p], strict=True)]), right.num_rows)
            found = np.flatnonzero(sums)
            partial = sums[found]
            if not known:
                top = found[np.argpartition(-partial, min(4 * k, len(found)) - 1)[: 4 * k]]
                cosine = exact(top)
                order = np.argsort(-cosine)
                enough = np.searchsorted(np.cumsum(copies[top[order]]), k)
                bound = max(bound, cosine[order[enough]] if enough < len(top) else floor)
                known = p == len(g) or bound > floor
            if p == len(g) or rest[p] < bound - NEAR:
                break
        found = found[partial >= bound - NEAR - rest[p]]
        cosine = exact(found) if len(found) else np.zeros(0)
        ok = (cosine > floor) & (cosine >= bound - NEAR)
        yield i, found[ok], cosine[ok], bound
        dense[g] = 0.0


def _bounds(k: int, floor: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = [(i, bound) for i, _, _, bound in _nearest(left, right, k, floor)] if left.num_rows and right.num_rows else []
        return pa.table({"a": left["name"].take(pa.array([i for i, _ in got], pa.int64())), "bound": pa.array([b for _, b in got], pa.float64())})

    return run


def _found(k: int, floor: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, c = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if left.num_rows and right.num_rows:
            place = np.empty(right.num_rows, np.int64)
            place[pc.sort_indices(right["first"]).to_numpy()] = np.arange(right.num_rows)
            for i, rows, cosine, _ in _nearest(left, right, k, floor):
                best = np.lexsort((place[rows], -np.round(cosine, 9)))[:k]
                a.append(np.full(len(best), i))
                b.append(rows[best])
                c.append(cosine[best])
        a, b = pa.array(np.concatenate(a)), pa.array(np.concatenate(b))
        return pa.table({"a": left["name"].take(a), "b": right["name"].take(b), "first": right["first"].take(b), "cosine": np.concatenate(c)})

    return run


def top_k(left: DataFrame, right: DataFrame, k: int, floor: float = 0.2, max_features: int | None = None) -> DataFrame:
    """For each left (id, name) the k right rows of greatest cosine over `floor`: (a, b, cosine), ties by id.

    Rows with equal names are one vector, which counts as often as it occurs; ids come back at the end: of a right name only its k
    first can be among the k best. No pair of names is lost. A first pass finds what a left name's k-th best must reach, among right names with
    its heaviest gram; a second holds blocks of left names against blocks of right ones by inverted lists, and leaves a pair as soon as it
    can't reach that (see _nearest).
    Names are taken as corpus rows of both sides; rows with the same id are one document. Ranks are on the cosine rounded to nine places."""
    spark, where = left.sparkSession, shared_folder(left.sparkSession)
    tag = lambda d, s: d.select(F.concat(F.lit(s), F.col("id").cast("string")).alias("id"), "name")
    docs = tag(left, "l").unionByName(tag(right, "r")).groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("name")), " ").alias("name"), F.count(F.lit(1)).alias("rows"))
    docs = written(docs.select(F.substring("id", 1, 1).alias("side"), F.expr("substring(id, 2)").alias("id"), "name", "rows"), where, "documents")
    of = lambda s, c: F.when(F.col("side") == s, c)
    names = written(docs.groupBy("name").agg(F.count(F.lit(1)).alias("docs"), F.sum("rows").alias("rows"), F.count(of("l", F.lit(1))).alias("lefts"), F.least(F.count(of("r", F.lit(1))), F.lit(k)).alias("copies"), F.min(of("r", F.col("id"))).alias("first")), where, "names")
    w = postings(names.select(F.col("name").alias("id"), "name", "docs", "rows"), max_features)
    grams = w.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("w"), "gram"))).alias("x")).select(F.col("id").alias("name"), F.col("x.gram").alias("grams"), F.transform("x.w", lambda v: -v).alias("ws"))
    vectors = written(names.select("name", "lefts", "copies", "first").join(grams, "name"), where, "vectors")
    again = spark.read.schema(vectors.schema).parquet(f"{where}/vectors")  # columns of its own, for the cogroups
    l, r = vectors.where("lefts > 0").select("name", "grams", "ws"), again.where("copies > 0").select("name", "grams", "ws", "copies", "first")
    n, lg, rg = vectors.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in (F.expr("int(copies > 0)"), F.expr("if(lefts > 0, size(grams), 0)"), F.expr("if(copies > 0, size(grams), 0)")))).first()

    homes = max(1, n // max(1, RARE_ROWS))
    home = lambda g: F.pmod(F.xxhash64(g), F.lit(homes))
    at_home = r.withColumn("home", F.explode(F.array_distinct(F.transform(F.slice("grams", 1, RARE), home))))
    known = l.withColumns({"home": home(F.element_at("grams", 1)), "bound": F.lit(0.0)}).groupBy("home").cogroup(at_home.groupBy("home")).applyInArrow(_bounds(k, floor), "a string, bound double")

    blocks = lambda total: max(1, round(total / min(GRAMS_MOST, max(GRAMS_LEAST, total // PARTS))))
    lefts, rights = blocks(lg), blocks(rg)
    l = l.join(known.withColumnRenamed("a", "name"), "name", "left").withColumns({"bound": F.coalesce("bound", F.lit(0.0)), "i": F.pmod(F.xxhash64("name"), F.lit(lefts)), "j": F.explode(F.sequence(F.lit(0), F.lit(rights - 1)))})
    r = r.withColumns({"j": F.pmod(F.xxhash64("name"), F.lit(rights)), "i": F.explode(F.sequence(F.lit(0), F.lit(lefts - 1)))})
    block = (F.col("i") * rights + F.col("j")).cast("long").alias("block")
    found = l.groupBy(block).cogroup(r.groupBy(block)).applyInArrow(_found(k, floor), "a string, b string, first string, cosine double").withColumn("cosine", F.round("cosine", 9))
    first = lambda d, by, *order: d.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k).drop("rank")
    found = first(found, "a", F.desc("cosine"), "first").drop("first")
    ids = lambda s: docs.where(F.col("side") == s)
    rows = found.join(first(ids("r").select("id", F.col("name").alias("b")), "b", "id"), "b")
    best = first(rows.select("a", F.col("id").alias("b"), "cosine"), "a", F.desc("cosine"), "b")
    return ids("l").select(F.col("name").alias("n"), F.col("id").alias("a")).join(best.withColumnRenamed("a", "n"), "n").select("a", "b", "cosine")
