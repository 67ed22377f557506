"""Document fingerprints: a Merkle tree over sections, paragraphs and leaves. Built-in functions only.

Leaves are sentences, cut after LEAF_WORDS words, under paragraphs (lines), under sections (parts between blank lines), under one root.
A fingerprint holds the root and every branch: `root;section{paragraph:leaf,leaf/paragraph:leaf};section{...}`. Equal roots mean equal
texts; else the first differing section, in it the first differing paragraph and in that the first differing leaf locate where an edit
begins. The likeness of two fingerprints is 1 for equal roots, else the Dice coefficient of the distinct leaves that they list.

Defined results: a null text is an empty one; repeated doc_ids follow one another by their text; rows without a doc_id come first; a
single document's next document is itself; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_partitions

#: Rows that a range of doc_ids has on average in small tables, and ranges for each shuffle partition in large ones: a range is then as large as it must
#: be, and Spark's sort spills. Ranges are found by bounds on the driver.
RANGE_ROWS = 500
RANGES_EACH = 16
#: Words of a leaf at most, and characters of a piece of a word that counts as one.
LEAF_WORDS = 32
WORD_CHARS = 64


def tree(text: str) -> str:
    """SQL: array of sections of arrays of paragraphs of arrays of leaf hashes. Every character is in one leaf."""
    leaves = f"case when length(x) <= {LEAF_WORDS} then array(x) else regexp_extract_all(x, '(?s)(?:\\\\S{{1,{WORD_CHARS}}}+\\\\s*+|\\\\s++){{1,{LEAF_WORDS}}}+', 0) end"
    return (
        f"transform(split({text}, '(?<=\\n\\n)(?!\\n)', -1), s -> transform(split(s, '(?<=\\n)', -1), "
        f"p -> transform(flatten(transform(split(p, '(?<=[.!?|;:] )|(?<=[\u3002\uff01\uff1f])', -1), x -> {leaves})), x -> md5(x))))"
    )


def branches(tree_col: str) -> str:
    """SQL: array of struct(section hash, array of paragraph hashes, array of arrays of leaves)."""
    paras = "transform(s, p -> md5(concat_ws(',', p)))"
    return f"transform({tree_col}, s -> named_struct('h', md5(concat_ws(',', {paras})), 'p', {paras}, 'l', s))"


def fingerprint(branch_col: str) -> str:
    """SQL: the fingerprint string."""
    root = f"sha2(concat_ws(',', transform({branch_col}, b -> b.h)), 256)"
    para = "array_join(transform(sequence(1, size(b.p)), i -> concat(substring(b.p[i - 1], 1, 8), ':', array_join(transform(b.l[i - 1], x -> substring(x, 1, 8)), ','))), '/')"
    return f"concat({root}, ';', array_join(transform({branch_col}, b -> concat(substring(b.h, 1, 16), '{{', {para}, '}}')), ';'))"


def add_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df plus `name` (the fingerprint) and `name`_leaves (distinct leaves as the fingerprint lists them, for likeness)."""
    return (
        df.withColumn("_tree", F.expr(tree(text))).withColumn("_branch", F.expr(branches("_tree")))
        .withColumn(name, F.expr(fingerprint("_branch"))).withColumn(f"{name}_leaves", F.expr("array_distinct(transform(flatten(flatten(_tree)), x -> substring(x, 1, 8)))")).drop("_tree", "_branch")
    )


def likeness(a: str, b: str) -> str:
    """SQL: 0 to 1, from two fingerprint columns with their _leaves."""
    return f"case when substring({a}, 1, 64) = substring({b}, 1, 64) then 1.0D else 2.0D * size(array_intersect({a}_leaves, {b}_leaves)) / (size({a}_leaves) + size({b}_leaves)) end"


def first_difference(a: str, b: str) -> str:
    """SQL: `section/paragraph/leaf` (from 0) at which fingerprint b first differs from a; null for equal roots. A step down reads one branch's children."""
    first = lambda x, y: f"coalesce(array_min(filter(sequence(0, greatest(size({x}), size({y})) - 1), i -> not (get({x}, i) <=> get({y}, i)))), size({y}))"
    let = lambda name, value, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    parts = lambda f: f"slice(split({f}, ';'), 2, length({f}))"
    paras = lambda x: f"case when {x} is null then cast(array() as array<string>) else split(substring({x}, 18, length({x}) - 18), '/') end"
    leaves = lambda x: f"case when {x} is null then cast(array() as array<string>) else split(substring({x}, 10), ',') end"
    leaf = let("la", leaves("get(pa, j)"), let("lb", leaves("get(pb, j)"), f"concat_ws('/', n, j, {first('la', 'lb')})"))
    para = let("pa", paras("get(sa, n)"), let("pb", paras("get(sb, n)"), let("j", first("pa", "pb"), leaf)))
    return f"case when substring({a}, 1, 64) <> substring({b}, 1, 64) then " + let("sa", parts(a), let("sb", parts(b), let("n", first("sa", "sb"), para))) + " end"


def _bounds(ids: DataFrame) -> list[int]:
    """Doc_ids that cut the table into ranges of about RANGE_ROWS rows, or into RANGES_EACH for each shuffle partition if these are fewer."""
    n = ids.count()
    ranges = min(RANGES_EACH * shuffle_partitions(ids.sparkSession), max(1, math.ceil(n / RANGE_ROWS)))
    if ranges == 1:
        return []
    got = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], max(10_000, 4 * ranges))).first()[0]
    return sorted({x for x in got if x is not None})


def _range_of(bounds: list[int]) -> str:
    """SQL: how many bounds are at most doc_id, in two steps of about the square root of them."""
    if not bounds:
        return "0"
    size = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + size] for i in range(0, len(bounds), size)]
    lit = lambda xs: "array(" + ", ".join(f"{x}L" for x in xs) + ")"
    coarse = f"size(filter({lit([g[0] for g in groups])}, x -> x <= doc_id))"
    fine = f"size(filter(element_at(array({', '.join(lit(g) for g in groups)}), {coarse}), x -> x <= doc_id))"
    return f"case when {coarse} = 0 then 0 else ({coarse} - 1) * {size} + {fine} end"


def ranged(docs: DataFrame) -> DataFrame:
    """docs by ranges of doc_id (`_range`), each also with the next range's first rows (`_ghost` 1; after the last range: the
    first), so that a window over one range finds every row's next document."""
    bounds = _bounds(docs.select("doc_id"))
    placed = docs.withColumn("_range", F.expr(_range_of(bounds)))
    firsts = placed.select("doc_id", "_range").groupBy("_range").agg(F.min("doc_id").alias("_first")).orderBy("_range").collect()  # one row per range
    ahead = [(firsts[(i + 1) % len(firsts)]["_first"], r["_range"]) for i, r in enumerate(firsts)]
    edges = docs.sparkSession.createDataFrame(ahead, "doc_id long, _to int")  # a row for each range
    ghosts = placed.drop("_range").join(F.broadcast(edges), "doc_id").withColumnRenamed("_to", "_range")
    return placed.withColumn("_ghost", F.lit(0)).unionByName(ghosts.withColumn("_ghost", F.lit(1)))


def compare(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and edit_at: section/paragraph/leaf at which the edit begins."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63) + 1)).alias("doc_id"), F.col("doc_id").isNull().alias("_null"), F.coalesce("text", F.lit("")).alias("text"))
    window = Window.partitionBy("_range").orderBy("_ghost", "doc_id", "text")
    rows = add_fingerprint(ranged(rows).repartition(shuffle_partitions(docs.sparkSession), "_range"), "text", "fingerprint")
    for c in ("text", "fingerprint", "fingerprint_leaves"):
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(window))
    rows = rows.where("_ghost = 0").withColumn("n_chars", F.length("text").cast("long")).withColumn("_half", F.expr("cast(n_chars div 2 as int)"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars as int) - _half), substring(next_text, 1, _half))"))
    rows = add_fingerprint(rows, "edited", "edited_fingerprint")
    return rows.select(
        F.expr("case when not _null then doc_id end").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        F.expr(likeness("fingerprint", "edited_fingerprint")).alias("near_edited"), F.expr(likeness("fingerprint", "next_fingerprint")).alias("near_next"), F.expr(first_difference("fingerprint", "edited_fingerprint")).alias("edit_at"),
    )
