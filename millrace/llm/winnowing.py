"""Benchmark decontamination by winnowing.

Of each `window` consecutive k-gram hashes the smallest is kept as a fingerprint, in documents as in test items, with
k + window - 1 = span. Any span of that many words that a document shares with an item holds a shared fingerprint at
the same place, so joining fingerprints finds it. Each hit is extended left and right to the spans of words that chose the
fingerprint, in the document and in the items; extended spans that are equal (64-bit hashes) count, and overlapping ones
join into longer ones. Every word lies in at most `span` of them however often a passage repeats, and hits are never listed by
pairs of places. Items with fewer words are matched whole, by the hash of all their words.

A benchmark of at most BLOCK_WORDS words (counted) is broadcast, and no document is shuffled. For a larger one the documents'
extended spans whose fingerprint may be an item's are joined with the items' by hash, and nothing that is held grows with it.

Defined results: a null or empty text has no words, hits or items; an item without words never occurs; repeated item
ids count once in a document's items; items without an id are hit like others, together count as one item (a null in
`items`, the last) and only items_sha256 leaves them out; repeated doc_ids keep a row each; an empty table gives no rows; other
columns are ignored or, with keep, returned, but for those named like the results, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from millrace.llm.common import bit_map, int_column, materialise, shared_dir, slices, text_buffers
from millrace.llm.hashing import ALNUM, gram_hashes, mix, sliding_min, word_bounds, word_hashes

SPAN = 10
#: Words per k-gram; the winnowing window follows.
K = 5
#: Words of items that are broadcast at most: about 40 MB of arrays.
BLOCK_WORDS = 1_000_000
RESULT = {"n_words": "long", "spans": "array<long>", "items": "array<string>", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}


def window_minima(hashes: np.ndarray, runs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that lie in one run, by their first k-gram, and the place of the smallest k-gram of each; of equal ones the rightmost.
    runs: the text number of each k-gram."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The low bits carry the place, so one minimum gives value and place (rightmost first among equal high bits).
    place = (np.arange(n, dtype=np.uint64) ^ np.uint64(0xFFFFFF)) & np.uint64(0xFFFFFF)
    least = sliding_min((mix(hashes) & ~np.uint64(0xFFFFFF)) | place, window)
    first = np.flatnonzero(runs[: n - window + 1] == runs[window - 1 :])
    low = (least[first] & np.uint64(0xFFFFFF)) ^ np.uint64(0xFFFFFF)
    # Undo the cut to 24 bits: the place lies within the window.
    return first, first + ((low.astype(np.int64) - first) & 0xFFFFFF)


def fingerprints(hashes: np.ndarray, runs: np.ndarray, window: int) -> np.ndarray:
    """Places of kept k-grams."""
    return np.unique(window_minima(hashes, runs, window)[1])


def _salted(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of spans of n words, apart from those of other lengths."""
    return mix(hashes + np.uint64(n << 32))


def item_spans(words: np.ndarray, item: np.ndarray, items: int, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans that make a document hit: hash, words and item number of each; and the fingerprints that stand for those of `span` words."""
    long = gram_hashes(words, span)
    first = np.flatnonzero(item[: len(long)] == item[span - 1 : span - 1 + len(long)])
    grams = gram_hashes(words, k)
    own = item[: len(grams)]
    at = fingerprints(grams, np.where(own == item[k - 1 : k - 1 + len(grams)], own, -1 - np.arange(len(own))), span - k + 1)
    hashes, sizes, of = [_salted(long[first], span)], [np.full(len(first), span)], [item[first]]
    counts = np.bincount(item, minlength=items)
    start = np.cumsum(counts) - counts
    for m in range(1, span):
        if len(whole := np.flatnonzero(counts == m)):
            hashes.append(_salted(gram_hashes(words, m)[start[whole]], m))
            sizes.append(np.full(len(whole), m))
            of.append(whole)
    return np.concatenate(hashes), np.concatenate(sizes).astype(np.int64), np.concatenate(of).astype(np.int64), np.unique(grams[at])


def spans_to_test(words: np.ndarray, doc: np.ndarray, span: int, k: int, short: list[int], has) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, words and hash of each span of a text that an item may hold. has: whether fingerprints may be an item's."""
    firsts, sizes, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    grams = gram_hashes(words, k)
    if len(words) >= span:
        own = doc[: len(grams)]
        first, at = window_minima(grams, np.where(own == doc[k - 1 : k - 1 + len(grams)], own, -1 - np.arange(len(own))), span - k + 1)
        first = first[has(grams[at])]
        if len(first):  # nearly all fingerprints are nobody's
            firsts.append(first)
            sizes.append(np.full(len(first), span))
            hashes.append(_salted(gram_hashes(words, span)[first], span))
    for m in short:
        grams = gram_hashes(words, m)
        first = np.flatnonzero(doc[: len(grams)] == doc[m - 1 : m - 1 + len(grams)])
        firsts.append(first)
        sizes.append(np.full(len(first), m))
        hashes.append(_salted(grams[first], m))
    return np.concatenate(firsts), np.concatenate(sizes), np.concatenate(hashes)


def _in(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


class Items:
    """Spans of all items: sorted distinct hashes; classes of spans that the same items hold, and the items of each class."""

    def __init__(self, ids: list, raw: np.ndarray, offs: np.ndarray, span: int, k: int):
        start, end, item = word_bounds(raw, offs, ALNUM)
        hashes, sizes, of, self.prints = item_spans(word_hashes(raw, start, end), item, len(ids), span, k)
        self.span, self.k, self.short = span, k, sorted(set(sizes.tolist()) - {span})
        names = sorted({x for x in ids if x is not None}) + [None] * (None in ids)
        number = {x: i for i, x in enumerate(names)}
        self.names = np.array(names, object)
        of = np.array([number[x] for x in ids], np.int64)[of] if len(ids) else of
        by = np.lexsort((of, hashes))
        hashes, of = hashes[by], of[by]
        once = np.ones(len(hashes), bool)
        once[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        hashes, of = hashes[once], of[once]
        cut = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))[: len(hashes)]
        self.hashes = hashes[cut]
        ends = np.append(cut[1:], len(hashes))[: len(cut)]
        who = np.add.reduceat(mix(of.astype(np.uint64) + np.uint64(0xA11)), cut) if len(cut) else np.zeros(0, np.uint64)
        _, one, self.class_of = np.unique(who, return_index=True, return_inverse=True)
        size = (ends - cut)[one]
        self.ends = np.cumsum(size)
        self.of = of[np.repeat(cut[one] - (self.ends - size), size) + np.arange(int(size.sum()))]


def covered(first: np.ndarray, n: np.ndarray, total: int) -> np.ndarray:
    """Whether each of total words lies in one of the spans."""
    edge = np.bincount(first, minlength=total + 1) - np.bincount(first + n, minlength=total + 1)
    return np.cumsum(edge[:total]) > 0


def _runs(hit: np.ndarray, doc: np.ndarray, counts: np.ndarray) -> list[list[int]]:
    """Each text's maximal runs of hit words: first word, words, ..."""
    new = hit.copy()
    new[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
    last = hit.copy()
    last[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
    first, end = np.flatnonzero(new), np.flatnonzero(last) + 1
    base = np.cumsum(counts) - counts
    out: list[list[int]] = [[] for _ in counts]
    for a, z, d in zip(first.tolist(), end.tolist(), doc[first].tolist(), strict=True):
        out[d] += [a - int(base[d]), z - a]
    return out


def _columns(counts: np.ndarray, spans: list, names: list[list]) -> dict[str, pa.Array]:
    hits = [sum(x[1::2]) for x in spans]
    return {
        "n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(names, pa.list_(pa.string())), "n_hit": pa.array(hits, pa.int64()),
        "n_items": pa.array([len(x) for x in names], pa.int64()), "items_sha256": pa.array([hashlib.sha256(",".join(y for y in x if y is not None).encode()).hexdigest() for x in names], pa.string()),
        "contaminated": pa.array([h > 0 for h in hits], pa.bool_()),
    }


def _scan(block, keep: list[str]):
    """Spans and items of each document, from broadcast items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = block.value
        for rows, raw, offs in slices(batches, text="_text"):
            start, end, doc = word_bounds(raw, offs, ALNUM)
            words = word_hashes(raw, start, end)
            counts = np.bincount(doc, minlength=rows.num_rows)
            first, n, h = spans_to_test(words, doc, items.span, items.k, items.short, lambda g: _in(items.prints, g))
            ok = _in(items.hashes, h)
            first, n, h = first[ok], n[ok], h[ok]
            names: list[list] = [[] for _ in range(rows.num_rows)]
            if len(first):
                pairs = np.unique(np.stack([doc[first], items.class_of[np.searchsorted(items.hashes, h)]]), axis=1)
                of: dict[int, list] = {}
                for d, c in pairs.T.tolist():
                    of.setdefault(d, []).append(c)
                for d, cs in of.items():
                    own = np.unique(np.concatenate([items.of[(items.ends[c - 1] if c else 0) : items.ends[c]] for c in cs]))
                    names[d] = items.names[own].tolist()
            cols = _columns(counts, _runs(covered(first, n, len(words)), doc, counts), names)
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in keep), *cols.values()], [*keep, *cols])

    return run


def _item_rows(span: int, k: int):
    """Rows of the items' spans (hash, words, item) and of their fingerprints (hash, 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in slices(batches):
            start, end, item = word_bounds(raw, offs, ALNUM)
            h, n, of, prints = item_spans(word_hashes(raw, start, end), item, rows.num_rows, span, k)
            ids = rows.column(rows.schema.get_field_index("item_id")).take(pa.array(of))
            hashes = np.concatenate([h, prints]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.concatenate([n, np.zeros(len(prints), np.int64)])), pa.concat_arrays([ids, pa.nulls(len(prints), pa.string())])], ["h", "n", "item"])

    return run


def _span_rows(span: int, k: int, short: list[int], marks):
    """Spans of documents that an item may hold: row, hash, words, and all places of the hash in the text, as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in slices(batches, text="_text"):
            start, end, doc = word_bounds(raw, offs, ALNUM)
            first, n, h = spans_to_test(word_hashes(raw, start, end), doc, span, k, short, marks.has)
            counts = np.bincount(doc, minlength=rows.num_rows)
            base = np.cumsum(counts) - counts
            by = np.lexsort((first, h, doc[first]))
            first, n, h = first[by], n[by], h[by]
            cut = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[first][1:] != doc[first][:-1])))[: len(h)]
            own = doc[first]
            places = (first - base[own]).astype("<i4")
            ends = np.append(cut[1:], len(h))[: len(cut)]
            data = places.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(int_column(rows, "_row")[own[cut]]), pa.array(h[cut].view(np.int64)), pa.array(n[cut]), pa.array([data[4 * a : 4 * z] for a, z in zip(cut.tolist(), ends.tolist(), strict=True)], pa.binary())], ["_row", "h", "n", "places"])

    return run


def _finish(keep: list[str]):
    """Documents with their hits (n, places) and items, as in _scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in slices(batches, text="_text"):
            _, _, doc = word_bounds(raw, offs, ALNUM)
            counts = np.bincount(doc, minlength=rows.num_rows)
            base = np.cumsum(counts) - counts
            firsts, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for d, hits in enumerate(rows.column(rows.schema.get_field_index("_hits")).to_pylist()):
                for x in hits or ():
                    at = np.frombuffer(x["places"], "<i4").astype(np.int64)
                    firsts.append(at + base[d])
                    sizes.append(np.full(len(at), x["n"]))
            names = [sorted(x for x in own or () if x is not None) + [None] * (null or 0) for own, null in zip(rows.column(rows.schema.get_field_index("_items")).to_pylist(), rows.column(rows.schema.get_field_index("_null")).to_pylist(), strict=True)]
            cols = _columns(counts, _runs(covered(np.concatenate(firsts), np.concatenate(sizes), len(doc)), doc, counts), names)
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in keep), *cols.values()], [*keep, *cols])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, block_words: int = BLOCK_WORDS, keep: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, spans (first word, words, ... of the runs of hit words), items, n_hit, n_items, items_sha256, contaminated.
    keep: with all columns of docs."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("_text", F.col("text").cast("string"))
    own = own.drop(*RESULT) if keep else own.select("doc_id", "_text")
    kept = [c for c in own.columns if c != "_text"]
    schema = StructType([f for f in own.schema.fields if f.name != "_text"])
    for name, kind in RESULT.items():
        schema = schema.add(name, DataType.fromDDL(kind))
    words = items.select(F.sum(F.length("text") / 4 + 1)).first()[0] or 0
    if words <= block_words:
        rows = items.collect()  # about 4 characters a word, block_words at most
        block = Items([r[0] for r in rows], *text_buffers(pa.array([r[1] for r in rows], pa.large_string())), span, k)
        return own.mapInArrow(_scan(spark.sparkContext.broadcast(block), kept), schema)
    where = shared_dir(spark)
    own = materialise(own.withColumn("_row", F.monotonically_increasing_id()), where, "docs")
    tested = materialise(items.mapInArrow(_item_rows(span, k), "h long, n long, item string").distinct(), where, "items")
    short = sorted(r[0] for r in tested.where(f"n between 1 and {span - 1}").select("n").distinct().collect())  # span - 1 rows at most
    marks = bit_map(tested.where("n = 0").select("h"))
    spans = materialise(own.mapInArrow(_span_rows(span, k, short, marks), "_row long, h long, n long, places binary"), where, "spans")
    hits = materialise(spans.join(tested.where("n > 0").select("h").distinct(), "h", "left_semi"), where, "hits")
    places = hits.groupBy("_row").agg(F.collect_list(F.struct("n", "places")).alias("_hits"))  # a document's own
    named = hits.select("_row", "h").join(tested.where("n > 0").select("h", "item"), "h").select("_row", "item").distinct()
    named = named.groupBy("_row").agg(F.collect_list("item").alias("_items"), F.max(F.col("item").isNull().cast("int")).alias("_null"))
    return own.join(places, "_row", "left").join(named, "_row", "left").drop("_row").mapInArrow(_finish(kept), schema)
