"""Suffix-array dedup over sparse suffixes.

Suffixes are kept only at content-selected positions: of each `span` consecutive words the smallest k-word hash marks one
(a minimiser), so any two equal passages of `span` words keep a suffix at the same place. A passage may reach up to span - k words to the
left of its minimiser. For passages that reach less than half as far the suffix begins at the minimiser, for the others half as far before
it; so each suffix begins with many words (its core, 38 of 50) that every passage it stands for holds, and beyond the core a passage
reaches over the same few words (12) to the left and right.

Round one deals the suffixes out by their cores, sorts these and compares neighbours: a suffix whose core is in no other document is
dropped. Round two deals the rest out by core with the words on both sides, sorts the suffixes of a core word by word, takes the common
prefix of neighbours, does the same leftwards, and so extends each match left and right: a passage that reaches j words to the left
repeats if another document's suffix agrees in j words to the left and in the rest to the right. Which of its passages repeat is answered to
where a suffix came from, and overlapping passages of a text join into maximal repeated spans. No repeat of `span` words is lost.

A batch of texts sends each distinct suffix with its surroundings once, with the least and greatest doc_id, so a passage in a third of all
texts makes one row per batch and surroundings; a common phrase in many surroundings has no common core and is dealt out widely.
Cores are compared by 64-bit hashes, words on the sides by 31-bit ones.

Defined results: A-Z count as a-z; null and short texts have no spans; windows that repeat only within one document (or
within rows of the same doc_id) are not reported unless across is False; rows without a doc_id (or with the least long) count as one
document and have null as doc_id; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Marks, bit_map, int_column, materialise, shared_dir, shuffle_partitions, slices
from millrace.llm.hashing import SPACED, gram_hashes, mix, word_bounds, word_hashes
from millrace.llm.winnowing import window_minima

SPAN = 50
#: Bytes of text whose distinct suffixes make one request.
REQUEST_BYTES = 8 << 20
#: Stands for a missing doc_id.
NO_ID = -(2**63)


class Layout:
    """Words per minimiser; of suffixes at it (0) and before it (1): where they begin, words of the core and, on each side, beyond it."""

    def __init__(self, span: int):
        self.span, self.k = span, max(1, span // 2)
        half = (span - self.k + 1) // 2
        self.before = (0, half)
        self.core = (span - max(0, half - 1), self.k + half)
        self.beyond = (span - self.core[0], span - self.core[1])
        self.most = max(self.beyond)


def suffixes(raw: np.ndarray, offs: np.ndarray, lay: Layout) -> dict[str, np.ndarray]:
    """Per kept suffix: text number, first word (within the text and among all words), kind, hash of the core (its lowest bit the kind), and the range of words to the
    left (low to high) that the passages it stands for reach over; and 32-bit hashes of all words with the text of each."""
    start, end, doc = word_bounds(raw, offs, SPACED)
    words = word_hashes(raw, start, end)
    grams = gram_hashes(words, lay.k)
    own = doc[: len(grams)]
    whole = own == doc[lay.k - 1 : lay.k - 1 + len(grams)]
    first, at = window_minima(grams, np.where(whole, own, -1 - np.arange(len(own))), lay.span - lay.k + 1)
    left = at - first
    kind = (left >= lay.before[1]).astype(np.int64) if lay.before[1] else np.zeros(len(left), np.int64)
    place = at - np.array(lay.before)[kind]
    # Passages of one suffix come one after another, the furthest to the left first.
    cut = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (kind[1:] != kind[:-1])))[: len(place)]
    last = np.append(cut[1:], len(place))[: len(cut)] - 1
    high, low, place, kind = (place - first)[cut], (place - first)[last], place[cut], kind[cut]
    core = np.zeros(len(place), np.uint64)
    for i in (0, 1):
        of = np.flatnonzero(kind == i)
        if len(of):
            core[of] = mix(gram_hashes(words, lay.core[i])[place[of]] + np.uint64(i + 1)) & ~np.uint64(1) | np.uint64(i)  # the lowest bit: the kind
    counts = np.bincount(doc, minlength=len(offs) - 1)
    base = np.cumsum(counts) - counts
    return {"doc": doc[place], "first": place - base[doc[place]], "place": place, "kind": kind, "core": core, "low": low, "high": high, "words": (words >> np.uint64(32)).astype(np.uint32) | np.uint32(1), "of": doc}


def sides(x: dict[str, np.ndarray], pick: np.ndarray, lay: Layout) -> np.ndarray:
    """Words beyond the core of some suffixes: those to the left, the nearest first, then those to the right; 0 where the text ends."""
    out = np.zeros((len(pick), 2 * lay.most), np.uint32)
    core = np.array(lay.core)[x["kind"][pick]]
    for j in range(lay.most):
        for column, at in ((j, x["place"][pick] - 1 - j), (lay.most + j, x["place"][pick] + core + j)):
            inside = (at >= 0) & (at < len(x["of"]))
            at = np.where(inside, at, 0)
            inside &= x["of"][at] == x["doc"][pick]
            out[:, column] = np.where(inside, x["words"][at], 0)
    return out


_DOCS = [("docs", pa.binary()), ("least", pa.binary()), ("two", pa.binary())]


def _docs(low: np.ndarray, high: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Least and greatest doc_id and whether there are more, as numbers into the row's own list; the greatest differs from the least for few."""
    own, at = np.unique(np.concatenate([low, high]), return_inverse=True)
    n = len(low)
    two = np.flatnonzero((at[:n] != at[n:]) | (counts > 1))
    return own.astype("<i8").tobytes(), at[:n].astype("<u2" if len(own) < 1 << 16 else "<u4").tobytes(), np.stack([two, at[n:][two]]).astype("<u4").tobytes()


def _read_docs(docs: bytes, least: bytes, two: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least and greatest doc_id, and whether there are more."""
    own = np.frombuffer(docs, "<i8")
    low = own[np.frombuffer(least, "<u2" if len(own) < 1 << 16 else "<u4")]
    high, more = low.copy(), np.zeros(len(low), bool)
    at = np.frombuffer(two, "<u4").reshape(2, -1)
    high[at[0]] = own[at[1]]
    more[at[0]] = True
    return low, high, more


def _grouped(keys: np.ndarray, ids: np.ndarray, core: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Distinct keys by bucket of their core: an input place of each, least and greatest doc_id, count, where each bucket begins and its
    number; and each input's place among them."""
    distinct, one, back, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    least, most = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(least, back, ids)
    np.maximum.at(most, back, ids)
    bucket = ((core[one] >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    bucket = bucket[by]
    cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    return one[by], least[by], most[by], counts[by], cut, bucket[cut[:-1]], place[back]


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*rows, strict=True) if rows else [[]] * len(fields), fields, strict=True)], [n for n, _ in fields])


_CORES = [("bucket", pa.int32()), ("cores", pa.binary()), *_DOCS]
_CORES_SCHEMA = "bucket int, cores binary, docs binary, least binary, two binary"


def _cores(lay: Layout, buckets: int):
    """Distinct cores of each batch of texts, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, have = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, have
            core, ids = (np.concatenate([m[i] for m in made]) for i in range(2))
            one, low, high, counts, cut, bucket, _ = _grouped(core, ids, core, buckets)
            made, have = [], 0
            return _batch([(int(k), core[one[a:z]].astype("<u8").tobytes(), *_docs(low[a:z], high[a:z], counts[a:z])) for k, a, z in zip(bucket.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True)], _CORES)

        for rows, raw, offs in slices(batches):
            x = suffixes(raw, offs, lay)
            made.append((x["core"], int_column(rows, "doc_id")[x["doc"]]))
            have += len(raw) + 64 * rows.num_rows
            if have >= REQUEST_BYTES:
                yield flush()
        if made:
            yield flush()

    return run


def _by_run(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of each bucket; the input comes sorted by bucket."""
    now, rows = None, []
    for b in batches:
        for bucket, *row in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("bucket", *columns)), strict=True):
            if bucket != now and rows:
                yield now, rows
                rows = []
            now = bucket
            rows.append(tuple(row))
    if rows:
        yield now, rows


def _repeat(low: np.ndarray, high: np.ndarray, more: np.ndarray, cut: np.ndarray, across: bool) -> np.ndarray:
    """Whether each group of sorted rows, which begin at cut, is in two documents (or at two places)."""
    found = np.minimum.reduceat(low, cut) != np.maximum.reduceat(high, cut)
    if not across:
        found |= (np.diff(np.append(cut, len(low))) > 1) | np.logical_or.reduceat(more, cut)
    return found


def _common_cores(across: bool):
    """Cores that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_run(batches, ["cores", "docs", "least", "two"]):
            core = np.concatenate([np.frombuffer(r[0], "<u8") for r in rows])
            low, high, more = (np.concatenate(x) for x in zip(*(_read_docs(*r[1:]) for r in rows), strict=True))
            by = np.argsort(core, kind="stable")
            core, low, high, more = core[by], low[by], high[by], more[by]
            cut = np.flatnonzero(np.append(True, core[1:] != core[:-1]))[: len(core)]
            if len(cut):
                yield pa.RecordBatch.from_arrays([pa.array(core[cut][_repeat(low, high, more, cut, across)].view(np.int64))], ["core"])

    return run


_PASS = [("kind", pa.int32()), ("batch", pa.int64()), ("bucket", pa.int32()), ("cores", pa.binary()), ("sides", pa.binary()), *_DOCS, ("doc", pa.binary()), ("first", pa.binary()), ("reach", pa.binary()), ("place", pa.binary())]
_PASS_SCHEMA = "kind int, batch long, bucket int, cores binary, sides binary, docs binary, least binary, two binary, doc binary, first binary, reach binary, place binary"


def _requests(lay: Layout, buckets: int, marks: Marks):
    """Per batch one row of suffixes (kind 0: doc_ids; of each suffix its document, first word, reach to the left, and place among the batch's
    distinct ones) and per bucket a request (kind 1): distinct suffixes with the words on both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, made, have, docs = TaskContext.get().partitionId() << 32, [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal number, made, have, docs
            core, side, doc, first, low, high, ids = (np.concatenate([m[i] for m in made]) for i in range(7))
            whole = core
            for j in range(side.shape[1]):
                whole = mix(whole ^ (side[:, j].astype(np.uint64) + np.uint64(j << 40)))
            one, least, most, counts, cut, bucket, place = _grouped(whole, ids[doc], core, buckets)
            used, own = np.unique(doc, return_inverse=True)
            rows = [(0, number, -1, None, None, ids[used].astype("<i8").tobytes(), None, None, own.astype("<u4").tobytes(), first.astype("<u4").tobytes(), np.stack([low, high]).astype("<u2").tobytes(), place.astype("<u4").tobytes())]
            cores, beside = core[one].astype("<u8"), side[one].astype(">u4")
            rows += [(1, number, int(k), cores[a:z].tobytes(), beside[a:z].tobytes(), *_docs(least[a:z], most[a:z], counts[a:z]), None, None, None, None) for k, a, z in zip(bucket.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            number, made, have, docs = number + 1, [], 0, 0
            return _batch(rows, _PASS)

        for rows, raw, offs in slices(batches):
            x = suffixes(raw, offs, lay)
            pick = np.flatnonzero(marks.has(x["core"]))
            made.append((x["core"][pick], sides(x, pick, lay), x["doc"][pick] + docs, x["first"][pick], x["low"][pick], x["high"][pick], int_column(rows, "doc_id")))
            docs += rows.num_rows
            have += len(raw) // 4 + 250 * len(pick) + 64 * rows.num_rows
            if have >= REQUEST_BYTES:
                yield flush()
        if any(len(m[0]) for m in made):
            yield flush()

    return run


def _agreeing(core: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For 0 and more words of side, the number of each row's class of rows with the same core and as many equal words: rows are sorted
    word by word, and neighbours belong together as far as their common prefix reaches."""
    n, most = side.shape
    line = np.empty((n, 8 + 4 * most), np.uint8)
    line[:, :8] = core.astype(">u8")[:, None].view(np.uint8)
    line[:, 8:] = np.ascontiguousarray(side.astype(">u4")).view(np.uint8)
    by = np.argsort(line.view(f"S{line.shape[1]}").ravel(), kind="stable")
    core, side = core[by], side[by]
    prefix = np.cumprod(np.hstack([(core[1:] == core[:-1])[:, None], side[1:] == side[:-1]]), axis=1).sum(axis=1)  # 1 for the core, and equal words
    out = np.zeros((n, most + 1), np.uint32)
    for j in range(most + 1):
        out[by[1:], j] = np.cumsum(prefix <= j)
    return out


def extended(core: np.ndarray, side: np.ndarray, low: np.ndarray, high: np.ndarray, more: np.ndarray, beyond: int, across: bool) -> np.ndarray:
    """Whether each suffix's passage that reaches j = 0 to beyond words to the left, and beyond - j to the right of the core, repeats."""
    most = side.shape[1] // 2
    left, right = _agreeing(core, side[:, :most]), _agreeing(core, side[:, most:])
    out = np.zeros((len(core), beyond + 1), bool)
    for j in range(beyond + 1):
        both = left[:, j].astype(np.uint64) << np.uint64(32) | right[:, beyond - j]
        by = np.argsort(both)
        cut = np.flatnonzero(np.append(True, both[by][1:] != both[by][:-1]))
        out[by, j] = np.repeat(_repeat(low[by], high[by], more[by], cut, across), np.diff(np.append(cut, len(by))))
    return out


def _compare(lay: Layout, across: bool):
    """For each request, which passages of its suffixes repeat: Layout.most + 1 bits a suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_run(batches, ["batch", "cores", "sides", "docs", "least", "two"]):
            core = np.concatenate([np.frombuffer(r[1], "<u8") for r in rows])
            side = np.concatenate([np.frombuffer(r[2], ">u4").reshape(-1, 2 * lay.most) if lay.most else np.zeros((len(r[1]) // 8, 0), ">u4") for r in rows])
            low, high, more = (np.concatenate(x) for x in zip(*(_read_docs(*r[3:]) for r in rows), strict=True))
            found = np.zeros((len(core), lay.most + 1), bool)
            for kind, beyond in enumerate(lay.beyond):
                of = np.flatnonzero((core & np.uint64(1)) == kind)
                if len(of):
                    found[of, : beyond + 1] = extended(core[of], side[of], low[of], high[of], more[of], beyond, across)
            ends = np.cumsum([len(r[1]) // 8 for r in rows])
            out = [np.packbits(found[z - len(r[1]) // 8 : z].ravel(), bitorder="little").tobytes() for r, z in zip(rows, ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()), pa.array([len(r[1]) // 8 for r in rows], pa.int64()), pa.array(out, pa.binary())], ["batch", "bucket", "n", "found"])

    return run


def _join(lay: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids, doc, first, place = (np.frombuffer(row[c], t).astype(np.int64) for c, t in (("docs", "<i8"), ("doc", "<u4"), ("first", "<u4"), ("place", "<u4")))
                low, high = np.frombuffer(row["reach"], "<u2").reshape(2, -1).astype(np.int64)
                got = sorted(row["answers"] or [], key=lambda x: x["bucket"])
                bits = [np.unpackbits(np.frombuffer(x["found"], np.uint8), count=x["n"] * (lay.most + 1), bitorder="little") for x in got]
                found = np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool).reshape(-1, lay.most + 1)
                n = high - low + 1  # passages of each suffix
                of = np.repeat(np.arange(len(n)), n)
                reach = low[of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]
                ok = found[place[of], reach]
                doc, first = doc[of][ok], (first[of] - reach)[ok]
                by = np.lexsort((first, doc))
                doc, first = doc[by], first[by]
                # A passage that starts after the one before has ended begins a new span.
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (first[1:] > first[:-1] + lay.span)
                cut = np.flatnonzero(new)
                last = np.append(cut[1:], len(doc)) - 1 if len(cut) else cut
                ids = ids[doc[cut]]
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NO_ID), pa.array(first[cut]), pa.array(first[last] + lay.span - first[cut])], ["doc_id", "start_word", "n_words"])

    return run


def repeats(docs: DataFrame, span: int = SPAN, across: bool = True) -> DataFrame:
    """One row per maximal repeated span: doc_id, start_word (from 0), n_words. Documents without one have no row."""
    spark, where, lay = docs.sparkSession, shared_dir(docs.sparkSession), Layout(span)
    n = shuffle_partitions(spark)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    sent = texts.mapInArrow(_cores(lay, 4 * n), _CORES_SCHEMA).repartition(n, "bucket").sortWithinPartitions("bucket")
    common = materialise(sent.mapInArrow(_common_cores(across), "core long"), where, "cores")
    made = materialise(texts.mapInArrow(_requests(lay, 4 * n, bit_map(common)), _PASS_SCHEMA), where, "suffixes", ["kind"])
    asked = made.where("kind = 1").select("batch", "bucket", "cores", "sides", "docs", "least", "two").repartition(n, "bucket").sortWithinPartitions("bucket")
    answers = asked.mapInArrow(_compare(lay, across), "batch long, bucket int, n long, found binary").groupBy("batch").agg(F.collect_list(F.struct("bucket", "n", "found")).alias("answers"))  # a batch's own suffixes
    rows = made.where("kind = 0").select("batch", "docs", "doc", "first", "reach", "place").join(answers, "batch", "left").select("docs", "doc", "first", "reach", "place", "answers")
    return rows.mapInArrow(_join(lay), "doc_id long, start_word long, n_words long")
