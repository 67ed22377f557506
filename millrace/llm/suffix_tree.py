"""LM scoring by a probabilistic suffix tree.

Symbols are the bytes of the lower-cased words, a blank between words, and an end mark. Every context of up to DEPTH
symbols is counted over all training texts. A context is kept if it was seen LEAST_COUNT times, whatever the size of the
corpus, and its next-symbol counts diverge from those of its one-shorter suffix (likelihood ratio N * KL of GAIN nats or
more), and so are all its suffixes. Next-symbol distributions are smoothed towards the suffix's; the root's is add-one over all 256 bytes. A text's
score is the sum of log10 P(symbol | longest kept suffix).

The tree grows with the corpus, so nobody holds it whole: each batch sends its distinct grams by hash of the two symbols
before the last to reducers, which add up the counts, build the part of the tree below these two symbols and send each
batch its own grams' probabilities back. Only contexts of one symbol and none (256 x 256) are broadcast.
Word counts for the base score go the same way: each batch sends its distinct words by hash to reducers, which
add up the counts and send each batch its own words' totals back.

Defined results: a null text is an empty one (one end token); repeated doc_ids are rows of their own; without training rows all
counts are 0 and the base score is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import int_column, materialise, release, shared_dir, shuffle_partitions, slices
from millrace.llm.hashing import SPACED, mix, word_bounds, word_hashes

#: Longest context, in symbols (a context and its next symbol fill at most 8 bytes).
DEPTH = 6
#: Least times that a kept context was seen, at any size of the corpus.
LEAST_COUNT = 2
#: Least likelihood ratio, in nats, of a kept context against its suffix.
GAIN = 10.0
#: Weight of the suffix's distribution in a context's, in counts.
SMOOTH = 8.0
#: Marks that no word holds: before the first symbol, and the end.
BEFORE, END = 9, 10
#: Bytes of text whose distinct words make one request.
REQUEST_BYTES = 8 << 20
#: Distinct grams that a task of train() gathers before it sends them.
FLUSH_GRAMS = 1_500_000
#: Bytes of one bucket's requests that stay in memory; more wait in a temporary file until the counts are complete.
SPOOL_BYTES = 32 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def stream(raw: np.ndarray, offs: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' symbols end to end, each after DEPTH marks, and where each text's part ends."""
    texts, size = len(offs) - 1, end - start
    words = np.bincount(doc, minlength=texts)
    length = DEPTH + np.maximum(1, np.bincount(doc, weights=size, minlength=texts).astype(np.int64) + words)
    ends = np.cumsum(length)
    out = np.full(int(ends[-1]) if texts else 0, BEFORE, np.uint8)
    before = np.cumsum(size + 1) - (size + 1)
    own = np.append(before, 0)[np.cumsum(words) - words] if len(before) else np.zeros(texts, np.int64)
    at = before - own[doc] + (ends - length)[doc] + DEPTH
    inside = SPACED[raw]
    out[np.arange(int(size.sum())) + np.repeat(at - (np.cumsum(size) - size), size)] = _LOWER[raw[inside]]
    out[at + size] = 32
    out[ends - 1] = END
    return out, ends


def _places(ends: np.ndarray) -> np.ndarray:
    """Places of the symbols to predict: all but the marks before each text."""
    total = int(ends[-1]) if len(ends) else 0
    keep = np.ones(total, bool)
    starts = np.append(0, ends[:-1])
    for j in range(DEPTH):
        keep[starts + j] = False
    return np.flatnonzero(keep)


def _held(doc_id: np.ndarray, mod: int, rest: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(str(x).encode()) % mod == rest for x in doc_id.tolist()), bool, len(doc_id))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(k, kind="stable")
    k, c = k[by], c[by]
    cut = np.flatnonzero(np.append(True, k[1:] != k[:-1]))[: len(k)]
    return k[cut], np.add.reduceat(c, cut) if len(k) else c


def _grams(mod: int, rest: int, buckets: int):
    """Counts of all grams of DEPTH + 1 symbols of training texts, by bucket of the two symbols before the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, have = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, counts, have
            k, c = _merged(keys, counts)
            bucket = (mix((k >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            k, c, bucket = k[by], c[by], bucket[by]
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
            rows = [(int(bucket[a]), k[a:b].astype("<u8").tobytes(), c[a:b].astype("<u8").tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            keys, counts, have = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "grams", "counts"])

        for rows, raw, offs in slices(batches, 1 << 20):
            held = _held(int_column(rows, "doc_id"), mod, rest)
            start, end, doc = word_bounds(raw, offs, SPACED)
            out, ends = stream(raw, offs, start, end, doc)
            at = _places(ends)
            at = at[~held[np.searchsorted(ends, at, side="right")]]
            if not len(at):
                continue
            code = out[at - DEPTH].astype(np.uint64)
            for j in range(DEPTH - 1, -1, -1):
                code = (code << np.uint64(8)) | out[at - j]
            k, c = np.unique(code, return_counts=True)
            keys.append(k)
            counts.append(c.astype(np.int64))
            have += len(k)
            if have >= 2 * FLUSH_GRAMS:
                merged = _merged(keys, counts)
                keys, counts, have = [merged[0]], [merged[1]], len(merged[0])
                if have >= FLUSH_GRAMS:
                    yield flush()
        if keys:
            yield flush()

    return run


def _contexts(least: float):
    """Next-symbol counts of the contexts of each bucket with at least `least` symbols (all of one symbol and none): (depth, grams, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(keys, counts) -> list[tuple]:
            k, c = _merged(keys, counts)
            out = []
            for depth in range(DEPTH, -1, -1):
                k, c = _merged([k & np.uint64((1 << (8 * (depth + 1))) - 1)], [c])
                if depth >= 2:
                    of = k >> np.uint64(8)
                    cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                    ok = np.repeat(np.add.reduceat(c, cut) >= least, np.diff(np.append(cut, len(k))))
                    if ok.any():
                        out.append((depth, k[ok].astype("<u8").tobytes(), c[ok].astype("<u8").tobytes()))
                else:
                    out.append((depth, k.astype("<u8").tobytes(), c.astype("<u8").tobytes()))
            return out

        now, keys, counts = None, [], []
        for b in batches:
            for bucket, g, c in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if bucket != now and keys:
                    yield _rows(close(keys, counts))
                    keys, counts = [], []
                now = bucket
                keys.append(np.frombuffer(g, "<u8"))
                counts.append(np.frombuffer(c, "<u8").astype(np.int64))
                if len(keys) >= 64:
                    k, c = _merged(keys, counts)
                    keys, counts = [k], [c]
        if keys:
            yield _rows(close(keys, counts))

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["depth", "grams", "counts"])

    return run


def build(rows: list[tuple]) -> dict[str, np.ndarray]:
    """The tree: child[state, symbol before] (the last state, which has no children, stands for none), logp[state, next symbol]."""
    by_depth: list[tuple[np.ndarray, np.ndarray]] = []
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for depth in range(DEPTH + 1):
        own = [(np.frombuffer(g, "<u8"), np.frombuffer(c, "<u8").astype(np.int64)) for d, g, c in rows if d == depth]
        by_depth.append(_merged([x[0] for x in own], [x[1] for x in own]) if own else empty)
    root = np.ones(256)
    for g, c in zip(*by_depth[0], strict=True):
        root[int(g)] += c
    # Dense next-symbol counts of every frequent context, level by level; the divergence test is against the suffix.
    codes, dense, gains = [np.zeros(1, np.uint64)], [(root / root.sum())[None, :]], [np.array([np.inf])]
    parents = [np.zeros(1, np.int64)]
    for depth in range(1, DEPTH + 1):
        g, c = by_depth[depth]
        ctx, number = np.unique(g >> np.uint64(8), return_inverse=True)
        n = np.zeros((len(ctx), 256))
        n[number, (g & np.uint64(255)).astype(np.int64)] = c
        up = np.searchsorted(codes[-1], ctx & np.uint64((1 << (8 * (depth - 1))) - 1))
        base = dense[-1][up]
        total = n.sum(axis=1, keepdims=True)
        p = (n + SMOOTH * base) / (total + SMOOTH)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(n > 0, n * np.log(p / base), 0.0).sum(axis=1)
        codes.append(ctx)
        dense.append(p)
        gains.append(gain)
        parents.append(up)
    keep = [g >= GAIN for g in gains]
    for depth in range(DEPTH, 1, -1):
        keep[depth - 1][np.unique(parents[depth][keep[depth]])] = True
    first = np.cumsum([0, *(int(k.sum()) for k in keep)])
    none = int(first[-1])
    child = np.full((none + 1, 256), none, np.int32)
    logp = np.zeros((none + 1, 256), np.float32)
    state = [np.zeros(1, np.int64)]
    logp[0] = np.log10(dense[0][0])
    for depth in range(1, DEPTH + 1):
        own = np.flatnonzero(keep[depth])
        number = np.full(len(keep[depth]), -1)
        number[own] = first[depth] + np.arange(len(own))
        state.append(number)
        symbol = (codes[depth][own] >> np.uint64(8 * (depth - 1))).astype(np.int64) & 255
        child[state[-2][parents[depth][own]], symbol] = number[own]
        # Smoothing went through every frequent suffix, kept or not: distributions stay proper.
        logp[number[own]] = np.log10(dense[depth][own])
    return {"child": child, "logp": logp}


def train(docs: DataFrame, mod: int, rest: int) -> dict[str, np.ndarray]:
    """The whole tree of the texts whose crc32(doc_id) mod `mod` isn't `rest`, on the driver: for inspection of small corpora, not used by score()."""
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.mapInArrow(_grams(mod, rest, 4 * n), "bucket int, grams binary, counts binary").repartition(n, "bucket").sortWithinPartitions("bucket")
    return build(rows.mapInArrow(_contexts(LEAST_COUNT), "depth int, grams binary, counts binary").collect())


def _word_hashes(out: np.ndarray) -> np.ndarray:
    """Of the words of a stream, a part at a time."""
    ends = np.flatnonzero(out == END) + 1
    made, lo = [np.zeros(0, np.uint64)], 0
    while lo < len(ends):
        first = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, first + (1 << 20))))
        raw = out[first : ends[hi - 1]]
        start, end, _ = word_bounds(raw, np.append(0, ends[lo:hi] - first), SPACED)
        made.append(word_hashes(raw, start, end))
        lo = hi
    return np.concatenate(made)


def _low(symbols: int) -> np.uint64:
    """Mask of the last symbols of a gram."""
    return np.uint64((1 << (8 * symbols)) - 1)


def _pack(a: np.ndarray) -> bytes:
    """Like bytes end to end, compressed: sorted grams share their first symbols."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return len(a).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(b: bytes, dtype: str) -> np.ndarray:
    n, t = int.from_bytes(b[:8], "little"), np.dtype(dtype)
    if not n:
        return np.zeros(0, t)
    planes = np.frombuffer(pa.decompress(b[8:], decompressed_size=n * t.itemsize, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(t.itemsize, n).T).view(t).ravel()


def _codes(out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each place to predict of a stream, and where each text's places begin."""
    ends = np.flatnonzero(out == END) + 1
    code = out.astype(np.uint64)
    code[1:] |= code[:-1] << np.uint64(8)  # grams of 2, 4 and then DEPTH + 1 symbols
    code &= _low(2)
    code[2:] |= code[:-2] << np.uint64(16)
    code &= _low(4)
    code[4:] |= (code[:-4] & _low(DEPTH - 3)) << np.uint64(32)
    size = np.diff(np.append(0, ends)) - DEPTH
    return code[_places(ends)], np.cumsum(size) - size


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (mix((grams >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int16 if buckets < 1 << 15 else np.int32)  # short ones sort faster


def _runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the places by a hash of their gram, the grams of its runs of equal ones, and where each run starts. Sorts values (hash and
    place in one number), not indices; where two grams' hashes agree, a gram may have several runs."""
    bits = np.uint64(max(1, len(code).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    by = np.sort((mix(code) & ~low) | np.arange(len(code), dtype=np.uint64)) & low
    by = by.astype(np.int64)
    k = code[by]
    cut = np.flatnonzero(np.append(True, k[1:] != k[:-1]))[: len(k)]
    return by, k[cut], cut


def top(sums: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The root's distribution, those of the contexts of one symbol, and whether these diverge from the root's; of bigram counts."""
    n = np.zeros(1 << 16)
    for g, c in sums:
        n[np.frombuffer(g, "<u2")] += np.frombuffer(c, "<u8")
    n = n.reshape(256, 256)
    root = np.ones(256) + n.sum(axis=0)
    root /= root.sum()
    one = (n + SMOOTH * root) / (n.sum(axis=1, keepdims=True) + SMOOTH)
    return root, one, np.where(n > 0, n * np.log(one / root), 0.0).sum(axis=1) >= GAIN


def part(k: np.ndarray, c: np.ndarray, one: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The tree's part below some contexts of two symbols, from the counts of all their grams: per depth from 2 the kept
    contexts, their counts, the grams seen after them and these grams' probabilities."""
    counted = []
    for depth in range(DEPTH, 1, -1):
        k, c = _merged([k & _low(depth + 1)], [c])
        counted.append((k, c))
    levels = []
    for depth, (k, c) in enumerate(reversed(counted), 2):
        of = k >> np.uint64(8)
        cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))[: len(k)]
        if not len(cut):
            break
        ok = np.repeat(np.add.reduceat(c, cut) >= LEAST_COUNT, np.diff(np.append(cut, len(k))))
        k, c = k[ok], c[ok]
        if not len(k):
            break
        of = k >> np.uint64(8)
        cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        ctx, total, sizes = of[cut], np.add.reduceat(c, cut), np.diff(np.append(cut, len(k)))
        if depth == 2:
            base = one[(of & np.uint64(255)).astype(np.int64), (k & np.uint64(255)).astype(np.int64)]
        else:
            base = levels[-1]["p"][np.searchsorted(levels[-1]["grams"], k & _low(depth))]
        p = (c + SMOOTH * base) / (np.repeat(total, sizes) + SMOOTH)
        up = np.searchsorted(levels[-1]["ctx"], ctx & _low(depth - 1)) if levels else None
        levels.append({"ctx": ctx, "total": total, "sizes": sizes, "grams": k, "p": p, "up": up, "keep": np.add.reduceat(c * np.log(p / base), cut) >= GAIN})
    for d in range(len(levels) - 1, 0, -1):
        levels[d - 1]["keep"][levels[d]["up"][levels[d]["keep"]]] = True
    out = []
    for x in levels:
        seen = np.repeat(x["keep"], x["sizes"])
        out.append({"ctx": x["ctx"][x["keep"]], "total": x["total"][x["keep"]], "grams": x["grams"][seen], "p": x["p"][seen]})
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def after(levels: list[dict[str, np.ndarray]], grams: np.ndarray, one: np.ndarray) -> np.ndarray:
    """log10 P(last symbol | longest kept suffix of those before it); NaN where no kept suffix has two symbols."""
    p = one[((grams >> np.uint64(8)) & np.uint64(255)).astype(np.int64), (grams & np.uint64(255)).astype(np.int64)]
    out = np.full(len(grams), np.nan, np.float32)
    live = np.arange(len(grams))
    for depth, x in enumerate(levels, 2):
        if not len(x["ctx"]) or not len(live):
            break
        at, ok = _find(x["ctx"], (grams[live] >> np.uint64(8)) & _low(depth))
        live, at = live[ok], at[ok]
        seen, ok = _find(x["grams"], grams[live] & _low(depth + 1))
        p[live] = np.where(ok, x["p"][seen], SMOOTH * p[live] / (x["total"][at] + SMOOTH))
        out[live] = np.log10(p[live])
    return out


def _gram_requests(mod: int, rest: int, buckets: int):
    """Per batch and bucket: the batch's distinct grams, and their counts in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, out = np.frombuffer(b.column(1)[i].as_py(), "<i8"), _unpack(b.column(2)[i].as_py(), "u1")
                code, first = _codes(out)
                code <<= np.uint64(1)  # the lowest bit: not for training
                code |= np.repeat(_held(ids, mod, rest), np.diff(np.append(first, len(code)))).astype(np.uint64)
                code.sort()
                grams = code >> np.uint64(1)
                cut = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))[: len(grams)]
                counts = np.add.reduceat(~code.astype(np.uint8) & np.uint8(1), cut, dtype=np.uint32)
                grams = grams[cut]
                del code
                bucket = _bucket(grams, buckets)
                by = np.argsort(bucket, kind="stable")
                grams, counts, bucket = grams[by], counts[by].astype("<u4"), bucket[by]
                cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
                rows = [(b.column(0)[i].as_py(), int(bucket[x]), _pack(grams[x:y]), _pack(counts[x:y])) for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["batch", "bucket", "grams", "counts"])
                release()

    return run


def _gram_answers(shared):
    """Per request the probabilities of its grams; per bucket one row (batch -1) with the last symbols of its kept contexts."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["batch", "bucket", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value[1]

        def close(bucket: int, spool, sizes: list[tuple], keys: list, counts: list) -> Iterator[pa.RecordBatch]:
            levels = part(*_merged(keys, counts), one)
            kept = np.unique(levels[0]["ctx"] & np.uint64(255)) if levels else np.zeros(0)
            rows, have = [(-1, bucket, kept.astype(np.uint8).tobytes())], 0
            spool.seek(0)
            for batch, size in sizes:
                rows.append((batch, bucket, _pack(after(levels, _unpack(spool.read(size), "<u8"), one))))
                have += len(rows[-1][2])
                if have >= 4 << 20:
                    yield made(rows)
                    rows, have = [], 0
            if rows:
                yield made(rows)
            spool.close()

        now, spool, sizes, keys, counts = None, None, [], [], []
        for b in batches:
            for i in range(b.num_rows):
                batch, bucket, g, c = (b.column(j)[i].as_py() for j in range(4))
                if bucket != now:
                    if sizes:
                        yield from close(now, spool, sizes, keys, counts)
                    now, spool, sizes, keys, counts = bucket, tempfile.SpooledTemporaryFile(SPOOL_BYTES), [], [], []
                spool.write(g)
                sizes.append((batch, len(g)))
                c = _unpack(c, "<u4")
                keys.append(_unpack(g, "<u8")[c > 0])
                counts.append(c[c > 0].astype(np.int64))
                if len(keys) >= 64:
                    k, c = _merged(keys, counts)
                    keys, counts = [k], [c]
            release()
        if sizes:
            yield from close(now, spool, sizes, keys, counts)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(1 << 16, np.int64)
    for b in batches:
        for g, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n[np.frombuffer(g, "<u2")] += np.frombuffer(c, "<u8").astype(np.int64)
    seen = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array([seen.astype("<u2").tobytes()], pa.binary()), pa.array([n[seen].astype("<u8").tobytes()], pa.binary())], ["a", "b"])


_PASS = "kind int, batch long, bucket int, doc_ids binary, a binary, b binary, stream binary"


def _numbered(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's distinct words bucket by bucket, each word's number among these, and their buckets: answers end to end are in this order."""
    distinct, back = np.unique(hashes, return_inverse=True)
    bucket = (distinct >> np.uint64(33)).astype(np.int64) % buckets
    by = np.argsort(bucket, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    return distinct[by], place[back], bucket[by]


def _requests(mod: int, rest: int, buckets: int):
    """Per batch of texts one row of documents (kind 0: ids, words of each, stream), per bucket one row of distinct words (kind 1: hashes, counts in training texts), and one row of bigrams
    (kind 2: symbols, counts in training texts)."""
    names = [x.split()[0] for x in _PASS.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        made, have = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, have, number
            ids, sizes, hashes, out = (np.concatenate([m[i] for m in made]) for i in range(4))
            bigrams = np.sum([m[4] for m in made], axis=0)
            held = np.repeat(_held(ids, mod, rest), sizes)
            distinct, place, bucket = _numbered(hashes, buckets)
            counts = np.bincount(place[~held], minlength=len(distinct))
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
            rows = [(0, number, -1, ids.astype("<i8").tobytes(), sizes.astype("<i8").tobytes(), None, _pack(out))]
            rows += [(1, number, int(bucket[a]), None, _pack(distinct[a:b].astype("<u8")), _pack(counts[a:b].astype("<u8")), None) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            two = np.flatnonzero(bigrams)
            rows.append((2, number, -1, None, two.astype("<u2").tobytes(), bigrams[two].astype("<u8").tobytes(), None))
            number, made, have = number + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for rows, raw, offs in slices(batches, 1 << 20):
            start, end, doc = word_bounds(raw, offs, SPACED)
            out, ends = stream(raw, offs, start, end, doc)
            ids, at = int_column(rows, "doc_id"), _places(ends)
            at = at[~_held(ids, mod, rest)[np.searchsorted(ends, at, side="right")]]
            bigrams = np.bincount((out[at - 1].astype(np.int64) << 8) | out[at], minlength=1 << 16)
            made.append((ids, np.bincount(doc, minlength=rows.num_rows), word_hashes(raw, start, end), out, bigrams))
            have += len(raw) + 64 * rows.num_rows
            if have >= REQUEST_BYTES:
                yield flush()
        if made:
            yield flush()

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Total counts for each request; per bucket one row (batch -1) with its distinct words and tokens in training texts."""

    def close(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
        hashes, counts = _merged([_unpack(r[1], "<u8") for r in rows], [_unpack(r[2], "<u8").astype(np.int64) for r in rows])
        out = [(r[0], bucket, _pack(counts[np.searchsorted(hashes, _unpack(r[1], "<u8"))].astype("<u8"))) for r in rows]
        out.append((-1, bucket, np.array([(counts > 0).sum(), counts.sum()], "<u8").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["batch", "bucket", "c"])

    now, rows = None, []
    for b in batches:
        for batch, bucket, h, c in zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in ("batch", "bucket", "a", "b")), strict=True):
            if bucket != now and rows:
                yield close(now, rows)
                rows = []
            now = bucket
            rows.append((batch, h, c))
    if rows:
        yield close(now, rows)


def _finish(mod: int, rest: int, tokens: int, distinct: int, ends_seen: int, shared, words: int, buckets: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = np.log10(tokens + distinct + 1.0)
        root, one, kept = shared.value

        def total(out: np.ndarray, answers: list[dict]) -> np.ndarray:
            """Each text's sum over its places; the longest kept suffix of one symbol or none is the batch's own look-up."""
            code, first = _codes(out)
            by, runs, cut = _runs(code)
            sizes = np.diff(np.append(cut, len(code)))
            del code
            grams, back = np.unique(runs, return_inverse=True)
            order = np.argsort(_bucket(grams, buckets), kind="stable")
            value = np.empty(len(grams), np.float32)
            value[order] = np.concatenate([_unpack(x["c"], "<f4") for x in sorted(answers, key=lambda x: x["bucket"])])
            short = np.flatnonzero(np.isnan(value))
            before, last = ((grams[short] >> np.uint64(8)) & np.uint64(255)).astype(np.int64), (grams[short] & np.uint64(255)).astype(np.int64)
            value[short] = np.log10(np.where(kept[before], one[before, last], root[last]))
            place = np.empty(len(by))
            place[by] = np.repeat(value[back], sizes)
            return np.add.reduceat(place, first)

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                ids, sizes = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["a"], "<i8")
                out = _unpack(row["stream"], "u1")
                place = _numbered(_word_hashes(out), words)[1]
                score = total(out, [x for x in row["answers"] if x["grams"]])
                got = sorted((x for x in row["answers"] if not x["grams"]), key=lambda x: x["bucket"])
                c = np.concatenate([np.zeros(0, "<u8"), *(_unpack(x["c"], "<u8") for x in got)])
                doc = np.repeat(np.arange(len(ids)), sizes)
                log, known = np.log10(c + 1.0)[place], (c > 0)[place]
                n = sizes + 1
                base = np.bincount(doc, weights=log, minlength=len(ids)) + np.log10(ends_seen + 1.0) - n * norm
                seen = np.bincount(doc, weights=known, minlength=len(ids)).astype(np.int64) + (ends_seen > 0)
                null = ids == np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=null), pa.array(_held(ids, mod, rest) & ~null), pa.array(n), pa.array(seen), pa.array(np.full(len(ids), tokens)), pa.array(base), pa.array(score)], names)

    return run


def score(docs: DataFrame, mod: int = 7, rest: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Learns from documents whose
    crc32(doc_id) mod `mod` isn't `rest`; scores all."""
    spark, where = docs.sparkSession, shared_dir(docs.sparkSession)
    n = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = materialise(rows.mapInArrow(_requests(mod, rest, n), _PASS), where, "requests", ["kind"])
    root, one, kept = top(made.where("kind = 2").select("a", "b").repartition(16).mapInArrow(_summed, "a binary, b binary").collect())
    shared = spark.sparkContext.broadcast((root, one, kept))  # 256 x 256
    grams = made.where("kind = 0").select("batch", "doc_ids", "stream").mapInArrow(_gram_requests(mod, rest, 4 * n), "batch long, bucket int, grams binary, counts binary")
    scored = materialise(grams.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_gram_answers(shared), "batch long, bucket int, c binary"), where, "scored")
    for r in scored.where("batch = -1").select("c").distinct().collect():  # one small row per bucket
        kept[np.frombuffer(r[0], np.uint8)] = True  # suffixes of kept contexts are kept
    whole = spark.sparkContext.broadcast((root, one, kept))
    answers = made.where("kind = 1").select("batch", "bucket", "a", "b").repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_answers, "batch long, bucket int, c binary")
    answers = materialise(answers, where, "answers")
    sums = [np.frombuffer(r[0], "<u8") for r in answers.where("batch = -1").select("c").collect()]  # one small row per bucket
    trained = rows.where(f"coalesce(crc32(cast(cast(doc_id as string) as binary)) % {mod} != {rest}, true)").count()
    tokens, distinct = int(sum(int(x[1]) for x in sums)) + trained, int(sum(int(x[0]) for x in sums)) + (trained > 0)
    # A batch's answers are as many as its own distinct words.
    back = answers.withColumn("grams", F.lit(False)).unionByName(scored.withColumn("grams", F.lit(True))).where("batch >= 0")
    back = back.groupBy("batch").agg(F.collect_list(F.struct("grams", "bucket", "c")).alias("answers"))
    ready = made.where("kind = 0").select("batch", "doc_ids", "a", "stream").join(back, "batch").select("doc_ids", "a", "stream", "answers")
    return ready.mapInArrow(_finish(mod, rest, tokens, distinct, trained, whole, n, 4 * n), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
