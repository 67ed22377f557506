"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams (byte 1- to 4-grams, words and word pairs, 1- to 3-grams of word shapes, the text's length and
repetition by classes, hashed to DIM places) are scaled by the log-count
ratio of the two classes; a linear hinge-loss model is fitted on the scaled vectors by dual coordinate descent; a
logistic curve turns its margin into a score. Class counts cover all labelled training rows; the fit uses at most
FIT_ROWS of them per class, taken in the order of a hash of doc_id; the model has DIM weights whatever the input.

Defined results: a null text is an empty one and gets the score of no features; without labelled rows of both
classes every score is the share of label 1 (0.5 without any); repeated doc_ids are scored as rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import int_column, materialise, only, release, shared_dir, slices
from millrace.llm.hashing import SPACED, gram_hashes, mix, word_bounds, word_hashes

BITS = 18
DIM = 1 << BITS
#: Texts whose features are marked together.
GROUP = 64
#: Labelled rows of each class that the hinge-loss fit sees at most. Counts see all.
FIT_ROWS = 2000
EPOCHS = 12
COST = 1.0
SMOOTH = 1.0


def features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of all texts end to end, and how many each text has."""
    n, texts = len(raw), len(offs) - 1
    if texts > GROUP:
        cut = [features(raw[offs[i] : offs[min(i + GROUP, texts)]], offs[i : i + GROUP + 1] - offs[i]) for i in range(0, texts, GROUP)]
        return np.concatenate([c[0] for c in cut]), np.concatenate([c[1] for c in cut])
    parts, owners = [], []
    doc_of = np.repeat(np.arange(texts), np.diff(offs))
    value = raw.astype(np.uint64)
    code = value.copy()
    for size in range(1, 5):
        if n >= size:
            if size > 1:
                code = (code[:-1] << np.uint64(8)) | value[size - 1 :]
            same = doc_of[: n - size + 1] == doc_of[size - 1 :]
            parts.append((mix(code[same] + (np.uint64(size) << np.uint64(40))) >> np.uint64(64 - BITS)).astype(np.int64))
            owners.append(doc_of[: n - size + 1][same])
    start, end, doc = word_bounds(raw, offs, SPACED)
    words = word_hashes(raw, start, end)
    parts.append((mix(words) >> np.uint64(64 - BITS)).astype(np.int64))
    owners.append(doc)
    for code, size in ((words, 2), *((_shapes(raw, start, end, doc, words), k) for k in (1, 2, 3))):
        if len(code) >= size:
            grams = gram_hashes(code, size) if size > 1 else code
            same = doc[: len(grams)] == doc[size - 1 :]
            parts.append((mix(grams[same] + np.uint64(size)) >> np.uint64(64 - BITS)).astype(np.int64))
            owners.append(doc[: len(grams)][same])
    counts = np.bincount(doc, minlength=texts)
    again = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (words[1:] == words[:-1])], minlength=texts) if len(words) else counts
    # Two indicators of the whole text: its length in words, by powers of two, and the share of words that repeat the one before.
    for salt, level in ((1, np.ceil(np.log2(counts + 1.0))), (2, np.ceil(16.0 * again / np.maximum(counts, 1)))):
        parts.append((mix(level.astype(np.uint64) + np.uint64(salt << 50)) >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(np.arange(texts))
    # Distinct (text, place) by a dense mark of GROUP * DIM bytes at most: no sort.
    mark = np.zeros(texts * DIM, bool)
    for place, owner in zip(parts, owners, strict=True):
        mark[owner * DIM + place] = True
    keys = np.flatnonzero(mark)
    return keys & (DIM - 1), np.bincount(keys >> BITS, minlength=texts)


def _shapes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A word's shape: length class, capitals, last byte if no letter, and whether it repeats the word before."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    upper = lambda x: (x >= 65) & (x <= 90)
    last = raw[end - 1].astype(np.uint64)
    letter = ((last >= 97) & (last <= 122)) | ((last >= 65) & (last <= 90)) | (last >= 128)
    same = np.zeros(len(start), bool)
    same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    code = np.minimum(3, size // 3).astype(np.uint64) | upper(raw[start]).astype(np.uint64) << np.uint64(2) | (upper(raw[np.minimum(start + 1, len(raw) - 1)]) & (size > 1)).astype(np.uint64) << np.uint64(3)
    return mix(code | np.where(letter, 0, last).astype(np.uint64) << np.uint64(8) | same.astype(np.uint64) << np.uint64(20) | np.uint64(1 << 40))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: rows and feature counts of each class, and the features of rows in the fit sample."""
    counts, rows_of = np.zeros((2, DIM), np.int64), np.zeros(2, np.int64)
    for rows, raw, offs in slices(batches, 1 << 19):
        index, per = features(raw, offs)
        label = int_column(rows, "label")
        by = np.repeat(label, per)
        for c in (0, 1):
            counts[c] += np.bincount(index[by == c], minlength=DIM)
        rows_of += np.bincount(label, minlength=2)[:2]
        chosen = np.flatnonzero(rows.column(rows.schema.get_field_index("chosen")).to_numpy(zero_copy_only=False))
        ends = np.cumsum(per)
        if len(chosen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[chosen].astype(np.int32)), pa.array([index[ends[i] - per[i] : ends[i]].astype("<i4").tobytes() for i in chosen.tolist()], pa.binary()), pa.array(int_column(rows, "rank")[chosen])],
                ["kind", "data", "place"],
            )
    for c in (0, 1):
        at = np.flatnonzero(counts[c])
        # Cut by place, so that the sums over tasks are spread over reducers.
        for lo in range(0, DIM, DIM // 8):
            own = at[(at >= lo) & (at < lo + DIM // 8)]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array([2 + c], pa.int32()), pa.array([np.concatenate([own, counts[c][own]]).astype("<i8").tobytes()], pa.binary()), pa.array([lo], pa.int64())], ["kind", "data", "place"])
        yield pa.RecordBatch.from_arrays([pa.array([4 + c], pa.int32()), pa.array([np.array([rows_of[c]], "<i8").tobytes()], pa.binary()), pa.array([0], pa.int64())], ["kind", "data", "place"])


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums count rows of the same class and places; a task holds arrays of DIM entries at most."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for kind, data, place in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            x = np.frombuffer(data, "<i8")
            if kind >= 4:
                sums[kind, 0] = sums.get((kind, 0), np.zeros(1, np.int64)) + x
            else:
                have = sums.setdefault((kind, place), np.zeros(DIM // 8, np.int64))
                have[x[: len(x) // 2] - place] += x[len(x) // 2 :]
    for (kind, place), x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([x.astype("<i8").tobytes()], pa.binary()), pa.array([place], pa.int64())], ["kind", "data", "place"])


class Rows:
    """Scaled indicator vectors of the fit, each of length 1, end to end."""

    def __init__(self, index: np.ndarray, sizes: np.ndarray, ratio: np.ndarray):
        self.index, self.ends = index, np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.value = ratio[index].astype(np.float32)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        norm = np.sqrt(np.bincount(doc, weights=self.value.astype(np.float64) ** 2, minlength=len(sizes)))
        self.value /= np.maximum(norm, 1e-12)[doc].astype(np.float32)

    def __len__(self) -> int:
        return len(self.ends)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.index[self.starts[i] : self.ends[i]], self.value[self.starts[i] : self.ends[i]]


def dual_descent(rows: Rows, own: np.ndarray, sign: np.ndarray, cost: np.ndarray, dim: int = DIM, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the L1-loss linear SVM over the rows in own; the bias last."""
    w = np.zeros(dim + 1)
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(own).tolist():
            v, x = rows.row(i)
            g = sign[i] * (float(w[v] @ x) + w[-1]) - 1.0
            a = min(max(alpha[i] - g / 2.0, 0.0), cost[i])  # a row of length 1 and the bias: norm 2
            if a != alpha[i]:
                step = (a - alpha[i]) * sign[i]
                w[v] += step * x
                w[-1] += step
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-3:
            break
    return w


def _platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps; the classes' smoothed targets."""
    pos, neg = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([d @ margin, d.sum()])
        m = np.array([[h @ margin**2 + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        step *= min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(max(a, 1e-6)), float(b)


def learn(y: np.ndarray, sizes: np.ndarray, index: np.ndarray, counts: np.ndarray, n: np.ndarray) -> dict:
    """The model of the fit's rows (labels y, places of each end to end) and the counts of all rows by class."""
    if min(n) == 0:
        share = 0.5 if n.sum() == 0 else float(n[1] / n.sum())
        return {"w": np.zeros(DIM, np.float32), "bias": float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), "a": 1.0, "b": 0.0, "ratio": np.zeros(DIM, np.float32)}
    p, q = counts[1] + SMOOTH, counts[0] + SMOOTH
    ratio = np.log(p / (n[1] + 2 * SMOOTH)) - np.log(q / (n[0] + 2 * SMOOTH))
    ratio[(counts[0] + counts[1]) < 2] = 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    cost = COST * np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum())))
    rows = Rows(index, sizes, ratio)
    # Two halves give margins of rows that the fit has not seen, for the logistic curve.
    half = np.arange(len(y)) % 2 == 0
    margin = np.zeros(len(y))
    for part in (half, ~half):
        own = np.flatnonzero(part)
        if len(set(y[own].tolist())) == 2:
            w = dual_descent(rows, own, sign, cost, epochs=6)
            for i in np.flatnonzero(~part).tolist():
                v, x = rows.row(i)
                margin[i] = float(w[v] @ x) + w[-1]
    w = dual_descent(rows, np.arange(len(y)), sign, cost)
    a, b = _platt(margin, y) if margin.any() else (1.0, 0.0)
    # The sample holds the classes in other shares than the labelled rows do.
    b += float(np.log(n[1] / n[0]) - np.log(max(1, (y == 1).sum()) / max(1, (y == 0).sum())))
    return {"w": (w[:-1] * ratio).astype(np.float32), "bias": float(w[-1]), "a": a, "b": b, "ratio": ratio.astype(np.float32)}


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row, the model, of all rows of _count's fit sample and of _total."""
    sample, counts, n = [], np.zeros((2, DIM)), np.zeros(2)
    for batch in batches:
        for kind, data, place in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if kind < 2:
                sample.append((place, kind, data))
            elif kind >= 4:
                n[kind - 4] = np.frombuffer(data, "<i8")[0]
            else:
                counts[kind - 2][place : place + DIM // 8] = np.frombuffer(data, "<i8")
    sample.sort()
    y, sizes = np.array([k for _, k, _ in sample], np.int64), np.array([len(d) // 4 for _, _, d in sample], np.int64)
    index = np.frombuffer(b"".join(d for _, _, d in sample), "<i4")
    sample.clear()
    m = learn(y, sizes, index, counts, n)
    yield pa.RecordBatch.from_arrays([pa.array([m[k].astype("<f4").tobytes()], pa.binary()) for k in ("w", "ratio")] + [pa.array([m[k]], pa.float64()) for k in ("bias", "a", "b")], ["w", "ratio", "bias", "a", "b"])
    release()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 3, rest: int = 1, fit_rows: int = FIT_ROWS) -> dict:
    """Learns from labelled rows whose crc32(doc_id) mod `mod` isn't `rest`. A doc_id labelled twice with different
    labels teaches nothing."""
    spark = docs.sparkSession
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("long").alias("label")).where(f"doc_id is not null and label in (0, 1) and crc32(cast(cast(doc_id as string) as binary)) % {mod} != {rest}")
    train = train.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_other")).where("label = _other").drop("_other")
    # The fit sample: the fit_rows smallest hashes of each class, found by a threshold (a sort of two small groups would do, but this needs no shuffle of texts).
    train = train.withColumn("rank", F.xxhash64("doc_id"))
    cuts = {}
    for c in (0, 1):
        top = train.where(F.col("label") == c).select("rank").orderBy("rank").limit(fit_rows).agg(F.max("rank")).first()[0]
        cuts[c] = -(2**63) if top is None else top
    train = train.withColumn("chosen", F.col("rank") <= F.when(F.col("label") == 1, F.lit(cuts[1])).otherwise(F.lit(cuts[0])))
    # Texts without a training label stay where they are: a bit map of the labelled ids tells nearly all of them.
    texts = only(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.col("text").cast("string").alias("text")), train, "doc_id")
    known = texts.join(train, "doc_id").select("text", "label", "rank", "chosen")
    where = shared_dir(spark)
    counted = materialise(known.mapInArrow(_count, "kind int, data binary, place long"), where, "counts")
    totals = counted.where("kind >= 2").repartition(16, "kind", "place").mapInArrow(_total, "kind int, data binary, place long")  # 2 * DIM numbers
    # One task learns, of 2 * fit_rows rows and 2 * DIM numbers at most: the driver has less memory, and gets the model only.
    learned = counted.where("kind < 2").unionByName(totals).repartition(1).mapInArrow(_learn, "w binary, ratio binary, bias double, a double, b double").collect()
    if not learned:  # no partition, no row
        return learn(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<i4"), np.zeros((2, DIM)), np.zeros(2))
    w, ratio, bias, slope, shift = learned[0]
    return {"w": np.frombuffer(w, "<f4"), "bias": bias, "a": slope, "b": shift, "ratio": np.frombuffer(ratio, "<f4")}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """docs' columns plus score (probability of label 1)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*docs.drop("score").schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        square = m["ratio"].astype(np.float64) ** 2
        for rows, raw, offs in slices(batches, 1 << 19):
            index, per = features(raw, offs)
            doc = np.repeat(np.arange(len(per)), per)
            dot = np.bincount(doc, weights=m["w"][index], minlength=len(per))
            norm = np.sqrt(np.bincount(doc, weights=square[index], minlength=len(per)))
            margin = dot / np.maximum(norm, 1e-12) + m["bias"]
            value = 1 / (1 + np.exp(-np.clip(m["a"] * margin + m["b"], -30, 30)))
            keep = [n for n in rows.schema.names if n != "score"]
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(n)) for n in keep), pa.array(value)], [*keep, "score"])

    return docs.drop("score").mapInArrow(run, schema)
