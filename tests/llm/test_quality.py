import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import nbsvm
from tests.llm import brute
from tests.llm.test_scans import frame


def test_learns_and_scores_held_out(spark):
    r = random.Random(4)
    good = lambda: " ".join("".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(2, 8))) for _ in range(40)) + "."
    texts = [good() if i % 4 else good().upper().replace(" ", "!! ") for i in range(300)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    model = nbsvm.fit(docs, labels)
    got = nbsvm.score(docs, model).collect()
    assert sum((x.score >= 0.5) == bool(x.doc_id % 4) for x in got) / 300 > 0.98
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "score"}


def test_edges(spark):
    docs = frame(spark, brute.EDGE)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = nbsvm.fit(docs, none)
    assert {x.score for x in nbsvm.score(docs, model).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(10)] + [(3, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    assert all(x.score > 0.5 for x in nbsvm.score(docs, nbsvm.fit(docs, one)).collect())
    assert nbsvm.score(docs.limit(0), model).count() == 0


def one_by_one(text):
    """Features of a text, n-gram by n-gram."""
    from millrace.llm.hashing import gram_hashes, mix, word_hashes

    place = lambda x: int(mix(np.array([x % 2**64], np.uint64))[0]) >> (64 - nbsvm.BITS)
    raw = (text or "").encode()
    out = {place(int.from_bytes(raw[i : i + n], "big") + (n << 40)) for n in range(1, 5) for i in range(len(raw) - n + 1)}
    words = [w.encode() for w in brute.WORD.findall(text or "")]
    h = [int(word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
    shapes = []
    for i, w in enumerate(words):
        upper = lambda c: 65 <= c <= 90
        code = min(3, len(w) // 3) | upper(w[0]) << 2 | (len(w) > 1 and upper(w[1])) << 3
        letter = 97 <= w[-1] <= 122 or upper(w[-1]) or w[-1] >= 128
        code |= (0 if letter else w[-1]) << 8 | (i > 0 and h[i] == h[i - 1]) << 20 | 1 << 40
        shapes.append(int(mix(np.array([code], np.uint64))[0]))
    out |= {place(x) for x in h}
    for codes, n in ((h, 2), (shapes, 1), (shapes, 2), (shapes, 3)):
        for i in range(len(codes) - n + 1):
            g = int(gram_hashes(np.array(codes[i : i + n], np.uint64), n)[0]) if n > 1 else codes[i]
            out.add(place(g + n))
    again = sum(a == b for a, b in zip(h, h[1:], strict=False))
    out.add(place(math.ceil(math.log2(len(h) + 1)) + (1 << 50)))
    out.add(place(math.ceil(16 * again / max(1, len(h))) + (2 << 50)))
    return out


def test_features_match_those_taken_one_by_one(monkeypatch):
    monkeypatch.setattr(nbsvm, "GROUP", 3)
    texts = [t for t in brute.EDGE if t is None or len(t) < 9000] + ["A same same SAME b.", "é", "Ab ab. AB! x"]
    raw = b"".join((t or "").encode() for t in texts)
    offs = np.cumsum([0, *(len((t or "").encode()) for t in texts)])
    index, per = nbsvm.features(np.frombuffer(raw, np.uint8), offs)
    ends = np.cumsum(per)
    for i, t in enumerate(texts):
        assert set(index[ends[i] - per[i] : ends[i]].tolist()) == one_by_one(t) and len(one_by_one(t)) == per[i]


def test_counts_ratios_and_scores_match_brute_force(spark):
    r = random.Random(6)
    texts = [" ".join(r.choice(["a", "bb", "Cc", "d!", "e1"] if i % 3 else ["A", "b", "cc?", "DD", "e1"]) for _ in range(r.randint(0, 12))) for i in range(80)] + [None]
    label = {i: int(i % 3 > 0) for i in range(70)}
    model = nbsvm.fit(frame(spark, texts), spark.createDataFrame(list(label.items()), "doc_id long, quality int"))
    counts, rows = [Counter(), Counter()], [0, 0]
    for i, y in label.items():
        if zlib.crc32(str(i).encode()) % 3 != 1:
            counts[y].update(one_by_one(texts[i]))
            rows[y] += 1
    for x in range(nbsvm.DIM):
        n, p = counts[0][x], counts[1][x]
        want = math.log((p + 1) / (rows[1] + 2)) - math.log((n + 1) / (rows[0] + 2)) if n + p > 1 else 0.0
        assert model["ratio"][x] == pytest.approx(want, abs=1e-5)
    got = {x.doc_id: x.score for x in nbsvm.score(frame(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        own = one_by_one(t)
        margin = sum(float(model["w"][x]) for x in own) / max(1e-12, math.sqrt(sum(float(model["ratio"][x]) ** 2 for x in own))) + model["bias"]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(model["a"] * margin + model["b"]))), abs=1e-5)


def test_dual_descent_closes_the_duality_gap():
    r = np.random.default_rng(2)
    n, dim = 60, 12
    sizes = r.integers(1, 7, n)
    index = np.concatenate([np.sort(r.choice(dim, k, replace=False)) for k in sizes])
    rows = nbsvm.Rows(index, sizes, r.normal(size=dim))
    x = np.zeros((n, dim + 1))
    for i in range(n):
        v, a = rows.row(i)
        x[i, v], x[i, -1] = a, 1
    sign, cost = np.where(r.random(n) < 0.5, 1.0, -1.0), np.full(n, 0.7)
    w = nbsvm.dual_descent(rows, np.arange(n), sign, cost, dim, epochs=3000)
    primal = lambda w: 0.5 * w @ w + cost @ np.maximum(0, 1 - sign * (x @ w))
    # The dual by plain projected gradient steps.
    q, alpha = (sign[:, None] * x) @ (sign[:, None] * x).T, np.zeros(n)
    for _ in range(100_000):
        alpha = np.clip(alpha - (q @ alpha - 1) / np.linalg.norm(q, 2), 0, cost)
    dual = alpha.sum() - 0.5 * alpha @ q @ alpha
    assert primal(w) == pytest.approx(dual, rel=2e-2)


def test_extra_columns_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "Good text here.", 0.3, 4), (None, None, 0.4, 5)], "doc_id long, text string, score double, label int")
    model = nbsvm.fit(docs, spark.createDataFrame([(1, 1, 2), (None, 0, 3)], "doc_id long, quality int, text int"))
    got = nbsvm.score(docs, model)
    assert got.columns == ["doc_id", "text", "label", "score"] and got.count() == 2
    assert nbsvm.score(docs.limit(0), nbsvm.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int"))).count() == 0


def test_the_driver_does_not_learn(spark, monkeypatch):
    """The fit's rows take hundreds of MB, which the driver need not have: it gets the model only."""
    import os

    driver, descent = os.getpid(), nbsvm.dual_descent

    def elsewhere(*a, **b):
        assert os.getpid() != driver
        return descent(*a, **b)

    monkeypatch.setattr(nbsvm, "dual_descent", elsewhere)
    texts = {i: f"good words {i} here" if i % 2 else f"bad junk {i} !!!" for i in range(60)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    model = nbsvm.fit(docs, spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int"))
    got = {x.doc_id: x.score for x in nbsvm.score(docs, model).collect()}
    assert all((s > 0.5) == bool(i % 2) for i, s in got.items())
