import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import packing, simple8b
from millrace.llm.queries import vocabulary
from tests.llm import brute
from tests.llm.test_scans import frame


@pytest.mark.parametrize("n", [0, 1, 59, 60, 511, 512, 513, 3000])
def test_simple8b_round_trip(n):
    r = np.random.default_rng(n)
    for a in (r.integers(0, 2, n), r.integers(0, 49408, n), r.integers(0, 2**63, n), r.integers(0, 2**62, n) >> r.integers(0, 62, n), np.full(n, 2**64 - 1, np.uint64)):
        a = a.astype(np.uint64)
        s = simple8b.encode(a)
        assert (simple8b.decode(s) == a).all()
        if n > 1024:
            assert (simple8b.decode(s, 1, 1) == a[512:1024]).all()


def test_simple8b_files(spark, monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", 50)
    r = random.Random(1)
    texts = brute.EDGE + [" ".join(r.choice(["alpha", "Beta,", "x9", "—", "naïve!"]) for _ in range(r.randint(0, 60))) for _ in range(80)]
    order = list(range(len(texts)))
    r.shuffle(order)
    docs = spark.createDataFrame([(i * 10, texts[i]) for i in order], "doc_id long, text string").repartition(5)
    got = sorted((x.doc_id, x.start, x.n_tokens, x.ids_crc32) for x in simple8b.round_trip(docs, vocabulary(), 1).collect())
    want, at = [], 0
    for i, ids in enumerate(brute.ids_of(texts, 1)):
        want.append((i * 10, at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert got == want
    assert simple8b.round_trip(docs.limit(0), vocabulary(), 1).count() == 0
    assert simple8b.round_trip(spark.createDataFrame([(1, "a"), (1, "a")], "doc_id long, text string"), vocabulary(), 1).count() == 2


@pytest.mark.parametrize("round_items", [10, 200_000])
def test_packing(spark, monkeypatch, round_items):
    monkeypatch.setattr(packing, "ROUND_ITEMS", round_items)
    r = random.Random(2)
    texts = brute.EDGE + ["word " * r.randint(0, 120) for _ in range(200)]
    got = packing.pack(frame(spark, texts).repartition(6), vocabulary(), 0, 64).collect()
    ids = dict(enumerate(brute.ids_of(texts, 0)))
    by_doc, by_seq = {}, {}
    for x in got:
        by_doc.setdefault(x.doc_id, []).append(x)
        by_seq.setdefault(x.sequence_id, []).append(x)
    assert set(by_doc) == set(ids)
    for d, rows in by_doc.items():
        rows.sort(key=lambda x: x.piece)
        assert [x.piece for x in rows] == list(range(len(rows))) and [x.start for x in rows] == [64 * i for i in range(len(rows))]
        assert sum(x.length for x in rows) == len(ids[d]) and all(x.length == 64 for x in rows[:-1])
        assert all(x.ids_crc32 == brute.crc(ids[d][x.start : x.start + x.length]) for x in rows)
    for rows in by_seq.values():
        at = 0
        for x in sorted(rows, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 64
    total = sum(map(len, ids.values()))
    assert len(by_seq) <= 1.1 * -(-total // 64)
    assert packing.pack(frame(spark, ["x"]).limit(0), vocabulary()).count() == 0


def test_bins_that_never_fill_stay_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_ITEMS", 10)
    bins = 1000
    cols = {"doc_id": np.arange(bins), "piece": np.zeros(bins, np.int32), "start": np.zeros(bins, np.int64), "length": np.full(bins, 40), "ids_crc32": np.zeros(bins, np.int64), "bin": np.arange(bins), "offset": np.zeros(bins, np.int64)}
    batches = [pa.RecordBatch.from_pydict({k: v[a : a + 64] for k, v in cols.items()}) for a in range(0, bins, 64)]
    out = list(packing._merge(64, 64)(iter(batches)))
    assert max(b.num_rows for b in out) == 10 and sum(b.num_rows for b in out) == bins
    one = {k: np.append(np.zeros(500, v.dtype) if k == "bin" else v[:500], v[500:520]) for k, v in cols.items()}
    one["length"], one["offset"] = np.ones(520, np.int64), np.append(np.arange(500), np.zeros(20, np.int64))
    monkeypatch.setattr(packing, "LOCAL_PIECES", 100)
    out = list(packing._merge(600, 600)(iter([pa.RecordBatch.from_pydict(one)])))
    assert [b.num_rows for b in out] == [500, 10, 10]  # a bin is never torn
    docs = frame(spark, ["word " * 39] * 300).repartition(7)
    got = packing.pack(docs, vocabulary(), 0, 64).collect()
    assert len(got) == 300 and len({x.sequence_id for x in got}) == 300


def test_packing_is_near_best_fit_over_all(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_ITEMS", 40)
    r = random.Random(4)
    texts = ["word " * r.choice([r.randint(0, 60), 30, 33, 90]) for _ in range(900)]
    got = packing.pack(frame(spark, texts).repartition(9), vocabulary(), 0, 64).collect()
    sizes = np.array([x.length for x in got])
    assert len({x.sequence_id for x in got}) <= 1.02 * (packing.best_fit(sizes, 64).max() + 1)


def test_missing_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, None), (None, None)], "doc_id long, text string")
    assert sorted(((x.doc_id, x.length) for x in packing.pack(docs, vocabulary()).collect()), key=str) == sorted([(None, 3), (3, 1), (None, 1)], key=str)
    assert sorted(((x.doc_id, x.n_tokens) for x in simple8b.round_trip(docs, vocabulary()).collect()), key=str) == sorted([(None, 3), (3, 1), (None, 1)], key=str)
