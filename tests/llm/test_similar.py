import random

import numpy as np
import pytest

from millrace.llm import common, components, parity_join
from tests.llm import brute
from tests.llm.test_scans import frame


def near_copies(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    out = list(brute.EDGE) + brute.EDGE[2:6]
    passage = [word() for _ in range(40)]
    for size in (1, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 30, 60, 150, 400):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for _ in range(r.randint(1, 12)):
                w = list(base)
                for _ in range(r.choice([0, 0, 1, 1, 2, 3, size // 12, size // 30])):
                    how, i = r.random(), r.randrange(len(w))
                    if how < 0.4:
                        w[i] = word()
                    elif how < 0.7:
                        w.insert(i, word())
                    elif len(w) > 1:
                        del w[i]
                if r.random() < 0.15:
                    w += passage
                out.append(" ".join(w).upper() if r.random() < 0.1 else "  ".join(w))
    r.shuffle(out)
    return out


@pytest.mark.parametrize(("group", "few", "ties"), [(2048, 4, 16), (6, 0, 1), (4, 4, 2)])
def test_components_match_brute_force(spark, monkeypatch, group, few, ties):
    monkeypatch.setattr(parity_join, "GROUP", group)
    monkeypatch.setattr(parity_join, "FEW", few)
    monkeypatch.setattr(parity_join, "TIES", ties)
    monkeypatch.setattr(components, "TASK_EDGES", 200_000 if few and group > 4 else 0)
    texts = near_copies(group)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in parity_join.similar(frame(spark, texts, 100).repartition(5)).collect()}
    want = brute.components({i + 100: t for i, t in enumerate(texts)})
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_chain_and_edges(spark):
    words = [f"w{i}" for i in range(300)]
    chain = [" ".join(words[i * 12 : i * 12 + 150]) for i in range(10)]  # neighbours link, distant ones don't
    got = {x.doc_id: x.component_id for x in parity_join.similar(frame(spark, chain)).collect()}
    assert got == {k: c for k, (_, c) in brute.components(dict(enumerate(chain))).items()} and set(got.values()) == {0}
    assert parity_join.similar(frame(spark, ["x"]).limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (None, "x")], "doc_id long, text string")
    got = [(x.doc_id, x.n_shingles, x.component_id) for x in parity_join.similar(twice).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1), (1, 1, 1), (2, 0, 2), (None, 1, None)], key=str)
    shared = spark.createDataFrame([(None, "a b"), (7, "a b"), (None, "c d"), (None, None)], "doc_id long, text string")
    got = [(x.doc_id, x.component_id) for x in parity_join.similar(shared).collect()]
    assert sorted(got, key=str) == sorted([(None, 7), (7, 7), (None, None), (None, None)], key=str)


def test_bit_maps_and_joins_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "MAP_VALUES", 0)
    texts = near_copies(3)[:120]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in parity_join.similar(frame(spark, texts)).collect()}
    assert got == brute.components(dict(enumerate(texts)))


def test_bands_bound_the_difference():
    b = parity_join.Bands(80, 100)
    for a in range(1, 400):
        for c in range(a, int(a / 0.8) + 1):
            i = -(-80 * (a + c) // 180)
            if i <= a:
                assert int(b.of(np.array([c]))[0]) - int(b.of(np.array([a]))[0]) in (0, 1)
                assert a + c - 2 * i <= b.d[b.of(np.array([a]))[0]]
