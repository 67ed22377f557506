import random

import numpy as np
import pytest

from millrace.llm import sparse_suffix
from tests.llm import brute
from tests.llm.test_scans import frame
from tests.llm.test_similar import near_copies


def covered(rows):
    out = {}
    for x in rows:
        out.setdefault(x.doc_id, set()).update(range(x.start_word, x.start_word + x.n_words))
    return out


@pytest.mark.parametrize(("span", "request_bytes"), [(50, 8 << 20), (12, 2000), (13, 8 << 20), (3, 8 << 20)])
def test_repeats_match_brute_force(spark, monkeypatch, span, request_bytes):
    monkeypatch.setattr(sparse_suffix, "REQUEST_BYTES", request_bytes)
    texts = [t for t in near_copies(span) if t is None or len(t) < 10_000]
    r = random.Random(span)
    passage = " ".join(f"P{i}" for i in range(60))
    texts += [" ".join(f"q{r.randrange(9999)}" for _ in range(30)) + f" {passage} tail{i}" for i in range(5)] + ["same " * 120]
    docs = frame(spark, texts).repartition(5)
    rows = sparse_suffix.repeats(docs, span, across=False).collect()
    want = {d: w for d, w in brute.repeated(dict(enumerate(texts)), span).items() if w}
    assert covered(rows) == want
    assert sum(x.n_words for x in rows) == sum(map(len, want.values()))
    # Across documents: a document that repeats only itself is left alone.
    got = covered(sparse_suffix.repeats(docs, span).collect())
    seen = {}
    for d, t in enumerate(texts):
        w = brute.WORD.findall(brute.lower(t))
        for a in range(len(w) - span + 1):
            seen.setdefault(tuple(w[a : a + span]), []).append((d, a))
    want = {}
    for places in seen.values():
        if len({d for d, _ in places}) > 1:
            for d, a in places:
                want.setdefault(d, set()).update(range(a, a + span))
    assert got == want and len(texts) - 1 not in got or span == 3


def test_edges(spark):
    assert sparse_suffix.repeats(frame(spark, brute.EDGE)).count() == 0
    assert sparse_suffix.repeats(frame(spark, ["x"]).limit(0)).count() == 0
    text = " ".join(map(str, range(60)))
    rows = spark.createDataFrame([(None, f"a {text}", 1, 2), (None, f"b {text}", 1, 2), (4, f"{text} c", 1, 2)], "doc_id long, text string, first int, kind int")
    assert sorted(((x.doc_id, x.start_word, x.n_words) for x in sparse_suffix.repeats(rows).collect()), key=str) == sorted([(None, 1, 60), (None, 1, 60), (4, 0, 60)], key=str)
    twice = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert sparse_suffix.repeats(twice).count() == 0 and sparse_suffix.repeats(twice, across=False).count() == 2


def test_a_common_phrase_in_many_surroundings_is_dealt_out(spark):
    """Forty words that all texts share make no common core of their own with others' surroundings; passages of fifty are found."""
    r = random.Random(9)
    phrase = " ".join(f"p{i}" for i in range(40))
    texts = [" ".join(f"x{r.randrange(10**9)}" for _ in range(20)) + f" {phrase} " + " ".join(f"y{r.randrange(10**9)}" for _ in range(20)) for _ in range(200)]
    texts += [f"z {phrase} " + " ".join(f"w{i}" for i in range(10)) + f" end{j}" for j in range(3)]
    docs = frame(spark, texts).repartition(5)
    assert covered(sparse_suffix.repeats(docs).collect()) == {200 + j: set(range(51)) for j in range(3)}  # "z", the phrase and ten words


def test_extension_by_common_prefixes():
    core, r = np.zeros(300, np.uint64), np.random.default_rng(5)
    side, doc = r.integers(1, 3, (300, 8)).astype(np.uint32), r.integers(0, 40, 300)
    got = sparse_suffix.extended(core, side, doc, doc, np.zeros(300, bool), 4, True)
    for i in range(300):
        for j in range(5):
            same = (side[:, :j] == side[i, :j]).all(axis=1) & (side[:, 4 : 8 - j] == side[i, 4 : 8 - j]).all(axis=1)
            assert got[i, j] == (len(set(doc[same])) > 1)
