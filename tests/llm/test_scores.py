import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import suffix_tree
from tests.llm import brute
from tests.llm.test_scans import frame


def corpus():
    r = random.Random(8)
    syl = ["ther", "in", "an", "ou", "st", "é", "tion"]
    return brute.EDGE + [" ".join("".join(r.choice(syl) for _ in range(r.randint(1, 3))).title() for _ in range(r.randint(0, 60))) + "." for _ in range(150)]


@pytest.mark.parametrize("request_bytes", [8 << 20, 3000])
def test_base_scores(spark, monkeypatch, request_bytes):
    monkeypatch.setattr(suffix_tree, "REQUEST_BYTES", request_bytes)
    texts = corpus()
    tok = [[*brute.WORD.findall(brute.lower(t)), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = Counter(w for t, h in zip(tok, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    got = {x.doc_id: x for x in suffix_tree.score(frame(spark, texts).repartition(4)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(tok):
        x = got[i]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(x.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    out = [x for i, x in got.items() if x.held_out and i >= len(brute.EDGE)]
    assert sum(x.score for x in out) > sum(x.base_score for x in out)


def test_tree_is_proper_and_scores_by_longest_suffix(spark, monkeypatch):
    texts = corpus()
    tree = suffix_tree.train(frame(spark, texts).select("doc_id", "text"), 7, 2)
    p = 10.0 ** tree["logp"][:-1].astype(float)
    assert np.allclose(p.sum(axis=1), 1.0, atol=1e-4) and len(p) > 20
    none = len(tree["child"]) - 1
    got = {x.doc_id: x.score for x in suffix_tree.score(frame(spark, texts)).collect()}
    for i in (0, 4, 6, len(texts) - 1, len(texts) - 5):
        s = [suffix_tree.BEFORE] * suffix_tree.DEPTH + list(" ".join(brute.WORD.findall(brute.lower(texts[i]))).encode()) + [suffix_tree.END]
        want = 0.0
        for j in range(suffix_tree.DEPTH, len(s)):
            state, d = 0, 1
            while d <= suffix_tree.DEPTH and tree["child"][state, s[j - d]] != none:
                state, d = tree["child"][state, s[j - d]], d + 1
            want += float(tree["logp"][state, s[j]])
        assert math.isclose(got[i], want, rel_tol=1e-6)


@pytest.mark.parametrize("gain", [10.0, 1.0])
def test_scores_match_a_tree_of_dictionaries(spark, monkeypatch, gain):
    monkeypatch.setattr(suffix_tree, "GAIN", gain)
    texts = corpus()[:-40]
    texts = [t for t in texts if t is None or len(t) < 3000]
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    want = brute.tree_scores(train, texts, suffix_tree.DEPTH, suffix_tree.LEAST_COUNT, gain, suffix_tree.SMOOTH)
    got = {x.doc_id: x.score for x in suffix_tree.score(frame(spark, texts).repartition(3)).collect()}
    assert all(math.isclose(got[i], w, rel_tol=1e-5, abs_tol=1e-5) for i, w in enumerate(want))


def test_places_sorted_by_value_give_the_same_runs():
    code = np.random.default_rng(3).integers(0, 1 << 20, 5000).astype(np.uint64) << np.uint64(30)
    by, grams, cut = suffix_tree._runs(code)
    assert sorted(by.tolist()) == list(range(5000))
    assert (np.repeat(grams, np.diff(np.append(cut, 5000))) == code[by]).all()


def test_edges(spark):
    assert suffix_tree.score(frame(spark, ["x"]).limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (5, None), (5, None)], "doc_id long, text string")
    got = suffix_tree.score(rows).collect()
    assert sorted(x.n_tokens for x in got) == [1, 1, 3] and {x.train_tokens for x in got} <= {1, 2, 3, 4, 5}


def test_contexts_do_not_fall_out_as_the_corpus_grows(spark):
    """Only the rare texts have tt, always before e: 20 places of over a million, far below a share of 1e-4."""
    rare = ["atte natte"] * 12
    r = random.Random(3)
    filler = [" ".join("".join(r.choice("aehinorst") for _ in range(r.randint(2, 7))).replace("tt", "t").replace("tt", "t") for _ in range(4000)) for _ in range(60)]
    assert sum(map(len, filler)) > 1_000_000
    docs = frame(spark, rare + filler).select("doc_id", "text")
    tree = suffix_tree.train(docs, 7, 2)
    child, none, text = tree["child"], len(tree["child"]) - 1, rare[0].encode()
    assert child[child[0, ord("t")], ord("t")] != none and tree["logp"][child[child[0, ord("t")], ord("t")], ord("e")] > -0.3
    s, want = [suffix_tree.BEFORE] * suffix_tree.DEPTH + list(text) + [suffix_tree.END], 0.0
    for j in range(suffix_tree.DEPTH, len(s)):
        state, d = 0, 1
        while d <= suffix_tree.DEPTH and child[state, s[j - d]] != none:
            state, d = child[state, s[j - d]], d + 1
        want += float(tree["logp"][state, s[j]])
    assert math.isclose(suffix_tree.score(docs).where("doc_id = 0").first().score, want, rel_tol=1e-6)
