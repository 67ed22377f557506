import math
import re

import corpus_pipeline as cp
import pytest

from millrace.llm import nbsvm
from tests.llm import brute
from tests.llm.test_quality import one_by_one

SF = "/root/testdata/sf0.001"


def redacted(text):
    """The confirmed spans of the brute force, replaced in order of start."""
    if text is None:
        return None
    found = []
    for k, p, ok in (
        ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("IP", r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("CARD", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(re.sub("[^0-9]", "", v)) <= 19 and brute.luhn(re.sub("[^0-9]", "", v))),
        ("PHONE", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15),
    ):
        found += [(m.start(), m.end(), k) for m in re.finditer(p, text) if ok(m[0])]
    out, at = "", 0
    for a, b, k in sorted(found):
        if a >= at:
            out += text[at:a] + f"[{k}]"
        at = max(at, b)
    return out + text[at:]


@pytest.mark.parametrize("extra", [False, True])
def test_each_stage_against_brute_force(spark, tmp_path, extra):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if extra:
        rows = [(900_000 + i, t, None, None, None) for i, t in enumerate([t for t in brute.EDGE if t is None or len(t) < 9000])]
        docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).unionByName(docs.limit(5))
    docs = cp.materialise(docs, str(tmp_path), "in")
    model = nbsvm.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in nbsvm.score(docs, model).where("score >= 0.5").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    for i, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = cp.materialise(stage(spark, docs, SF), str(tmp_path), name)
        rows = docs.collect()
        if i < 4:
            assert docs.columns == cp.COLUMNS
        got = {r.doc_id for r in rows}
        if name == "quality":
            assert got == good and len(good) > 100
            for d, r in before.items():  # the score of short texts, feature by feature
                if len(r.text or "") < 400:
                    own = one_by_one(r.text)
                    margin = sum(float(model["w"][x]) for x in own) / max(1e-12, math.sqrt(sum(float(model["ratio"][x]) ** 2 for x in own))) + model["bias"]
                    assert (d in got) == (model["a"] * margin + model["b"] >= 0) or abs(model["a"] * margin + model["b"]) < 1e-4
        elif name == "near_duplicates":
            comp = brute.components({d: r.text for d, r in before.items()})
            assert got == {d for d, (_, c) in comp.items() if c == d} and len(rows) == len(got) < len(before)
        elif name == "decontamination":
            hit = brute.hits({d: r.text for d, r in before.items()}, items)
            assert got == {d for d, h in hit.items() if not h[4]} and len(got) < len(before)
        elif name == "private_data":
            assert {r.doc_id: r.text for r in rows} == {d: redacted(r.text) for d, r in before.items()}
            assert any(r.text != text[r.doc_id] for r in rows)
        else:
            ids = brute.ids_of([r.text for r in before.values()], 0)
            assert {d: len(x) for d, x in zip(before, ids, strict=True)} == {d: sum(r.length for r in rows if r.doc_id == d) for d in got}
            assert len({r.sequence_id for r in rows}) <= 1.02 * sum(map(len, ids)) / 2048 + 1
            assert all(r.ids_crc32 == brute.crc(dict(zip(before, ids, strict=True))[r.doc_id][r.start : r.start + r.length]) for r in rows)


def test_run_is_the_stages_in_order(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 2048


def test_empty(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = cp.materialise(stage(spark, docs, SF), str(tmp_path), "x" + _)
        assert docs.count() == 0


def test_near_duplicates_keep_unlike_texts_of_one_id_and_rows_without_an_id(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (2, one), (2, two), (None, three), (None, three), (None, two), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, one), (2, two), (None, three), (3, None)], key=str)
