"""Every registered query of the package, on whole tables: against its SQL in DuckDB, or else against brute force."""

import glob
import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import pytest

from millrace.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def rows(spark, name):
    got = queries.queries()[name](spark, SF).collect()
    return {r.doc_id: r for r in got}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = queries.queries()[name](spark, SF)
    cur = con.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(cur.fetchall())


def test_all_ten_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 11))


def test_op1(spark, texts):
    got = rows(spark, "op1_ownership_secrets")
    assert {i: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for i, r in got.items()} == {i: brute.secrets(t) for i, t in texts.items()}
    for r in got.values():
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert len(spans) == len([x for x in r.verdicts.split(",") if x]) and sum(x[0] == "live" for x in spans) <= r.n_live
        base = ",".join(":".join(x) for x in spans if x[0] != "live")
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_op2(spark, texts):
    got = rows(spark, "op2_suffix_tree_scores")
    tok = {i: [*brute.WORD.findall(brute.lower(t)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in tok.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tok.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9) and r.score < 0
    assert len(got) == len(texts)


def test_op3(spark, texts):
    got, ids = rows(spark, "op3_merkle_fingerprints"), sorted(texts)
    for k, i in enumerate(ids):
        t, u = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        r, f, g = got[i], brute.merkle(t), brute.merkle(edited)
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.edit_at) == (len(t), brute.sha(edited), f, g, brute.first_difference(f, g))
        assert r.near_edited == pytest.approx(brute.likeness(f, g)) and r.near_next == pytest.approx(brute.likeness(f, brute.merkle(u)))


def test_op4(spark, texts):
    got = rows(spark, "op4_pii")
    assert {i: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for i, r in got.items()} == {i: (*brute.pii(t), brute.personal(t)[1]) for i, t in texts.items()}


def test_op8(spark, texts):
    got = queries.queries()["op8_residual_packing"](spark, SF).collect()
    ids = dict(zip(texts, brute.ids_of(list(texts.values()), 0), strict=True))
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == brute.crc(ids[r.doc_id][r.start : r.start + r.length])
    assert {d: sorted((r.piece, r.start, r.length) for r in rs) for d, rs in by_doc.items()} == {d: [(k, a, min(2048, len(x) - a)) for k, a in enumerate(range(0, len(x), 2048))] for d, x in ids.items()}
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))] and sum(r.length for r in rs) <= 2048
    assert len(by_seq) <= 1.02 * sum(map(len, ids.values())) / 2048 + 1


def test_op9(spark, texts):
    got, at = rows(spark, "op9_simple8b_output"), 0
    for i, x in sorted(zip(texts, brute.ids_of(list(texts.values()), 1), strict=True)):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(x), brute.crc(x))
        at += len(x)
    assert len(got) == len(texts)


def test_op10(spark, texts):
    got = rows(spark, "op10_quality_nbsvm")
    assert {i: r.held_out for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in texts}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    own = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert sum(p == y for p, y in own) >= 0.9 * len(own)
