"""Every query with SQL gives the same rows in DuckDB, on the smallest tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from millrace import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "as_tuple"):
        return round(float(v), 9)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(catalog.SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    assert got or name in ("filter_uncached",)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_rows_only(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["source1_entity_id", "matched_entity_ids"] and df.where("matched_entity_ids <> ''").count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_end_to_end_and_full_features_use_all_passes(spark):
    """Orders without a country share no key with their customer: only similar names find them."""
    every = {tuple(r) for r in catalog.candidates_all_passes(spark, SF).select("source1_entity_id", "source2_entity_id").collect()}
    assert every > {tuple(r) for r in catalog.candidates_union(spark, SF).select("source1_entity_id", "source2_entity_id").collect()}
    assert {(r.source1_entity_id, r.source2_entity_id) for r in catalog.pair_features_v3_full(spark, SF).collect()} == every
    found = [x for r in catalog.er_end_to_end(spark, SF).collect() for x in r.matched_entity_ids.split(",") if x]
    assert any(int(x[1:]) % 11 == 0 for x in found)


@pytest.mark.parametrize("name", ["candidates_all_passes", "candidates_all_passes_v1", "er_end_to_end"])
def test_sides_are_normalised_once(spark, name):
    """What several steps read is written before: the last plan normalises no text again."""
    assert "_nfkc" not in catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
