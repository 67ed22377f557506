import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace import config, worker
from millrace.operators import experiments, features, metrics, models, providers, quality, setops, sharding, submission
from millrace.plans import blocking, er, pairs, tfidf
from millrace.functions import text as T
from millrace.sources import readers, synthetic
from millrace.streaming import resume


def items(spark, n=100):
    return spark.createDataFrame([(f"item_{i}", i) for i in range(n)], "id string, value int")


def test_shards_are_disjoint_and_complete(spark):
    df = items(spark)
    parts = [sharding.get_shard(df, "id", i, 5) for i in range(5)]
    row = sharding.verify_shards(df, parts, "id").first()
    assert (row.total_ids, row.covered_ids, row.overlapping_ids, row.complete) == (100, 100, 0, True)
    assert sum(p.count() for p in parts) == 100
    for bad in ((5, 5), (-1, 5)):
        with pytest.raises(ValueError):
            sharding.get_shard(df, "id", *bad)
    with pytest.raises(ValueError):
        sharding.get_shard(df, "nope", 0, 5)


def test_splits(spark):
    df = spark.createDataFrame([(i, i % 3, "ABCD"[i % 4]) for i in range(200)], "id int, target int, grp string")
    val = sharding.split(df, "id", "random", 0.2).where("split = 'val'")
    assert val.count() == 40 and sorted(r.id for r in val.collect()) == sorted(r.id for r in sharding.split(df.repartition(7), "id", "random", 0.2).where("split = 'val'").collect())
    strat = sharding.split(df, "id", "stratified", 0.2, target="target").where("split = 'val'")
    assert strat.count() == 40 and max(r["count"] for r in strat.groupBy("target").count().collect()) <= 14
    grouped = sharding.split(df, "id", "group", 0.5, group="grp")
    assert grouped.select("grp", "split").distinct().count() == 4
    assert sharding.split(df, "id", "stratified", 0.2, target="absent").where("split = 'val'").count() == 40
    with pytest.raises(ValueError):
        sharding.split(df.limit(0), "id")
    folds = sharding.balanced_folds(df, "grp", 3)
    assert folds.select("grp", "fold").distinct().count() == 4 and folds.select("fold").distinct().count() == 3


def test_balanced_folds_are_greedy_at_any_number_of_groups(spark):
    r = random.Random(4)
    for folds, sizes in ((3, [r.choice([1, 1, 2, 3, 7, 40]) for _ in range(150)]), (5, [90, *[2] * 30, *[1] * 101]), (4, [1, 1])):
        loads, want = [0] * min(folds, len(sizes)), {}
        for c, g in sorted(((c, f"g{i:03}") for i, c in enumerate(sizes)), key=lambda x: (-x[0], x[1])):
            want[g] = loads.index(min(loads))
            loads[want[g]] += c
        rows = spark.createDataFrame([(f"g{i:03}",) for i, c in enumerate(sizes) for _ in range(c)], "grp string")
        got = sharding.balanced_folds(rows, "grp", folds).collect()
        assert len(got) == sum(sizes) and {(x.grp, x.fold) for x in got} == set(want.items())
    many = spark.range(1_200_000).selectExpr("if(id < 200000, -1, id) as grp")  # 1,000,001 groups, one of 200,000 rows
    got = {x.fold: x["count"] for x in sharding.balanced_folds(many, "grp", 5).groupBy("fold").count().collect()}
    assert sum(got.values()) == 1_200_000 and max(got.values()) - min(got.values()) <= 1


def test_split_counts_are_exact_for_any_fraction(spark):
    df = items(spark, 97)
    for f in (0.01, 0.1, 0.33, 0.5, 0.99):
        assert sharding.split_random(df, "id", f).where("split = 'val'").count() == -(-97 * int(f * 100) // 100)


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", None, 1), (2, None, 2.0, 1), (3, "bb", 4.0, 1), (3, None, 6.0, 1), (None, "c", 8.0, 1)], "id int, t string, v double, k int")
    assert {r.column: r.nulls for r in quality.null_report(df).collect()} == {"id": 1, "t": 2, "v": 1}
    found = {(r.level, r.check, r.column) for r in quality.validate(df, "id", "t", ["id", "zz"]).collect()}
    assert {("error", "null_ids", "id"), ("error", "missing_column", "zz"), ("warning", "null_target", "t"), ("warning", "constant_column", "k"), ("warning", "duplicate_ids", "id")} == found
    assert ("error", "empty") in {(r.level, r.check) for r in quality.validate(df.limit(0), "id").collect()}
    assert sorted(r.v for r in quality.impute_medians(df, ["v"]).collect()) == [2.0, 4.0, 5.0, 6.0, 8.0]
    rep = quality.inspect(df)
    assert rep["rows"] == 5 and rep["duplicate_rows"] == 0 and rep["distinct"]["t"] == 3
    a, b = items(spark, 5), items(spark, 7).where("value >= 3")
    assert quality.leakage(a, b, "id", "value").orderBy("kind").collect()[1].overlap == 2
    stats = quality.text_stats(spark.createDataFrame([("hello world",), ("foo bar baz",), ("a",), (None,), ("",)], "t string"), "t").first()
    assert (stats["count"], stats.null_count, stats.empty_count, stats.word_max) == (4, 1, 1, 3)


def test_setops_and_cache(spark, tmp_path):
    a, b = items(spark, 3), items(spark, 5).where("value >= 3")
    assert setops.union_checked([a, b.select("value", "id")], "id").count() == 5
    with pytest.raises(ValueError):
        setops.union_checked([a, a], "id")
    with pytest.raises(ValueError):
        setops.union_checked([a, b.select("id")], "id")
    v = setops.verify_merge(items(spark, 6), setops.union_checked([a, b], "id"), "id").first()
    assert (v.original_rows, v.merged_rows, v.missing_ids, v.unexpected_ids) == (6, 5, 1, 0)
    assert setops.config_hash({"a": 1, "b": 2}) == setops.config_hash({"b": 2, "a": 1})
    cache = setops.Cache(spark, str(tmp_path), "emb", {"v": 1})
    assert not cache.is_valid() and cache.filter_uncached(a).count() == 3
    calls = []
    out = setops.resume(a, cache, lambda d: calls.append(d.count()) or d.withColumn("x", F.lit(1)))
    assert out.count() == 3 and calls == [3]
    out = setops.resume(items(spark, 5), cache, lambda d: calls.append(d.count()) or d.withColumn("x", F.lit(2)))
    assert calls == [3, 2] and sorted(r.x for r in out.collect()) == [1, 1, 1, 2, 2]
    cache.save(items(spark, 1).withColumn("x", F.lit(9)))
    assert cache.read().where("id = 'item_0'").first().x == 9 and cache.read().count() == 5
    cache.clear()
    assert not cache.is_valid()


def test_streaming_upsert_and_windows(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("a", 2, 5)], "id string, v int, n int").write.parquet(src)
    stream = lambda: spark.readStream.schema("id string, v int, n int").parquet(src)
    cache = setops.Cache(spark, str(tmp_path / "c"), "s")
    resume.upsert_stream(stream(), cache, ["n"], str(tmp_path / "ck")).awaitTermination()
    spark.createDataFrame([("b", 7, 9)], "id string, v int, n int").write.mode("append").parquet(src)
    resume.upsert_stream(stream(), cache, ["n"], str(tmp_path / "ck")).awaitTermination()
    assert {r.id: r.v for r in cache.read().collect()} == {"a": 2, "b": 7}
    t = datetime.datetime(2024, 1, 1)
    e = spark.createDataFrame([(t, "x"), (t + datetime.timedelta(minutes=5), "x"), (t + datetime.timedelta(hours=1), "x")], "ts timestamp, k string")
    assert sorted(r.n for r in resume.windowed_counts(e, "ts", ["k"]).collect()) == [1, 2]


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1, "a"), (0, 1, "a"), (1, 0, "b"), (0, 0, "c")], "y int, h int, g string")
    assert {r.metric: r.value for r in metrics.classification(df, "y", "h").collect()}["accuracy"] == 0.5
    multi = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "y string, h string")
    got = {r.metric: r.value for r in metrics.classification(multi, "y", "h").collect()}
    assert "f1_binary" not in got and got["f1_macro"] == pytest.approx((2 / 3 + 0 + 1) / 3, abs=1e-6)
    assert metrics.confusion_matrix(multi, "y", "h").columns == ["y_true", "a", "b", "c"]
    one = lambda rows: metrics.macro_f05(spark.createDataFrame(rows, "y int, h int, g string"), "y", "h", "g").first()[0]
    assert one([(1, 1, "a"), (0, 0, "b")]) == 1.0 and one([(1, 0, "a"), (1, 0, "b")]) == 0.0 and one([(0, 0, "a"), (0, 0, "b")]) == 1.0
    parts = [spark.createDataFrame(list(zip("abc", p, strict=True)), "id string, prediction double") for p in ([0.2, 0.4, 0.6], [0.4, 0.6, 0.8])]
    assert [round(r.prediction, 9) for r in metrics.ensemble(parts, "id", "prediction").orderBy("id").collect()] == [0.3, 0.5, 0.7]
    two = [spark.createDataFrame(list(zip("ab", p, strict=True)), "id string, prediction double") for p in ([0.0, 1.0], [1.0, 0.0])]
    assert [r.prediction for r in metrics.ensemble(two, "id", "prediction", [3, 1]).orderBy("id").collect()] == [0.25, 0.75]
    for bad in (lambda: metrics.ensemble(two, "id", "prediction", [1]), lambda: metrics.ensemble([two[0], parts[0]], "id", "prediction")):
        with pytest.raises(ValueError):
            bad()
    assert "accuracy" in metrics.format_metrics({"accuracy": 0.5})


@pytest.mark.parametrize("seed", [1, 2])
def test_threshold_searches_match_plain_loops(spark, seed):
    import random

    r = random.Random(seed)
    rows = [(r.randint(0, 1), r.choice([r.random(), 0.01, 0.5, 0.99, 0.0, 1.0, round(r.random(), 2)]), f"g{r.randint(0, 9)}") for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, p double, g string")
    thr = [0.01 + i * (0.98 / 99) for i in range(100)]
    f1 = lambda t: (lambda tp, fp, fn: 2 * tp / (2 * tp + fp + fn) if tp else 0.0)(sum(y and p >= t for y, p, _ in rows), sum((not y) and p >= t for y, p, _ in rows), sum(y and p < t for y, p, _ in rows))
    best = metrics.search_threshold(df, "y", "p").first()
    assert best.f1 == pytest.approx(max(map(f1, thr)), abs=1e-6) and best.threshold == pytest.approx(next(t for t in thr if abs(f1(t) - max(map(f1, thr))) < 1e-12), abs=1e-6)

    def f05(t):
        out = []
        for g in sorted({g for *_, g in rows}):
            tp, fp, fn = (sum(1 for y, p, h in rows if h == g and c(y, p)) for c in (lambda y, p: y and p >= t, lambda y, p: not y and p >= t, lambda y, p: y and p < t))
            out.append(1.0 if tp + fp + fn == 0 else 0.0 if tp == 0 else 1.25 * (tp / (tp + fp)) * (tp / (tp + fn)) / (0.25 * (tp / (tp + fp)) + tp / (tp + fn)))
        return sum(out) / len(out)

    got = [x.macro_f05 for x in metrics.tune_threshold_f05(df, "y", "p", "g").orderBy("threshold").collect()]
    assert got == pytest.approx([f05(0.01 + i * (0.98 / 199)) for i in range(200)], abs=1e-6)


def test_features(spark):
    base = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, val int")
    out = features.merge(base, [spark.createDataFrame([(1, 0.1), (2, 0.2), (2, 0.3)], "id int, f1 double"), spark.createDataFrame([(1, 5)], "id int, val int"), spark.createDataFrame([(9,)], "z int")], "id")
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 3 and out.columns == ["id", "val", "f1", "val_feat1"] and rows[2].f1 == 0.3 and rows[3].f1 is None
    df = spark.createDataFrame([(1, "x", 1.0, "b"), (2, None, 2.0, "a"), (3, "Y 1", None, None)], "id int, text string, price double, cat string")
    got = {r.id: r for r in features.build(df, "id", None, ("text",)).collect()}
    assert [got[i].cat_encoded for i in (1, 2, 3)] == [1, 0, -1] and got[3].text_has_digits == 1 and got[2].text_char_len == 0


def test_models(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 7), "hi" if i % 10 > 4 else "lo") for i in range(200)], "id int, f1 double, f2 double, target string")
    for kind in ("logistic", "random_forest", "gbt"):
        m, train = models.train_baseline(df, "id", "target", kind, **({"rounds": 5} if kind == "gbt" else {"trees": 10} if kind == "random_forest" else {}))
        assert train.where("target = prediction").count() > 190
        p = m.predict_proba(df).collect()
        assert all(0 <= r.proba <= 1 for r in p)
    m.save(str(tmp_path / "m"))
    again = models.Model.load(str(tmp_path / "m"))
    pred = models.batch_predict(again, df.drop("target"), "id")
    assert pred.count() == 200
    assert models.validate_predictions(pred, df, "id").first().asDict() == {"rows": 200, "expected_rows": 200, "missing_ids": 0, "duplicate_ids": 0, "null_predictions": 0}
    with pytest.raises(ValueError):
        models.train_baseline(df, "id", "absent")


def test_providers(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", None)], "id string, text string")
    got = {r.id: r.embedding for r in providers.text_embeddings(df, "id", "text", 3, lambda ts: [[float(len(t))] * 5 for t in ts]).collect()}
    assert got == {"a": [3.0] * 3, "b": [0.0] * 3}
    assert providers.expand_embedding(providers.text_embeddings(df, "id", "text", 2), 2).columns == ["id", "text_emb_0", "text_emb_1"]
    with pytest.raises(ValueError):
        providers.ocr(df, "id", "text", "none")
    scored = providers.score_pairs(df.withColumn("prompt", F.coalesce("text", F.lit(""))), "prompt", lambda ps: [(1.0, 0.0) for _ in ps])
    assert scored.first().score == pytest.approx(1 / (1 + 2.718281828 ** -1))
    assert providers.score_pairs(df.limit(0), "text").columns[-1] == "score"


def test_experiments(spark, tmp_path):
    for i in range(2):
        experiments.log(spark, str(tmp_path / "log"), experiment_id=f"e{i}", task="t", parameters={"b": 1, "a": 2}, train_score=0.5)
    got = experiments.merge([experiments.read(spark, str(tmp_path / "log"))] * 2).collect()
    assert [r.experiment_id for r in got] == ["e0", "e1"] and json.loads(got[0].parameters) == {"a": 2, "b": 1}
    with pytest.raises(ValueError):
        experiments.log(spark, str(tmp_path / "log"), nope=1)


def test_readers_and_writers(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        readers.extract(spark, folder=base)
    items(spark, 5).coalesce(1).write.parquet(f"{base}/z.parquet")
    assert readers.extract(spark, folder=base, max_rows=2, id_column="id").count() == 2
    items(spark, 5).coalesce(1).write.option("header", True).csv(f"{base}/a.csv")
    assert readers.extract(spark, folder=base).dtypes == [("id", "string"), ("value", "int")]
    ents, truth = synthetic.entity_resolution(spark, 30)
    for split in ("train", "test"):
        for i in (1, 2):
            readers.write_delimited(ents.where(f"split = '{split}' and source = {i}").select("entity_id", "business_name", "business_address", "country"), f"{base}/er/{split}/{split}_source{i}.tsv")
    readers.write_delimited(truth, f"{base}/er/train/train_ground_truth.tsv")
    got = readers.entities(spark, f"{base}/er", "train")
    assert got.select("source").distinct().count() == 2 and got.where("source = 1").count() == 21
    assert readers.ground_truth(spark, f"{base}/er").count() == 21 and readers.ground_truth(spark, base).count() == 0
    for w in (0, 1):
        readers.write_worker(items(spark, 4).where(f"value % 2 = {w}"), f"{base}/out", w, {"a": [1, {"b": 2}]}, {}, {})
    assert readers.merge_workers(spark, f"{base}/out", "id").count() == 4
    assert json.loads(spark.read.text(f"{base}/out/worker_0/config.json").first().value) == {"a": [1, {"b": 2}]}
    assert readers.predictions(spark, [f"{base}/z.parquet", f"{base}/none.parquet"], "id", "value")[0].count() == 5


def test_tfidf(spark):
    names = spark.createDataFrame([("a", "alpha beta"), ("b", "alpha beta"), ("c", "zzz"), ("d", "")], "id string, name string")
    w = tfidf.postings(names)
    pair = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d")], "a string, b string")
    assert [round(r.cosine, 9) for r in tfidf.pair_cosine(pair, w).orderBy("b").collect()] == [1.0, 0.0, 0.0]
    left = spark.createDataFrame([(1, "alpha beta"), (2, "gamma")], "id int, name string")
    right = spark.createDataFrame([(7, "alpha betas"), (8, "alpha"), (9, "delta")], "id int, name string")
    got = [(r.a, r.b) for r in tfidf.top_k(left, right, 1).collect()]
    assert got == [("1", "7")]


def test_blocking_cap_and_keys(spark):
    mk = lambda rows: T.normalize_entities(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"), "v1")
    left = mk([("l1", "Acme Foods", "12 Main 75001", "US"), ("l2", "X", "", None), ("l3", "", "12", "US")])
    right = mk([(f"r{i}", "Acme Tools", "75001 x 12", "US") for i in range(3)] + [("q", "X", None, None)])
    join = lambda key, cap=None: sorted((r[0], r[1]) for r in blocking.key_join(left, right, key, cap).collect())
    assert join(blocking.first_word_key()) == [("l1", f"r{i}") for i in range(3)]
    assert join(blocking.first_word_key(), 3) == [] and len(join(blocking.first_word_key(), 4)) == 3
    assert len(join(blocking.numeric_key())) == 3 and join(blocking.two_word_key()) == []
    gt = spark.createDataFrame([("l1", "r0"), ("l2", "q")], "source1_entity_id string, source2_entity_id string")
    row = blocking.recall(blocking.key_join(left, right, blocking.first_word_key()), gt).first()
    assert (row.gt_pairs, row.found, row.recall) == (2, 1, 0.5)


def test_pair_features_of_missing_entities(spark):
    mk = lambda rows: T.normalize_entities(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    p = spark.createDataFrame([("a", "b"), ("a", "zz")], "source1_entity_id string, source2_entity_id string")
    got = {r.source2_entity_id: r for r in pairs.features(p, mk([("a", "Acme Inc", "1 Rue X", "FR")]), mk([("b", "ACME Ltd", "1 st x", "FR")])).collect()}
    assert len(got) == 2 and set(pairs.FEATURES_V3) == set(got["b"].asDict()) - {"source1_entity_id", "source2_entity_id"} and len(pairs.FEATURES_V3) == 33 and len(pairs.FEATURES_V1) == 18
    assert got["b"].name_stripped_edit_sim == 1.0 and got["b"].addr_exact == 1.0 and got["b"].country_match == 1.0
    assert got["zz"].name_jaccard == 0.0 and got["zz"].country_both_empty == 0.0 and got["zz"].name_lcs_ratio == 0.0


def test_submission(spark):
    gt = spark.createDataFrame([("s1", " a , b"), ("s2", ""), ("s3", None)], "source1_entity_id string, matched_entity_ids string")
    assert submission.explode_truth(gt).count() == 2
    cand = spark.createDataFrame([("s1", "a", 0.9), ("s1", "c", 0.1), ("s2", "a", 0.2)], "source1_entity_id string, source2_entity_id string, proba double")
    assert [r.label for r in submission.assign_labels(cand, gt).orderBy("source1_entity_id", "source2_entity_id").collect()] == [1, 0, 0]
    left = spark.createDataFrame([("s1",), ("s2",)], "entity_id string")
    res = submission.matching_results(cand, left, 0.5)
    assert {r[0]: r[1] for r in res.collect()} == {"s1": "a", "s2": ""}
    assert submission.violations(res, left, spark.createDataFrame([("a",)], "entity_id string"), cand).count() == 0


def test_entity_resolution_end_to_end(spark, tmp_path):
    ents, truth = synthetic.entity_resolution(spark, 60)
    report = er.run(ents.where("split = 'train'"), truth, ents.where("split = 'test'"), str(tmp_path), kind="random_forest", folds=2, trees=10)
    assert report["blocking"]["recall"] > 0.9 and report["cv"]["macro_f05"] > 0.8
    res = spark.read.parquet(f"{tmp_path}/matching_results")
    left, others = er.prepare(ents.where("split = 'test'"))
    right = others[0].unionByName(others[1])
    assert submission.violations(res, left, right, spark.read.parquet(f"{tmp_path}/candidate_pairs")).where("level = 'error'").count() == 0
    assert er.llm_match(blocking.candidates(left, others, names=False), left, right).count() == left.count()


def test_config(tmp_path):
    assert config.Config().max_rows == -1 and config.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    (tmp_path / "tasks").mkdir()
    (tmp_path / "default.yaml").write_text("seed: 1\nunknown: 2\ntask: nlp\n")
    (tmp_path / "tasks" / "ocr.yaml").write_text("enable_ocr: true\n")
    c = config.load(["--config-dir", str(tmp_path), "--total-workers", "4", "--text-columns", "a", "b"], {"WORKER_ID": "2", "WORKER_TASK": "ocr"})
    assert (c.seed, c.task, c.enable_ocr, c.worker_id, c.text_columns) == (1, "ocr", True, 2, ("a", "b"))
    with pytest.raises(ValueError):
        config.Config(worker_id=3, total_workers=2)


def test_worker_tasks(spark, tmp_path):
    synthetic.tabular(spark, 120).where("part = 'train'").drop("part").write.parquet(str(tmp_path / "in.parquet"))
    base = dict(input_file=str(tmp_path / "in.parquet"), output_dir=str(tmp_path / "out"), cache_dir=str(tmp_path / "cache"), text_columns=("text",))
    for task in ("etl", "nlp", "cv", "embeddings", "baseline", "inference"):
        folder = worker.run(config.Config(task=task, enable_embeddings=True, embedding_dim=4, **base), spark)
        assert spark.read.parquet(f"{folder}/output.parquet").count() > 0
    assert worker.run(config.Config(task="etl", dry_run=True)) is None
    with pytest.raises(ValueError):
        worker.run(config.Config(task="nope"), spark)


def test_rest_works_without_the_llm_files(tmp_path):
    import shutil
    import subprocess
    import sys

    shutil.copytree("millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy("__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'er_end_to_end' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; import millrace.worker"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})


def test_quantiles_are_exact(spark, monkeypatch):
    import random

    import numpy as np

    r = random.Random(1)
    rows = [(r.choice([None, float("nan"), r.gauss(0, 1) ** 9, float(r.randrange(5))]), float(i % 3), 10.0 ** r.randint(-300, 300)) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    for near, error in ((20_000, 1e-4), (10, 0.05)):
        monkeypatch.setattr(quality, "NEAR_ROWS", near)
        monkeypatch.setattr(quality, "RANK_ERROR", error)
        got = quality.quantiles(df, {c: F.col(c) for c in "abc"}, shares)
        for k, c in enumerate("abc"):
            assert np.allclose(got[c], np.quantile([x[k] for x in rows if x[k] is not None and x[k] == x[k]], shares), rtol=1e-12)
    assert quality.quantiles(df.limit(0), {"a": F.col("a")}, [0.5]) == {"a": [None]}


def test_ensembles_with_threshold_and_of_classes(spark):
    part = lambda v: spark.createDataFrame(list(enumerate(v)), "id long, prediction double")
    truth = spark.createDataFrame(list(enumerate([0, 0, 1, 1])), "id long, y int")
    blend, best = metrics.ensemble_with_threshold([part([0.1, 0.4, 0.35, 0.8]), part([0.3, 0.2, 0.55, 0.6])], truth, "id", "prediction", "y")
    assert [round(x.prediction, 3) for x in blend.orderBy("id").collect()] == [0.2, 0.3, 0.45, 0.7]
    row = best.first()
    assert row.f1 == 1.0 and 0.3 < row.threshold <= 0.45
    blend, _ = metrics.ensemble_with_threshold([part([0.0, 1.0, 0.0, 1.0]), part([1.0, 0.0, 1.0, 0.0])], truth, "id", "prediction", "y", [3, 1])
    assert [x.prediction for x in blend.orderBy("id").collect()] == [0.25, 0.75, 0.25, 0.75]
    classes = spark.createDataFrame(list(enumerate([0, 1, 2, 2])), "id long, y int")
    got = {r.model: (r.f1_macro, r.improves) for r in metrics.compare_ensemble([part([0.0, 1.0, 2.0, 0.0]), part([1.0, 1.0, 2.0, 3.0])], classes, "id", "prediction", "y", metric="f1_macro").collect()}
    assert set(got) == {"model_0", "model_1", "ensemble"} and got["ensemble"] == (1.0, True)
    half = {r.model: r.accuracy for r in metrics.compare_ensemble([part([0.5, 1.5, 2.5, 2.0])], classes, "id", "prediction", "y").collect()}
    assert half["model_0"] == 0.75  # 0.5 -> 0, 1.5 -> 2, 2.5 -> 2


def test_image_embeddings(spark):
    df = spark.createDataFrame([(1, b"abc"), (2, None)], "id long, content binary")
    assert [list(r.embedding) for r in providers.image_embeddings(df, "id", dim=3).orderBy("id").collect()] == [[0.0] * 3] * 2
    got = providers.image_embeddings(df, "id", dim=2, model=lambda xs: [[float(len(x)), 1.0, 9.0] for x in xs]).orderBy("id").collect()
    assert [list(r.embedding) for r in got] == [[3.0, 1.0], [0.0, 1.0]]


def test_worker_folder_has_errors_readme_and_sections(spark, tmp_path):
    base = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a", None), (2, "", "Broken: x, \"y\"")], "id long, text string, error string")
    readers.write_worker(df, base, 0, {"task": "ocr", "total_workers": 2}, {}, {"total_elapsed": 1.5})
    assert [r.value for r in spark.read.text(f"{base}/worker_0/README.txt").collect()] == ["Worker 0/2", "Task: ocr", "Runtime: 1.50s"]
    assert [tuple(r) for r in readers.extract(spark, f"{base}/worker_0/errors.csv").collect()] == [(2, "Broken: x, \"y\"")]
    assert spark.read.parquet(f"{base}/worker_0/output.parquet").columns == ["id", "text"]
    with pytest.raises(FileNotFoundError):
        worker.run(config.Config(task="etl", input_dir=str(tmp_path / "none"), output_dir=base, worker_id=1, total_workers=2), spark)
    assert "FileNotFoundError" in readers.extract(spark, f"{base}/worker_1/errors.csv").first().error
    t = worker.Timer()
    assert t.summary() == {"total_elapsed": 0.0} and t.eta(0, 5, "a") == float("inf")
    with t.section("a"):
        assert t.elapsed("a") >= 0 and t.eta(1, 3, "a") >= 0
    assert set(t.summary()) == {"a", "total_elapsed"}


@pytest.mark.parametrize(("rare", "rows"), [(3, 1000), (2, 0)])
def test_top_k_matches_all_pairs(spark, monkeypatch, rare, rows):
    import random

    monkeypatch.setattr(tfidf, "RARE", rare)
    monkeypatch.setattr(tfidf, "RARE_ROWS", rows)
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randint(2, 5)))
    left, right = ([(f"{s}{i}", " ".join(word() for _ in range(r.randint(0, 3)))) for i in range(n)] for s, n in (("x", 30), ("y", 60)))
    l, q = (spark.createDataFrame(d, "id string, name string") for d in (left, right))
    both = l.select(F.concat(F.lit("l"), "id").alias("id"), "name").unionByName(q.select(F.concat(F.lit("r"), "id").alias("id"), "name"))
    pair = l.select(F.concat(F.lit("l"), "id").alias("a")).crossJoin(q.select(F.concat(F.lit("r"), "id").alias("b")))  # 30 x 60, a test
    want = {}
    for x in tfidf.pair_cosine(pair, tfidf.postings(both)).collect():
        if x.cosine > 0.2:
            want.setdefault(x.a[1:], []).append((-round(x.cosine, 9), x.b[1:]))
    got = {}
    for x in tfidf.top_k(l, q, 4, 0.2).collect():
        got.setdefault(x.a, []).append((-x.cosine, x.b))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:4] for k, v in want.items()}


def test_top_k_makes_no_pairs_of_copies(spark, monkeypatch):
    """Vectors are made of distinct names, however many rows have them; rows, ties among copies and repeated ids come out as from all pairs."""
    made, postings = [], tfidf.postings
    monkeypatch.setattr(tfidf, "postings", lambda names, m=None: (made.append(names.count()), postings(names, m))[1])
    base = ["alpha beta", "beta alpha", "alpha betas", "gamma", "gamma ray", "delta", "", None, "alpha beta gamma"]
    left = [(f"x{i}", base[i % 9]) for i in range(45)] + [("x1", "delta")]  # an id with two names is one document
    right = [(f"y{i}", base[i * 2 % 9]) for i in range(63)]
    l, q = (spark.createDataFrame(d, "id string, name string") for d in (left, right))
    got = {}
    for x in tfidf.top_k(l, q, 4, 0.2).collect():
        got.setdefault(x.a, []).append((-x.cosine, x.b))
    assert made == [9]  # 8 of base, as null is '', and the one of two names
    tag = lambda d, s: d.select(F.concat(F.lit(s), "id").alias("id"), "name")
    pair = tag(l, "l").select(F.col("id").alias("a")).distinct().crossJoin(tag(q, "r").select(F.col("id").alias("b")))  # 45 x 63, a test
    want = {}
    for x in tfidf.pair_cosine(pair, postings(tag(l, "l").unionByName(tag(q, "r")))).collect():
        if x.cosine > 0.2:
            want.setdefault(x.a[1:], []).append((-round(x.cosine, 9), x.b[1:]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:4] for k, v in want.items()}
    assert tfidf.top_k(l.limit(0), q, 4).count() == 0 and tfidf.top_k(l, q.limit(0), 4).count() == 0


def test_name_cosine_is_of_names(spark, monkeypatch):
    """Vectors and products are made once for equal names; every pair of ids gets its cosine."""
    made, postings = [], tfidf.postings
    monkeypatch.setattr(tfidf, "postings", lambda names, m=None: (made.append(names.count()), postings(names, m))[1])
    mk = lambda s, n: spark.createDataFrame([(f"{s}{i}", ["alpha beta", "alpha betas", "gamma"][i % 3]) for i in range(n)], "entity_id string, business_name_norm string")
    l, r = mk("x", 6), mk("y", 9)
    pair = l.select(F.col("entity_id").alias("source1_entity_id")).crossJoin(r.select(F.col("entity_id").alias("source2_entity_id"))).where("source2_entity_id <> 'y8'")
    got = {(x[0], x[1]): x[2] for x in pairs.name_cosine(pair, l, r).collect()}
    assert made == [3]
    tag = lambda d, s: d.select(F.concat(F.lit(s), "entity_id").alias("id"), F.col("business_name_norm").alias("name"))
    w = postings(tag(l, "1").unionByName(tag(r.where("entity_id <> 'y8'"), "2")))
    want = tfidf.pair_cosine(pair.select(F.concat(F.lit("1"), "source1_entity_id").alias("a"), F.concat(F.lit("2"), "source2_entity_id").alias("b")), w)
    assert got == {(x.a[1:], x.b[1:]): round(x.cosine, 9) for x in want.collect()} and len(got) == 48


def test_features_use_whole_texts(spark):
    """Edit distances and common substrings count what comes after the first 500 and 200 characters."""
    texts = {"x": "a" * 600 + "b" * 600, "y": "a" * 600 + "c" * 600, "p": "ab" * 300 + "q", "q": "c" * 300 + "ab" * 200}
    mk = lambda ids: spark.createDataFrame([(i, texts[i], texts[i], "us") for i in ids], "entity_id string, business_name_norm string, business_address_norm string, country_norm string")
    pair = spark.createDataFrame([("x", "y"), ("p", "q")], "source1_entity_id string, source2_entity_id string")
    got = {r.source1_entity_id: r for r in pairs.features(pair, mk("xp"), mk("yq"), "v3").collect()}
    assert got["x"].name_edit_sim == got["x"].addr_edit_sim == got["x"].name_sorted_edit_sim == got["x"].name_stripped_edit_sim == got["x"].name_expanded_edit_sim == 0.5
    assert got["x"].name_lcs_ratio == got["x"].addr_lcs_ratio == 0.5 and got["p"].name_lcs_ratio == pytest.approx(400 / 700)
    held = pairs.features(pair, mk("xp"), mk("yq"), "v3", substring=False, cosine=False, edit_chars=500).where("source1_entity_id = 'x'").first()
    assert held.name_edit_sim == 1.0


def test_longest_common_of_long_texts():
    from millrace.functions import similarity as S

    r = random.Random(3)
    for _ in range(200):
        a, b = ("".join(r.choice("abé") for _ in range(r.randint(1, 60))) for _ in range(2))
        assert S._longest_common_of_long(a, b) == S._longest_common([a], [b])[0]
    assert S._longest_common_of_long("a" * 50000, "b" + "a" * 40000) == 40000 and S._longest_common_of_long("a", "b") == 0


def test_candidates_without_cap_are_made_once(spark):
    """Without a cap pairs are distinct without a shuffle of pairs, also over several sources; a repeated id brings the shuffle back."""
    mk = lambda s, rows: spark.createDataFrame([(f"{s}{i}", *x) for i, x in enumerate(rows)], "entity_id string, business_name_norm string, business_address_norm string, country_norm string")
    left = mk("l", [("acme foods", "12 main", "us"), ("acme  tools", "12 main", "us"), ("x", "7 road", "us"), ("", None, None), ("bolt co", "9 hill", None), (None, "12", "us")])
    right = [mk("r", [("acme food", "12 main", "us"), (" acme tool", "3 main", "us"), ("bolt co", "12 x", "us"), ("x", "7", "us")]), mk("q", [("bolt co", "9 y", None), ("acme", "12", "us"), ("acme foods", None, "fr")])]
    keys = [blocking.first_word_key(), blocking.numeric_key()]
    want = {tuple(x) for x in blocking.keys_join(left, right, keys).collect()} | {tuple(x) for r in right for x in blocking.similar_names(left, r, 10).collect()}
    got = blocking.candidates(left, right, "v1")
    assert sorted(tuple(x) for x in got.collect()) == sorted(want) and len(want) > 8
    assert "keys=[source1_entity_id" not in got._jdf.queryExecution().executedPlan().toString()
    twice = blocking.candidates(left.unionByName(left.limit(1)), right, "v1")
    assert sorted(tuple(x) for x in twice.where("source1_entity_id <> 'l0'").collect()) == sorted(x for x in want if x[0] != "l0")
    assert twice.count() == twice.distinct().count()


def test_features_by_text_are_the_same(spark, monkeypatch):
    """The same rows as with derived columns joined to each pair, also for unknown and repeated ids; one measure for equal texts."""
    r = random.Random(5)
    word = lambda: r.choice(["acme", "foods", "ltd", "intl", "12", "main", "75001", "po box 7", "x"])
    mk = lambda s, n: spark.createDataFrame([(f"{s}{i % (n - 2)}", *(r.choice([None, " ".join(word() for _ in range(r.randint(0, 3)))]) for _ in range(2)), r.choice([None, "us", ""])) for i in range(n)], "entity_id string, business_name_norm string, business_address_norm string, country_norm string")
    left, right = mk("l", 8), mk("r", 12)
    pair = spark.createDataFrame([(f"l{i}", f"r{j}") for i in range(7) for j in range(11)], "source1_entity_id string, source2_entity_id string")
    for options in ({}, {"substring": False, "cosine": False}):
        want, got = pairs.features(pair, left, right, "v3", **options), pairs.features_by_text(pair, left, right, "v3", **options)
        flat = lambda d: sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in x) for x in d.select(*got.columns).collect())
        assert set(want.columns) == set(got.columns) and flat(want) == flat(got) and want.count() > 77
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [n1" in plan and "Aggregate [a1" in plan
