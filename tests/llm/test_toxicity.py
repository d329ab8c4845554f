import zlib

import numpy as np
from pyspark.sql import functions as F

from convmill.llm import queries, toxicity
from convmill.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    pos = y.sum()
    return (rank[y > 0].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def test_isotonic_is_monotone_and_pools():
    x, v = toxicity.isotonic(np.array([3.0, 1, 2, 4]), np.array([0.0, 0, 1, 1]))
    assert v.tolist() == [0, 0, 0.5, 0.5, 1, 1] and x.tolist() == [1, 1, 2, 3, 4, 4]


def test_trees_learn_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.6) & (x[:, 2] < 0.5)).astype(float)
    fresh = rng.random((3000, 4))
    assert auc(toxicity.Trees().fit(x, y).margin(fresh), (fresh[:, 0] > 0.6) & (fresh[:, 2] < 0.5)) > 0.99


def test_features():
    of = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t.encode(), toxicity.Kinds({"blah": 2.0}))))
    rude, fine = of("You are an IDIOT!! an id1ot, you blahs"), of("The weather is fine, Anna.")
    assert rude["near_you"] > 0 and rude["obfuscated"] > 0 and rude["shouted"] > 0 and rude["piled"] > 0 and rude["mark_top"] == 2.0
    assert fine["insults"] == fine["obfuscated"] == fine["near_you"] == 0
    assert len(toxicity.features(None, toxicity.Kinds({}))) == len(toxicity.FEATURES)


def test_query_ranks_held_out_documents(spark):
    rows = queries.op7_toxicity(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(np.array([r.score for r in held]), y) > 0.75
    hit = [labels[r.doc_id] for r in held if r.predicted]
    assert len(hit) > 3 and np.mean(hit) > 0.7


def test_odd_rows_and_no_labels(spark):
    rows = [(None, None), (1, ""), (2, "you idiot " * 30), (2, "you idiot " * 30), (3, "word " * 100000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1))
    s = Scratch(spark)
    for labels, want in (([], 0.0), ([(1, 1), (4, 1)], 1.0), ([(1, None)], 0.0)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), s)
        got = toxicity.judged(docs, model).collect()
        assert len(got) == len(rows) and {r.score for r in got} == {want}
    model = toxicity.fit(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), s)
    assert toxicity.judged(docs.limit(0), model).count() == 0
    assert toxicity.keep_clean(docs, model).columns == docs.columns and toxicity.keep_clean(docs, model).count() == len(rows)


def test_isotonic_pools_equal_points_first():
    x, v = toxicity.isotonic(np.array([1.0, 1, 1, 1, 2]), np.array([0.0, 0, 0, 1, 1]))
    assert np.interp([1.0, 2.0], x, v).tolist() == [0.25, 1.0]
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 12, 400).astype(float), rng.random(400)
    x, v = toxicity.isotonic(a, b)
    # The fit at each point by its min-max form: the least over later ends of the greatest mean from earlier starts.
    at = np.unique(a)
    mean = lambda i, j: b[(a >= at[i]) & (a <= at[j])].mean()
    want = [max(min(mean(i, j) for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    assert np.allclose(np.interp(at, x, v), want)


def test_sample_bounds_rows_of_repeated_ids(spark):
    docs = spark.createDataFrame([(i % 10, f"text {i}") for i in range(1000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    rows = toxicity.training_sample(docs, labels, 5).collect()
    assert len(rows) == 5


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), Scratch(spark))
    kinds = toxicity.Kinds(model.marks)
    want = {}
    for r in docs.collect():
        x, margin = toxicity.features((r.text or "").encode(), kinds), model.trees.start
        for feats, cuts, value in model.trees.splits:
            node = 0
            for _ in range(model.trees.depth):
                node = 2 * node + 1 + int(x[feats[node]] >= cuts[node])
            margin += value[node - (2**model.trees.depth - 1)]
        want[r.doc_id] = min(1.0, max(0.0, 0.999 * float(np.interp(margin, *model.knots)) + 0.001 / (1 + np.exp(-margin))))
    got = {r.doc_id: r.score for r in queries.op7_toxicity(spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "fine", "a", 2.0, {"k": 1})], "doc_id long, text string, _bytes string, _score double, m map<string,int>")
    kept = toxicity.keep_clean(docs, toxicity.Model({}, None, None, 0.0))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [tuple(r) for r in docs.collect()]
