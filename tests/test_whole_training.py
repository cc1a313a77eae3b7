"""Neighbours come from every training row, however many there are."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cupola.operators import models as ML
from cupola.plans import catalog
from cupola.plans.forecast import coupon_forecast
from cupola.sources.tables import DOC_FEATURES


def _table(spark, n, seed):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 1) for _ in DOC_FEATURES], int(rnd.random() < 0.4)) for i in range(n)]
    x = F.col("x")
    return spark.createDataFrame(rows, "doc_id long, x array<double>, label int").select("doc_id", "label", *[x[i].alias(c) for i, c in enumerate(DOC_FEATURES)])


def _shares(known, asked, features, k, id_col):
    """Share of label 1 among the k nearest, by brute force."""
    known, asked = known.toPandas(), asked.toPandas()
    both = np.vstack([known[features], asked[features]])
    mu, sd = both.mean(0), both.std(0)
    t, labels, names = (known[features].to_numpy() - mu) / sd, known["label"].to_numpy(), known[id_col].to_numpy()
    out = {}
    for name, q in zip(asked[id_col], (asked[features].to_numpy() - mu) / sd):
        d = np.where(names == name, np.inf, ((t - q) ** 2).sum(1))
        out[name] = labels[np.argsort(d, kind="stable")[:k]].mean()
    return out


def test_knn_score_reads_every_labelled_row(spark):
    known = _table(spark, 20_400, 3).cache()
    asked = known.where("doc_id < 300")
    got = {r["id"]: r["score"] for r in catalog._knn(asked, known).collect()}
    assert got == pytest.approx(_shares(known, asked, DOC_FEATURES, 15, "doc_id"))


def test_forest_splits_at_quantiles_of_every_row(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(30_000):
        a, b = rnd.gauss(0, 1), rnd.choice([0.0, 0.0, 0.0, 0.0, 1.0, 2.5, 70.0])
        rows.append((i, a, b, rnd.random(), int(a + b / 50 + rnd.gauss(0, 0.5) > 0.3)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int").cache()
    model = ML.fit_forest(df, ["a", "b", "c"], "label", num_trees=8)
    trees = ML.forest_rows(model)
    places = {f: df.agg(F.percentile_approx(f, [i / 32 for i in range(1, 32)], 10000)).first()[0] for f in "abc"}
    used = {(r["feature"], r["cut"]) for r in trees.where("feature is not null").collect()}
    assert len(used) > 20 and all(cut in places[f] for f, cut in used)
    # missing values go right, in the model and in its rows
    odd = df.limit(500).unionByName(spark.createDataFrame([(-1, float("nan"), 1.0, 0.5, 0), (-2, -9.0, float("nan"), 0.5, 0), (-3, float("inf"), -3.0, 2.0, 0), (-4, float("-inf"), 70.0, -1.0, 0)], df.schema))
    own = {r["id"]: r["score"] for r in ML.score_forest_rows(trees, odd, ["a", "b", "c"], "rows", "id").collect()}
    assert own == pytest.approx({r["id"]: r["score"] for r in ML.score(model, odd, "rf", "id").collect()})


def test_model_compare_reads_every_training_row(spark, monkeypatch):
    docs = _table(spark, 31_500, 8).cache()
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    train, test = docs.where(~held), docs.where(held)
    assert train.count() > 20_000
    seen, compare = [], catalog.M.compare_models
    monkeypatch.setattr(catalog, "_docs", lambda spark, sf_dir: docs)
    monkeypatch.setattr(catalog.M, "compare_models", lambda scores: seen.append(scores) or compare(scores))
    got = {r["model"]: r["n"] for r in catalog.q_model_compare(spark, "").collect()}
    assert set(got) == {"lr", "rf", "adaboost", "knn"} and set(got.values()) == {test.count()}
    asked = test.where("doc_id < 900")
    knn = {r["id"]: r["score"] for r in seen[0].where("model = 'knn' and id < 900").collect()}
    both = _shares(train, test, DOC_FEATURES, 15, "doc_id")
    assert knn == pytest.approx({r["doc_id"]: both[r["doc_id"]] for r in asked.collect()})


def test_coupon_forecast_reads_every_training_row(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(2_900):
        split, label = ("train" if i < 2_600 else "test"), int(rnd.random() < 0.4)
        rows.append((split, i, 1, label, rnd.random(), 0.0, 20160101, int(1000 * rnd.random()) + 200 * label, rnd.random() + label))
    matrix = spark.createDataFrame(rows, "split string, l_orderkey long, l_linenumber int, label int, discount_rate double, min_spend double, date_int int, customer_n_events long, part_label_rate double")
    result = coupon_forecast(matrix)
    known, asked = (matrix.where(F.col("split") == s).toPandas() for s in ("train", "test"))
    t, q = (x[result.features].to_numpy(float) for x in (known, asked))
    mu, sd = t.mean(0), t.std(0)
    want = {}
    for key, v in zip(asked["l_orderkey"], (q - mu) / sd):
        d = (((t - mu) / sd - v) ** 2).sum(1)
        want[key * 10 + 1] = known["label"].to_numpy()[np.argsort(d, kind="stable")[:15]].mean()
    assert {r["id"]: r["score"] for r in result.scores.where("model = 'knn'").collect()} == pytest.approx(want)
