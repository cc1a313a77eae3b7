"""KNN against brute force, AdaBoost properties, determinism, sources."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cupola.operators import models as ML
from cupola.sources.tables import DOC_FEATURES, labelled_documents, read_coupons
from tests.conftest import SF01


def _brute_knn(ids, vecs, qids, qvecs, k, exclude_self):
    out = {}
    for qi, qv in zip(qids, qvecs):
        d = []
        for ti, tv in zip(ids, vecs):
            if exclude_self and ti == qi:
                continue
            s = 0.0
            for a, b in zip(qv, tv):
                s += (float(a) - float(b)) * (float(a) - float(b))
            d.append((s, ti))
        out[qi] = [t for _, t in sorted(d)[:k]]
    return out


@pytest.mark.parametrize("block_cells", [4_000_000, 700])
def test_knn_exact_matches_brute_force(spark, block_cells):
    rnd = random.Random(11)
    rows = []
    for i in range(240):
        if i % 40 == 0:
            v = [0.5, 0.5, 0.5]  # exact duplicates: ties broken by id
        else:
            v = [rnd.random(), rnd.random(), rnd.random()]
        rows.append((i, v, i % 3))
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    nb = ML.knn_neighbours(df, df, 4, exclude_self=True, block_cells=block_cells)
    got = {}
    for r in nb.orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.tid)
    ids = [r[0] for r in rows]
    vecs = [r[1] for r in rows]
    assert got == _brute_knn(ids, vecs, ids, vecs, 4, True)


def test_knn_separate_query_set(spark):
    rnd = random.Random(2)
    train = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(5)], i % 2) for i in range(150)],
                                  "id long, vec array<double>, label int")
    query = spark.createDataFrame([(1000 + i, [rnd.gauss(0, 1) for _ in range(5)]) for i in range(40)],
                                  "id long, vec array<double>")
    got = {}
    for r in ML.knn_neighbours(train, query, 3).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.tid)
    t = train.collect()
    q = query.collect()
    assert got == _brute_knn([r.id for r in t], [r.vec for r in t], [r.id for r in q], [r.vec for r in q], 3, False)


def test_knn_has_no_bound_on_the_training_side(spark):
    train = spark.range(200_001).select("id", F.array(F.col("id").cast("double")).alias("vec"), (F.col("id") % 2).alias("label"))
    query = spark.createDataFrame([(-1, [5.2]), (-2, [200_000.0]), (-2, [200_000.0])], "id long, vec array<double>")
    got = [tuple(r) for r in ML.knn_neighbours(train, query, 3).select("qid", "rank", "tid").collect()]
    last = [(-2, 1, 200_000), (-2, 2, 199_999), (-2, 3, 199_998)]
    assert sorted(got) == sorted([(-1, 1, 5), (-1, 2, 6), (-1, 3, 4), *last, *last])


def test_knn_fetches_few_vectors_whatever_the_settings(spark):
    """Approximations rule most vectors out; a third of all rows are one vector."""
    rnd = random.Random(8)
    rows = [(i, [0.25] * 16 if i % 3 == 0 else [rnd.gauss(0, 1) for _ in range(16)], i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, vec array<float>, label int")
    vecs = {r.id: r.vec for r in df.collect()}
    want = _brute_knn(list(vecs), list(vecs.values()), list(vecs)[::30], list(vecs.values())[::30], 4, True)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, block_rows in ((before, 4096), ("3", 100)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = ML.knn_neighbours(df, df, 4, exclude_self=True, block_rows=block_rows).collect()
            assert len(got) == 900 * 4 and max(r.fetched for r in got) < 150
            ranked = {}
            for r in sorted(got, key=lambda r: r["rank"]):
                ranked.setdefault(r.qid, []).append(r.tid)
            assert {i: ranked[i] for i in want} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_knn_of_a_long_tail_fetches_few_vectors(spark):
    """dense vectors with a few far ones: cells are as fine as the vectors are dense."""
    rng = np.random.default_rng(4)
    v = rng.lognormal(0.0, 1.0, (6000, 2))
    v[:3] = [[1e6, 0.0], [0.0, 1e6], [1e6, 1e6]]
    train = spark.createDataFrame([(i, x.tolist(), i % 2) for i, x in enumerate(v[:5000])], "id long, vec array<double>, label int")
    query = spark.createDataFrame([(10_000 + i, x.tolist()) for i, x in enumerate(v[4900:])], "id long, vec array<double>")
    got = {}
    for r in ML.knn_neighbours(train, query, 15).orderBy("qid", "rank").collect():
        assert r.fetched < 120
        got.setdefault(r.qid, []).append(r.tid)
    for i, x in enumerate(v[4900:]):
        d = (x[0] - v[:5000, 0]) ** 2 + (x[1] - v[:5000, 1]) ** 2
        assert got[10_000 + i] == np.lexsort((np.arange(5000), d))[:15].tolist()


def test_knn_leaves_infinite_vectors_out_and_counts_them(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, [float("inf"), 1.0], 0), (3, [1e200, -1e200], 1), (4, [0.0, float("-inf")], 1)],
                               "id long, vec array<double>, label int")
    assert ML.knn_left_out(df) == 2
    got = ML.knn_neighbours(df, df, 2, exclude_self=True).collect()
    assert sorted((r.qid, r.tid) for r in got) == [(1, 3), (3, 1)]


def test_knn_vote_ties_pick_smallest_label(spark):
    nb = spark.createDataFrame([(1, 10, 2), (1, 11, 1), (2, 12, 3), (2, 13, 3), (2, 14, 0)],
                               "qid long, tid long, tlabel int")
    got = {r.qid: r.pred_label for r in ML.knn_vote(nb).collect()}
    assert got == {1: 1, 2: 3}


@pytest.fixture(scope="module")
def docs(spark):
    return labelled_documents(spark, SF01).cache()


def test_adaboost_exponential_loss_never_rises(spark, docs):
    model = ML.adaboost_fit(docs, DOC_FEATURES, "label", rounds=6)
    assert 1 <= len(model.stumps) <= 6
    losses = []
    y = F.col("label") * 2 - 1
    for t in range(1, len(model.stumps) + 1):
        part = ML.AdaBoostModel(model.features, model.stumps[:t])
        losses.append(docs.select(F.avg(F.exp(-0.5 * y * part.margin()))).first()[0])
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))
    assert all(s["error"] < 0.5 for s in model.stumps)


def test_stump_search_matches_brute_force(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 6), rnd.randint(0, 3), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, y int")
    best = ML.stump_search(df, ["a", "b"], "y").first()
    cands = []
    for fi, f in enumerate(["a", "b"]):
        for thr in sorted({r[fi] for r in rows}):
            for pol in (1, -1):
                err = sum((pol if r[fi] <= thr else -pol) != (2 * r[2] - 1) for r in rows) / len(rows)
                cands.append((err, f, float(thr), -pol))
    err, f, thr, negpol = min(cands)
    assert (best.feature, best.threshold, best.polarity) == (f, thr, -negpol)
    assert math.isclose(best.error, err)


@pytest.mark.parametrize("n_buckets", [1, 5, 97])
def test_stump_search_continuous_any_bucket_count(spark, n_buckets):
    rnd = random.Random(9)
    rows = [(rnd.random(), float(rnd.randint(0, 3)), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y int").repartition(5)
    best = ML.stump_search(df, ["a", "b"], "y", n_buckets=n_buckets).first()
    cands = []
    for fi, f in enumerate(["a", "b"]):
        for thr in sorted({r[fi] for r in rows}):
            for pol in (1, -1):
                err = sum((pol if r[fi] <= thr else -pol) != (2 * r[2] - 1) for r in rows) / len(rows)
                cands.append((round(err, 12), f, float(thr), -pol))
    err, f, thr, negpol = min(cands)
    assert (best.feature, best.threshold, best.polarity) == (f, thr, -negpol)
    assert math.isclose(best.error, err)


def test_models_are_deterministic(spark, docs):
    a = ML.score(ML.fit_forest(docs, DOC_FEATURES, "label", num_trees=10), docs, "rf", "doc_id", "label")
    b = ML.score(ML.fit_forest(docs, DOC_FEATURES, "label", num_trees=10), docs, "rf", "doc_id", "label")
    assert a.exceptAll(b).count() == 0
    lr = ML.score(ML.fit_logistic(docs, DOC_FEATURES, "label"), docs, "lr", "doc_id", "label")
    s = [r.score for r in lr.collect()]
    assert all(0.0 <= x <= 1.0 for x in s) and len(s) == docs.count()


def test_read_coupons_csv(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("user_id,merchant_id,coupon_id,rate_raw,distance,date_received,date\n"
                 "1,2,c1,200:20,1,20160115,null\n3,4,c2,0.9,null,2016-01-16,20160120\n")
    df = read_coupons(spark, str(p))
    assert df.count() == 2 and dict(df.dtypes)["rate_raw"] == "string"
    assert np.isclose([r.rate_raw for r in df.collect()].count("0.9"), 1)


def test_knn_exact_on_embeddings_many_tasks(spark):
    """2,000 x 64 embeddings: the queries are spread over all shuffle partitions."""
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    nb = ML.knn_neighbours(emb, emb, 5, id_col="vec_id", vec_col="embedding", exclude_self=True)
    tasks = nb.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {}
    for r in nb.orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.tid)
    pdf = emb.toPandas()
    ids = pdf.vec_id.to_numpy()
    v = np.stack(pdf.embedding.to_numpy()).astype(np.float64)
    for i in range(len(ids)):
        acc = np.zeros(len(ids))
        for j in range(v.shape[1]):
            d = v[i, j] - v[:, j]
            acc += d * d
        acc[i] = np.inf
        assert got[int(ids[i])] == [int(x) for x in ids[np.lexsort((ids, acc))[:5]]]


def test_adaboost_round_search_equals_stump_search(spark):
    rnd = random.Random(8)
    rows = [(float(rnd.randint(0, 9)), float(rnd.randint(0, 4)) if rnd.random() < 0.9 else float("nan"), rnd.random() * 3, rnd.randint(0, 1))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, w double, y int")
    want = ML.stump_search(df, ["a", "b"], "y", F.col("w")).first()
    got = ML.stump_search(df, ["a", "b"], "y", F.col("w"), n_buckets=0).first()
    assert (got["feature"], got["threshold"], got["polarity"]) == (want.feature, want.threshold, want.polarity)
    assert got["error"] == pytest.approx(want.error, rel=1e-12)


def test_knn_missing_vectors_and_the_training_bound(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], 1), (2, None, 0), (3, [1.0, None], 0), (4, [float("nan"), 0.0], 0), (5, [2.0, 0.0], 0)],
                               "id long, vec array<double>, label int")
    got = [(r.qid, r.tid, r["rank"]) for r in ML.knn_neighbours(df, df, 3, exclude_self=True).collect()]
    assert sorted(got) == [(1, 5, 1), (5, 1, 1)] and ML.knn_left_out(df) == 3
    with pytest.raises(ValueError, match="max_train_rows"):
        ML.knn_neighbours(df, df, 3, max_train_rows=1)


def test_missing_features_are_named(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0), (None, 1.0, 1), (3.0, float("nan"), 0), (4.0, 2.0, 1)], "a double, b double, y int")
    for fit in (ML.fit_logistic, ML.fit_forest):
        with pytest.raises(ValueError, match="'a': 1"):
            fit(df, ["a", "b"], "y")
    assert ML.complete_rows(df, ["a", "b"]).count() == 2
    assert ML.fit_logistic(ML.complete_rows(df, ["a", "b"]), ["a", "b"], "y", reg_param=0.1) is not None


def test_read_coupons_null_token(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("user_id,merchant_id,coupon_id,rate_raw,distance,date_received,date\n"
                 "1,2,c1,200:20,1,20160115,null\nnull,4,c2,0.9,null,2016-01-16,20160120\n")
    rows = read_coupons(spark, str(p), null_value="null").orderBy("coupon_id").collect()
    assert rows[0].date is None and rows[1].user_id is None and rows[1].distance is None


def test_score_sink_round_trip_and_model_pruning(spark, tmp_path):
    rows = [("lr", i, i / 10.0, i % 2) for i in range(10)] + [("rf", i, 1 - i / 10.0, i % 2) for i in range(10)]
    scores = spark.createDataFrame(rows, "model string, id bigint, score double, label int")
    path = str(tmp_path / "scores")
    ML.write_scores(scores, path)
    back = spark.read.parquet(path)
    assert back.select(*scores.columns).exceptAll(scores).count() == 0 and back.count() == 20
    plan = back.where(F.col("model") == "rf")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model" in plan


def test_adaboost_folded_margin_gives_the_same_stumps(spark, docs):
    plain = ML.adaboost_fit(docs, DOC_FEATURES, "label", rounds=6, fold_every=0)
    folded = ML.adaboost_fit(docs, DOC_FEATURES, "label", rounds=6, fold_every=2)
    assert len(plain.stumps) == len(folded.stumps) >= 1
    for a, b in zip(plain.stumps, folded.stumps):
        assert (a["feature"], a["threshold"], a["polarity"]) == (b["feature"], b["threshold"], b["polarity"])
        assert a["alpha"] == pytest.approx(b["alpha"], rel=1e-9)


def test_forest_rows_give_the_models_probabilities(spark, docs):
    model = ML.fit_forest(docs, DOC_FEATURES, "label", num_trees=12, max_depth=6)
    trees = ML.forest_rows(model)
    assert trees.select("tree").distinct().count() == 12 and trees.where("(left is null) <> (feature is null)").count() == 0
    wide = docs.select("doc_id", "label", *DOC_FEATURES).unionByName(
        spark.createDataFrame([(-1, 1, float("nan"), 3.0, 2.0, 1.0)], "doc_id long, label int, n_chars double, n_words double, n_distinct_words double, n_lines double"))
    want = {r.id: r.score for r in ML.score(model, wide, "rf", "doc_id").collect()}
    got = {r.id: r.score for r in ML.score_forest_rows(trees, wide, DOC_FEATURES, "rows", "doc_id", "label").collect()}
    assert got == want
    stump = ML.fit_forest(docs, DOC_FEATURES, "label", num_trees=2, max_depth=0)
    got = {r.score for r in ML.score_forest_rows(ML.forest_rows(stump), docs, DOC_FEATURES, "rows", "doc_id").collect()}
    assert got == {r.score for r in ML.score(stump, docs, "rf", "doc_id").collect()}


def _boost_in_whole_numbers(rows, names, rounds, unit):
    weight = {}
    for r in rows:
        weight[r] = weight.get(r, 0) + unit
    out = []
    for _ in range(rounds):
        total = sum(weight.values())
        wrong_of = lambda i, c, p: sum(w for r, w in weight.items() if ((r[i] <= c) == (p == 1)) != (r[-1] == 1))
        e, _, c, negp, i = min((wrong_of(i, c, p), names[i], c, -p, i) for i in range(len(names)) for c in {r[i] for r in weight} for p in (1, -1))
        if 2 * e >= total:
            break
        out.append((names[i], float(c), -negp, e, total))
        if not e:
            break
        right = lambda r: ((r[i] <= c) == (negp == -1)) == (r[-1] == 1)
        weight = {r: w * total // (2 * (total - e) if right(r) else 2 * e) for r, w in weight.items()}
    return out


def test_boosting_in_whole_numbers_matches_a_replay(spark):
    rnd = random.Random(17)
    rows = [(a, b, int(rnd.random() < (0.75 if a > 3 or b == 2 else 0.2))) for a, b in ((rnd.randint(0, 6), rnd.randint(0, 4)) for _ in range(400))]
    df = spark.createDataFrame([*rows, (None, 1, 1), (1, 1, None)], "a int, b int, y int")
    for unit in (1 << 20, 7):
        model = ML.adaboost_fit_whole(df, ["a", "b"], "y", rounds=7, unit=unit)
        got = [(s["feature"], s["threshold"], s["polarity"], s["wrong"], s["total"]) for s in model.stumps]
        assert got == _boost_in_whole_numbers(rows, ["a", "b"], 7, unit) and len(got) >= 3
    assert ML.adaboost_fit_whole(df.where("y = 1"), ["a", "b"], "y").stumps[0]["wrong"] == 0
    assert ML.adaboost_fit_whole(df.where("a > 99"), ["a", "b"], "y").stumps == []


def test_knn_looks_at_few_pairs_one_by_one(monkeypatch):
    # one in a hundred vectors is far from what its bytes say; these are sifted like the others
    rng = np.random.default_rng(5)
    met = []
    look = ML._Search.meet
    monkeypatch.setattr(ML._Search, "meet", lambda self, row, *rest: (met.append(len(row)), look(self, row, *rest))[1])
    q, blocks, off = rng.normal(size=(200, 64)), 10, np.where(np.arange(1000) % 100 == 0, 0.05, 0.001)
    search = ML._Search(q, 3, 4_000_000)
    book = np.repeat(np.linspace(-4, 4, 256)[:, None], 64, axis=1)
    codes = [rng.integers(64, 192, (1000, 64)).astype(np.uint8) for _ in range(blocks)]
    for i, c in enumerate(codes):
        x = book[c, np.arange(64)]
        search.add(np.arange(1000) + 1000 * i, x.min(0), x.max(0), c, off, book)
    row, name, low, high = search.survivors()
    true = np.sqrt(((q[:, None] - book[np.concatenate(codes), np.arange(64)][None]) ** 2).sum(2))
    for i in range(len(q)):
        assert set(np.argsort(true[i])[:3]) <= set(name[row == i])
    assert sum(met) < blocks * len(q) * 10  # what these vectors alone would be
