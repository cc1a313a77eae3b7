"""Empty inputs give empty results, not errors, for the operators that collect cut
points, counts or pivots before they plan the main job."""

from pyspark.sql import functions as F

from cupola.operators import metrics as M
from cupola.operators import models as ML
from cupola.operators import timeline as TL


def test_empty_inputs(spark):
    scores = spark.createDataFrame([], "model string, id bigint, score double, label int")
    assert M.auc(scores).count() == 0 and M.roc_points(scores).count() == 0
    assert M.compare_models(scores).count() == 0
    ev = spark.createDataFrame([], "event_id long, user_id long, ts timestamp_ntz, event_type string")
    assert TL.prior_features(ev, ["user_id"], "ts", "event_id", {"n": F.lit(1)}).count() == 0
    train = spark.createDataFrame([], "id long, vec array<double>, label int")
    query = spark.createDataFrame([(1, [0.0, 1.0])], "id long, vec array<double>")
    assert ML.knn_neighbours(train, query, 3).count() == 0
    li = spark.createDataFrame([], "a double, b double, y int")
    assert ML.stump_search(li, ["a", "b"], "y").count() == 0
    cp = spark.createDataFrame([], "u long, m long, label int, min_spend double, ts timestamp_ntz")
    assert TL.coupon_feature_table(cp, {"u": ["u"], "m": ["m"]}, "ts", "2024-01-01").count() == 0
    feats = TL.coupon_features(cp, {"u": ["u"], "m": ["m"]}, "ts", "2024-01-01")
    assert {k: v.count() for k, v in feats.items()} == {"u": 0, "m": 0}
