"""Registered queries: one Spark job per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables; column names match the oracle statements in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from cupola.operators import quality as Q
from cupola.operators import matching as MT
from cupola.operators import metrics as M
from cupola.operators import models as ML
from cupola.operators import select as S
from cupola.operators import timeline as TL
from cupola.operators.normalise import bad_value_report, discount_band_report, normalise_coupons
from cupola.session import materialise, table_path
from cupola.sources.tables import (
    coupon_view,
    events_with_gaps,
    events_with_repeats,
    DOC_FEATURES,
    labelled_documents,
    lineitem_scores,
    read_coupons,
    read_coupons_checked,
    read_table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# --- coupon text (A1, A2, A4, B1) -------------------------------------------------------

@register("coupon_normalise")
def q_coupon_normalise(spark, sf_dir):
    out = normalise_coupons(coupon_view(spark, sf_dir), with_day=False)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "rate_raw", "date_raw", "label",
                      "discount_rate", "min_spend", "date_int")


@register("discount_bands")
def q_discount_bands(spark, sf_dir):
    return discount_band_report(normalise_coupons(coupon_view(spark, sf_dir), date_col=None))


def _messy_coupons(spark, sf_dir):
    """The coupon view with text that does not parse, and missing tokens."""
    view, p = coupon_view(spark, sf_dir), F.col("l_partkey")
    rate = F.when(p % 11 == 0, F.concat("rate_raw", F.lit("f"))).when(p % 13 == 0, F.lit("0:5")) \
        .when(p % 17 == 0, F.lit("nan")).otherwise(F.col("rate_raw"))
    day = F.when(p % 7 == 0, F.translate("date_raw", "-", "/")).otherwise(F.col("date_raw"))
    return view.withColumns({"rate_raw": rate, "date_raw": day})


@register("bad_value_report")
def q_bad_value_report(spark, sf_dir):
    return bad_value_report(_messy_coupons(spark, sf_dir))


@register("coupon_csv")
def q_coupon_csv(spark, sf_dir):
    # raw records as text files, read back by the CSV reader with its explicit schema
    path = table_path(spark)
    view = coupon_view(spark, sf_dir)
    raw = view.select(F.col("l_orderkey").cast("string").alias("user_id"), F.lit("m").alias("merchant_id"),
                      F.col("l_partkey").cast("string").alias("coupon_id"), "rate_raw", F.lit("null").alias("distance"),
                      F.col("date_raw").alias("date_received"), F.lit("null").alias("date"))
    raw.write.option("header", True).csv(path)
    got = normalise_coupons(read_coupons(spark, path, null_value="null"), date_col="date_received", with_day=False)
    return got.select("user_id", "coupon_id", "discount_rate", "min_spend", "date_int")


# --- data quality (A3, B3, B4, B5) -------------------------------------------------------

QUASI_FEATURES = ["rate_raw", "discount_rate", "min_spend", "date_int", "label",
                  "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_shipdate",
                  "qty_le_48"]


@register("coupon_quarantine")
def q_coupon_quarantine(spark, sf_dir):
    """A coupon file in which some ids are no numbers and some lines lack fields."""
    view = coupon_view(spark, sf_dir)
    key, part = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    whole = F.concat_ws(",", F.when(F.col("l_orderkey") % 97 == 0, F.concat(F.lit("x"), key)).otherwise(key), part, part, F.col("rate_raw"), F.lit("1"), F.col("date_raw"), F.lit("null"))
    line = F.when(F.col("l_orderkey") % 89 == 0, F.concat_ws(",", key, part)).otherwise(whole)
    path = table_path(spark)
    view.select(line.alias("line")).write.text(path)
    good, bad = read_coupons_checked(spark, path, header=False)
    return (good.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("user_id").alias("user_id_sum")).withColumn("part", F.lit("kept"))
            .unionByName(bad.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("record")).alias("user_id_sum")).withColumn("part", F.lit("quarantine")))
            .select("part", "n_rows", F.coalesce("user_id_sum", F.lit(0)).alias("checksum")))


def _quasi_view(spark, sf_dir):
    view = coupon_view(spark, sf_dir, extra_columns=("l_returnflag", "l_linestatus", "l_quantity",
                                                     "l_discount", "l_tax", "l_shipdate"))
    # a feature just over the threshold: about 48 of 50 quantities
    return normalise_coupons(view, with_day=False) \
        .withColumn("qty_le_48", (F.col("l_quantity") <= F.lit(48)).cast("int"))


@register("quasi_constant")
def q_quasi_constant(spark, sf_dir):
    return Q.quasi_constant_report(_quasi_view(spark, sf_dir), QUASI_FEATURES, 0.95)


@register("quasi_constant_sketch")
def q_quasi_constant_sketch(spark, sf_dir):
    # one scan, and one of the columns that may be flagged; no shuffle by value
    rep = Q.quasi_constant_report(_quasi_view(spark, sf_dir), QUASI_FEATURES, 0.95, method="sketch")
    return rep.select("feature", "non_missing", "flagged")


@register("frequent_value_features")
def q_frequent_value_features(spark, sf_dir):
    # the same summary far below one half: features whose most frequent value holds over a tenth
    rep = Q.quasi_constant_report(_quasi_view(spark, sf_dir), QUASI_FEATURES, 0.1, method="sketch")
    return rep.where("flagged").select("feature", "top_count", "non_missing")


@register("missing_report")
def q_missing_report(spark, sf_dir):
    return Q.missing_report(events_with_gaps(spark, sf_dir))


@register("missing_fill")
def q_missing_fill(spark, sf_dir):
    ev = events_with_gaps(spark, sf_dir)
    # exact median: an order statistic, the same whatever the partitioning
    return Q.fill_missing(ev, {"event_type": "unknown", "value": "median"}, add_indicator=True) \
        .select("event_id", "event_type", "value", "event_type_missing", "value_missing")


@register("missing_fill_by_group")
def q_missing_fill_by_group(spark, sf_dir):
    # the median of the user's day, and of all events where that day has no value
    ev = events_with_gaps(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    return Q.fill_missing_by_group(ev, "value", ["user_id", "day"]).select("event_id", "user_id", "day", "value")


@register("dedup_exact")
def q_dedup_exact(spark, sf_dir):
    return Q.dedup_exact(events_with_repeats(spark, sf_dir))


@register("dedup_keyed")
def q_dedup_keyed(spark, sf_dir):
    return Q.dedup_keyed(events_with_repeats(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"]) \
        .select("user_id", "event_type", "event_id", "ts", "value")


@register("duplicate_report")
def q_duplicate_report(spark, sf_dir):
    return Q.duplicate_report(events_with_repeats(spark, sf_dir), ["event_id"])


OUTLIER_COLS = ["l_quantity", "l_discount", "l_tax"]


@register("outlier_iqr")
def q_outlier_iqr(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"] + OUTLIER_COLS)
    bounds = Q.outlier_bounds(li, OUTLIER_COLS, method="iqr", k=1.5)
    return Q.outlier_clip(Q.outlier_flag(li, bounds), bounds)


@register("outlier_events")
def q_outlier_events(spark, sf_dir):
    # event values are right-skewed (the lineitem columns are near uniform), and error
    # events carry no value, so flags and clipping meet real outliers and NULLs
    ev = events_with_gaps(spark, sf_dir).select("event_id", "value")
    bounds = Q.outlier_bounds(ev, ["value"], method="iqr", k=1.5)
    return Q.outlier_clip(Q.outlier_flag(ev, bounds), bounds)


SIGMA_COLS = ["l_extendedprice", "l_quantity"]


@register("outlier_sigma")
def q_outlier_sigma(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"] + SIGMA_COLS)
    return Q.outlier_drop(li, Q.outlier_bounds(li, SIGMA_COLS, method="sigma", k=1.5))


@register("missing_drop")
def q_missing_drop(spark, sf_dir):
    return Q.drop_missing(events_with_gaps(spark, sf_dir), ["event_type", "value"]) \
        .select("event_id", "user_id", "event_type", "value")


# --- time split, label, behaviour features (B2, B18, B6) --------------------------------

SPLIT_CUTS = ("2024-01-15", "2024-01-23")
HISTORY_END = "2024-01-20"
EVENT_TYPES = ("view", "signup", "purchase", "error", "click")


@register("time_split")
def q_time_split(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    return TL.time_split(ev, "ts", SPLIT_CUTS)


def _clicks_and_purchases(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type"])
    return ev.where(F.col("event_type") == "click"), ev.where(F.col("event_type") == "purchase")


@register("redemption_label")
def q_redemption_label(spark, sf_dir):
    clicks, purchases = _clicks_and_purchases(spark, sf_dir)
    out = TL.redemption_label(clicks, purchases, ["user_id"], "ts", horizon=86400)
    return out.select("event_id", "user_id", "ts", "label")


@register("redemption_match")
def q_redemption_match(spark, sf_dir):
    clicks, purchases = _clicks_and_purchases(spark, sf_dir)
    out = MT.redemption_match(clicks, purchases, ["user_id"], "ts", horizon=86400, id_col="event_id")
    return out.select("event_id", "user_id", "ts", "redeem_id", "redeem_ts", "label")


@register("entity_features")
def q_entity_features(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return TL.entity_features(ev, ["user_id"], "ts", HISTORY_END, category_col="event_type",
                              categories=EVENT_TYPES, amount_cols=("value",), distinct_cols=("event_type",))


@register("prior_features")
def q_prior_features(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    out = TL.prior_features(ev, ["user_id"], "ts", "event_id", {
        "events": F.lit(1),
        "purchases": (F.col("event_type") == "purchase").cast("int"),
        "value_units": F.round(F.col("value") * 100).cast("bigint"),
    })
    return out.select("event_id", "user_id", "ts", "prior_events", "prior_purchases", "prior_value_units")


# --- ROC / AUC (B15, B16) ----------------------------------------------------------------

@register("auc")
def q_auc(spark, sf_dir):
    return M.auc(lineitem_scores(spark, sf_dir))


@register("roc_points")
def q_roc_points(spark, sf_dir):
    return M.roc_points(lineitem_scores(spark, sf_dir))


def _gapped_scores(spark, sf_dir):
    """A score column with NULL and NaN (both missing)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_linenumber", "l_discount", "l_returnflag"])
    ln = F.col("l_linenumber")
    score = F.when(ln % 5 == 0, F.lit(None)).when(ln % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    return li.select(F.lit("discount").alias("model"), score.cast("double").alias("score"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))


@register("auc_missing")
def q_auc_missing(spark, sf_dir):
    return M.auc(_gapped_scores(spark, sf_dir))


@register("roc_points_missing")
def q_roc_points_missing(spark, sf_dir):
    return M.roc_points(_gapped_scores(spark, sf_dir))


# --- feature screening (B7, B8, B9) -------------------------------------------------------

CHI_FEATURES = ["l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
CORR_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "label"]
VIF_FEATURES = ["l_quantity", "l_extendedprice"]


def _lineitem_labelled(spark, sf_dir, cols):
    li = read_table(spark, sf_dir, "lineitem", [c for c in cols if c != "label"] + ["l_returnflag"])
    return li.withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))


@register("chi_square")
def q_chi_square(spark, sf_dir):
    out = S.chi_square(_lineitem_labelled(spark, sf_dir, CHI_FEATURES), CHI_FEATURES, "label", with_p_value=False)
    return out.withColumn("statistic", F.round("statistic", 6))


@register("chi_merge")
def q_chi_merge(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_returnflag"])
    li = li.select("l_quantity", F.round(F.col("l_discount") * 100).alias("discount_pct"),
                   F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    return S.chi_merge(li, ["l_quantity", "discount_pct"], "label")


@register("corr_pairs")
def q_corr_pairs(spark, sf_dir):
    out = S.corr_pairs(_lineitem_labelled(spark, sf_dir, CORR_FEATURES), CORR_FEATURES)
    return out.withColumn("corr", F.round("corr", 9))


@register("vif_pair")
def q_vif_pair(spark, sf_dir):
    out = S.vif(_lineitem_labelled(spark, sf_dir, VIF_FEATURES), VIF_FEATURES)
    return out.withColumn("vif", F.round("vif", 6))


VIF3_FEATURES = ["l_quantity", "l_discount", "disc_plus_tax"]


@register("vif_three")
def q_vif_three(spark, sf_dir):
    # diagonal of the inverse 3 x 3 correlation matrix (one aggregate for the matrix);
    # disc_plus_tax is collinear with l_discount by construction
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_tax"]) \
        .withColumn("disc_plus_tax", F.col("l_discount") + F.col("l_tax"))
    return S.vif(li, VIF3_FEATURES).withColumn("vif", F.round("vif", 6))


@register("corr_constant")
def q_corr_constant(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount"]).withColumn("three", F.lit(3.0))
    return S.corr_pairs(li, ["l_quantity", "three", "l_discount"]).withColumn("corr", F.round("corr", 9))


@register("vif_collinear")
def q_vif_collinear(spark, sf_dir):
    # the collinear pair stands last, a constant column among the others
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount"]).withColumn("three", F.lit(3.0)) \
        .withColumn("twice_quantity", F.col("l_quantity") * 2 + 1)
    return S.vif(li, ["l_discount", "three", "l_quantity", "twice_quantity"]).withColumn("vif", F.round("vif", 6))


# --- models (B10-B14, B17) ------------------------------------------------------------------

KNN_K = 5


@register("knn_exact")
def q_knn_exact(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    nb = ML.knn_neighbours(emb, emb, KNN_K, id_col="vec_id", vec_col="embedding", exclude_self=True)
    return (ML.knn_vote(nb).join(emb.select(F.col("vec_id").alias("qid"), "label"), "qid")
            .select(F.col("qid").alias("vec_id"), "label", "pred_label"))


@register("adaboost_stump")
def q_adaboost_stump(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_returnflag"])
    li = li.select("l_quantity", F.round(F.col("l_discount") * 100).alias("discount_pct"),
                   F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    return ML.stump_search(li, ["l_quantity", "discount_pct"], "label")


def _docs(spark, sf_dir):
    # the narrow feature table is read by every pass of the model fits: tokenise the texts once
    return materialise(labelled_documents(spark, sf_dir))


def _lr(docs, train=None):
    return ML.score(ML.fit_logistic(docs if train is None else train, DOC_FEATURES, "label"), docs, "lr", "doc_id", "label")


def _rf(docs, train=None):
    return ML.score(ML.fit_forest(docs if train is None else train, DOC_FEATURES, "label", num_trees=20), docs, "rf", "doc_id", "label")


def _ada(docs, train=None):
    model = ML.adaboost_fit(docs if train is None else train, DOC_FEATURES, "label", rounds=8)
    return ML.adaboost_scores(model, docs, "adaboost", "doc_id", "label")


def _knn(docs, train=None):
    """Scores from the exact neighbours among all labelled rows."""
    known = docs if train is None else train
    vec = ML.features_to_vector(known.withColumn("_part", F.lit(0)).unionByName(docs.withColumn("_part", F.lit(1))), DOC_FEATURES)
    nb = ML.knn_neighbours(vec.where("_part = 0"), vec.where("_part = 1"), 15, id_col="doc_id", vec_col="vec", exclude_self=True)
    return (ML.knn_score(nb).join(docs.select(F.col("doc_id").alias("qid"), "label"), "qid")
            .select(F.lit("knn").alias("model"), F.col("qid").alias("id"), "score", "label"))


@register("lr_score")
def q_lr_score(spark, sf_dir):
    return _lr(_docs(spark, sf_dir))


@register("rf_score")
def q_rf_score(spark, sf_dir):
    return _rf(_docs(spark, sf_dir))


@register("rf_tree_gap")
def q_rf_tree_gap(spark, sf_dir):
    # the fitted trees, walked as rows, against the library's own probabilities
    docs = _docs(spark, sf_dir)
    model = ML.fit_forest(docs, DOC_FEATURES, "label", num_trees=20)
    own = ML.score_forest_rows(ML.forest_rows(model), docs, DOC_FEATURES, "rows", "doc_id").select("id", F.col("score").alias("own"))
    gap = F.abs(F.col("own") - F.col("score")) + F.lit(0.0)
    return ML.score(model, docs, "rf", "doc_id").join(own, "id").select(F.col("id").alias("doc_id"), F.round(gap, 12).alias("gap"))


@register("adaboost_rounds")
def q_adaboost_rounds(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    bins = {"chars_bin": F.least(F.floor(F.col("n_chars") / 200), F.lit(40)), "lines_bin": F.least(F.col("n_lines"), F.lit(30)),
            "words_bin": F.least(F.floor(F.col("n_words") / 25), F.lit(40))}
    model = ML.adaboost_fit_whole(docs.select("label", *[c.cast("bigint").alias(n) for n, c in bins.items()]), list(bins), "label", rounds=8)
    rows = [(i + 1, s["feature"], int(s["threshold"]), s["polarity"], s["wrong"], s["total"]) for i, s in enumerate(model.stumps)]
    return spark.createDataFrame(rows, "round int, feature string, threshold long, polarity int, wrong_weight long, total_weight long")


@register("adaboost_score")
def q_adaboost_score(spark, sf_dir):
    return _ada(_docs(spark, sf_dir))


@register("knn_score")
def q_knn_score(spark, sf_dir):
    return _knn(_docs(spark, sf_dir))


@register("knn_score_counts")
def q_knn_score_counts(spark, sf_dir):
    # the raw length counts are whole numbers, so distances are exact in any engine
    docs = _docs(spark, sf_dir)
    vec = ML.features_to_vector(docs, ["n_words", "n_lines"], standardise=False)
    nb = ML.knn_neighbours(vec, vec, 15, id_col="doc_id", vec_col="vec", exclude_self=True)
    return ML.knn_score(nb).select(F.col("qid").alias("doc_id"), F.round("score", 9).alias("score"))


@register("lr_gradient")
def q_lr_gradient(spark, sf_dir):
    # at the fitted weights of an unpenalised model the gradient of the log-loss is zero
    docs = _docs(spark, sf_dir)
    scored = _lr(docs).select(F.col("id").alias("doc_id"), "score").join(docs, "doc_id")
    residual = F.col("score") - F.col("label").cast("double")
    sums = scored.agg(*[F.try_divide(F.avg(residual * F.col(f)), F.stddev_samp(f)).alias(f) for f in DOC_FEATURES], F.avg(residual).alias("intercept"))
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), (F.round(F.col(f), 2) + F.lit(0.0)).alias("gradient")) for f in [*DOC_FEATURES, "intercept"]])
    return sums.select(F.inline(rows))


@register("model_compare")
def q_model_compare(spark, sf_dir):
    # fitted on two thirds of the labelled documents, compared on the rest
    docs = _docs(spark, sf_dir)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    train, test = docs.where(~held), docs.where(held)
    scores = [fit(test, train) for fit in (_lr, _rf, _ada, _knn)]
    return M.compare_models(scores[0].unionByName(scores[1]).unionByName(scores[2]).unionByName(scores[3]))


def _sink(spark, scores):
    """Write a score table to a folder of its own and read it back."""
    path = table_path(spark)
    ML.write_scores(scores, path, mode="errorifexists")
    return spark.read.parquet(path)


@register("score_sink")
def q_score_sink(spark, sf_dir):
    return _sink(spark, QUERIES["lr_score"](spark, sf_dir))


def _fixed_scores(spark, sf_dir):
    """Scores that are plain columns, so that sink and comparison can be checked row by row."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_quantity", "l_returnflag"])
    ident = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label")
    scores = {"discount": F.col("l_discount") * 10, "quantity": F.col("l_quantity") / 64}
    return li.select(ident, label, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()])))


@register("score_sink_fixed")
def q_score_sink_fixed(spark, sf_dir):
    return _sink(spark, _fixed_scores(spark, sf_dir).select("model", "id", "score", "label"))


@register("model_compare_fixed")
def q_model_compare_fixed(spark, sf_dir):
    got = M.compare_models(_fixed_scores(spark, sf_dir))
    return got.select("model", "n", F.round("accuracy", 9).alias("accuracy"), F.round("auc", 9).alias("auc"), "auc_rank")


@register("auc_compare")
def q_auc_compare(spark, sf_dir):
    # an amount, an hour with heavy ties and a user number as scores of one set of events
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    scores = {"value": F.col("value"), "hour": F.hour("ts").cast("double"), "user": F.col("user_id").cast("double")}
    rows = ev.select(F.col("event_id").alias("id"), (F.col("event_type") == "purchase").cast("int").alias("label"),
                     F.inline(F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()])))
    got = M.compare_auc(rows)
    return got.select("model_a", "model_b", "n_pos", "n_neg", F.round("auc_a", 9).alias("auc_a"), F.round("auc_b", 9).alias("auc_b"),
                      F.round("covariance", 14).alias("covariance"), F.round("z", 6).alias("z"))


# --- end to end (E4) --------------------------------------------------------------------------

@register("redemption_forecast")
def q_redemption_forecast(spark, sf_dir):
    from cupola.plans.forecast import redemption_forecast

    return redemption_forecast(spark, sf_dir).comparison


# --- coupon feature family per merchant and per user x merchant (B6) ----------------------

COUPON_HISTORY_END = "1997-01-01"


def _coupons_with_parties(spark, sf_dir):
    view = normalise_coupons(coupon_view(spark, sf_dir, extra_columns=("l_suppkey", "l_shipdate")), with_day=False)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return view.join(orders, view.l_orderkey == orders.o_orderkey, "inner").drop("o_orderkey")


@register("merchant_features")
def q_merchant_features(spark, sf_dir):
    view = normalise_coupons(coupon_view(spark, sf_dir, extra_columns=("l_suppkey", "l_shipdate")), with_day=False)
    return TL.coupon_features(view, {"merchant": ["l_suppkey"]}, "l_shipdate", COUPON_HISTORY_END,
                              distinct_cols={"merchant": ["l_partkey"]})["merchant"]


@register("user_merchant_features")
def q_user_merchant_features(spark, sf_dir):
    return TL.coupon_features(_coupons_with_parties(spark, sf_dir), {"um": ["o_custkey", "l_suppkey"]},
                              "l_shipdate", COUPON_HISTORY_END)["um"]


FAMILY_KINDS = {"customer": ["o_custkey"], "merchant": ["l_suppkey"], "part": ["l_partkey"],
                "customer_merchant": ["o_custkey", "l_suppkey"]}


@register("coupon_sliding_features")
def q_coupon_sliding_features(spark, sf_dir):
    # what the customer did in the 7 and 30 days before each coupon's day
    coupons = materialise(_coupons_with_parties(spark, sf_dir).select("l_orderkey", "l_linenumber", "o_custkey", "l_suppkey", "l_shipdate", "label", "min_spend"))
    recent = TL.sliding_features(coupons, ["o_custkey"], "l_shipdate", (7, 30), {"n_label": F.col("label"), "min_spend_units": F.round(F.col("min_spend") * 100)},
                                 ["l_suppkey"])
    issued = coupons.select("l_orderkey", "l_linenumber", "o_custkey", F.col("l_shipdate").cast("date").alias("day"))
    return issued.join(recent, ["o_custkey", "day"])


@register("coupon_feature_family")
def q_coupon_feature_family(spark, sf_dir):
    # every kind from one scan of the coupons: one row per (kind, entity)
    return TL.coupon_feature_table(_coupons_with_parties(spark, sf_dir), FAMILY_KINDS, "l_shipdate",
                                   COUPON_HISTORY_END, distinct_cols=("l_partkey",))


MATRIX_FEATURES = ("n_events", "label_rate", "min_spend_avg", "days_since_last")


def coupon_matrix(spark, sf_dir, periods=(("train", "1996-01-01", "1996-02-01", "1997-01-01"),
                                          ("test", "1997-01-01", "1997-02-01", "1998-01-01"))):
    """One row per coupon of each period ``(split, history end, start, end)``: its own discount
    features, and those of its user, merchant, part and user-merchant pair from the history
    before the period. The gap between history end and start keeps late labels out.

    The parsed and joined coupons are written once; every period and kind reads that table."""
    coupons = materialise(_coupons_with_parties(spark, sf_dir).drop("rate_raw", "date_raw"))
    out = None
    for split, history_end, start, end in periods:
        table = TL.split_filter(coupons, "l_shipdate", start, end)
        feats = TL.coupon_features(coupons, FAMILY_KINDS, "l_shipdate", history_end, features=MATRIX_FEATURES)
        cols = []
        for kind, keys in FAMILY_KINDS.items():
            mine = [f"{kind}_{c}" for c in MATRIX_FEATURES]
            table = TL.join_features(table, feats[kind].select(*keys, *mine), keys)
            cols += [F.coalesce(mine[0], F.lit(0)).alias(mine[0]), *mine[1:]]
        part = table.select(F.lit(split).alias("split"), "l_orderkey", "l_linenumber", "label", "discount_rate", "min_spend", "date_int", *cols)
        out = part if out is None else out.unionByName(part)
    return out


@register("coupon_training_matrix")
def q_coupon_training_matrix(spark, sf_dir):
    return coupon_matrix(spark, sf_dir)


@register("coupon_forecast")
def q_coupon_forecast(spark, sf_dir):
    from cupola.plans.forecast import coupon_forecast

    return coupon_forecast(coupon_matrix(spark, sf_dir)).comparison


ROLLING_ORIGINS = ("2024-01-12", "2024-01-16", "2024-01-20", "2024-01-24")


@register("rolling_origin_table")
def q_rolling_origin_table(spark, sf_dir):
    from cupola.plans.forecast import rolling_table

    return rolling_table(read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"]), ROLLING_ORIGINS)


@register("rolling_origin_auc")
def q_rolling_origin_auc(spark, sf_dir):
    from cupola.plans.forecast import rolling_evaluation

    return rolling_evaluation(read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"]), ROLLING_ORIGINS)[1]
