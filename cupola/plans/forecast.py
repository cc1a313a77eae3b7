"""End-to-end redemption forecast: split by time -> label -> features -> cleaning ->
screening -> four classifiers -> ROC/AUC comparison.

Run on the event log: an issued coupon is a ``click``, and it counts as redeemed
when the same user makes a ``purchase`` within the horizon. Every cut, window and
threshold is an argument. Features of a coupon only use events strictly before
its period starts (entity features) or strictly before the coupon itself (prior
features), so no model sees the period it predicts.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cupola.operators import metrics as M
from cupola.operators import models as ML
from cupola.operators import quality as Q
from cupola.operators import select as S
from cupola.operators import timeline as TL
from cupola.session import checkpoint_dir, materialise
from cupola.sources.tables import read_table

EVENT_TYPES = ("view", "signup", "purchase", "error", "click")


@dataclass
class ForecastResult:
    comparison: DataFrame
    scores: DataFrame
    features: list[str]
    screening: dict


def _day(v: str) -> dt.datetime:
    return dt.datetime.fromisoformat(v)


def _period_features(events: DataFrame, issues: DataFrame, start: str, history_days: int) -> DataFrame:
    """Issues of one period with user features from the ``history_days`` before it."""
    end = _day(start)
    feats = TL.entity_features(events, ["user_id"], "ts", history_end=end,
                               history_start=end - dt.timedelta(days=history_days),
                               category_col="event_type", categories=EVENT_TYPES, amount_cols=("value",),
                               prefix="u_").drop("u_last_ts")
    return TL.join_features(issues, feats, ["user_id"])


def redemption_forecast(
    spark: SparkSession,
    sf_dir: str,
    train_start: str = "2024-01-08",
    test_start: str = "2024-01-18",
    test_end: str = "2024-01-29",
    history_days: int = 7,
    horizon_seconds: int = 86400,
    quasi_threshold: float = 0.95,
    chi_alpha: float = 0.05,
    corr_threshold: float = 0.95,
    vif_threshold: float = 10.0,
    knn_k: int = 15,
    ada_rounds: int = 10,
) -> ForecastResult:
    checkpoint_dir(spark)
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    clicks = TL.split_filter(events.where(F.col("event_type") == "click"), "ts", train_start, test_end)
    purchases = TL.split_filter(events.where(F.col("event_type") == "purchase"), "ts", train_start,
                                _day(test_end) + dt.timedelta(seconds=horizon_seconds + 1))

    # label and period
    issues = TL.redemption_label(clicks.select("event_id", "user_id", "ts"), purchases.select("user_id", "ts"),
                                 ["user_id"], "ts", horizon_seconds)
    # training clicks end one horizon before the test period, so no label looks into it
    gap_start = _day(test_start) - dt.timedelta(seconds=horizon_seconds)
    issues = TL.split_filter(issues, "ts", None, gap_start).withColumn("split", F.lit("train")).unionByName(
        TL.split_filter(issues, "ts", test_start, None).withColumn("split", F.lit("test")))

    # behaviour before each period, and before each coupon
    per_period = _period_features(events, issues.where(F.col("split") == "train"), train_start, history_days) \
        .unionByName(_period_features(events, issues.where(F.col("split") == "test"), test_start, history_days))
    prior = TL.prior_features(events, ["user_id"], "ts", "event_id", {
        "events": F.lit(1),
        "clicks": (F.col("event_type") == "click").cast("int"),
        "purchases": (F.col("event_type") == "purchase").cast("int"),
    }).select("event_id", "prior_events", "prior_clicks", "prior_purchases")
    table = (per_period.join(prior, "event_id", "left")
             .withColumn("hour", F.hour("ts").cast("double"))
             .withColumn("weekday", F.dayofweek("ts").cast("double")))
    candidates = [c for c in table.columns if c.startswith(("u_", "prior_"))] + ["hour", "weekday"]
    table = table.select("event_id", "split", "label", *[F.col(c).cast("double").alias(c) for c in candidates])

    # missing values: entities without history have no features -> 0, recency -> window length + 1
    fill = {c: 0.0 for c in candidates}
    fill["u_days_since_last"] = float(history_days + 1)
    table = materialise(table.fillna(fill))
    train = table.where(F.col("split") == "train")

    # outliers: bounds from the training period, applied to both
    amount_cols = [c for c in candidates if c.startswith("u_value_")]
    bounds = Q.outlier_bounds(train, amount_cols, method="iqr", k=3.0)
    table = Q.outlier_clip(table, bounds)
    train = table.where(F.col("split") == "train")

    # screening
    _, qc_report = Q.quasi_constant_filter(train, candidates, quasi_threshold, report_only=True)
    quasi = [r.feature for r in qc_report.where("flagged").collect()]
    feats = [c for c in candidates if c not in quasi]
    binned = ML.quantile_bins(train, feats, n_bins=10)
    chi = {r.feature: r.p_value for r in S.chi_square(binned, feats, "label").collect()}
    dependent = [f for f in feats if chi.get(f) is not None and chi[f] < chi_alpha]
    if not dependent:
        raise ValueError(f"no feature depends on the label at alpha={chi_alpha}")
    feats = dependent
    feats, corr_dropped = S.corr_filter(train, feats, "label", corr_threshold)
    feats, vif_dropped = S.vif_select(train, feats, vif_threshold)
    screening = {"quasi_constant": quasi, "chi_square_p": chi, "corr_dropped": corr_dropped,
                 "vif_dropped": vif_dropped}

    # models
    test = table.where(F.col("split") == "test")
    lr = ML.fit_logistic(train, feats, "label", reg_param=0.01)
    rf = ML.fit_forest(train, feats, "label", num_trees=50, max_depth=5)
    ada = ML.adaboost_fit(train, feats, "label", rounds=ada_rounds)
    stats = train.select(*[F.avg(c).alias(f"m_{c}") for c in feats],
                         *[F.stddev_pop(c).alias(f"s_{c}") for c in feats]).first()
    z = F.array(*[(F.col(c) - F.lit(stats[f"m_{c}"] or 0.0)) / F.lit(stats[f"s_{c}"] or 1.0) for c in feats])
    nb = ML.knn_neighbours(train.withColumn("vec", z), test.withColumn("vec", z), knn_k,
                           id_col="event_id", vec_col="vec", label_col="label")
    knn = (ML.knn_score(nb).join(test.select(F.col("event_id").alias("qid"), "label"), "qid")
           .select(F.lit("knn").alias("model"), F.col("qid").alias("id"), "score", F.col("label").cast("int")))
    scores = materialise(ML.score(lr, test, "lr", "event_id", "label")
              .unionByName(ML.score(rf, test, "rf", "event_id", "label"))
              .unionByName(ML.adaboost_scores(ada, test, "adaboost", "event_id", "label"))
              .unionByName(knn))
    return ForecastResult(M.compare_models(scores, write_once=False), scores, feats, screening)


def coupon_forecast(matrix: DataFrame, quasi_threshold: float = 0.95, chi_alpha: float = 0.05, corr_threshold: float = 0.95,
                    vif_threshold: float = 10.0, knn_k: int = 15, ada_rounds: int = 10) -> ForecastResult:
    """Four classifiers on a coupon matrix (``plans.catalog.coupon_matrix``): cleaning, outliers
    and screening from the training period, comparison on the test period. Every model learns
    from all training rows.
    """
    candidates = [c for c in matrix.columns if c not in ("split", "l_orderkey", "l_linenumber", "label", "date_int")]
    table = materialise(matrix.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "split", "label",
        *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0 if c.endswith(("rate", "avg", "last")) or c == "min_spend" else 0.0)).alias(c) for c in candidates]))
    train = table.where(F.col("split") == "train")
    bounds = Q.outlier_bounds(train, [c for c in candidates if c.endswith(("min_spend", "spend_avg"))], method="iqr", k=3.0)
    table = materialise(Q.outlier_clip(table, bounds))  # every fit and screen reads the clipped rows
    train, test = table.where(F.col("split") == "train"), table.where(F.col("split") == "test")
    _, report = Q.quasi_constant_filter(train, candidates, quasi_threshold, report_only=True)
    quasi = [r.feature for r in report.where("flagged").collect()]
    feats = [c for c in candidates if c not in quasi]
    chi = {r.feature: r.p_value for r in S.chi_square(ML.quantile_bins(train, feats, n_bins=10), feats, "label").collect()}
    chosen = [f for f in feats if chi.get(f) is not None and chi[f] < chi_alpha]
    screening = {"quasi_constant": quasi, "chi_square_p": chi, "no_dependent_feature": not chosen}
    # without a dependent feature the report says so, and the strongest one is used
    feats = chosen or sorted(feats, key=lambda f: (chi.get(f) is None, chi.get(f), f))[:1]
    feats, screening["corr_dropped"] = S.corr_filter(train, feats, "label", corr_threshold)
    feats, screening["vif_dropped"] = S.vif_select(train, feats, vif_threshold)
    lr = ML.fit_logistic(train, feats, "label", reg_param=0.01)
    rf = ML.fit_forest(train, feats, "label", num_trees=20, max_depth=5)
    ada = ML.adaboost_fit(train, feats, "label", rounds=ada_rounds)
    stats = train.select(*[F.avg(c).alias(f"m_{c}") for c in feats], *[F.stddev_pop(c).alias(f"s_{c}") for c in feats]).first()
    z = F.array(*[(F.col(c) - F.lit(stats[f"m_{c}"] or 0.0)) / F.lit(stats[f"s_{c}"] or 1.0) for c in feats])
    nb = ML.knn_neighbours(train.withColumn("vec", z), test.withColumn("vec", z), knn_k, id_col="id", vec_col="vec", label_col="label")
    knn = (ML.knn_score(nb).join(test.select(F.col("id").alias("qid"), "label"), "qid")
           .select(F.lit("knn").alias("model"), F.col("qid").alias("id"), "score", F.col("label").cast("int")))
    scores = materialise(ML.score(lr, test, "lr", "id", "label").unionByName(ML.score(rf, test, "rf", "id", "label"))
                         .unionByName(ML.adaboost_scores(ada, test, "adaboost", "id", "label")).unionByName(knn))
    return ForecastResult(M.compare_models(scores, write_once=False), scores, feats, screening)


ROLLING_FEATURES = ["n_events", "n_clicks", "n_purchases", "value_units", "days_since_last"]


def rolling_table(events: DataFrame, origins, history_days: int = 10, horizon_days: int = 3) -> DataFrame:
    """One row per (fold, user with history): features of the days before the fold's origin and
    ``label``, whether the user buys in the days after it. One scan and one aggregate for all folds."""
    f = TL.rolling_folds(events, "ts", origins, history_days, horizon_days)
    past, of = F.col("part") == "history", lambda t: F.col("event_type") == t
    units = F.when(past, F.round(F.col("value") * 100).cast("bigint"))
    return f.groupBy("fold", "origin", "user_id").agg(
        F.count_if(past).alias("n_events"), F.count_if(past & of("click")).alias("n_clicks"), F.count_if(past & of("purchase")).alias("n_purchases"),
        F.coalesce(F.sum(units), F.lit(0)).alias("value_units"),
        F.datediff(F.first("origin").cast("date"), F.max(F.when(past, F.col("ts"))).cast("date")).alias("days_since_last"),
        F.max((~past & of("purchase")).cast("int")).alias("label"),
    ).where("n_events > 0").drop("origin")


def rolling_evaluation(events: DataFrame, origins, history_days: int = 10, horizon_days: int = 3, ada_rounds: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(folds, spread)``: AUC of each model at each origin but the first, and per model its number of
    folds, mean, smallest, largest and standard deviation, so that a ranking can be seen to move
    with the time of the split. A model of a fold learns from the fold before it, whose labels end where the fold's
    origin is or earlier. The fold table is written once."""
    starts = sorted(str(o) for o in origins)
    table = materialise(rolling_table(events, starts, history_days, horizon_days))
    feats = ROLLING_FEATURES
    parts = []
    for i in range(1, len(starts)):
        train, test = table.where(F.col("fold") == i - 1), table.where(F.col("fold") == i)
        ada = ML.adaboost_fit(train, feats, "label", rounds=ada_rounds)
        for scores in (ML.score(ML.fit_logistic(train, feats, "label", reg_param=0.01), test, "lr", "user_id", "label"),
                       ML.score(ML.fit_forest(train, feats, "label", num_trees=20), test, "rf", "user_id", "label"),
                       ML.adaboost_scores(ada, test, "adaboost", "user_id", "label")):
            parts.append(scores.withColumn("fold", F.lit(i)))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    folds = materialise(M.auc(materialise(scores), ["fold", "model"]))
    spread = folds.groupBy("model").agg(F.count("auc").alias("n_folds"), F.avg("auc").alias("auc_mean"), F.min("auc").alias("auc_min"),
                                        F.max("auc").alias("auc_max"), F.stddev_samp("auc").alias("auc_sd"))
    return folds, spread
