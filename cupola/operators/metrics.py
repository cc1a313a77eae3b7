"""Model evaluation on a long score table ``(group..., score, label)``.

ROC and AUC need the scores in global order. Instead of a window over the whole
table (one task), the table is first reduced to one row per distinct score
(positive and negative counts, partial aggregation), then running counts come
from the two-level prefix sum over score ranges (one range per shuffle partition by
default, cut where Spark's range partitioner cuts). Results are exact; the buckets
only split the work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cupola.operators.prefix import running_totals
from cupola.session import materialise


def _usable(score_col: str, label_col: str):
    """Rows with a score and a label: NaN is missing, like NULL."""
    return F.col(score_col).isNotNull() & ~F.isnan(F.col(score_col).cast("double")) & F.col(label_col).isNotNull()


def left_out(scores: DataFrame, group_cols: Sequence[str] = ("model",), score_col: str = "score",
             label_col: str = "label") -> DataFrame:
    """Rows per group that the metrics leave out: ``n, n_left_out``."""
    return scores.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"),
                                           F.count_if(~_usable(score_col, label_col)).alias("n_left_out"))


def score_counts(scores: DataFrame, group_cols: Sequence[str] = ("model",), score_col: str = "score",
                 label_col: str = "label") -> DataFrame:
    """One row per (group, distinct score): ``pos``, ``neg`` (rows with a missing score or label are left out)."""
    lab = F.col(label_col).cast("bigint")
    return (
        scores.where(_usable(score_col, label_col))
        .groupBy(*group_cols, F.col(score_col).alias("score"))
        .agg(F.sum(lab).alias("pos"), F.sum(F.lit(1) - lab).alias("neg"))
    )


def _n_buckets(df: DataFrame, n_buckets: int | None) -> int:
    """Default bucket count: the session's shuffle partition count (sized to the data on
    a cluster), at least 64."""
    if n_buckets:
        return int(n_buckets)
    return max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _score_buckets(counts: DataFrame, n_buckets: int | None) -> DataFrame:
    """Bucket index, non-decreasing in score, about 1/n_buckets of the distinct scores
    each whatever their distribution. Cut points are the lowest score of each range of
    Spark's range partitioning of the distinct scores: the partitioner samples a
    bounded number of scores, and one number per range reaches the driver."""
    n = _n_buckets(counts, n_buckets)
    s = F.col("score").cast("double")
    lows = (counts.select(s.alias("_s")).where(~F.isnan("_s")).repartitionByRange(n, "_s")
            .groupBy(F.spark_partition_id().alias("_p")).agg(F.min("_s").alias("_lo")).collect())
    cuts = [r["_lo"] for r in lows if r["_lo"] is not None]
    splits = [float("-inf")] + sorted({float(c) for c in cuts} - {float("-inf")}) + [float("inf")]
    if len(splits) < 3:
        return counts.withColumn("_sb", F.lit(0.0))
    b = Bucketizer(splits=splits, inputCol="score", outputCol="_sb", handleInvalid="keep")
    return b.transform(counts.withColumn("score", F.col("score").cast("double")))


def _totals(counts: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return counts.groupBy(*group_cols).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def _ranked(scores: DataFrame, group_cols: list[str], score_col: str, label_col: str,
            n_buckets: int | None) -> DataFrame:
    """Per (group, distinct score): ``pos, neg`` and the running ``tp, fp`` over scores at or
    above it, plus the group totals ``n_pos, n_neg``."""
    # the distinct-score table is read by the cut-point jobs and by the query itself:
    # aggregate the scores once
    counts = materialise(score_counts(scores, group_cols, score_col, label_col))
    counts = _score_buckets(counts, n_buckets)
    run = running_totals(counts, group_cols, [F.col("score").desc()], -F.col("_sb"),
                         {"tp": F.col("pos"), "fp": F.col("neg")}, inclusive=True)
    return run.join(_totals(counts, group_cols), group_cols, "inner")


def _auc_ap(ranked: DataFrame, group_cols: list[str]) -> DataFrame:
    # rows strictly below a score: neg_below = n_neg - fp (fp includes the score itself)
    neg_below = F.col("n_neg").cast("double") - F.col("fp").cast("double")
    term = F.col("pos").cast("double") * (F.lit(2.0) * neg_below + F.col("neg").cast("double"))
    agg = ranked.groupBy(*group_cols).agg(
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"), F.sum(term).alias("_u"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("_ap"))
    denom = F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(*group_cols, "n_pos", "n_neg", F.when(denom > 0, F.col("_u") / denom).alias("auc"),
                      F.try_divide(F.col("_ap"), F.col("n_pos")).alias("average_precision"))


def auc(scores: DataFrame, group_cols: Sequence[str] = ("model",), score_col: str = "score",
        label_col: str = "label", n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC per group, ties counted one half (Mann-Whitney).

    ``auc = sum_s pos_s * (2 * neg_below_s + neg_s) / (2 * P * N)``; NULL when a
    group has only one class. Terms are integers held in doubles, so the sum is
    exact up to 2^53 and accurate beyond.
    """
    group_cols = list(group_cols)
    return _auc_ap(_ranked(scores, group_cols, score_col, label_col, n_buckets), group_cols) \
        .drop("average_precision")


def roc_points(scores: DataFrame, group_cols: Sequence[str] = ("model",), score_col: str = "score",
               label_col: str = "label", n_buckets: int | None = None) -> DataFrame:
    """One ROC point per (group, distinct score) taken as threshold (predict 1 when
    ``score >= threshold``): ``tp, fp, tpr, fpr``. The origin (0, 0) is implied."""
    group_cols = list(group_cols)
    return _ranked(scores, group_cols, score_col, label_col, n_buckets).select(
        *group_cols, F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide(F.col("tp"), F.col("n_pos")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("n_neg")).alias("fpr"))


def average_precision(scores: DataFrame, group_cols: Sequence[str] = ("model",), score_col: str = "score",
                      label_col: str = "label", n_buckets: int | None = None) -> DataFrame:
    """Area under the precision-recall steps: ``sum_s pos_s * precision_s / P``."""
    group_cols = list(group_cols)
    return _auc_ap(_ranked(scores, group_cols, score_col, label_col, n_buckets), group_cols) \
        .select(*group_cols, "average_precision")


def compare_models(scores: DataFrame, group_cols: Sequence[str] = ("model",), score_col: str = "score",
                   label_col: str = "label", threshold: float = 0.5, eps: float = 1e-15,
                   write_once: bool = True, n_buckets: int | None = None) -> DataFrame:
    """Per model: rows, class counts, AUC, average precision, accuracy at ``threshold``,
    log-loss (scores read as probabilities, clipped to [eps, 1-eps]); ranked by AUC.

    The score table is read by two aggregates; ``write_once`` writes it to the
    checkpoint folder first (``materialise``), so the models behind it are not evaluated twice.
    """
    group_cols = list(group_cols)
    if write_once:
        scores = materialise(scores)
    y = F.col(label_col).cast("double")
    p = F.least(F.greatest(F.col(score_col).cast("double"), F.lit(eps)), F.lit(1 - eps))
    pred = (F.col(score_col) >= F.lit(threshold)).cast("double")
    basic = scores.where(_usable(score_col, label_col)).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((pred == y).cast("double")).alias("accuracy"),
        F.avg(-(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))).alias("log_loss"),
    )
    ranked = _auc_ap(_ranked(scores, group_cols, score_col, label_col, n_buckets), group_cols)
    out = basic.join(ranked, group_cols)
    # one row per model here, so the unpartitioned ranking window is small
    rank = F.dense_rank().over(Window.orderBy(F.desc_nulls_last("auc")))
    return out.withColumn("auc_rank", rank).withColumn("best", F.col("auc_rank") == 1)


def compare_auc(scores: DataFrame, model_col: str = "model", id_col: str = "id", score_col: str = "score",
                label_col: str = "label", n_buckets: int | None = None) -> DataFrame:
    """Whether two models' AUCs differ on the same rows (DeLong's test): one row per pair of
    models ``a <= b`` with ``n_pos, n_neg, auc_a, auc_b, covariance, difference, std_error, z, p_value``.

    The placement of a positive is the share of negatives scored below it (equal ones count
    half), that of a negative the share of positives above it. The covariance of two AUCs is the
    sample covariance of their positives' placements over ``n_pos`` plus that of their negatives'
    over ``n_neg``. Placements are mid-ranks, from the running counts that the ROC uses, joined to
    the rows by (model, score); in units of half a row they are whole numbers, their products are
    summed as decimals, and one row per label reaches the driver, with a number per pair of
    models. Only ids that every model scores once, with one label, are compared. With fewer than two rows of a
    label the covariance is NULL, and with no spread of the difference ``z`` is.
    """
    usable = scores.where(_usable(score_col, label_col)).select(
        F.col(model_col).alias("model"), F.col(id_col).alias("id"), F.col(score_col).cast("double").alias("score"), F.col(label_col).cast("int").alias("label"))
    usable = materialise(usable)
    models = sorted(r[0] for r in usable.select("model").distinct().collect())  # one row per model
    spark, p = scores.sparkSession, len(models)
    kind = usable.schema["model"].dataType.simpleString()
    schema = (f"model_a {kind}, model_b {kind}, n_pos long, n_neg long, auc_a double, auc_b double, covariance double, "
              "difference double, std_error double, z double, p_value double")
    if not p:
        return spark.createDataFrame([], schema)
    whole = usable.groupBy("id").agg(
        F.min("label").alias("label"), F.max("label").alias("_l"), F.count(F.lit(1)).alias("_n"),
        F.array(*[F.max(F.when(F.col("model") == m, F.col("score"))) for m in models]).alias("s"))
    whole = materialise(whole.where((F.col("_n") == p) & (F.col("label") == F.col("_l")) & ~F.exists("s", lambda x: x.isNull())).select("id", "label", "s"))
    long = whole.select("id", "label", F.posexplode("s").alias("model", "score"))
    ranked = _ranked(long, ["model"], "score", "label", n_buckets)
    below = F.lit(2) * (F.col("n_neg") - F.col("fp")) + F.col("neg")  # 2 * n_neg placements of a positive
    above = F.lit(2) * (F.col("tp") - F.col("pos")) + F.col("pos")
    ranked = ranked.select("model", "score", below.cast("decimal(18,0)").alias("_below"), above.cast("decimal(18,0)").alias("_above"))
    placed = long.join(ranked, ["model", "score"]).select("id", "label", "model", F.when(F.col("label") == 1, F.col("_below")).otherwise(F.col("_above")).alias("u"))
    per_row = placed.groupBy("id", "label").agg(*[F.max(F.when(F.col("model") == j, F.col("u"))).alias(f"u{j}") for j in range(p)])
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = per_row.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"u{j}").cast("decimal(38,0)")).alias(f"s{j}") for j in range(p)],
        *[F.sum((F.col(f"u{i}") * F.col(f"u{j}")).cast("decimal(38,0)")).alias(f"c{i}_{j}") for i, j in pairs]).collect()
    side = {r["label"]: r for r in sums}
    n = {y: int(side[y]["n"]) if y in side else 0 for y in (0, 1)}

    def spread(y: int, i: int, j: int) -> Fraction:  # covariance of placements of label y, over its rows
        r, m = side[y], n[y]
        return Fraction(m * int(r[f"c{i}_{j}"]) - int(r[f"s{i}"]) * int(r[f"s{j}"]), m * (m - 1) * 4 * n[1 - y] ** 2 * m)

    def cov(i: int, j: int) -> Fraction | None:
        i, j = min(i, j), max(i, j)
        return spread(1, i, j) + spread(0, i, j) if min(n.values()) > 1 else None

    auc_of = [float(Fraction(int(side[1][f"s{j}"]), 2 * n[0] * n[1])) if n[0] * n[1] else None for j in range(p)]
    out = []
    for i, j in pairs:
        v = cov(i, i) + cov(j, j) - 2 * cov(i, j) if cov(i, j) is not None else None
        diff = None if auc_of[i] is None else auc_of[i] - auc_of[j]
        se = None if v is None else math.sqrt(v)
        z = diff / se if se else None
        out.append((models[i], models[j], n[1], n[0], auc_of[i], auc_of[j], None if v is None else float(cov(i, j)), diff, se, z,
                    None if z is None else math.erfc(abs(z) / math.sqrt(2))))
    return spark.createDataFrame(out, schema)
