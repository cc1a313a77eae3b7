"""Feature screening: chi-square test, correlation pairs, variance inflation.

Statistics are Spark aggregates over the whole table; what reaches the driver is
one number per feature or per feature pair (p x p at most), and the matrix
algebra on that p x p matrix is done there with numpy.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupola.operators.prefix import running_totals
from cupola.session import materialise

def chi2_sf(spark: SparkSession, stat: float | None, dof: float | None) -> float | None:
    """P(X >= stat) for X ~ chi-square(dof), from the JVM's math library (the one Spark ships)."""
    if stat is None or dof is None or dof <= 0 or stat != stat:
        return None
    if stat <= 0:
        return 1.0
    return float(spark._jvm.org.apache.commons.math3.special.Gamma.regularizedGammaQ(
        float(dof) / 2.0, float(stat) / 2.0, 1e-14, 2**31 - 1))


# ---------------------------------------------------------------------------------------
# Chi-square test of independence, feature vs label
# ---------------------------------------------------------------------------------------

def _as_category(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        col = F.when(~F.isnan(col), col + F.lit(0.0))  # NaN is missing; -0.0 joins 0.0
    return col.cast("string")


def chi_square(df: DataFrame, features: Sequence[str], label: str, with_p_value: bool = True) -> DataFrame:
    """Pearson chi-square statistic per feature against ``label``, treating each
    distinct value as a category (bin continuous features first, for example with
    ``QuantileDiscretizer``).

    ``statistic = N * (sum over observed cells of o^2 / (r * c) - 1)``, which
    needs no rows for empty cells. Columns: ``feature, n, n_values, n_labels, dof,
    statistic`` and ``p_value``. Rows with a missing value or label are left out
    of that feature's table. Four shuffles: counts per (feature, value, label), the
    value totals beside them, sums per (feature, label), sums per feature. With
    ``with_p_value`` the result (one row per feature) is computed at once, for the
    JVM's chi-square tail is evaluated on the driver.
    """
    long = df.select(F.col(label).cast("string").alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), _as_category(df, f).alias("_x")) for f in features])))
    cells = (long.where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
             .groupBy("feature", "_x", "_y").agg(F.count(F.lit(1)).alias("_o")))
    of_value = Window.partitionBy("feature", "_x")
    o = F.col("_o").cast("double")
    by_label = (cells.withColumn("_r", F.sum("_o").over(of_value))
                .withColumn("_first", (F.row_number().over(of_value.orderBy("_y")) == 1).cast("int"))
                .groupBy("feature", "_y")
                .agg(F.sum(o * o / F.col("_r").cast("double")).alias("_s"), F.sum("_o").alias("_c"), F.sum("_first").alias("_v")))
    out = (by_label.groupBy("feature")
           .agg(F.sum("_c").alias("n"), F.sum("_v").alias("n_values"), F.count(F.lit(1)).alias("n_labels"),
                F.sum(F.col("_s") / F.col("_c").cast("double")).alias("_s"))
           .select("feature", "n", "n_values", "n_labels",
                   ((F.col("n_values") - 1) * (F.col("n_labels") - 1)).alias("dof"),
                   (F.col("n").cast("double") * (F.col("_s") - F.lit(1.0))).alias("statistic")))
    if not with_p_value:
        return out
    spark = df.sparkSession
    rows = [(*r, chi2_sf(spark, r["statistic"], r["dof"])) for r in out.collect()]  # one row per feature
    return spark.createDataFrame(rows, out.schema.add("p_value", "double"))


def chi_square_select(df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.05) -> list[str]:
    """Features whose chi-square p-value is below ``alpha`` (dependent on the label)."""
    res = chi_square(df, features, label).where(F.col("p_value") < F.lit(alpha)).select("feature").collect()
    keep = {r.feature for r in res}
    return [f for f in features if f in keep]


# ---------------------------------------------------------------------------------------
# Supervised binning
# ---------------------------------------------------------------------------------------

def _chi_of_neighbours(a: float, b: float, c: float, d: float) -> float:
    """Chi-square of two intervals with ``a`` and ``c`` positives, ``b`` and ``d`` negatives."""
    cross = a * d - b * c
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return (a + b + c + d) * cross * cross / margins if margins else 0.0


def _merged_intervals(rows: list[tuple[float, float, int, int]], threshold: float, max_bins: int) -> list[tuple[float, float, int, int]]:
    """ChiMerge of ordered ``(low, high, pos, neg)``: the neighbours of least chi-square (the first
    of equals) are merged while that is under ``threshold`` or there are over ``max_bins``."""
    import heapq

    low, high, pos, neg = map(list, zip(*rows))
    n = len(rows)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    alive, version = [True] * n, [0] * n  # a pair is named by its left interval

    def pair(i: int) -> tuple[float, int, int]:
        j = right[i]
        return _chi_of_neighbours(float(pos[i]), float(neg[i]), float(pos[j]), float(neg[j])), i, version[i]

    heap = [pair(i) for i in range(n - 1)]
    heapq.heapify(heap)
    count = n
    while heap:
        chi, i, v = heapq.heappop(heap)
        if not alive[i] or v != version[i] or right[i] < 0:
            continue
        if chi >= threshold and count <= max_bins:
            break
        j = right[i]
        high[i], pos[i], neg[i], alive[j] = high[j], pos[i] + pos[j], neg[i] + neg[j], False
        right[i] = right[j]
        if right[i] >= 0:
            left[right[i]] = i
        count -= 1
        for k in (left[i], i):
            if k >= 0:
                version[k] += 1
                if right[k] >= 0:
                    heapq.heappush(heap, pair(k))
    return [(low[i], high[i], pos[i], neg[i]) for i in range(n) if alive[i]]


def chi_merge(df: DataFrame, features: Sequence[str], label: str, threshold: float = 3.841458820694124, max_bins: int = 64,
              start: int = 1024) -> DataFrame:
    """Supervised bins of numeric features (ChiMerge): ``feature, bin, low, high, n_pos, n_neg``, bins
    from 1, each holding the values from ``low`` to ``high``.

    Neighbouring intervals with the smallest chi-square against the 0/1 label are merged until
    all neighbours differ by ``threshold`` (its default: 5 % at one degree of freedom) and there are ``max_bins`` at most. The
    intervals to start from are the distinct values, counted by a partial aggregate; a feature
    with more than ``start`` of them starts from about ``start`` ranges of equal row counts, whose
    borders a two-level prefix sum gives. So a feature's merge, in one task, sees ``start``
    rows at most, whatever the table's size. Rows with a missing value or label are left out.
    """
    y = F.col(label).cast("int")
    x = {f: F.col(f).cast("double") for f in features}
    long = df.select((y == 1).cast("long").alias("_p"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.when(~F.isnan(c), c + F.lit(0.0)).alias("_x")) for f, c in x.items()])))
    counts = long.where(F.col("_x").isNotNull() & F.col("_p").isNotNull()).groupBy("feature", "_x") \
        .agg(F.sum("_p").alias("_pos"), F.count(F.lit(1)).alias("_n"))
    counts = materialise(counts.repartitionByRange("feature", "_x").withColumn("_piece", F.spark_partition_id()))
    of_feature = counts.groupBy("feature").agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_values"))
    ranked = running_totals(counts, ["feature"], ["_x"], F.col("_piece"), {"_before": F.col("_n")}, inclusive=False).join(of_feature, "feature")
    # few values: one interval each; many: ranges of rows
    at = F.when(F.col("_values") <= start, F.col("_x")).otherwise(F.floor(F.col("_before") * F.lit(start) / F.col("_total")).cast("double"))
    begun = ranked.groupBy("feature", at.alias("_at")).agg(F.min("_x").alias("low"), F.max("_x").alias("high"), F.sum("_pos").alias("_pos"), F.sum("_n").alias("_n"))

    def merge(rows):
        rows = rows.sort_values("low")
        got = _merged_intervals(list(zip(rows["low"], rows["high"], rows["_pos"], rows["_n"] - rows["_pos"])), threshold, max_bins)
        out = pd.DataFrame(got, columns=["low", "high", "n_pos", "n_neg"])
        out.insert(0, "feature", rows["feature"].iloc[0])
        out.insert(1, "bin", range(1, len(out) + 1))
        return out

    return begun.groupBy("feature").applyInPandas(merge, "feature string, bin int, low double, high double, n_pos long, n_neg long")


def apply_bins(df: DataFrame, bins: DataFrame, features: Sequence[str], suffix: str = "_bin") -> DataFrame:
    """``df`` with a column ``<feature><suffix>``: the bin of the value (the first whose ``high`` reaches
    it, the last beyond all of them; NULL for a missing value). A projection: the cuts, ``max_bins`` a feature, are constants."""
    cuts: dict[str, list] = {f: [] for f in features}
    for r in bins.select("feature", "bin", "high").orderBy("feature", "bin").collect():
        if r.feature in cuts:
            cuts[r.feature].append(r.high)
    cols = {}
    for f, highs in cuts.items():
        x = F.col(f).cast("double")
        expr = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int"))
        for i, h in enumerate(highs[:-1]):
            expr = expr.when(x <= F.lit(h), F.lit(i + 1))
        cols[f + suffix] = expr.otherwise(F.lit(len(highs))) if highs else F.lit(None).cast("int")
    return df.withColumns(cols)


# ---------------------------------------------------------------------------------------
# Correlation pairs; B8: variance inflation
# ---------------------------------------------------------------------------------------

def _triangle(df: DataFrame, features: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """``(n, varies, R)``: complete rows, whether each feature varies, and the triangular factor of
    the centred features.

    Tall-skinny QR in one pass: a task keeps the triangular factor of ``[1, x]`` over its rows so
    far (p + 1 rows), factors are stacked and factored again in a tree of two levels, and the
    constant in front takes the means out. Unlike sums of squares, this loses no digits to large
    means or near-equal features.
    """
    import pyarrow as pa

    p = len(features)
    x = [F.col(f).cast("double") for f in features]
    rows = df.select(*[F.when(~F.isnan(c), c).alias(f"x{i}") for i, c in enumerate(x)]).dropna()
    names = ["n", "r", *[f"{k}{i}" for k in ("lo", "hi") for i in range(p)]]
    schema = "n long, r binary, " + ", ".join(f"{c} double" for c in names[2:])

    def emit(n, r, lo, hi):
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([r.tobytes()], pa.binary()), *[pa.array([float(v)]) for v in (*lo, *hi)]], names)

    def leaves(batches):
        n, r, lo, hi = 0, np.zeros((0, p + 1)), np.full(p, np.inf), np.full(p, -np.inf)
        for batch in batches:
            if batch.num_rows:
                m = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns]])
                n, lo, hi = n + len(m), np.minimum(lo, m[:, 1:].min(0)), np.maximum(hi, m[:, 1:].max(0))
                r = np.linalg.qr(np.vstack([r, m]), mode="r")
        if n:
            yield emit(n, r, lo, hi)

    def stacked(parts):
        n, r, lo, hi = 0, np.zeros((0, p + 1)), np.full(p, np.inf), np.full(p, -np.inf)
        for q in parts:
            n, lo, hi = n + q[0], np.minimum(lo, q[2 : 2 + p]), np.maximum(hi, q[2 + p :])
            r = np.linalg.qr(np.vstack([r, np.frombuffer(q[1]).reshape(-1, p + 1)]), mode="r")
        return n, r, lo, hi

    def merge(batches):
        n, r, lo, hi = stacked(list(q.values()) for batch in batches for q in batch.to_pylist())
        if n:
            yield emit(n, r, lo, hi)

    got = rows.mapInArrow(leaves, schema).repartition(_MERGE).mapInArrow(merge, schema).collect()  # at most _MERGE small factors
    n, r, lo, hi = stacked([q.n, q.r, *q[2:]] for q in got)
    r = np.vstack([r, np.zeros((max(0, p + 1 - len(r)), p + 1))])
    return n, hi > lo, r[1 : p + 1, 1:]


#: Tasks that merge the factors before the driver does.
_MERGE = 16


def _unit_columns(varies: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The factor with columns of length 1; NaN for features without variance."""
    size = np.sqrt((r * r).sum(0))
    return np.where(varies, r / np.where(varies, size, 1.0), np.nan)


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    """Pearson correlation of every feature pair as a p x p numpy matrix on the driver.

    One pass over the rows where no feature is missing (NULL or NaN). A feature
    without variance (or a table without complete rows) has NaN with every other.
    """
    _, varies, r = _triangle(df, list(features))
    return _correlations(_unit_columns(varies, r))


def _correlations(u: np.ndarray) -> np.ndarray:
    m = np.clip(u.T @ u, -1.0, 1.0)
    np.fill_diagonal(m, 1.0)
    return m


def corr_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long table ``feature_a, feature_b, corr`` for each pair (a before b in ``features``);
    ``corr`` is NULL when one of the two has no variance. p (p - 1) / 2 rows."""
    feats = list(features)
    m = correlation_matrix(df, feats)
    rows = [(feats[i], feats[j], None if np.isnan(m[i, j]) else float(m[i, j]))
            for i in range(len(feats)) for j in range(i + 1, len(feats))]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def corr_filter(df: DataFrame, features: Sequence[str], label: str | None = None,
                threshold: float = 0.9) -> tuple[list[str], list[tuple[str, str, float]]]:
    """Drop one feature of every pair with ``|corr| > threshold``: the one less
    correlated with ``label`` (or the later one without a label). Returns
    ``(kept, dropped)`` where ``dropped`` lists (feature, partner, corr)."""
    feats = list(features)
    cols = feats + ([label] if label else [])
    m = correlation_matrix(df, cols)
    strength = {f: (abs(m[i, len(feats)]) if label else 0.0) for i, f in enumerate(feats)}
    kept, dropped = list(feats), []
    pairs = sorted(((abs(m[i, j]), i, j) for i in range(len(feats)) for j in range(i + 1, len(feats))
                    if not np.isnan(m[i, j]) and abs(m[i, j]) > threshold), reverse=True)
    for r, i, j in pairs:
        a, b = feats[i], feats[j]
        if a not in kept or b not in kept:
            continue
        loser = b if (strength[a] >= strength[b] or np.isnan(strength[b])) else a
        kept.remove(loser)
        dropped.append((loser, a if loser == b else b, float(m[i, j])))
    return kept, dropped


def _inflation(u: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """Variance inflation from a factor with unit columns: infinite for exactly the features that
    the others determine (those that take part in its null space), NaN for features without
    variance, else the squared norms of the rows of its (pseudo-)inverse. Singular values of the
    factor, not of its square, decide, so condition numbers up to 1 / tol are told from infinite."""
    p = u.shape[1]
    out = np.full(p, np.nan)
    use = [i for i in range(p) if not np.isnan(u[:, i]).any()]
    if not use:
        return np.ones(1) if p == 1 else out
    _, s, vt = np.linalg.svd(u[:, use], full_matrices=True)
    s = np.append(s, np.zeros(len(use) - len(s)))
    null = s <= tol * max(1.0, s[0])
    values = ((vt[~null] / s[~null, None]) ** 2).sum(0)
    values[(vt[null] ** 2).sum(0) > 1e-9] = np.inf
    out[use] = values
    return out


def vif_values(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Variance inflation factor of each feature: infinite where the other features
    determine it, NaN for a feature without variance."""
    feats = list(features)
    _, varies, r = _triangle(df, feats)
    return {f: float(x) for f, x in zip(feats, _inflation(_unit_columns(varies, r)))}


def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, vif`` as a DataFrame (p rows)."""
    vals = {f: None if v != v else v for f, v in vif_values(df, features).items()}
    return df.sparkSession.createDataFrame(list(vals.items()), "feature string, vif double")


def vif_select(df: DataFrame, features: Sequence[str], threshold: float = 10.0) -> tuple[list[str], list]:
    """Stepwise removal: features without variance first, then the feature with the largest
    VIF (the later one of equals) while it exceeds ``threshold``. One pass over the table;
    every step reuses the same factor."""
    feats = list(features)
    _, varies, r = _triangle(df, feats)
    u = _unit_columns(varies, r)
    idx = list(range(len(feats)))
    removed = []
    for i in range(len(feats)):
        if len(feats) > 1 and not varies[i]:
            removed.append((feats[i], float("nan")))
            idx.remove(i)
    while len(idx) > 1:
        v = _inflation(u[:, idx])
        k = len(v) - 1 - int(np.argmax(v[::-1]))
        if not v[k] > threshold:
            break
        removed.append((feats[idx[k]], float(v[k])))
        idx.pop(k)
    return [feats[i] for i in idx], removed
