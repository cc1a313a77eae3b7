"""Data-quality operators: quasi-constant features, missing values, duplicates, outliers.

All statistics are computed by Spark aggregates (map-side partial aggregation,
one shuffle at most); only per-column results (one number per feature) reach
the driver, to be applied back as literals in a projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupola.operators.quantile import exact_quantiles, exact_quantiles_many, group_quantiles
from cupola.session import materialise

_FLOATS = (T.FloatType, T.DoubleType)


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _FLOATS)


def _value(df: DataFrame, c: str) -> Column:
    """Column value with NaN treated as missing (NULL)."""
    col = F.col(c)
    return F.when(~F.isnan(col), col) if _is_float(df, c) else col


def _features_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # the feature list itself (p names), to keep empty / all-missing features in reports
    rows = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(c).alias("feature")) for i, c in enumerate(cols)])
    return df.sparkSession.range(1, numPartitions=1).select(F.inline(rows)) if cols else df.sparkSession.createDataFrame([], "idx int, feature string")


# ---------------------------------------------------------------------------------------
# A3: quasi-constant features
# ---------------------------------------------------------------------------------------

_SET_CHUNK = 48  # grouping sets per aggregate (grouping id is a 64-bit mask)


def _top_counts_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(idx, top_count, non_missing) per feature via grouping sets, one per column.

    ``Expand`` emits one row per (row, feature); the partial hash aggregate before
    the shuffle collapses repeated values, so a near-constant column costs almost
    nothing to shuffle, and a high-cardinality one shuffles its distinct values.
    """
    parts = []
    for start in range(0, len(cols), _SET_CHUNK):
        chunk = list(cols[start:start + _SET_CHUNK])
        names = [f"_v{i}" for i in range(len(chunk))]
        base = df.select(*[_value(df, c).alias(n) for c, n in zip(chunk, names)])
        grouped = base.groupingSets([[F.col(n)] for n in names], *names).agg(
            F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
        full = (1 << len(names)) - 1
        # grouping_id has bit (k-1-i) clear for the active column i
        idx = F.coalesce(*[F.when(F.col("_gid") == F.lit(full ^ (1 << (len(names) - 1 - i))), F.lit(start + i))
                           for i in range(len(names))])
        present = F.coalesce(*[F.when(F.col("_gid") == F.lit(full ^ (1 << (len(names) - 1 - i))),
                                      F.col(n).isNotNull()) for i, n in enumerate(names)])
        parts.append(
            grouped.select(idx.alias("idx"), present.alias("_present"), "_n")
            .groupBy("idx")
            .agg(F.max(F.when(F.col("_present"), F.col("_n"))).alias("top_count"),
                 F.sum(F.when(F.col("_present"), F.col("_n"))).alias("non_missing"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tracked(threshold: float) -> int:
    """Counters with which the summary cannot miss a value of more than ``threshold``: its error
    is at most 3.5 rows in as many as it has slots (a power of two over 4/3 of the counters)."""
    return max(64, math.ceil(8 / threshold))


def _top_counts_sketch(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """(idx, top_count, non_missing) without grouping by value; ``top_count`` is exact for a
    feature whose top share reaches ``threshold``, and NULL for one that is proven to be under it.

    One scan feeds the value hashes of every feature to a frequent-item summary (a bounded
    number of counters, merged over tasks; counts are never too low, and no value over twice
    its error is left out). Only features with a value that may reach the threshold, at most
    ``1 / threshold`` values each, are read again, to count those values exactly; the second
    aggregate also takes the smallest and largest value with each hash: if they differ,
    distinct values share the hash, and that column is counted by grouping instead.
    """
    n = _tracked(threshold)
    hashes = [F.when(_value(df, c).isNotNull(), F.xxhash64(_value(df, c))) for c in cols]
    row = df.select(*[F.call_function("approx_top_k", h, F.lit(n), F.lit(n)).alias(f"_k{i}") for i, h in enumerate(hashes)],
                    *[F.count(_value(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)]).first()
    may = [(i, k["item"]) for i in range(len(cols)) for k in row[f"_k{i}"]
           if k["item"] is not None and k["count"] >= threshold * row[f"_m{i}"]]
    aggs = []
    for j, (i, target) in enumerate(may):
        hit = hashes[i] == F.lit(target)
        v = F.when(hit, _value(df, cols[i]))
        aggs += [F.count_if(hit).alias(f"_t{j}"), F.min(v).alias(f"_lo{j}"), F.max(v).alias(f"_hi{j}")]
    found = df.select(*aggs).first() if aggs else None
    top = {i: None for i in range(len(cols))}
    collided = set()
    for j, (i, _) in enumerate(may):
        if found[f"_lo{j}"] != found[f"_hi{j}"]:
            collided.add(i)
        elif found[f"_t{j}"] >= threshold * row[f"_m{i}"]:
            top[i] = max(top[i] or 0, found[f"_t{j}"])
    number = lambda x, kind: F.lit(x).cast(kind)
    rows = [F.struct(number(i, "int").alias("idx"), number(top[i], "bigint").alias("top_count"), number(row[f"_m{i}"], "bigint").alias("non_missing"))
            for i in top if i not in collided]
    out = df.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*rows))) if rows \
        else df.sparkSession.createDataFrame([], "idx int, top_count bigint, non_missing bigint")
    if collided:
        again = sorted(collided)
        exact = _top_counts_exact(df, [cols[i] for i in again])
        remap = F.element_at(F.array(*[F.lit(i) for i in again]), F.col("idx") + 1)
        out = out.unionByName(exact.select(remap.alias("idx"), "top_count", "non_missing"))
    return out


def quasi_constant_report(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 0.95,
                          method: str = "exact") -> DataFrame:
    """Share of the most frequent value among non-missing values, per feature.

    Columns: ``feature, top_count, non_missing, ratio, flagged``. Missing values
    (NULL, and NaN in floating columns) are outside numerator and denominator; an
    all-missing feature has ratio NULL and is not flagged; the test is strict
    (``ratio > threshold``). ``method="sketch"`` avoids the shuffle by value and
    decides flags exactly for any threshold of 0.001 or more; its ``top_count`` and
    ``ratio`` are NULL for features whose top share is under the threshold.
    """
    cols = list(cols if cols is not None else df.columns)
    if method == "exact":
        tops = _top_counts_exact(df, cols)
    elif method == "sketch":
        if threshold < 0.001:
            raise ValueError("method='sketch' needs a threshold of 0.001 or more; use method='exact'")
        tops = _top_counts_sketch(df, cols, threshold)
    else:
        raise ValueError("method must be 'exact' or 'sketch'")
    ratio = F.col("top_count") / F.col("non_missing")
    return (
        _features_frame(df, cols)
        .join(F.broadcast(tops), "idx", "left")  # both sides hold one row per feature
        .select("idx", "feature", "top_count",
                F.coalesce(F.col("non_missing"), F.lit(0)).cast("bigint").alias("non_missing"),
                F.when(F.col("non_missing") > 0, ratio).alias("ratio"))
        .withColumn("flagged", F.coalesce(F.col("ratio") > F.lit(threshold), F.lit(False)))
        .drop("idx")
    )


def quasi_constant_messages(report: DataFrame) -> DataFrame:
    """One line of text per flagged feature: its name and the top share to 4 decimals."""
    return report.where("flagged").select(
        F.format_string("dropped feature %s: most frequent value holds %.4f of non-missing values",
                        F.col("feature"), F.col("ratio")).alias("message"))


def quasi_constant_filter(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 0.95,
                          method: str = "exact", report_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Drop quasi-constant features. Returns ``(pruned_df, report)``.

    The flagged names (at most one per feature) are the only values brought to
    the driver. ``report_only=True`` leaves ``df`` unchanged.
    """
    # one row per feature, written once: the flags and the caller read the same report
    report = materialise(quasi_constant_report(df, cols, threshold, method))
    if report_only:
        return df, report
    flagged = [r["feature"] for r in report.where("flagged").select("feature").collect()]
    return df.drop(*flagged), report


# ---------------------------------------------------------------------------------------
# Missing values
# ---------------------------------------------------------------------------------------

def _is_missing(df: DataFrame, c: str) -> Column:
    return _value(df, c).isNull()


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``feature, n_rows, n_missing, missing_ratio`` for every column, from one aggregate."""
    cols = list(cols if cols is not None else df.columns)
    wide = df.select(F.count(F.lit(1)).alias("_rows"),
                     *[F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col("_rows").alias("n_rows"), F.col(f"_m{i}").alias("n_missing"),
                 F.try_divide(F.col(f"_m{i}"), F.col("_rows")).alias("missing_ratio"))
        for i, c in enumerate(cols)])))


def _mode_value(df: DataFrame, c: str):
    # most frequent non-missing value, smallest value on ties (distributed group-by, top-1 kept)
    row = (df.where(~_is_missing(df, c)).groupBy(c).count()
           .orderBy(F.desc("count"), F.asc(c)).limit(1).collect())
    return row[0][c] if row else None


def fill_values(df: DataFrame, strategies: dict, exact: bool = True, accuracy: int = 10000) -> dict:
    """Replacement value per column: ``'mean'``, ``'median'``, ``'mode'`` or a constant.

    Means come from one aggregate over all listed columns. Medians are exact order
    statistics (``exact_quantiles``: sketch brackets, then only the rows inside them)
    or, with ``exact=False``, ``percentile_approx`` values.
    """
    means = [F.avg(_value(df, c)).alias(c) for c, how in strategies.items() if how == "mean"]
    values = df.select(*means).first().asDict() if means else {}
    approx = [c for c, how in strategies.items() if how == "median" and not exact]
    if approx:
        row = df.select(*[F.percentile_approx(_value(df, c), 0.5, accuracy).alias(c) for c in approx]).first()
        values.update(row.asDict())
    medians = [c for c, how in strategies.items() if how == "median" and exact]
    if medians:
        values.update({c: q[0] for c, q in exact_quantiles_many(df, {c: [0.5] for c in medians}).items()})
    for c, how in strategies.items():
        if how == "mode":
            values[c] = _mode_value(df, c)
        elif how not in ("mean", "median"):
            values[c] = how
    return values


def fill_missing(df: DataFrame, strategies: dict, add_indicator: bool = False, exact: bool = True) -> DataFrame:
    """Replace missing values (NULL, NaN) per column; optional ``<c>_missing`` 0/1 flags."""
    values = fill_values(df, strategies, exact=exact)
    cols = {}
    for c, v in values.items():
        if add_indicator:
            cols[f"{c}_missing"] = _is_missing(df, c).cast("int")
        cols[c] = F.coalesce(_value(df, c), F.lit(v).cast(df.schema[c].dataType))
    return df.withColumns(cols)


def fill_missing_by_group(df: DataFrame, col: str, keys: Sequence[str], prob: float = 0.5, add_indicator: bool = False) -> DataFrame:
    """Missing values of ``col`` replaced by the exact quantile (median) of the row's group, and by
    that of the whole column where the group has no value or a key is NULL. One row per group is
    joined to the data; the table keeps all its rows."""
    groups = group_quantiles(df, keys, col, [prob]).select(*keys, F.col("q0").alias("_fill"))
    whole = exact_quantiles(df, col, [prob])[0]
    out = df.join(groups, list(keys), "left")
    cols = {f"{col}_missing": _is_missing(df, col).cast("int")} if add_indicator else {}
    cols[col] = F.coalesce(_value(df, col), F.coalesce(F.col("_fill"), F.lit(whole).cast("double")).cast(df.schema[col].dataType))
    return out.withColumns(cols).select(*df.columns, *[c for c in cols if c != col])


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """Drop rows with a missing value (``how="any"``) or all missing (``"all"``) in ``cols``."""
    cols = list(cols if cols is not None else df.columns)
    flags = [_is_missing(df, c) for c in cols]
    cond = flags[0]
    for f in flags[1:]:
        cond = (cond | f) if how == "any" else (cond & f)
    return df.where(~cond)


# ---------------------------------------------------------------------------------------
# duplicates
# ---------------------------------------------------------------------------------------

def dedup_exact(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows (or projections on ``cols``) that are fully equal are kept once.

    A hash aggregate on all columns: duplicates collapse in the map-side partial
    aggregate before the shuffle, so a value repeated a billion times ships once
    per map task.
    """
    return (df.select(*cols) if cols else df).dropDuplicates()


def dedup_keyed(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the first by ``order`` (give a total order for a deterministic winner).

    ``row_number() = 1`` is planned with a partial ``WindowGroupLimit`` before the
    shuffle, so each map task sends at most one row per key; a hot key does not
    move its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


# ---------------------------------------------------------------------------------------
# outliers
# ---------------------------------------------------------------------------------------

def outlier_bounds(df: DataFrame, cols: Sequence[str], method: str = "iqr", k: float = 1.5,
                   exact: bool = True, accuracy: int = 10000) -> dict[str, tuple[float, float]]:
    """(low, high) per column.

    ``iqr``: [q1 - k*IQR, q3 + k*IQR] with linearly interpolated quartiles, exact
    (``exact_quantiles``) or from ``percentile_approx``; ``sigma``: mean -/+ k *
    sample standard deviation from one aggregate.
    """
    if method not in ("iqr", "sigma"):
        raise ValueError("method must be 'iqr' or 'sigma'")
    stats = {}
    if method == "iqr" and exact:
        stats = {c: tuple(q) for c, q in exact_quantiles_many(df, {c: [0.25, 0.75] for c in cols}).items()}
    else:
        aggs = []
        for i, c in enumerate(cols):
            v = _value(df, c)
            if method == "iqr":
                q = F.percentile_approx(v, [0.25, 0.75], accuracy)
                aggs += [q[0].alias(f"_a{i}"), q[1].alias(f"_b{i}")]
            else:
                aggs += [F.avg(v).alias(f"_a{i}"), F.stddev_samp(v).alias(f"_b{i}")]
        row = df.select(*aggs).first()
        stats = {c: (row[f"_a{i}"], row[f"_b{i}"]) for i, c in enumerate(cols)}
    bounds = {}
    for c in cols:
        a, b = stats[c]
        if a is None or b is None:
            bounds[c] = (None, None)
        elif method == "iqr":
            bounds[c] = (a - k * (b - a), b + k * (b - a))
        else:
            bounds[c] = (a - k * b, a + k * b)
    return bounds


def _outside(df: DataFrame, c: str, lo, hi) -> Column:
    col = _value(df, c)  # missing (NULL, NaN) is never an outlier; Spark orders NaN above all numbers
    if lo is None:
        return F.lit(False)
    return F.coalesce((col < F.lit(lo)) | (col > F.lit(hi)), F.lit(False))


def outlier_flag(df: DataFrame, bounds: dict) -> DataFrame:
    """Add ``<c>_outlier`` (0/1) per column."""
    return df.withColumns({f"{c}_outlier": _outside(df, c, lo, hi).cast("int") for c, (lo, hi) in bounds.items()})


def outlier_clip(df: DataFrame, bounds: dict) -> DataFrame:
    """Clip each column into its bounds (winsorise); missing values (NULL, NaN) stay
    as they are (``least``/``greatest`` alone would skip a NULL and return a bound)."""
    return df.withColumns({c: F.when(_is_missing(df, c), F.col(c))
                           .otherwise(F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))
                           for c, (lo, hi) in bounds.items() if lo is not None})


def outlier_drop(df: DataFrame, bounds: dict) -> DataFrame:
    """Drop rows outside the bounds of any column."""
    cond = F.lit(False)
    for c, (lo, hi) in bounds.items():
        cond = cond | _outside(df, c, lo, hi)
    return df.where(~cond)
