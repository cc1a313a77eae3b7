"""Exact quantiles without holding every distinct value in one task.

Spark's exact ``percentile`` keeps a count per distinct value and merges them in
a single task for a global aggregate; ``percentile_approx`` is cheap but can be
off by a few ranks. Here every wanted rank is bracketed by two sketch quantiles
and one counting pass says where the rank lies: on the lower end, on the upper
end, or strictly between them, where the next round looks again. The ends are
values of the column, so a tied value that holds the rank ends the search at
once, and each round keeps about one in ``accuracy / 4`` of the rows: two jobs
a round, all ranks of all columns together, two to four rounds for any table.
Only a few numbers per rank reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cupola.operators.prefix import running_totals
from cupola.session import materialise


def _clean(c: str):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _ranks_exact(df: DataFrame, wanted: dict[str, tuple[int, list[int]]], accuracy: int) -> dict[str, dict[int, float]]:
    """``wanted``: column -> (n, ranks within the column's non-missing values)."""
    out: dict[str, dict[int, float]] = {c: {} for c in wanted}
    # an open rank: column, rank, exclusive bounds, values at or below the lower bound, values between
    todo = [(c, r, None, None, 0, n) for c, (n, ranks) in wanted.items() for r in ranks]
    while todo:
        inside: dict[tuple, list] = {}
        for c, r, lo, hi, below, m in todo:
            slack = m / accuracy + 1
            ends = inside.setdefault((c, lo, hi), [])
            ends += [min(1.0, max(0.0, (r - below + 1 - slack) / m)), min(1.0, (r - below + 1 + slack) / m)]
        aggs = []
        for i, ((c, lo, hi), fractions) in enumerate(inside.items()):
            x = _clean(c)
            keep = x.isNotNull()
            if lo is not None:
                keep = keep & (x > F.lit(lo))
            if hi is not None:
                keep = keep & (x < F.lit(hi))
            aggs.append(F.percentile_approx(F.when(keep, x), fractions, accuracy).alias(f"q{i}"))
        sketch = df.select(*aggs).first()
        taken = {k: iter(sketch[f"q{i}"]) for i, k in enumerate(inside)}
        ends = [(next(taken[t[0], t[2], t[3]]), next(taken[t[0], t[2], t[3]])) for t in todo]
        counts = df.select(*[
            F.count_if(test).alias(f"{name}{i}")
            for i, (t, (a, b)) in enumerate(zip(todo, ends))
            for name, test in (("a", _clean(t[0]) < F.lit(a)), ("aa", _clean(t[0]) <= F.lit(a)),
                               ("b", _clean(t[0]) < F.lit(b)), ("bb", _clean(t[0]) <= F.lit(b)))
        ]).first()
        rest = []
        for i, ((c, r, lo, hi, below, m), (a, b)) in enumerate(zip(todo, ends)):
            lt_a, le_a, lt_b, le_b = (counts[f"{k}{i}"] for k in ("a", "aa", "b", "bb"))
            if lt_a <= r < le_a:
                out[c][r] = a
            elif lt_b <= r < le_b:
                out[c][r] = b
            elif r < lt_a:
                rest.append((c, r, lo, a, below, lt_a - below))
            elif r >= le_b:
                rest.append((c, r, b, hi, le_b, below + m - le_b))
            else:
                rest.append((c, r, a, b, le_a, lt_b - le_a))
        todo = rest
    return out


def exact_quantiles_many(df: DataFrame, probs: dict[str, Sequence[float]], interpolation: str = "linear",
                         accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Exact quantiles of several numeric columns (NULL and NaN left out), sharing passes.

    ``interpolation="linear"``: at position ``(n-1)*p``, ``lo + (pos - floor(pos)) * (hi - lo)``;
    ``"lower"``: the value at rank ``floor((n-1)*p)``. ``None`` for an empty column.
    """
    cols = list(probs)
    counts = df.select(*[F.count(_clean(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    wanted = {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        if n:
            ranks = set()
            for p in probs[c]:
                pos = (n - 1) * p
                ranks |= {math.floor(pos), math.ceil(pos)}
            wanted[c] = (n, sorted(ranks))
    vals = _ranks_exact(df, wanted, accuracy) if wanted else {}
    out = {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        res = []
        for p in probs[c]:
            if not n:
                res.append(None)
                continue
            pos = (n - 1) * p
            lo, hi = vals[c][math.floor(pos)], vals[c][math.ceil(pos)]
            res.append(lo if interpolation == "lower" or lo == hi else lo + (pos - math.floor(pos)) * (hi - lo))
        out[c] = res
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], interpolation: str = "linear",
                    accuracy: int = 10000) -> list[float | None]:
    """Exact quantiles of one numeric column; see ``exact_quantiles_many``."""
    return exact_quantiles_many(df, {col: probs}, interpolation, accuracy)[col]


def group_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float] = (0.5,)) -> DataFrame:
    """Exact quantiles of ``col`` per group: the keys, ``n`` and ``q0, q1, ...`` in the order of ``probs``.

    For any number of groups, and for groups of any size: rows become counts per (keys, value) in a
    partial aggregate; ranges of (keys, value) cut them into pieces, and a two-level prefix sum
    gives every value its ranks, so a group that holds a third of the table is spread over the
    ranges. Linear interpolation as in ``exact_quantiles_many``. Rows with a NULL key or a
    missing value are left out; a group without values has no row.
    """
    keys = list(keys)
    known = F.col("_x").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    counts = df.select(*keys, (_clean(col) + F.lit(0.0)).alias("_x")).where(known).groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n"))
    counts = materialise(counts.repartitionByRange(*keys, "_x").withColumn("_piece", F.spark_partition_id()))
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("n"))
    ranked = running_totals(counts, keys, ["_x"], F.col("_piece"), {"_upto": F.col("_n")}, inclusive=True).join(totals, keys)

    def at(rank):
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), F.col("_x")))

    out, aggs = [], []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        aggs += [at(F.floor(pos)).alias(f"_lo{i}"), at(F.ceil(pos)).alias(f"_hi{i}")]
        out.append((F.col(f"_lo{i}") + (pos - F.floor(pos)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}"))
    return ranked.groupBy(*keys, "n").agg(*aggs).select(*keys, "n", *out)
