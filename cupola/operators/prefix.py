"""Running totals without one task per key: a two-level prefix sum.

A window ``partitionBy(key).orderBy(t)`` puts every row of a key into one task,
and an unpartitioned window puts the whole table into one task. Here the order
is cut into buckets (a column that is non-decreasing along the order, such as
the day of a timestamp or a score quantile): totals per (key, bucket) come from
a partial aggregate, exclusive offsets per bucket from a window over those
small totals, and the running sum inside each (key, bucket) from a window that
is partitioned by (key, bucket). A hot key is thereby spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cupola.session import materialise


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    bucket: Column,
    values: dict[str, Column],
    inclusive: bool = True,
) -> DataFrame:
    """Add one running sum per entry of ``values`` (name -> numeric column).

    ``order`` must be a total order within ``keys`` (end it with a unique id);
    ``bucket`` must be non-decreasing along ``order``. ``inclusive=False`` sums
    the rows strictly before the current one (0 for the first). Result is exact:
    the buckets only decide how the work is split.
    """
    keys = list(keys)
    b = df.withColumn("_bucket", bucket)
    totals = b.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_tot_{n}") for n, v in values.items()])
    w_off = (Window.partitionBy(*keys) if keys else Window).orderBy("_bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bucket", *[
        F.coalesce(F.sum(f"_tot_{n}").over(w_off), F.lit(0)).alias(f"_off_{n}") for n in values])
    joined = b.join(offsets, [*keys, "_bucket"], "inner")
    w_in = Window.partitionBy(*keys, "_bucket").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return joined.withColumns({
        n: F.col(f"_off_{n}") + F.coalesce(F.sum(v).over(w_in), F.lit(0)) for n, v in values.items()
    }).drop("_bucket", *[f"_off_{n}" for n in values])


def with_hot_split(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    position: Column,
    max_bucket_rows: int = 1_000_000,
    broadcast_rows: int = 100_000,
    col: str = "_bucket",
) -> DataFrame:
    """``df`` plus a bucket column ``col`` for ``running_totals`` in which no (key, bucket)
    group is much larger than ``max_bucket_rows`` when rows spread evenly in ``position``.

    ``bucket`` must be an integer non-decreasing along the order; ``position`` a
    number non-decreasing along the order inside a bucket (for example microseconds
    of the timestamp the order starts with). Groups over ``max_bucket_rows`` rows
    are found by one partial aggregate and cut into slices of ``position`` of width
    ``(max - min + 1) * max_bucket_rows / rows``; the new bucket is
    ``bucket * 2^40 + slice`` (slice 0 for the others), so it stays non-decreasing
    along the order. A group gets at most about rows / ``max_bucket_rows`` slices,
    far below 2^40; ``bucket`` must stay below 2^23 (day numbers do). The hot groups number at most rows / max_bucket_rows; they are
    broadcast only when counted at or under ``broadcast_rows``, else joined by a
    shuffle. The running totals stay exact whatever the slices.
    """
    keys = list(keys)
    b = df.withColumns({"_hb": bucket.cast("bigint"), "_hp": position.cast("bigint")})
    hot = (b.groupBy(*keys, "_hb")
           .agg(F.count(F.lit(1)).alias("_hn"), F.min("_hp").alias("_hlo"), F.max("_hp").alias("_hhi"))
           .where(F.col("_hn") > F.lit(max_bucket_rows))
           .select(*keys, "_hb", "_hlo",
                   F.greatest(F.lit(1), F.ceil((F.col("_hhi") - F.col("_hlo") + F.lit(1)).cast("double")
                                               * F.lit(float(max_bucket_rows)) / F.col("_hn"))).alias("_hw")))
    hot = materialise(hot)  # a small table, read by the count and by the join
    n_hot = hot.count()
    slice_ = F.lit(0).cast("bigint")
    if n_hot:
        side = F.broadcast(hot) if n_hot <= broadcast_rows else hot
        b = b.join(side, [*keys, "_hb"], "left")
        slice_ = F.coalesce(F.floor((F.col("_hp") - F.col("_hlo")) / F.col("_hw")), slice_)
    out = b.withColumn(col, F.col("_hb") * F.lit(1 << 40) + slice_)
    return out.drop("_hb", "_hp", *(["_hlo", "_hw"] if n_hot else []))


def with_tie_split(df: DataFrame, keys: Sequence[str], bucket: str, position: Column, id_col: str,
                   max_bucket_rows: int = 1_000_000, broadcast_rows: int = 100_000, col: str = "_tie") -> DataFrame:
    """``df`` plus an integer ``col`` that cuts (key, ``bucket``) groups whose rows all share one
    ``position`` (a burst, a date-only column) by ranges of the integer ``id_col``, which orders
    such rows. ``(bucket, col)`` stays non-decreasing along (position, id); 0 for other groups.
    """
    keys = list(keys)
    b = df.withColumns({"_tp": position.cast("bigint"), "_ti": F.col(id_col).cast("bigint")})
    hot = materialise(
        b.groupBy(*keys, bucket)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_tp").alias("_a"), F.max("_tp").alias("_z"), F.min("_ti").alias("_tlo"), F.max("_ti").alias("_thi"))
        .where((F.col("_n") > F.lit(max_bucket_rows)) & (F.col("_a") == F.col("_z")))
        .select(*keys, bucket, "_tlo", F.greatest(F.lit(1.0), (F.col("_thi") - F.col("_tlo") + 1).cast("double") * F.lit(float(max_bucket_rows)) / F.col("_n")).alias("_tw")))
    n_hot = hot.count()
    if not n_hot:
        return df.withColumn(col, F.lit(0).cast("bigint"))
    b = b.join(F.broadcast(hot) if n_hot <= broadcast_rows else hot, [*keys, bucket], "left")
    cut = F.coalesce(F.floor((F.col("_ti") - F.col("_tlo")) / F.col("_tw")), F.lit(0))
    return b.withColumn(col, cut.cast("bigint")).drop("_tp", "_ti", "_tlo", "_tw")
