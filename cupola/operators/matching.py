"""One redeem uses up one coupon.

``timeline.redemption_label`` asks whether any redeem follows an issue, so one redeem marks many
coupons. Here redeems use up coupons of their key first in, first out: a redeem takes the
earliest coupon that is issued, not used and not expired (``[issue, issue + horizon]``); a redeem
that finds none takes nothing.

Issues, redeems and expiries of a key stand in one order of time. Coupons are used or expire in
the order of their issue, so a key's state is one number, how many of its coupons have gone:

- the e-th expiry sets it to ``max(x, e)``;
- a redeem after i issues sets it to ``min(x + 1, i)``, and takes coupon ``x + 1`` if that is
  no more than i.

Both are clamps ``min(c, max(b, x + a))``, and clamps compose to clamps. So no task reads a whole
key: events are cut into ranges of (key, time); counts of the ranges before give each range its
first issue and expiry numbers; each range of a key that has several composes its clamp; the few
clamps of a key, in order, give every range the state that it starts with; then ranges are
played independently. Coupons and redeems meet by an equi-join on (key, number).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cupola.operators.timeline import _micros, _seconds
from cupola.session import materialise

ISSUE, REDEEM, EXPIRY = 0, 1, 2  # in this order at equal times: a coupon can be used in its last instant
#: Above any number of coupons.
NO_BOUND = 1 << 62


def _played(run: Iterator[tuple[int, int]], x: int, issued: int, expired: int) -> Iterator[tuple[int, int, int]]:
    """``(kind, number, row)`` of each issue, and of each redeem that takes a coupon."""
    for kind, row in run:
        if kind == ISSUE:
            issued += 1
            yield ISSUE, issued, row
        elif kind == EXPIRY:
            expired += 1
            x = max(x, expired)
        elif x < issued:
            x += 1
            yield REDEEM, x, row


def _clamp(run: Iterator[tuple[int, int]], issued: int, expired: int) -> tuple[int, int, int]:
    """``(a, b, c)`` of ``x -> min(c, max(b, x + a))``, what a range does to the state."""
    a, b, c = 0, -NO_BOUND, NO_BOUND
    for kind, _ in run:
        if kind == ISSUE:
            issued += 1
        elif kind == EXPIRY:
            expired += 1
            b, c = max(b, expired), max(c, expired)
        else:
            a, b, c = a + 1, min(b + 1, issued), min(c + 1, issued)
    return a, b, c


def _ranges(batches, n_state: int) -> Iterator[tuple[tuple, Iterator[tuple[int, int]]]]:
    """``(range and its state, events)``; a row is ``n_state`` columns, then kind and row."""
    from itertools import groupby

    def rows():
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                yield from zip(*[c.to_pylist() for c in batch.slice(k, 4096).columns])

    for state, run in groupby(rows(), key=lambda r: r[:n_state]):
        yield state, (r[n_state:] for r in run)


def _batches(rows: Iterator[tuple], names: Sequence[str]) -> Iterator:
    from itertools import islice

    import pyarrow as pa

    while out := list(islice(rows, 4096)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], list(names))


def redemption_match(
    issues: DataFrame,
    redeems: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    horizon,
    id_col: str,
    redeem_ts_col: str | None = None,
    redeem_id_col: str | None = None,
    label_col: str = "label",
) -> DataFrame:
    """``issues`` with ``redeem_id, redeem_ts`` (NULL if not used) and ``label``: 1 when a redeem
    used the coupon, each redeem using one at most, first in, first out.

    ``horizon`` in seconds or a ``timedelta``. Equal times: issues before redeems, each by id.
    Rows with a NULL key or time match nothing; issues among them stay, with label 0.
    """
    h_us = _seconds(horizon) * 1_000_000
    if h_us <= 0:
        raise ValueError("horizon must be positive")
    keys = list(keys)
    known = F.lit(True)
    for c in [*keys, "_t"]:
        known = known & F.col(c).isNotNull()
    rows = materialise(issues.withColumn("_row", F.monotonically_increasing_id()))
    used = materialise(redeems.select(*keys, F.col(redeem_id_col or id_col).alias("redeem_id"), F.col(redeem_ts_col or ts_col).alias("redeem_ts"))
                       .withColumn("_row", F.monotonically_increasing_id()))

    a = rows.select(*keys, _micros(F.col(ts_col)).alias("_t"), F.col(id_col).alias("_i"), "_row")
    a = a.select(*keys, "_i", "_row", F.inline(F.array(
        F.struct(F.col("_t").alias("_t"), F.lit(ISSUE).cast("long").alias("_kind")),
        F.struct((F.col("_t") + F.lit(h_us)).alias("_t"), F.lit(EXPIRY).cast("long").alias("_kind")))))
    b = used.select(*keys, _micros(F.col("redeem_ts")).alias("_t"), F.lit(REDEEM).cast("long").alias("_kind"), F.col("redeem_id").alias("_r"), "_row")
    order = [*keys, "_t", "_kind", "_i", "_r", "_row"]
    events = materialise(
        a.unionByName(b, allowMissingColumns=True).where(known).repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*keys, "_kind", "_row", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_nth")))

    counts = events.groupBy(*keys, "_part").agg(F.count_if(F.col("_kind") == ISSUE).alias("_n_i"), F.count_if(F.col("_kind") == EXPIRY).alias("_n_e"))
    of_key = Window.partitionBy(*keys)  # a row per key and range
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialise(counts.withColumn("_run", F.monotonically_increasing_id())).select(
        *keys, "_part", "_run", F.min("_run").over(of_key).alias("_key"), F.count(F.lit(1)).over(of_key).alias("_ranges"),
        F.coalesce(F.sum("_n_i").over(before), F.lit(0)).alias("_issued"), F.coalesce(F.sum("_n_e").over(before), F.lit(0)).alias("_expired"))
    ranges = materialise(ranges)
    placed = events.join(ranges, [*keys, "_part"])

    def compose(batches):
        yield from _batches(((s[0], s[1], *_clamp(run, s[2], s[3])) for s, run in _ranges(batches, 4)), ["_key", "_run", "a", "b", "c"])

    def start(batches):
        def states():
            for (key,), run in _ranges(batches, 1):
                x = 0
                for run_id, a, b, c in run:
                    yield run_id, x
                    x = min(c, max(b, x + a))

        yield from _batches(states(), ["_run", "_x"])

    def play(batches):
        yield from _batches(((s[0], *e) for s, run in _ranges(batches, 5) for e in _played(run, s[4], s[2], s[3])), ["_key", "_kind", "_n", "_row"])

    split = placed.where("_ranges > 1").select("_key", "_run", "_issued", "_expired", "_kind", "_row", "_nth")
    clamps = split.repartition("_run").sortWithinPartitions("_run", "_nth").drop("_nth").mapInArrow(compose, "_key long, _run long, a long, b long, c long")
    states = (clamps.join(ranges.select("_run", "_part"), "_run").repartition("_key").sortWithinPartitions("_key", "_part")
              .select("_key", "_run", "a", "b", "c").mapInArrow(start, "_run long, _x long"))
    played = (placed.join(states, "_run", "left")
              .select("_key", "_run", "_issued", "_expired", F.coalesce("_x", F.lit(0)).cast("long").alias("_x"), "_kind", "_row", "_nth")
              .repartition("_run").sortWithinPartitions("_run", "_nth").drop("_nth")
              .mapInArrow(play, "_key long, _kind long, _n long, _row long"))
    played = materialise(played)
    taken = (played.where(F.col("_kind") == REDEEM).select("_key", "_n", F.col("_row").alias("_used"))
             .join(played.where(F.col("_kind") == ISSUE).drop("_kind"), ["_key", "_n"])
             .join(used.select(F.col("_row").alias("_used"), "redeem_id", "redeem_ts"), "_used")
             .select("_row", "redeem_id", "redeem_ts", F.lit(1).alias("_hit")))
    return rows.join(taken, "_row", "left").withColumn(label_col, F.coalesce("_hit", F.lit(0))).drop("_row", "_hit")
