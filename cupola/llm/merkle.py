"""Merkle manifest of a table, with parents that keep SHA-256 states between their children.

A leaf is the hash of a row's fields. Leaves of a group stand in order; every ``fanout``
consecutive nodes of a level (the last run may be shorter) become the hash of their digests'
hex text, until one is left: the group's subroot. The subroots, in the order of the groups,
give the root in the same way.

A parent hashes its children one after another, and keeps a copy of the hash state from before
each of them. To fold a changed child upwards, the copy that stands before its slot is resumed
with the new digest and the siblings to the right; those to the left are in the state already.

Nodes are numbered without a window over a group: rows are sorted by ranges, and the counts of
the ranges before are added. Blocks of ``fanout ** depth`` consecutive nodes are the unit of
work, so a group of any size is spread over many tasks: going up, a block yields one node of
the next table; going down, it takes the siblings on the path from that node to the root (a few
digests a level) and gives each of its nodes its own path. States live in the task that made
them; above its block they are remade from the left siblings, once for the block.

Edge cases: a null field is ``-``, so it differs from an empty text; a null group is a group of
its own, before the others; rows with a null order column stand first; rows equal in group and
order stand by leaf, and rows that repeat in full are leaves of their own; a group of one row
has its leaf as subroot, and one group's subroot is the root; long texts are hashed where they
are read and do not travel; an empty table gives no rows; only the named fields are read, so
extra columns of any name do not matter. A row that is not tampered with is folded as well,
from its own leaf.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cupola.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes that a block has at most; rows read and handed back at once.
BLOCK = 1024
ROWS_OUT = 1024


def field(c: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def H(parts: Sequence[bytes]) -> bytes:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest().encode()


class Parent:
    """An inner node: its digest, its children, and a hash state from before each of them."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: Sequence[bytes]):
        h, self.children, self.states = hashlib.sha256(), children, []
        for c in children:
            self.states.append(h.copy())
            h.update(c)
        self.digest = h.hexdigest().encode()

    def fold(self, slot: int, digest: bytes) -> bytes:
        h = self.states[slot].copy()
        h.update(digest)
        for c in self.children[slot + 1 :]:
            h.update(c)
        return h.hexdigest().encode()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1 :])


def height(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes."""
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def tree(nodes: Sequence[bytes], n: int, fanout: int, depth: int) -> list[list[Parent]]:
    """Parents level by level over a block's nodes; ``n`` nodes are in the group in all."""
    levels, below = [], list(nodes)
    for _ in range(min(depth, height(n, fanout))):
        levels.append([Parent(below[k : k + fanout]) for k in range(0, len(below), fanout)])
        below = [p.digest for p in levels[-1]]
    return levels


@dataclass
class Manifest:
    """``rows``: ``(key, pos, n, digest, id, changed)`` for each row of the table; ``up``: tables
    ``(key, pos, n, digest)`` of the nodes a block higher each, up to one per group; ``groups``:
    the subroots (``lang``, ``key`` 0) and the tables above them; ``root`` is None without rows."""

    rows: DataFrame
    up: list[DataFrame]
    groups: list[DataFrame]
    root: str | None
    fanout: int
    depth: int


def numbered(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos``, a row's place in its key by ``order`` (a total order), and ``n``, the key's rows."""
    cuts = [F.col(c).asc_nulls_first() for c in (key, *order)]
    placed = materialise(
        df.repartitionByRange(*cuts).sortWithinPartitions(*cuts)
        .withColumns({"part": F.spark_partition_id(), "nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    )
    runs = placed.groupBy(F.col(key).alias("k"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("m"), F.min("nth").alias("first"))
    ranges = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row per key and range
    runs = runs.select("k", "p", (F.coalesce(F.sum("m").over(ranges), F.lit(0)) - F.col("first")).alias("off"), F.sum("m").over(Window.partitionBy("k")).alias("n"))
    joined = placed.join(runs, (F.col("part") == F.col("p")) & F.col(key).eqNullSafe(F.col("k")))
    return joined.withColumn("pos", F.col("nth") + F.col("off")).drop("k", "p", "off", "part", "nth")


def _dealt(nodes: DataFrame) -> DataFrame:
    """Nodes in order within their blocks, each block in one task."""
    return nodes.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def _block(size: int) -> Column:
    return F.floor(F.col("pos") / F.lit(size)).cast("long").alias("block")


def _runs(batches) -> Iterator[tuple[object, int, list[tuple]]]:
    """``(key, block, rows)`` for each block, however the batches cut it; a row is what follows
    ``key`` and ``block`` in the columns."""

    def rows():
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                yield from zip(*[c.to_pylist() for c in batch.slice(k, ROWS_OUT).columns])

    for (key, block), run in groupby(rows(), key=lambda r: r[:2]):
        yield key, block, [r[2:] for r in run]


def _batches(rows: Iterator[tuple], schema) -> Iterator:
    import pyarrow as pa

    while out := list(islice(rows, ROWS_OUT)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def _arrow(df_schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def _ascend(nodes: DataFrame, fanout: int, depth: int) -> list[DataFrame]:
    """The tables of nodes above ``nodes(key, pos, n, digest)``, until each key has one node."""
    size = fanout**depth
    to = StructType([nodes.schema["key"], *(StructField(c, LongType()) for c in ("pos", "n")), StructField("digest", StringType())])
    schema = _arrow(to)

    def run(batches):
        def parents():
            for key, block, rows in _runs(batches):
                n = rows[0][1]
                levels = tree([r[2].encode() for r in rows], n, fanout, depth)
                for _ in levels:
                    n = -(-n // fanout)
                yield key, block, n, levels[-1][0].digest.decode() if levels else rows[0][2]

        yield from _batches(parents(), schema)

    tables, here = [], nodes
    while (here.agg(F.max("n")).first()[0] or 0) > 1:
        here = materialise(_dealt(here.select("key", _block(size), "pos", "n", "digest")).mapInArrow(run, to))
        tables.append(here)
    return tables


def _joined(steps: Sequence[tuple[bytes, bytes]]) -> str:
    return b";".join(a + b"," + b for a, b in steps).decode()


def _steps(path: str) -> list[tuple[bytes, bytes]]:
    return [tuple(s.split(b",")) for s in path.encode().split(b";")] if path else []


def _descend(nodes: DataFrame, paths: DataFrame, fanout: int, depth: int, give: Callable, to: StructType) -> DataFrame:
    """What ``give`` makes of each block: its key, its place, its rows, their parents, and the
    path and subroot that ``paths(key, pos, path, subroot)`` holds for the block's node."""
    size, schema = fanout**depth, _arrow(to)
    extra = [c for c in nodes.columns if c not in ("key", "pos", "n", "digest")]
    below = nodes.select("key", _block(size), "pos", "n", "digest", *extra)
    above = paths.select("key", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("n"), "path", "subroot")
    rows = below.unionByName(above, allowMissingColumns=True)  # a block's path stands before its nodes

    def run(batches):
        def made():
            for key, block, run in _runs(batches):
                (head, rows) = run[0], run[1:]
                levels = tree([r[2].encode() for r in rows], rows[0][1], fanout, depth)
                yield from give(key, rows, levels, head[-2], head[-1])

        yield from _batches(made(), schema)

    return _dealt(rows).mapInArrow(run, to)


def _paths(nodes: DataFrame, paths: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Rows ``(key, pos, path, subroot)`` for every node of a table."""
    to = StructType([nodes.schema["key"], StructField("pos", LongType()), StructField("path", StringType()), StructField("subroot", StringType())])

    def give(key, rows, levels, path, subroot):
        for i, r in enumerate(rows):
            steps = _joined([p[i // fanout ** (k + 1)].siblings(i // fanout**k % fanout) for k, p in enumerate(levels)])
            yield key, r[0], ";".join(s for s in (steps, path) if s), subroot

    return materialise(_descend(nodes.select("key", "pos", "n", "digest"), paths, fanout, depth, give, to))


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", fanout: int = 2, depth: int | None = None,
          tampered: dict[str, Column] | None = None) -> Manifest:
    """The tree over ``docs``. ``tampered`` maps fields to columns that replace them in a second
    leaf of each row, which ``fold`` checks against the tree."""
    if fanout < 2:
        raise ValueError("a parent has room for two children or more")
    depth = depth or max(1, int(math.log(BLOCK, fanout) + 1e-9))
    changed = leaf([(tampered or {}).get(c, F.col(c)) for c in fields])
    leaves = materialise(docs.select(F.col(order).alias("id"), F.col(group).cast("string").alias("key"), leaf([F.col(c) for c in fields]).alias("digest"),
                                     changed.alias("changed"), F.monotonically_increasing_id().alias("row")))
    rows = materialise(numbered(leaves, "key", ["id", "digest", "row"]).select("key", "pos", "n", "digest", "id", "changed"))
    up = _ascend(rows, fanout, depth)
    subroots = (up[-1] if up else rows).select(F.lit(0).alias("all"), "key", "digest")
    groups = materialise(numbered(subroots, "all", ["key"]).select(F.col("all").alias("key"), "pos", "n", "digest", F.col("key").alias("lang")))
    above = _ascend(groups, fanout, depth)
    last = (above[-1] if above else groups).select("digest").first()
    return Manifest(rows, up, [groups, *above], last[0] if last else None, fanout, depth)


def fold(m: Manifest) -> DataFrame:
    """Rows ``(id, leaf, subroot, path, proof_sha256, folded_root)``: every row's second leaf
    folded to a root with the siblings of its first; ``path`` holds those, ``left,right`` for
    each level up to the root, joined by ``;``."""
    paths = m.groups[-1].select("key", "pos", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"))
    for nodes in m.groups[-2::-1]:
        paths = _paths(nodes, paths, m.fanout, m.depth)
    paths = m.groups[0].join(paths.select("pos", "path"), "pos").select(F.col("lang").alias("key"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"))
    for nodes in m.up[-2::-1]:
        paths = _paths(nodes, paths, m.fanout, m.depth)
    to = StructType([StructField("id", m.rows.schema["id"].dataType), *(StructField(c, StringType()) for c in ("leaf", "subroot", "path", "proof_sha256", "folded_root"))])
    fanout = m.fanout

    def give(key, rows, levels, path, subroot):
        above = _steps(path)
        beside = b"".join(a + b for a, b in above)
        states = [hashlib.sha256(a) for a, _ in above]
        for i, (_, _, digest, id_, changed, _, _) in enumerate(rows):
            now, steps, at = changed.encode(), [], i
            for parents in levels:
                parent, slot = parents[at // fanout], at % fanout
                steps.append(parent.siblings(slot))
                now = parent.fold(slot, now)
                at //= fanout
            for state, (_, right) in zip(states, above):
                h = state.copy()
                h.update(now + right)
                now = h.hexdigest().encode()
            proof = H([*(x for s in steps for x in s), beside])
            yield id_, digest, subroot, ";".join(s for s in (_joined(steps), path) if s), proof.decode(), now.decode()

    return _descend(m.rows, paths, m.fanout, m.depth, give, to)


def verify(m: Manifest, id_col: str = "doc_id") -> DataFrame:
    """Rows ``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for the whole table."""
    root = F.lit(m.root).cast("string")
    return fold(m).select(F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
