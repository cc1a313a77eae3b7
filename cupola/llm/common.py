"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_worker(key: tuple, build: Callable[[], object]) -> object:
    """``build()`` once per Python worker process.

    Functions reach the workers by value, so a module global would be made anew in each
    task; the interpreter's own ``sys`` module lives as long as the worker.
    """
    store = sys.__dict__.setdefault("_cupola_llm", {})
    if key not in store:
        store[key] = build()
    return store[key]


def forget() -> None:
    """Give back what ``per_worker`` holds in this worker for operators that ran before.

    Workers outlive a query: a vocabulary and its memo would stay beside the tables of the next one."""
    if sys.__dict__.pop("_cupola_llm", None):
        import gc

        gc.collect()


def values(column, step: int = 512):
    """The values of an Arrow column one by one, taken out of it a few at a time."""
    for k in range(0, len(column), step):
        yield from column.slice(k, step).to_pylist()


def text_key(text: str | Column) -> list[Column]:
    """128 bits that stand for a text: two seeded 64-bit hashes (null reads as empty)."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(t), F.xxhash64(F.lit(7), t)]


def squeeze(df: DataFrame, text_col: str = "t") -> DataFrame:
    """``df`` with its text as zstd-compressed UTF-8 (binary ``z``, last column), for a shuffle
    that carries whole texts."""
    import pyarrow as pa

    rest = [c for c in df.columns if c != text_col]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(rest).schema)

    def run(batches):
        import zstandard

        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                z = [c.compress((t or "").encode("utf-8", "replace")) for t in part.column(len(rest)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(z, pa.binary())], [*rest, "z"])

    return df.select(*rest, text_col).mapInArrow(run, f"{kinds}, z binary")


def bounded_rows(docs: DataFrame, id_col: str, text_col: str, extra: list[str], max_rows: int, max_bytes: int) -> list:
    """At most ``max_rows`` rows and ``max_bytes`` of text, as a list on the driver.

    For fitting a classifier only. Rows are taken in the order of a hash of the id, so the
    sample is spread over the table and repeats from run to run; a text that does not fit into
    what is left of ``max_bytes`` is passed over. The ids are chosen from
    the id column alone; texts are read for the chosen rows only.
    """
    h = F.xxhash64(F.lit(11), F.col(id_col))
    chosen = [r[0] for r in docs.where(F.col(id_col).isNotNull()).select(id_col).distinct().orderBy(h, id_col).limit(max_rows).collect()]
    if not chosen:
        return []
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit("")))
    wanted = docs.where(F.col(id_col).isin(chosen)) if len(chosen) <= 50 else docs.join(
        F.broadcast(docs.sparkSession.createDataFrame([(c,) for c in chosen], docs.select(id_col).schema)), id_col, "left_semi"
    )
    sizes = wanted.select(F.col(id_col), size.alias("n"), h.alias("h")).orderBy("h", id_col, "n").limit(max_rows).collect()
    left, fits = max_bytes, []
    for r in sizes:  # a text that does not fit is passed over, later ones may
        if r["n"] <= left:
            left -= r["n"]
            fits.append((r[0], r["n"]))
    if not fits:
        return []
    # one row for each place in fits: rows equal in id and size stand for one another
    nth = F.row_number().over(Window.partitionBy(id_col, "__n").orderBy(F.xxhash64(F.col(text_col)), text_col))
    times = Counter(fits)
    small = docs.sparkSession.createDataFrame([(*k, c) for k, c in times.items()], StructType([
        StructField("__id", docs.schema[id_col].dataType), StructField("__size", IntegerType()), StructField("__times", LongType())]))
    got = (
        wanted.select(id_col, text_col, *extra, size.alias("__n")).withColumn("__nth", nth)
        .join(F.broadcast(small), (F.col(id_col) == F.col("__id")) & (F.col("__n") == F.col("__size")) & (F.col("__nth") <= F.col("__times")))  # at most max_rows
        .select(id_col, text_col, *extra).collect()
    )
    return sorted(got, key=lambda r: (r[0], r[1] or ""))
