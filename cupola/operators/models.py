"""Classifiers: logistic regression and random forest (MLlib), exact k-nearest
neighbours and AdaBoost with decision stumps (composed from DataFrame jobs),
plus scoring and the score sink.

Every model emits the same long score table ``model, id, score, label`` that
``cupola.operators.metrics`` evaluates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cupola.operators.prefix import running_totals
from cupola.session import materialise, table_path

# ---------------------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------------------

def _assemble(features: Sequence[str], scale: bool) -> list:
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True))
    return stages


# ---------------------------------------------------------------------------------------
# MLlib models
# ---------------------------------------------------------------------------------------

def complete_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows where no feature is missing (NULL or NaN)."""
    sound = F.lit(True)
    for f in features:
        sound = sound & _number(f).isNotNull()
    return df.where(sound)


def _checked(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``train`` with a double label; a missing feature value is an error that names its column."""
    bad = train.select(*[F.count_if(_number(f).isNull()).alias(f"_m{i}") for i, f in enumerate(features)]).first()
    missing = {f: bad[f"_m{i}"] for i, f in enumerate(features) if bad[f"_m{i}"]}
    if missing:
        raise ValueError(f"missing feature values (fill them, or use complete_rows): {missing}")
    return train.withColumn(label, F.col(label).cast("double"))


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, reg_param: float = 0.0,
                 elastic_net: float = 0.0, max_iter: int = 100) -> PipelineModel:
    """Standardised features + ``LogisticRegression`` (distributed L-BFGS)."""
    lr = LogisticRegression(featuresCol="_features", labelCol=label, regParam=reg_param,
                            elasticNetParam=elastic_net, maxIter=max_iter)
    return Pipeline(stages=[*_assemble(features, True), lr]).fit(_checked(train, features, label))


#: Rows up to which MLlib looks at all of them for the places where trees may split.
SPLIT_ROWS = 10_000


def _split_cuts(train: DataFrame, features: Sequence[str], n: int, n_bins: int = 32) -> list[list[float]]:
    """Per feature, quantiles of all ``n`` rows where trees may split (``<=`` goes left); between
    two of them lie ``n / (4 * n_bins)`` rows or more."""
    probs = [i / n_bins for i in range(1, n_bins + 1)]
    row = train.select(*[F.percentile_approx(F.col(f).cast("double"), probs, 10000).alias(f"_q{i}") for i, f in enumerate(features)]).first()
    cuts = [sorted(set(row[f"_q{i}"])) for i in range(len(features))]
    place = lambda f, c: F.aggregate(F.lit(np.array(c)), F.lit(0), lambda acc, x: acc + (F.col(f).cast("double") > x).cast("int"))
    held = train.select(F.posexplode(F.array(*[place(f, c) for f, c in zip(features, cuts)])).alias("f", "bin")).groupBy("f", "bin").count().collect()
    out = []
    for i, mine in enumerate(cuts):
        size = {r["bin"]: r["count"] for r in held if r["f"] == i}
        since, left, kept = 0, n, []
        for j, cut in enumerate(mine):
            since, left = since + size.get(j, 0), left - size.get(j, 0)
            if 4 * n_bins * min(since, left) >= n:
                kept.append(cut)
                since = 0
        out.append(kept or mine[-1:])
    return out


def fit_forest(train: DataFrame, features: Sequence[str], label: str, num_trees: int = 50, max_depth: int = 5,
               seed: int = 42, subsampling_rate: float = 1.0) -> PipelineModel:
    """``RandomForestClassifier`` with a fixed seed: the same forest on every run over the same
    input partitions (bagging draws per partition).

    MLlib takes the places where trees may split from a sample of some ``SPLIT_ROWS`` rows. A larger
    table's features are therefore first numbered by bins between quantiles of all rows; every
    bin holds enough rows to be in that sample, so trees may split at each of those quantiles.
    """
    rf = RandomForestClassifier(featuresCol="_raw", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                seed=seed, subsamplingRate=subsampling_rate)
    train = _checked(train, features, label)
    n = train.count()
    if n <= SPLIT_ROWS:
        return Pipeline(stages=[*_assemble(features, False), rf]).fit(train)
    splits = [[-math.inf, *np.nextafter(c, math.inf).tolist(), math.inf] for c in _split_cuts(train, features, n)]  # a bin begins above its cut
    bins, numbers = ([f"_{x}{i}" for i in range(len(splits))] for x in ("bin", "number"))
    number = Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=bins, handleInvalid="keep")
    plain = SQLTransformer(statement=f"SELECT *, {', '.join(f'{b} + 0D AS {x}' for b, x in zip(bins, numbers))} FROM __THIS__")  # not categories
    return Pipeline(stages=[number, plain, *_assemble(numbers, False), rf]).fit(train)


def forest_rows(model: PipelineModel) -> DataFrame:
    """The fitted trees as rows ``(tree, node, feature, cut, left, right, counts)``: an inner node
    sends ``feature <= cut`` to ``left`` and the rest to ``right``; a leaf has neither and holds
    its training rows per class. Read from the files of the saved model, which go to the
    session's checkpoint folder; at most ``num_trees * 2 ** (max_depth + 1)`` rows."""
    forest, names = model.stages[-1], model.stages[0].getInputCols()
    binned = isinstance(model.stages[0], Bucketizer)
    spark = SparkSession.getActiveSession()
    path = table_path(spark)
    forest.save(path)
    n = "nodeData"
    split = F.col(f"{n}.split.featureIndex")
    cut = F.get(F.col(f"{n}.split.leftCategoriesOrThreshold"), F.lit(0))
    if binned:  # the last bin that goes left ends at the cut
        ends = [F.lit(np.nextafter(x[1:-1], -math.inf)) for x in model.stages[0].getSplitsArray()]
        cut = F.get(F.get(F.array(*ends), split), F.floor(cut).cast("int"))
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{n}.id").alias("node"),
        F.when(split >= 0, F.element_at(F.array(*[F.lit(c) for c in names]), split + 1)).alias("feature"),
        F.when(split >= 0, cut).alias("cut"),
        F.when(split >= 0, F.col(f"{n}.leftChild")).alias("left"), F.when(split >= 0, F.col(f"{n}.rightChild")).alias("right"),
        F.col(f"{n}.impurityStats").alias("counts"))


def score_forest_rows(trees: DataFrame, df: DataFrame, features: Sequence[str], name: str, id_col: str, label_col: str | None = None) -> DataFrame:
    """``model, id, score, label`` from the rows of ``forest_rows``, as one expression: every
    tree walks level by level to a leaf, whose share of class 1 is its vote. The rows (a model,
    not data) become a constant of the plan; scoring is a projection without a shuffle."""
    import json

    nodes = sorted((r.tree, r.node, r.feature, r.cut, r.left, r.right, r.counts) for r in trees.collect())  # bounded by the model
    if not nodes:
        raise ValueError("no trees")
    where = {f: i for i, f in enumerate(features)}
    packed = []
    for t in sorted({r[0] for r in nodes}):
        own = [r for r in nodes if r[0] == t]
        if [r[1] for r in own] != list(range(len(own))):
            raise ValueError(f"tree {t}: nodes are not numbered from 0")
        packed.append({"f": [where[r[2]] if r[2] is not None else -1 for r in own], "c": [0.0 if r[3] is None else r[3] for r in own],
                       "l": [-1 if r[4] is None else r[4] for r in own], "r": [-1 if r[5] is None else r[5] for r in own],
                       "a": [r[6][0] / sum(r[6]) for r in own], "b": [r[6][1] / sum(r[6]) for r in own]})

    def depth(t: dict, node: int = 0) -> int:
        return 0 if t["l"][node] < 0 else 1 + max(depth(t, t["l"][node]), depth(t, t["r"][node]))

    levels = max(depth(t) for t in packed)
    kind = "array<struct<f:array<int>,c:array<double>,l:array<int>,r:array<int>,a:array<double>,b:array<double>>>"
    forest = F.from_json(F.lit(json.dumps(packed)), kind)
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])  # NaN goes right, as in the model

    def leaf(t: Column) -> Column:
        step = lambda at, _: F.when(F.get(t["l"], at) < 0, at).otherwise(
            F.when(F.get(F.col("_x"), F.get(t["f"], at)) <= F.get(t["c"], at), F.get(t["l"], at)).otherwise(F.get(t["r"], at)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), step) if levels else F.lit(0)

    at = df.select("*", x.alias("_x")).withColumn("_at", F.transform(forest, lambda t: F.struct(t.alias("t"), leaf(t).alias("n"))))
    votes = [F.aggregate(F.col("_at"), F.lit(0.0), lambda acc, v: acc + F.get(v["t"][side], v["n"])) for side in ("a", "b")]
    return at.select(F.lit(name).alias("model"), F.col(id_col).alias("id"), (votes[1] / (votes[0] + votes[1])).alias("score"),
                     (F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")).alias("label"))


def score(model: PipelineModel, df: DataFrame, name: str, id_col: str, label_col: str | None = None) -> DataFrame:
    """``model, id, score, label``: score is P(class 1). Row-wise, no shuffle."""
    out = model.transform(df)
    return out.select(F.lit(name).alias("model"), F.col(id_col).alias("id"),
                      vector_to_array(F.col("probability"))[1].alias("score"),
                      (F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")).alias("label"))


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink partitioned by model (one folder per model, prunable on read)."""
    scores.write.mode(mode).partitionBy("model").parquet(path)


# ---------------------------------------------------------------------------------------
# Exact k-nearest neighbours
# ---------------------------------------------------------------------------------------

def _sound(v: Column) -> Column:
    """The vector is there and every component is a finite number."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def knn_left_out(df: DataFrame, vec_col: str = "vec") -> int:
    """Rows that ``knn_neighbours`` leaves out on either side: the vector is NULL or holds a
    NULL, NaN or infinite component."""
    return df.where(~_sound(F.col(vec_col))).count()


def _classes(rows: DataFrame, vec: str) -> DataFrame:
    """``rows`` with ``_h1, _h2``, 128 bits that name the vector."""
    return rows.withColumns({"_h1": F.xxhash64(vec), "_h2": F.xxhash64(F.lit(7), vec)})


def _grid(sides: DataFrame, n_dims: int) -> list[list[float]]:
    """Cut points of the dimensions that order vectors in space: quantiles, up to 60 bits in all."""
    bits = max(1, min(8, 60 // max(1, n_dims)))
    probs = [i / (1 << bits) for i in range(1, 1 << bits)]
    x = F.col("x").cast("double")
    cuts = sides.select(F.posexplode("v").alias("j", "x")).where(F.col("j") < 60).groupBy("j").agg(F.percentile_approx(x, probs, 2000).alias("cuts")).collect()
    return [r["cuts"] for r in sorted(cuts, key=lambda r: r["j"])]  # a row per dimension


def _place(entries: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """``entries`` with ``z``: the bits of their cells in all dimensions, interleaved, so that
    near vectors mostly have near numbers."""
    import pyarrow as pa

    names = entries.columns
    bits = (len(cuts[0]) if cuts else 1).bit_length()

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            v = batch.column(names.index("v")).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))
            z = np.zeros(n, np.int64)
            cells = [np.searchsorted(np.asarray(c), v[:, j], "right") for j, c in enumerate(cuts) if j < v.shape[1]]
            for b in range(bits - 1, -1, -1):
                for cell in cells:
                    z = (z << 1) | ((cell >> b) & 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(z)], [*names, "z"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema)
    return entries.mapInArrow(run, f"{kind}, z long")


def _blocks(entries: DataFrame, n_blocks: int, block_rows: int, dim: int, approximate: bool) -> DataFrame:
    """One row per block of ``entries(v, z, names...)`` that are neighbours in space: ``n``, the box
    (``lo``, ``hi``), the names, and the vectors.

    Approximate vectors are one byte per component, the nearest of 256 values that divide the
    block's own distinct values evenly (``book``), with the distance of each from what the bytes say (``off``).
    """
    import pyarrow as pa

    ids = [c for c in entries.columns if c not in ("v", "z")]
    schema = pa.schema([("n", pa.int32()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                        *[(c, pa.binary()) for c in ids], ("x", pa.binary()), ("off", pa.binary()), ("book", pa.binary())])

    def values(x):
        x = np.unique(x)
        return x[np.linspace(0, len(x) - 1, 256).round().astype(int)] if len(x) > 256 else np.append(x, np.full(256 - len(x), x[-1]))

    def pack(table):
        n = table.num_rows
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        if v.shape[1] != dim:
            raise ValueError("vectors of different lengths")
        lo, hi, off, book, x = v.min(0), v.max(0), np.zeros(0), np.zeros(0), v
        if approximate:
            book = np.stack([values(v[:, j]) for j in range(dim)], 1)
            between = book[1:] / 2 + book[:-1] / 2
            x = np.stack([np.searchsorted(between[:, j], v[:, j]) for j in range(dim)], 1).astype(np.uint8)
            off = np.sqrt(((v - book[x, np.arange(dim)]) ** 2).sum(1))
        names = [[table.column(c).to_numpy().tobytes()] for c in ids]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([[n], [lo], [hi], *names, [x.tobytes()], [off.tobytes()], [book.tobytes()]], schema.types)], schema=schema)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            while rows >= block_rows:
                table = pa.Table.from_batches(held)
                yield pack(table.slice(0, block_rows))
                held, rows = table.slice(block_rows).to_batches(), rows - block_rows
        if rows:
            yield pack(pa.Table.from_batches(held))

    dealt = entries.withColumn("v", F.transform("v", lambda x: x.cast("double"))).repartitionByRange(n_blocks, "z", *ids).sortWithinPartitions("z", *ids)
    kind = f"n int, lo array<double>, hi array<double>, {', '.join(f'{c} binary' for c in ids)}, x binary, off binary, book binary"
    return dealt.mapInArrow(run, kind)


def _routes(asking: DataFrame, offered: DataFrame, k: int) -> DataFrame:
    """``(g, c, least)``: the blocks ``c`` that may hold one of the ``k`` nearest of a vector of the
    block ``g``, with the distance of their boxes.

    A block of ``k`` rows and more, all of them no further than the far corners of both boxes,
    rules out every block whose box lies beyond. Only boxes are compared here, a pair per two blocks.
    """
    pairs = asking.select("g", F.col("lo").alias("glo"), F.col("hi").alias("ghi")).crossJoin(offered.select("c", F.col("n").alias("m"), "lo", "hi"))
    near = F.zip_with(F.zip_with("lo", "ghi", lambda a, b: a - b), F.zip_with("glo", "hi", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    far = F.zip_with(F.zip_with("hi", "glo", lambda a, b: a - b), F.zip_with("ghi", "lo", lambda a, b: a - b), lambda a, b: F.greatest(a, b))
    length = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, y: acc + y * y))
    pairs = pairs.select("g", "c", "m", (length(near) * (1 - 1e-9)).alias("least"), (length(far) * (1 + 1e-9)).alias("most"))
    bound = pairs.where(F.col("m") >= k).groupBy("g").agg(F.min("most").alias("bound"))
    return pairs.join(bound, "g", "left").where(F.col("bound").isNull() | ~(F.col("least") > F.col("bound"))).select("g", "c", "least")


def _nearest(hits: tuple, k: int) -> tuple:
    """Of ``(row, high)`` the ``k`` least of every row, as ``(rows, table)``."""
    row, high = hits
    order = np.lexsort((high, row))
    row, high = row[order], high[order]
    rows, first, size = np.unique(row, return_index=True, return_counts=True)
    place = np.arange(len(row)) - np.repeat(first, size)
    out = np.full((len(rows), k), np.inf)
    keep = place < k
    out[np.repeat(np.arange(len(rows)), size)[keep], place[keep]] = high[keep]
    return rows, out


class _Search:
    """The ``k`` nearest of a block of query vectors among blocks of approximations that come one
    after another; what is kept are bounds and the names of survivors."""

    def __init__(self, q: np.ndarray, k: int, block_cells: int):
        self.q, self.k, self.cells = q, k, block_cells
        self.reach = np.abs(q).max(1)
        self.top = np.full((len(q), k), np.inf)  # least upper bounds
        self.found: list[tuple] = []  # (query, name, lower bound, upper bound)
        self.size = self.limit = 0

    def add(self, names, lo, hi, codes, off, book):
        middle = book[len(book) // 2]
        x = book[codes, np.arange(len(lo))] - middle
        box = np.maximum(np.maximum(lo - self.q, self.q - hi), 0.0)
        active = np.flatnonzero(~(np.sqrt((box * box).sum(1)) * (1 - 1e-9) > self.top[:, -1]))
        ends = max(np.abs(lo).max(), np.abs(hi).max())
        # the few vectors far from what their bytes say have a width of their own, so the others stay narrow
        tight = off <= 2 * np.sort(off)[int(0.98 * len(off))]
        self.sift(np.flatnonzero(tight), active, names, x, middle, off, ends, len(lo) > 16)
        self.sift(np.flatnonzero(~tight), active, names, x, middle, off, ends, False)

    def sift(self, cols, active, names, x, middle, off, ends, short):
        """The active queries meet the vectors ``cols`` in one product, in short numbers where these
        are precise enough; only pairs that its bounds leave are looked at one by one."""
        if not len(cols):
            return
        t, xx = x[cols], (x[cols] ** 2).sum(1)
        far, widest = np.sqrt(xx.max()), off[cols].max()
        kind = np.float32 if short and far < 1e15 and far < 4 * np.sqrt(np.median(xx)) else np.float64
        eps = (x.shape[1] + 8) * (1.2e-7 if kind is np.float32 else 3e-16)
        # |q - x|^2 - |q|^2 in one product
        t = np.vstack([-2.0 * t.T, xx]).astype(kind)
        step = max(1, self.cells // len(cols))
        for s in range(0, len(active), step):
            rows = active[s : s + step]
            q = self.q[rows] - middle
            qq = (q * q).sum(1)
            slack = eps * (np.sqrt(qq) + far) ** 2
            blur = widest + self.blur(rows, ends)
            part = np.hstack([q, np.ones((len(rows), 1))]).astype(kind) @ t

            def within(bound):
                with np.errstate(over="ignore"):
                    edge = ((bound + blur) ** 2 - qq + slack).astype(kind)
                return ~(part > np.nextafter(edge, kind(np.inf))[:, None])

            bound = self.top[rows, -1]
            mask = within(bound)
            if len(cols) >= self.k and np.count_nonzero(mask) > 8 * self.k * len(rows):
                # the k-th least in this block is a bound too
                kth = np.partition(part, self.k - 1, axis=1)[:, self.k - 1].astype(float)
                mine = (np.sqrt(np.maximum(kth + qq + slack, 0.0)) + blur) * (1 + 1e-9)
                mask &= within(np.fmin(bound, np.where(np.isnan(mine), np.inf, mine)))
            r, c = np.divmod(np.flatnonzero(mask), len(cols))
            for z in range(0, len(r), 1 << 16):
                self.meet(rows[r[z : z + (1 << 16)]], cols[c[z : z + (1 << 16)]], names, x, middle, off, ends)

    def blur(self, rows, ends):
        """What rounding may add to the distance of a vector from a cell."""
        return 1e-15 * len(self.q[0]) ** 0.5 * (self.reach[rows] + ends)

    def meet(self, row, c, names, x, middle, off, ends):
        d = np.sqrt((((self.q[row] - middle) - x[c]) ** 2).sum(1))
        off = off[c] + self.blur(row, ends)
        low, high = np.maximum(d - off, 0.0) * (1 - 1e-9), (d + off) * (1 + 1e-9)
        high = np.where(np.isnan(high), np.inf, high)
        mine, best = _nearest((row, high), self.k)
        self.top[mine] = np.partition(np.hstack([self.top[mine], best]), self.k - 1, axis=1)[:, : self.k]
        self.top[mine] = np.sort(self.top[mine], axis=1)
        left = ~(low > self.top[row, -1])
        self.found.append((row[left], names[c[left]], low[left], high[left]))
        self.size += int(left.sum())
        if self.size > max(1 << 20, 2 * self.limit):
            self.limit = len(self.survivors()[0])

    def survivors(self) -> tuple:
        row, name, low, high = (np.concatenate(x) for x in zip(*self.found)) if self.found else [np.zeros(0, t) for t in (np.int64, np.int64, float, float)]
        left = ~(low > self.top[row, -1])
        self.found = [(row[left], name[left], low[left], high[left])]
        self.size = len(self.found[0][0])
        return self.found[0]


def _survivors(cells: DataFrame, k: int, dim: int, block_cells: int) -> DataFrame:
    """Rows ``(h1, h2, q, t, low, high)``: a query's name and vector, and the training vectors that
    its ``k`` least upper bounds leave, from rows sorted by query block ``g`` and part ``s``: the
    query block itself, then its training blocks, the nearest first. One training block is held at a time."""
    import pyarrow as pa

    schema = pa.schema([("_h1", pa.int64()), ("_h2", pa.int64()), ("qv", pa.list_(pa.float64())), ("t", pa.list_(pa.int64())),
                        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])

    def result(search, h1, h2):
        row, name, low, high = search.survivors()
        order = np.argsort(row, kind="stable")
        row, values = row[order], [name[order], low[order], high[order]]
        some, first = np.unique(row, return_index=True)
        for s in range(0, len(some), 1024):
            mine, ends = some[s : s + 1024], np.append(first, len(row))[s : s + 1025]
            at = pa.array(ends - ends[0], pa.int32())
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(mine) + 1) * dim, pa.int32()), pa.array(search.q[mine].ravel()))
            lists = [pa.ListArray.from_arrays(at, pa.array(x[ends[0] : ends[-1]])) for x in values]
            yield pa.RecordBatch.from_arrays([pa.array(h1[mine]), pa.array(h2[mine]), vectors, *lists], schema=schema)

    def run(batches):
        search = h1 = h2 = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["c"] is None:
                    if search is not None:
                        yield from result(search, h1, h2)
                    h1, h2 = (np.frombuffer(row[x], np.int64) for x in ("_h1", "_h2"))
                    search = _Search(np.frombuffer(row["x"]).reshape(-1, dim), k, block_cells)
                else:
                    search.add(np.frombuffer(row["e"], np.int64), np.array(row["lo"]), np.array(row["hi"]),
                               np.frombuffer(row["x"], np.uint8).reshape(-1, dim), np.frombuffer(row["off"]), np.frombuffer(row["book"]).reshape(-1, dim))
        if search is not None:
            yield from result(search, h1, h2)

    return cells.mapInArrow(run, "_h1 long, _h2 long, qv array<double>, t array<long>, low array<double>, high array<double>")


def knn_neighbours(
    train: DataFrame,
    query: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "vec",
    label_col: str = "label",
    exclude_self: bool = False,
    max_train_rows: int | None = None,
    block_rows: int = 4096,
    block_cells: int = 4_000_000,
) -> DataFrame:
    """The exact ``k`` nearest training rows of every query row:
    ``qid, tid, tlabel, dist2, rank, fetched`` (ties broken by training id).

    A vector-approximation file over blocks in space. Vectors are ordered by the interleaved bits of
    their quantile cells and cut into blocks of at most ``block_rows``; a training vector is one byte
    per component, the nearest of 256 values that divide those of its own block evenly, and its
    distance from the vector that the bytes say. So cells are fine where vectors are dense, and a long
    tail costs little. The distance of a query from that vector, less and plus the offset, bounds
    the distance of two vectors. A block of queries meets the training blocks whose boxes may hold a
    neighbour, the nearest first and one at a time; a training vector survives unless its lower
    bound is above the query's k-th least upper bound. Full vectors are joined to the survivors
    only (``fetched`` is how many a query had), and the exact distances decide: sums of squares
    in doubles, left to right.

    Each training block is copied once per block of queries that its box concerns, whatever the
    session's settings, and only survivors are written.
    Equal vectors are one entry with the ``k + 1`` smallest ids, which are all that a result can
    hold; so many copies of a vector do not multiply. A caller that wants an error for a large
    training side sets ``max_train_rows``; there is no bound otherwise. Rows whose vector is
    missing or holds a NULL, NaN or infinite component take no part (``knn_left_out``).
    """
    keep = k + 1 if exclude_self else k
    t = train.select(F.col(id_col).alias("tid"), F.col(vec_col).alias("v"), F.col(label_col).alias("tlabel")).where(_sound(F.col("v")))
    if max_train_rows is not None and t.count() > max_train_rows:
        raise ValueError(f"more than max_train_rows={max_train_rows} labelled training rows: sample them first")
    nth = F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy("tid", "tlabel"))
    entries = materialise(
        _classes(t, "v").withColumn("_n", nth).where(F.col("_n") <= keep)  # limited before the shuffle
        .groupBy("_h1", "_h2").agg(F.first("v").alias("v"), F.collect_list(F.struct("tid", "tlabel")).alias("rows"))
        .select(F.monotonically_increasing_id().alias("e"), "v", "rows"))
    q = query.select(F.col(id_col).alias("qid"), F.col(vec_col).alias("v")).where(_sound(F.col("v")))
    q = materialise(_classes(q, "v"))
    asked = materialise(q.groupBy("_h1", "_h2").agg(F.first("v").alias("v")))

    sides = entries.select("v", F.lit(0).alias("s")).unionByName(asked.select("v", F.lit(1).alias("s")))
    sizes = {r["s"]: r for r in sides.groupBy("s").agg(F.count("v").alias("n"), F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).collect()}
    dims = {r[end] for r in sizes.values() for end in ("least", "most")}
    if len(dims) > 1:
        raise ValueError("vectors of different lengths")
    dim = max(dims, default=1)
    cuts = _grid(sides, dim)

    def blocks(side, s, name, approximate):
        n = sizes[s]["n"] if s in sizes else 0
        rows = min(block_rows, max(256, math.ceil(n / 64)))
        return materialise(_blocks(_place(side, cuts), max(1, math.ceil(n / rows / 4)), rows, dim, approximate).withColumn(name, F.monotonically_increasing_id()))

    offered = blocks(entries.select("v", "e"), 0, "c", True)
    asking = blocks(asked, 1, "g", False)
    n_c, n_g = offered.count(), max(1, asking.count())
    parts = max(1, min(math.ceil(64 / n_g), math.ceil(n_c / 16)))  # of the training blocks, for few queries
    route = _routes(asking, offered, keep).withColumn("s", F.pmod(F.xxhash64("c"), F.lit(parts)).cast("int"))
    tasks = min(n_g * parts, max(4096, int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    none = F.lit(None).cast("binary")
    cells = (asking.select("g", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("s"), F.lit(-1.0).alias("least"), F.lit(None).cast("long").alias("c"),
                           "lo", "hi", "_h1", "_h2", none.alias("e"), "x", "off", "book")
             .unionByName(route.join(offered, "c").select("g", "s", "least", "c", "lo", "hi", none.alias("_h1"), none.alias("_h2"), "e", "x", "off", "book"))
             .repartition(tasks, "g", "s").sortWithinPartitions("g", "s", "least", "c"))
    found = _survivors(cells, keep, dim, block_cells)
    if parts == 1:
        left = materialise(found.drop("low", "high")).select("_h1", "_h2", "qv", F.size("t").alias("fetched"), F.explode("t").alias("t"))
    else:
        by_query = Window.partitionBy("_h1", "_h2")
        bound = F.max(F.when(F.col("_r") <= keep, F.col("high"))).over(by_query)
        pairs = materialise(found).select("_h1", "_h2", "qv", F.inline(F.arrays_zip("t", "low", "high")))
        left = (pairs.withColumn("_r", F.row_number().over(by_query.orderBy("high"))).withColumn("_bound", bound)
                .where(~(F.col("low") > F.col("_bound"))).select("_h1", "_h2", "qv", "t", F.count(F.lit(1)).over(by_query).alias("fetched")))

    apart = F.zip_with("qv", "v", lambda a, b: (a - b.cast("double")) * (a - b.cast("double")))
    exact = (left.join(entries.select(F.col("e").alias("t"), "v", "rows"), "t")
             .select("_h1", "_h2", "fetched", "rows", F.aggregate(apart, F.lit(0.0), lambda acc, x: acc + x).alias("dist2"))
             .select("_h1", "_h2", "fetched", "dist2", F.inline("rows")))
    first = F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy("dist2", "tid"))
    best = exact.withColumn("_r", first).where(F.col("_r") <= keep).drop("_r")
    # query rows with one id are queries of their own
    queries = q.withColumn("_qn", F.row_number().over(Window.partitionBy("qid").orderBy("_h1", "_h2"))).select("qid", "_qn", "_h1", "_h2")
    found = queries.join(best, ["_h1", "_h2"])
    if exclude_self:
        found = found.where(~F.col("qid").eqNullSafe(F.col("tid")))
    rank = F.row_number().over(Window.partitionBy("qid", "_qn").orderBy("dist2", "tid"))
    spread = found.repartition(int(q.sparkSession.conf.get("spark.sql.shuffle.partitions")), "qid", "_qn")
    return spread.withColumn("rank", rank).where(F.col("rank") <= k).select("qid", "tid", "tlabel", "dist2", "rank", "fetched")


def knn_vote(neighbours: DataFrame) -> DataFrame:
    """Majority label per query (ties: smallest label): ``qid, pred_label, votes``."""
    votes = neighbours.groupBy("qid", "tlabel").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("qid").orderBy(F.desc("votes"), F.asc("tlabel"))
    return (votes.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("qid", F.col("tlabel").alias("pred_label"), "votes"))


def knn_score(neighbours: DataFrame, positive=1) -> DataFrame:
    """Share of positive neighbours per query: ``qid, score``."""
    return neighbours.groupBy("qid").agg(F.avg((F.col("tlabel") == F.lit(positive)).cast("double")).alias("score"))


def features_to_vector(df: DataFrame, features: Sequence[str], col: str = "vec", standardise: bool = True) -> DataFrame:
    """Numeric columns -> one array column (z-scored with one aggregate of means and deviations)."""
    if not standardise:
        return df.withColumn(col, F.array(*[F.col(c).cast("double") for c in features]))
    stats = df.select(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                      *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    parts = []
    for i, c in enumerate(features):
        mu, sd = stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 0.0
        parts.append((F.col(c).cast("double") - F.lit(mu)) / F.lit(sd if sd > 0 else 1.0))
    return df.withColumn(col, F.array(*parts))


# ---------------------------------------------------------------------------------------
# AdaBoost with decision stumps
# ---------------------------------------------------------------------------------------

def stump_search(df: DataFrame, features: Sequence[str], label: str, weight: Column | None = None,
                 n_buckets: int | None = None) -> DataFrame:
    """Best decision stump over the distinct values of each feature.

    A stump ``(feature, threshold, polarity)`` predicts ``polarity`` when
    ``x <= threshold`` and ``-polarity`` otherwise (also for missing ``x``).
    Weighted error = misclassified weight / total weight. Weighted class sums per
    (feature, value) come from one grouped aggregate; the running sums over the
    values of a feature use the two-level prefix sum over value ranges (one per
    shuffle partition by default), so a feature with many distinct values is not
    ordered in one task. The winner
    is the smallest error, then feature name, threshold and polarity +1 first.
    ``n_buckets=0`` says that every feature has few distinct values (a binned table): they
    are ordered in one window per feature, without range pieces. Missing is NULL or NaN.
    Returns one row: ``feature, threshold, polarity, error``.
    """
    w = (weight if weight is not None else F.lit(1.0)).cast("double")
    y = F.col(label).cast("int")
    base = df.select(w.alias("_w"), y.alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), _number(f).alias("_x")) for f in features])))
    base = base.withColumns({"_wp": F.when(F.col("_y") == 1, F.col("_w")).otherwise(F.lit(0.0)),
                             "_wn": F.when(F.col("_y") == 1, F.lit(0.0)).otherwise(F.col("_w"))})
    tot = base.groupBy("feature").agg(F.sum("_wp").alias("_P"), F.sum("_wn").alias("_N"))
    g = base.where(F.col("_x").isNotNull()).groupBy("feature", "_x").agg(F.sum("_wp").alias("_gp"),
                                                                          F.sum("_wn").alias("_gn"))
    if n_buckets == 0:
        upto = Window.partitionBy("feature").orderBy("_x")
        c = g.select("feature", "_x", F.sum("_gp").over(upto).alias("_pos_le"), F.sum("_gn").over(upto).alias("_neg_le"))
        return _least_error(c, tot)
    # value ranges: Spark's range partitioning of (feature, value) cuts the distinct values
    # into n pieces of about equal size; the range index is written once (a table) so
    # that every later read sees the same buckets
    n = n_buckets or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    g = materialise(g.repartitionByRange(n, "feature", "_x").withColumn("_vb", F.spark_partition_id()))
    c = running_totals(g, ["feature"], [F.col("_x")], F.col("_vb"),
                       {"_pos_le": F.col("_gp"), "_neg_le": F.col("_gn")}, inclusive=True).drop("_vb")
    return _least_error(c, tot)


def _number(c: str) -> Column:
    """The column as a double, NaN as NULL."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _least_error(c: DataFrame, tot: DataFrame) -> DataFrame:
    c = c.join(F.broadcast(tot), "feature")  # one row per feature
    total = F.col("_P") + F.col("_N")
    err_plus = (F.col("_neg_le") + (F.col("_P") - F.col("_pos_le"))) / total
    err_minus = (F.col("_pos_le") + (F.col("_N") - F.col("_neg_le"))) / total
    cands = c.select("feature", F.col("_x").alias("threshold"), F.inline(F.array(
        F.struct(F.lit(1).alias("polarity"), err_plus.alias("error")),
        F.struct(F.lit(-1).alias("polarity"), err_minus.alias("error")))))
    return cands.orderBy("error", "feature", "threshold", F.desc("polarity")).limit(1)


@dataclass
class AdaBoostModel:
    features: list[str]
    stumps: list[dict] = field(default_factory=list)  # feature, threshold, polarity, alpha, error

    def margin(self) -> Column:
        """``sum_j alpha_j * h_j(x)`` as one expression (h in {-1, +1})."""
        f = F.lit(0.0)
        for s in self.stumps:
            le = F.coalesce(_number(s["feature"]) <= F.lit(s["threshold"]), F.lit(False))
            h = F.when(le, F.lit(float(s["polarity"]))).otherwise(F.lit(-float(s["polarity"])))
            f = f + F.lit(s["alpha"]) * h
        return f

    def score(self) -> Column:
        """P(class 1) on the logistic link of the margin."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def quantile_bins(df: DataFrame, features: Sequence[str], n_bins: int = 32, accuracy: int = 10000) -> DataFrame:
    """Replace each feature by the largest approximate-quantile cut at or above it (its
    bin's upper edge; values past the last cut keep the feature maximum), so stumps
    on the binned column are stumps on the raw value. Cuts from one aggregate."""
    probs = [i / n_bins for i in range(1, n_bins)] + [1.0]
    row = df.select(*[F.percentile_approx(_number(f), probs, accuracy).alias(f"_q{i}")
                      for i, f in enumerate(features)]).first()
    cols = {}
    for i, f in enumerate(features):
        cuts = sorted({float(x) for x in (row[f"_q{i}"] or [])})
        if not cuts:
            continue
        x = _number(f)
        expr = F.when(x.isNull(), F.lit(None).cast("double"))
        for cut in cuts[:-1]:
            expr = expr.when(x <= F.lit(cut), F.lit(cut))
        cols[f] = expr.otherwise(F.greatest(x, F.lit(cuts[-1])))
    return df.withColumns(cols)


def adaboost_fit(df: DataFrame, features: Sequence[str], label: str, rounds: int = 20, n_bins: int = 32,
                 checkpoint: bool = True, fold_every: int = 50) -> AdaBoostModel:
    """Discrete AdaBoost with stumps; each round is one ``stump_search`` over binned features.

    The binned training table is cut from its lineage once (``materialise``);
    no column is added per round: the weight of a row is a closed form of the
    ensemble so far, ``exp(-0.5 * y * margin)`` with ``alpha = ln((1-e)/e)``, so
    each round is a projection of the same table plus ``stump_search``. Every
    ``fold_every`` rounds the margin so far is written into the table (one
    ``materialise``), so the weight expression never holds more than ``fold_every``
    stumps. Stops early when the best stump is no better than chance or perfect.
    """
    feats = list(features)
    base = quantile_bins(df.select(*feats, label), feats, n_bins).withColumn("_m0", F.lit(0.0))
    if checkpoint:
        base = materialise(base)
    model = AdaBoostModel(feats)
    y = F.col(label).cast("double") * F.lit(2.0) - F.lit(1.0)
    folded = 0  # stumps already summed into _m0
    for _ in range(rounds):
        if fold_every and len(model.stumps) - folded >= fold_every:
            recent = AdaBoostModel(feats, model.stumps[folded:])
            base = base.withColumn("_m0", F.col("_m0") + recent.margin())
            base = materialise(base) if checkpoint else base
            folded = len(model.stumps)
        margin = F.col("_m0") + AdaBoostModel(feats, model.stumps[folded:]).margin()
        w = F.exp(F.lit(-0.5) * y * margin)
        best = stump_search(base, feats, label, w, n_buckets=0).first()
        if best is None or best["error"] is None:
            break
        e = float(best["error"])
        if e >= 0.5:
            break
        e_c = min(max(e, 1e-10), 1 - 1e-10)
        model.stumps.append({"feature": best["feature"], "threshold": float(best["threshold"]),
                             "polarity": int(best["polarity"]), "alpha": math.log((1 - e_c) / e_c), "error": e})
        if e <= 0.0:
            break
    return model


def adaboost_fit_whole(df: DataFrame, features: Sequence[str], label: str, rounds: int = 20, unit: int = 1 << 20) -> AdaBoostModel:
    """Discrete AdaBoost on a binned table in whole numbers, so that every engine fits the same stumps.

    ``features`` are whole-number columns of few values (bins). Rows equal in all of them and in the
    label are one cell, with weight ``rows * unit``. A round takes the stump of least wrong weight
    E of the total W (ties: feature name, threshold, polarity +1 first), then multiplies right
    cells by ``W / 2(W - E)`` and wrong ones by ``W / 2E``, rounded down. One aggregate a round, to
    a row per bin, and one rewrite of the cells; a row a round reaches the driver. Ends early
    when no stump is right on more than half the weight, or one is right on all. Rows with a
    missing feature or label are left out. Weights are held in 64 bits: ``rows * unit`` must fit.
    """
    feats = list(features)
    known = F.col(label).isNotNull()
    for f in feats:
        known = known & F.col(f).isNotNull()
    cells = df.where(known).groupBy(*[F.col(f).cast("bigint").alias(f) for f in feats], (F.col(label).cast("int") == 1).alias("_y")) \
        .agg((F.count(F.lit(1)) * F.lit(unit)).alias("_w"))
    model = AdaBoostModel(feats)
    for _ in range(rounds):
        cells = materialise(cells)
        each = cells.select("_y", "_w", F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("threshold")) for f in feats])))
        bins = each.groupBy("feature", "threshold").agg(F.sum(F.when(F.col("_y"), F.col("_w")).otherwise(0)).alias("p"),
                                                        F.sum(F.when(F.col("_y"), F.lit(0)).otherwise(F.col("_w"))).alias("n"))
        upto, whole = Window.partitionBy("feature").orderBy("threshold"), Window.partitionBy("feature")  # bins of a feature
        bins = bins.select("feature", "threshold", (F.sum("n").over(upto) + F.sum("p").over(whole) - F.sum("p").over(upto)).alias("plus"),
                           (F.sum("p").over(whole) + F.sum("n").over(whole)).alias("total"))
        best = bins.select("feature", "threshold", "total", F.inline(F.array(
            F.struct(F.lit(1).alias("polarity"), F.col("plus").alias("wrong")), F.struct(F.lit(-1).alias("polarity"), (F.col("total") - F.col("plus")).alias("wrong"))))) \
            .orderBy("wrong", "feature", "threshold", F.desc("polarity")).first()
        if best is None or 2 * best["wrong"] >= best["total"]:
            break
        e, w = best["wrong"], best["total"]
        model.stumps.append({"feature": best["feature"], "threshold": float(best["threshold"]), "polarity": best["polarity"],
                             "alpha": math.log((w - e) / max(e, w * 1e-10)), "error": e / w, "wrong": e, "total": w})
        if not e:
            break
        says_one = (F.col(best["feature"]) <= best["threshold"]) == F.lit(best["polarity"] == 1)
        share = F.when(says_one == F.col("_y"), F.lit(2 * (w - e))).otherwise(F.lit(2 * e)).cast("decimal(20,0)")
        scaled = F.col("_w").cast("decimal(19,0)") * F.lit(w).cast("decimal(19,0)")
        cells = cells.withColumn("_w", F.call_function("div", scaled, share).cast("bigint"))
    return model


def adaboost_scores(model: AdaBoostModel, df: DataFrame, name: str, id_col: str, label_col: str) -> DataFrame:
    return df.select(F.lit(name).alias("model"), F.col(id_col).alias("id"), model.score().alias("score"),
                     F.col(label_col).cast("int").alias("label"))
