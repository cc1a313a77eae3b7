"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks of bytes that cover it whole. Every position of a
chunk passes through learned filters (a table per filter width and byte value), plus a plane
that tells whether the bytes just before repeat at a short distance (words said over and
over look like any other bytes to a short filter). ReLU, maximum over the positions of a
chunk, maximum over the chunks, and one logistic unit give the probability.

The network is fitted on the driver on a bounded sample of labelled rows (``max_rows``,
``max_bytes``); scoring is one map over the table. Labels and ids choose the training rows
and are never inputs of a score.

Edge cases: null text scores as empty; an empty text has no position, so only the bias
speaks; texts of any length are scored whole, block by block; rows are scored one by one
(repeated rows get equal scores, null ids and extra columns do not matter); with no usable
label of one class, the score is the share of label 1 in the sample (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, forget

WIDTH, FILTERS = 5, 16
CHUNK, OVERLAP = 4096, 64
#: Distances at which a repetition is looked for, and over how many bytes.
LAGS, SPAN = range(2, 25), 32
#: Weight of that plane against the filters when the fit starts.
REPEAT_SCALE = 4.0
#: Rows of a batch scored before results go back.
ROWS_OUT = 512


def repeats(x: np.ndarray) -> np.ndarray:
    """For each byte, the largest share of the last SPAN bytes that equal those one lag before."""
    best = np.zeros(len(x), np.int16)
    for lag in LAGS:
        if len(x) <= lag + SPAN:
            break
        run = np.cumsum(x[lag:] == x[:-lag], dtype=np.int16)
        np.maximum(best[lag + SPAN :], run[SPAN:] - run[:-SPAN], out=best[lag + SPAN :])
    return best.astype(np.float32) / SPAN


class Network:
    """Filters, pooled over positions, and a logistic unit over the pooled values."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.2, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.2, FILTERS + 1).astype(np.float32)
        self.out_bias = np.float32(0)
        self.pairs = None

    def prepare(self) -> None:
        """Sum the tables of neighbouring positions by byte pair: fewer lookups when scoring."""
        t = self.table
        self.pairs = [(t[w][:, None] + t[w + 1][None]).reshape(65536, FILTERS) for w in (0, 2)]

    def chunk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pooled values of one chunk and the positions they come from."""
        n = len(x) - WIDTH + 1
        if n <= 0:
            return np.zeros(FILTERS, np.float32), np.full(FILTERS, -1)
        if self.pairs is None:
            act = self.table[0][x[:n]]
            for w in range(1, WIDTH):
                act += self.table[w][x[w : w + n]]
        else:
            two = (x[:-1].astype(np.uint16) << 8) | x[1:]
            act = self.pairs[0][two[:n]]
            act += self.pairs[1][two[2 : 2 + n]]
            act += self.table[4][x[4 : 4 + n]]
        where = act.argmax(0)
        return act[where, np.arange(FILTERS)] + self.bias, where

    def pooled(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(data, np.uint8)
        best, where, rep = np.zeros(FILTERS, np.float32), np.full(FILTERS, -1), 0.0
        for a in range(0, max(1, len(x) - OVERLAP), CHUNK - OVERLAP):
            part = x[a : a + CHUNK]
            top, at = self.chunk(part)
            better = top > best
            best[better], where[better] = top[better], at[better] + a
            r = repeats(part)
            rep = max(rep, float(r.max()) if len(r) else 0.0)
        return np.append(best, np.float32(REPEAT_SCALE * rep)), where

    def score(self, data: bytes) -> float:
        return sigmoid(float(self.pooled(data)[0] @ self.out + self.out_bias))

    def fit(self, rows: list[tuple[bytes, int]], epochs: int, rate: float = 0.05, seed: int = 3) -> None:
        """Adagrad on the log-loss, classes weighted equally; gradients pass through the maxima."""
        rng = np.random.default_rng(seed)
        share = sum(y for _, y in rows) / len(rows)
        weight = {1: 0.5 / share, 0: 0.5 / (1 - share)}
        g_table, g_bias, g_out = (np.full_like(v, 1e-3) for v in (self.table, self.bias, self.out))
        g_ob = 1e-3
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                data, y = rows[i]
                best, where = self.pooled(data)
                err = np.float32((sigmoid(float(best @ self.out + self.out_bias)) - y) * weight[y])
                if abs(err) < 1e-3:
                    continue
                back = err * self.out[:FILTERS]
                d_out = err * best + 1e-4 * self.out
                g_out += d_out**2
                self.out -= rate * d_out / np.sqrt(g_out)
                g_ob += err**2
                self.out_bias -= np.float32(rate * err / np.sqrt(g_ob))
                on = np.flatnonzero(where >= 0)
                g_bias[on] += back[on] ** 2
                self.bias[on] -= rate * back[on] / np.sqrt(g_bias[on])
                x = np.frombuffer(data, np.uint8)
                for w in range(WIDTH):
                    at = (w, x[where[on] + w], on)
                    g_table[at] += back[on] ** 2
                    self.table[at] -= rate * back[on] / np.sqrt(g_table[at])


class Constant:
    """Stands in for the network where there is nothing to learn from."""

    def __init__(self, share: float):
        self.share = share

    def prepare(self) -> None:
        pass

    def score(self, data: bytes) -> float:
        return self.share


def sigmoid(m: float) -> float:
    return float(1 / (1 + np.exp(-min(30.0, max(-30.0, m)))))


def is_held_out(id_col: str | Column = "doc_id") -> Column:
    """Rows kept out of the fit: crc32 of the id as text leaves remainder 1 modulo 3."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = 1500, max_bytes: int = 8 << 20, epochs: int = 10) -> Network | Constant:
    """The network of a bounded sample: labelled rows outside the held-out fold, spread by a
    hash of the id, at most ``max_rows`` of each label and half of ``max_bytes`` of text each."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(id_col))
    rows: list[tuple[bytes, int]] = []
    texts = docs.select(id_col, text_col)
    for y in (0, 1):
        h = F.xxhash64(F.lit(11), F.col(id_col))
        ids = known.where(F.col(label_col) == y).select(id_col).distinct().orderBy(h, id_col).limit(max_rows)
        chosen = texts.join(F.broadcast(ids), id_col, "left_semi")  # at most max_rows ids
        rows += [((r[1] or "").encode("utf-8", "replace"), y) for r in bounded_rows(chosen, id_col, text_col, [], max_rows, max_bytes // 2)]
    ones = sum(y for _, y in rows)
    if not 0 < ones < len(rows):
        return Constant(ones / len(rows) if rows else 0.5)
    net = Network()
    net.fit(rows, epochs)
    return net


def scorer(net: Network | Constant, at: int, names: list[str], keep_from: float | None):
    """Arrow map: append ``score`` to each row, or keep the rows scoring ``keep_from`` at least."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        net.prepare()
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(k, ROWS_OUT)
                score = [net.score((t or "").encode("utf-8", "replace")) for t in part.column(at).to_pylist()]
                if keep_from is None:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score, pa.float64())], [*names, "score"])
                else:
                    yield part.filter(pa.array([s >= keep_from for s in score]))

    return run


def score(docs: DataFrame, net: Network | Constant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, held_out, score, predicted)``, one per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("row_text"))
    kind = src.schema[0].dataType.simpleString()
    got = src.mapInArrow(scorer(net, 1, ["row_id", "row_text"], None), f"row_id {kind}, row_text string, score double")
    return got.select(
        F.col("row_id").alias(id_col),
        is_held_out("row_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, net: Network | Constant, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more."""
    return docs.mapInArrow(scorer(net, docs.columns.index(text_col), docs.columns, least), docs.schema)
