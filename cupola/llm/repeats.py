"""Suffix-array dedup: bytes covered by a string of ``WINDOW`` bytes that starts twice are removed.

Suffixes need ordering only through ``WINDOW`` bytes, by most-significant-digit passes; the
groups that stay equal are the repeated windows. A pass over every suffix of a corpus would
move many times the corpus, so the first digit is a short string inside the window, at a
place that the window's own bytes choose: the one of its GRAM-byte strings with the smallest
hash (the last such, when several are equal). Equal windows choose the same string at the
same place, so windows whose digit occurs once are done, and runs of windows share theirs.

1. Map: choose the digit of every window; one row per run of windows with the same choice.
   Runs with equal bytes inside a batch are repeated as a whole: their bytes are marked at
   once and one row goes on for all of them.
2. Spark groups the digits; those that occur once leave.
3. The bytes around the remaining digits are shuffled by digit, and each group is ordered by
   its remaining digits (the place of the first digit, then blocks of DIGIT bytes, each named
   by a 64-bit fingerprint); windows alone in their group leave at each pass.
4. Repeated windows are merged to spans per document and cut out.

Texts are UTF-8 bytes; matches never cross documents; windows are judged on the input.

Edge cases: null text counts as empty; texts shorter than a window lose nothing; repeated
rows are different documents, so a long text given twice is removed from both; null ids are
kept; texts of any length are read whole, in overlapping blocks; only id and text are read,
so extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cupola.session import materialise

from .common import per_worker, squeeze, values

WINDOW, GRAM, DIGIT = 200, 24, 50
#: Window starts that are looked at together.
BLOCK = 1 << 17
#: Runs of windows whose windows are ordered together (whole groups only).
ROWS = 2048
#: Runs and bytes of windows that a task packs at once; bytes of text per index bucket.
PACK, CONTEXT_BYTES, BUCKET_BYTES = 1 << 20, 16 << 20, 32 << 20
BASE = 0x9E3779B97F4A7C15 | 1


class Roll:
    """Fingerprints of byte ranges from prefix sums: ``sum(code[b_j] * BASE^-(j-i))``, mixed."""

    def __init__(self, n: int = BLOCK + WINDOW):
        rng = np.random.default_rng(77)
        self.code = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        inverse = pow(BASE, -1, 1 << 64)
        self.down, self.up = self._powers(inverse, n), self._powers(BASE, n)

    @staticmethod
    def _powers(b: int, n: int) -> np.ndarray:
        out = np.full(n, np.uint64(b))
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefix(self, x: np.ndarray) -> np.ndarray:
        """Prefix sums along the last axis, one longer than ``x``."""
        s = np.zeros((*x.shape[:-1], x.shape[-1] + 1), np.uint64)
        np.cumsum(self.code[x] * self.down[: x.shape[-1]], axis=-1, out=s[..., 1:])
        return s

    def ranges(self, s: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of all ranges of ``size`` bytes."""
        n = s.shape[-1] - size
        return mix((s[..., size:] - s[..., :-size]) * self.up[:n])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def last_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the last smallest value in each window of ``width`` values."""
    n = len(h)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    v = (h & ~low) | (low - np.arange(n, dtype=np.uint64))  # equal high bits: the later position is smaller
    pad = -n % width
    p = np.append(v, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))).reshape(-1, width)
    ahead = np.minimum.accumulate(p, axis=1).ravel()
    behind = np.minimum.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    m = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (low - (m & low)).astype(np.int64)


def runs(data: bytes, roll: Roll) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of arrays ``(digit, place, first, last, whole)``: windows that start in
    [first, last] choose ``digit`` at ``place``; ``whole`` is the fingerprint of all their bytes."""
    x = np.frombuffer(data, np.uint8)
    for a in range(0, len(x) - WINDOW + 1, BLOCK):
        part = x[a : a + BLOCK + WINDOW - 1]
        s = roll.prefix(part)
        grams = roll.ranges(s, GRAM)
        at = last_minimum(grams, WINDOW - GRAM + 1)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:], len(at)) - 1
        place = at[first]
        whole = mix((s[last + WINDOW] - s[first]) * roll.up[first] + (place - first).astype(np.uint64))
        yield grams[place], place + a, first + a, last + a, whole


def merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges [first, end)."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.append(True, first[1:] > end[:-1])
    return first[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)]


def _roll() -> Roll:
    return per_worker(("roll", BLOCK, WINDOW), Roll)


def _pack(columns: list[np.ndarray], to: np.ndarray, buckets: int, squeezer) -> tuple[list[int], list[bytes]]:
    """Per bucket, the columns' bytes one after the other, compressed."""
    order = np.argsort(to, kind="stable")
    columns, to = [c[order] for c in columns], to[order]
    ends = np.searchsorted(to, np.arange(buckets + 1))
    full = [b for b in range(buckets) if ends[b] < ends[b + 1]]
    return full, [squeezer.compress(b"".join(c[ends[b] : ends[b + 1]].tobytes() for c in columns)) for b in full]


def _unpack(blob: bytes, kinds: tuple, rest: int = 0) -> tuple[list[np.ndarray], int]:
    """The columns of a packed row, and where they end (``rest`` bytes follow)."""
    n = (len(blob) - rest) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(blob, k, n, at))
        at += out[-1].nbytes
    return out, at


def _bucket(digit: np.ndarray, buckets: int) -> np.ndarray:
    return ((digit >> np.uint64(11)) % np.uint64(buckets)).astype(np.int32)


#: Columns of a packed run: digit, row, place, places before it, further windows, times.
RUN = ("<u8", "<i8", "<i4", "u1", "u1", "u1")
#: Columns of packed contexts: the same without the place, with the first window.
CONTEXT = ("<u8", "<i8", "<i4", "u1", "u1", "u1")


def first_digits(src: DataFrame, buckets: int) -> DataFrame:
    """Rows ``(bucket, z)`` of packed runs; for spans that are already known to repeat, rows
    ``(row, first, last)`` with the span's start and end."""
    import pyarrow as pa

    names = ["bucket", "z", "row", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        roll, squeezer, held, size = _roll(), zstandard.ZstdCompressor(level=3), [], 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            full, z = _pack(cols, _bucket(cols[0], buckets), buckets, squeezer)
            none = pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(z, pa.binary()), none[0], none[1], none[1]], names)

        for batch in batches:
            row = batch.column(0).to_numpy(zero_copy_only=False)
            got, doc = [], []
            for i, t in enumerate(values(batch.column(1))):
                data = t.encode("utf-8", "replace")
                if len(data) >= WINDOW:
                    for block in runs(data, roll):
                        got.append(block)
                        doc.append(np.full(len(block[0]), i))
            if not got:
                continue
            digit, place, first, last, whole = (np.concatenate(x) for x in zip(*got))
            doc = np.concatenate(doc)
            _, one, which, times = np.unique(whole ^ digit, return_index=True, return_inverse=True, return_counts=True)
            one_times = np.minimum(times, 2)
            back, more = place - first, last - first
            held.append([digit[one], row[doc[one]], place[one].astype("<i4"), back[one].astype("u1"), more[one].astype("u1"), one_times.astype("u1")])
            size += len(one)
            if size > PACK:
                yield flush()
                size = 0
            known = times[which] > 1
            spans = [[], [], []]
            for i in np.unique(doc[known]):
                lo, hi = np.searchsorted(doc, [i, i + 1])
                mine = np.flatnonzero(known[lo:hi]) + lo
                a, b = merged(first[mine], last[mine] + WINDOW)
                spans[0].append(np.full(len(a), row[i]))
                spans[1].append(a)
                spans[2].append(b)
            if spans[0]:
                r, a, b = (np.concatenate(x) for x in spans)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(r), pa.int32()), pa.nulls(len(r), pa.binary()), pa.array(r.astype(np.int64)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names
                )
        if held:
            yield flush()

    return src.select("row", "t").mapInArrow(run, "bucket int, z binary, row long, first int, last int")


def repeated_digits(packed: DataFrame, buckets: int) -> DataFrame:
    """Rows ``(row, digit, place, first, last, times)`` of the runs whose digit occurs twice or more."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain, parts = zstandard.ZstdDecompressor(), []
        for batch in batches:
            parts += [_unpack(plain.decompress(z), RUN)[0] for z in batch.column(1).to_pylist()]
        if not parts:
            return
        digit, row, place, back, more, times = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        order = np.argsort(digit, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(digit[order]) != 0))
        total = np.add.reduceat(times[order].astype(np.int64), at)
        keep = order[np.repeat(total > 1, np.diff(np.append(at, len(order))))]
        for k in range(0, len(keep), 1 << 16):
            i = keep[k : k + (1 << 16)]
            first = place[i] - back[i].astype(np.int32)
            cols = [row[i], digit[i].view(np.int64), place[i], first, first + more[i].astype(np.int32), times[i].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["row", "digit", "place", "first", "last", "times"])

    return packed.select("bucket", "z").repartition(buckets, "bucket").mapInArrow(run, "row long, digit long, place int, first int, last int, times int")


def contexts(held: DataFrame, buckets: int) -> DataFrame:
    """Rows ``(bucket, rest, z)``: packed runs with the bytes of their windows (``rest`` of them)."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeezer, plain, kept, size = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor(), [], 0

        def flush():
            kept.sort(key=lambda f: f[0])  # equal digits together: their bytes are alike
            out = ([], [], [])
            to = _bucket(np.array([f[0] for f in kept], np.int64).view(np.uint64), buckets)
            for b in np.unique(to).tolist():
                mine = [kept[i] for i in np.flatnonzero(to == b)]
                cols = [np.array(c, k) for c, k in zip(list(zip(*mine))[:6], ("<i8", *CONTEXT[1:]))]
                text = b"".join(f[6] for f in mine)
                out[0].append(b)
                out[1].append(len(text))
                out[2].append(squeezer.compress(b"".join(c.tobytes() for c in cols) + text))
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], ["bucket", "rest", "z"])

        for batch in batches:
            for r, z, found in zip(*[c.to_pylist() for c in batch.columns]):
                if not found:
                    continue
                data = plain.decompress(z)
                for f in found:
                    piece = data[f["first"] : f["last"] + WINDOW]
                    kept.append((f["digit"], r, f["first"], f["place"] - f["first"], f["last"] - f["first"], f["times"], piece))
                    size += len(piece)
                if size > CONTEXT_BYTES:
                    yield flush()
                    size = 0
        if kept:
            yield flush()

    return held.select("row", "z", "found").mapInArrow(run, "bucket int, rest int, z binary")


def repeated_windows(digit: np.ndarray, off: np.ndarray, n: np.ndarray, times: np.ndarray, pieces: list[bytes], roll: Roll) -> np.ndarray:
    """Flags [row, window]: the window's bytes occur more than once among the rows (whole groups)."""
    wide = max(len(p) for p in pieces)
    x = np.zeros((len(pieces), wide), np.uint8)
    for i, p in enumerate(pieces):
        x[i, : len(p)] = np.frombuffer(p, np.uint8)
    s = roll.prefix(x)
    most = int(n.max())
    row, start = np.nonzero(np.arange(most)[None, :] < n[:, None])
    flags = np.zeros((len(pieces), most), bool)
    # first digit: its bytes (the shuffle's key) and its place in the window
    group = mix(digit.view(np.uint64)[row] + mix((off[row] - start).astype(np.uint64)))
    blocks = roll.ranges(s, DIGIT)
    for d in range(0, WINDOW, DIGIT):
        key = mix(group ^ mix(blocks[row, start + d] + np.uint64(d)))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        multi = np.bincount(which, weights=times[row])[which] > 1.5 if d + DIGIT >= WINDOW else (count[which] > 1) | (times[row] > 1)
        row, start, group = row[multi], start[multi], key[multi]
        if not len(row):
            break
    flags[row, start] = True
    return flags


def repeated_spans(packed: DataFrame, buckets: int) -> DataFrame:
    """Rows ``(row, start, end)`` of bytes covered by repeated windows."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        roll, plain, parts, pieces = _roll(), zstandard.ZstdDecompressor(), [], []
        for batch in batches:
            for rest, z in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                blob = plain.decompress(z)
                cols, at = _unpack(blob, CONTEXT, rest)
                parts.append(cols)
                for n in (cols[4].astype(int) + WINDOW).tolist():
                    pieces.append(blob[at : at + n])
                    at += n
        if not parts:
            return
        digit, row, first, off, more, times = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(digit, kind="stable")
        ends = np.append(np.flatnonzero(np.diff(digit[order]) != 0) + 1, len(order))
        done = 0
        for e in ends.tolist():
            if e - done < ROWS and e != ends[-1]:
                continue
            i = order[done:e]
            done = e
            flags = repeated_windows(digit[i], off[i].astype(np.int64), more[i].astype(np.int64) + 1, times[i].astype(np.int64), [pieces[k] for k in i.tolist()], roll)
            r, w = np.nonzero(flags)
            if not len(r):
                continue
            new = np.append(True, (r[1:] != r[:-1]) | (w[1:] != w[:-1] + 1))
            a = np.flatnonzero(new)
            b = np.append(a[1:] - 1, len(r) - 1)
            start = first[i][r[a]] + w[a]
            end = first[i][r[b]] + w[b] + WINDOW
            yield pa.RecordBatch.from_arrays([pa.array(row[i][r[a]]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["row", "start", "end"])

    return packed.repartition(buckets, "bucket").mapInArrow(run, "row long, start int, end int")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, one per row of ``docs``;
    ``spans`` (array of struct(start, end), null if none) are the removed byte ranges."""
    import pyarrow as pa

    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.xxhash64(F.lit(13), F.col(id_col), F.xxhash64(text), F.xxhash64(F.lit(7), text))
    src = docs.select(F.col(id_col).alias("doc"), row.alias("row"), text.alias("t"))
    long_enough = src.where(F.octet_length("t") >= WINDOW)
    total = long_enough.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))
    digits = materialise(first_digits(long_enough, buckets))
    twice = repeated_digits(digits.where("bucket is not null"), buckets)
    known = digits.where("bucket is null").select("row", F.col("first").alias("start"), F.col("last").alias("end"))
    found = twice.select("row", F.struct("digit", "place", "first", "last", "times").alias("f"))
    none = F.lit(None).cast(found.schema["f"].dataType)
    touched = found.unionByName(known.select("row").distinct().withColumn("f", none)).groupBy("row").agg(F.collect_list("f").alias("found"))
    held = materialise(squeeze(long_enough.select("row", "t")).join(touched, "row"))
    spans = repeated_spans(contexts(held, buckets), buckets).unionByName(known)
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for r, z, sp in zip(*[batch.column(c).slice(k, 256).to_pylist() for c in range(3)]):
                    data = plain.decompress(z)
                    a, b = merged(np.array([s["start"] for s in sp]), np.array([s["end"] for s in sp]))
                    kept, at = hashlib.sha256(), 0
                    for x, y in zip(a.tolist(), b.tolist()):
                        kept.update(data[at:x])
                        at = y
                    kept.update(data[at:])
                    out.append({"row": r, "n_removed": int((b - a).sum()), "n_spans": len(a), "kept_sha256": kept.hexdigest(), "spans": [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())]})
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("row", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    cut = held.select("row", "z").join(by_row, "row").mapInArrow(
        run, "row long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"
    ).dropDuplicates(["row"])  # rows equal in id and text have equal results
    whole = src.select("doc", "row", F.octet_length("t").cast("long").alias("n_bytes"), F.sha2(F.col("t").cast("binary"), 256).alias("all_sha256"))
    return whole.join(cut, "row", "left").select(
        F.col("doc").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
        "spans",
    )
