"""Inverted lists by packed postings: one row per task and bucket instead of one per posting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

#: Postings that a task packs at once, and that an index bucket holds about.
PACK, BUCKET = 1 << 18, 1 << 19
PACKED = "bucket int, tokens binary, names binary, tags binary"


def pack(tokens: np.ndarray, names: np.ndarray, tags: np.ndarray, buckets: int, short: bool = False):
    """One Arrow row per bucket with the postings ``(token, name, tag)`` that fall into it.

    ``short``: tokens keep 40 bits beside their bucket, for lists whose members are verified,
    and tags are compressed.
    """
    import pyarrow as pa

    to = ((tokens >> np.uint64(11)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    tokens, names, tags, to = tokens[order], names[order], tags[order], to[order]
    ends = np.searchsorted(to, np.arange(buckets + 1))
    full = [b for b in range(buckets) if ends[b] < ends[b + 1]]
    cols = [[x[ends[b] : ends[b + 1]].tobytes() for b in full] for x in (tokens, names, tags)]
    if short:
        import zstandard

        plane = lambda x, n: np.frombuffer(x, np.uint8).reshape(-1, n).T
        deflate = zstandard.ZstdCompressor(level=1).compress
        cols[0] = [plane(x, 8)[:5].T.tobytes() for x in cols[0]]
        cols[2] = [deflate(plane(x, 4).tobytes()) for x in cols[2]]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *[pa.array(c, pa.binary()) for c in cols]], ["bucket", "tokens", "names", "tags"])


def unpack(bucket: int, tokens: bytes, names: bytes, tags: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The postings of a row of ``pack``; a short token has its bucket above its 40 bits."""
    name = np.frombuffer(names, np.int64)
    if len(tokens) == len(names):
        return np.frombuffer(tokens, np.uint64), name, np.frombuffer(tags, np.int32)
    import zstandard

    wide = np.zeros((len(name), 8), np.uint8)
    wide[:, :5] = np.frombuffer(tokens, np.uint8).reshape(-1, 5)
    tag = np.frombuffer(zstandard.ZstdDecompressor().decompress(tags), np.uint8).reshape(4, -1).T
    return wide.view(np.uint64).ravel() | np.uint64(bucket << 40), name, np.ascontiguousarray(tag).view(np.int32).ravel()


def lists(posted: DataFrame, buckets: int, heads: bool = False, dealt=None) -> DataFrame:
    """Rows ``(token, first, first_tag, name, tag)`` of the lists with two names or more.

    ``first`` is the smallest name of the list; with ``heads``, the smallest one with the largest tag,
    lists without a positive tag are left out, and the tags of a name add up. ``dealt`` replaces the postings of a bucket by others
    (arrays in, arrays out), so that lists are split before they are read.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[], [], []]
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                for part, x in zip(parts, unpack(*row)):
                    part.append(x)
        if not parts[0]:
            return
        tok, name, tag = (np.concatenate(p) for p in parts)
        parts.clear()
        if dealt is not None:
            tok, name, tag = dealt(tok, name, tag)
        if not len(tok):
            return
        order = np.lexsort((-tag, name, tok))
        tok, name, tag = tok[order], name[order], tag[order]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (name[1:] != name[:-1])
        tag = np.minimum(np.add.reduceat(tag, np.flatnonzero(new), dtype=np.int64), (1 << 31) - 1).astype(np.int32) if heads else tag[new]
        tok, name = tok[new], name[new]
        at = np.flatnonzero(np.append(True, tok[1:] != tok[:-1]))
        length = np.diff(np.append(at, len(tok)))
        keep = length > 1
        first = at
        if heads:
            most = np.maximum.reduceat(tag, at)
            best = np.flatnonzero(tag == np.repeat(most, length))
            first = best[np.searchsorted(best, at)]
            keep &= most > 0
        head = np.repeat(first, length)
        keep = np.flatnonzero(np.repeat(keep, length))
        for k in range(0, len(keep), 1 << 16):
            i = keep[k : k + (1 << 16)]
            cols = [tok[i].view(np.int64), name[head[i]], tag[head[i]], name[i], tag[i]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["token", "first", "first_tag", "name", "tag"])

    return posted.repartition(buckets, "bucket").mapInArrow(run, "token long, first long, first_tag int, name long, tag int")
