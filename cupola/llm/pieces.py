"""SentencePiece (BPE kind) encoding and decoding, exact, by backtracking instead of merging.

The library puts a space mark before the text, turns spaces into marks, and merges neighbouring
symbols from single characters on: best piece score first, the leftmost of equal scores. A
sequence of pieces is its result exactly when each two neighbours, merged alone, stay the two
they are: a first merge across a border of the sequence would depend on nothing but the pieces
beside it. So a text is encoded by taking the longest piece at the current place
(Aho-Corasick), the next shorter one while it may not follow the piece before, and one step
back when none is left. Whether two pieces may be neighbours is found by re-merging their
characters, and kept in a memo. Only one valid sequence ends at a place, so a place that failed
once stays failed: a bitfield holds those, and each is given up at most once.

No piece holds a character before a space mark, and characters that no longer piece holds stand
alone; the text is cut there into segments, whose ids each worker keeps in a bounded memo. A
model whose pieces do not allow the cut is encoded uncut. Characters without a piece become
their UTF-8 bytes' pieces.

Edge cases: null text counts as empty; an empty text has no ids and decodes to nothing; the
mark U+2581 in a text decodes to a space, as the library has it; long texts are encoded segment
by segment, and their ids held as packed integers; rows are handled one by one, so repeated
rows, null ids, ties and extra columns of any name change nothing; an empty table gives no
rows. Models with another algorithm, a character map, user-defined or unused pieces, or without
byte pieces are refused.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, values

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format (fixed values)
BPE = 2  # model type of the model format (fixed value)
#: Rows per Arrow batch handed back; segments and pairs that a worker's memos hold; longest segment kept.
ROWS_OUT = 256
MEMO_SEGMENTS = 400_000
MEMO_PAIRS = 1_000_000
MEMO_CHARS = 64


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(buf):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value, at = buf[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = buf[at : at + n], at + n
        else:
            raise ValueError("not a SentencePiece model")
        yield key >> 3, value


def read_model(path: str) -> list[tuple[str, float, int]]:
    """``(piece, score, type)`` of every id of a model file that this module can encode with."""
    with open(path, "rb") as f:
        buf = f.read()
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(buf):
        if number == 1:
            d = dict(_fields(value))
            pieces.append((d[1].decode("utf-8"), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    kinds = {t for _, _, t in pieces}
    if trainer.get(3) != BPE or not trainer.get(35) or trainer.get(24) or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path}: only BPE models with byte pieces and without user-defined or unused pieces")
    if normaliser.get(2) or not normaliser.get(3, 1) or normaliser.get(4, 1) or not normaliser.get(5, 1):
        raise ValueError(f"{path}: only models that put a mark before the text and change nothing but spaces")
    if sum(t == BYTE for _, _, t in pieces) != 256:
        raise ValueError(f"{path}: the 256 byte pieces are missing")
    return pieces


def merged(parts: list[str], score: dict[str, float]) -> list[str]:
    """``parts`` merged as the library does: best score first, the leftmost of equal scores."""
    parts = list(parts)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = score.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Coder:
    """Tables of one model, made in each worker from its pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        import ahocorasick

        self.score = {p: s for p, s, t in pieces if t == NORMAL}
        ids = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.byte = [0] * 256
        for i, (p, _, t) in enumerate(pieces):
            if t == BYTE:
                self.byte[int(p[3:5], 16)] = i
        # tokens: pieces that merging makes from their own characters, and those characters
        text = sorted({c for p in ids for c in p} | {p for p in ids if len(merged(list(p), self.score)) == 1})
        number = {p: k for k, p in enumerate(text)}
        self.text, self.size = text, [len(p) for p in text]
        self.alphabet = {p for p in text if len(p) == 1}
        self.out = [array("i", [ids[p]] if p in ids else [self.byte[b] for b in p.encode()]).tobytes() for p in text]
        self.shorter = [next((number[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in number), -1) for p in text]
        self.automaton = ahocorasick.Automaton()
        for k, p in enumerate(text):
            self.automaton.add_word(p, k)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.memo = Memo(self)
        longer = {c for p in ids if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(b)) for b in range(128) if chr(b) not in longer)
        whole = any(c != MARK and d == MARK for p in ids for c, d in zip(p, p[1:]))
        self.cut = None if whole else re.compile(
            f"[{alone}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" if alone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.surface = [b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else bytes([int(p[3:5], 16)]) if t == BYTE
                        else p.replace(MARK, " ").encode() for p, _, t in pieces]
        self.is_byte = [t == BYTE for _, _, t in pieces]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the two pieces stay apart when their characters are merged again."""
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        x, y = self.text[a], self.text[b]
        got = self.pairs[a << 32 | b] = merged(list(x + y), self.score) == [x, y]
        return got

    def tokens(self, segment: str) -> list[int]:
        """Token numbers of a segment whose characters all are tokens."""
        n, size, shorter, pairs = len(segment), self.size, self.shorter, self.pairs
        longest = [-1] * (n + 1)
        for end, tok in self.automaton.iter(segment):
            longest[end + 1 - size[tok]] = tok  # ends come in order, so the longest stays
        failed = None  # bitfield of places, made when the first one fails
        out: list[int] = []
        at, tok, last = 0, longest[0], -1
        while at < n:
            while tok >= 0:
                end = at + size[tok]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | tok)
                    if fits or (fits is None and self.may_follow(last, tok)):
                        break
                tok = shorter[tok]
            if tok >= 0:
                out.append(tok)
                last, at, tok = tok, end, longest[end]
            else:  # nothing may follow here: give the place up, go on with a shorter piece before it
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                tok = out.pop()
                at -= size[tok]
                last, tok = out[-1] if out else -1, shorter[tok]
        return out

    def segment(self, segment: str) -> bytes:
        """Packed ids of a segment; a character that is no token stands between the parts it leaves."""
        known = self.alphabet
        if known.issuperset(segment):
            return b"".join([self.out[k] for k in self.tokens(segment)])
        ids, start = [], 0
        for i, c in enumerate(segment):
            if c not in known:
                if start < i:
                    ids += [self.out[k] for k in self.tokens(segment[start:i])]
                ids.append(array("i", [self.byte[b] for b in c.encode("utf-8", "surrogatepass")]).tobytes())
                start = i + 1
        if start < len(segment):
            ids += [self.out[k] for k in self.tokens(segment[start:])]
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit integers."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        if self.cut is None:
            return self.segment(marked)
        memo = self.memo
        return b"".join([memo[s] for s in self.cut.findall(marked)])

    def decode(self, ids) -> bytes:
        """UTF-8 of the text that ids stand for: the first mark goes, a byte that is no part of
        a character becomes U+FFFD."""
        ids = list(ids)
        first = 0
        while first < len(ids) and not self.surface[ids[first]]:
            first += 1
        out = b"".join([self.surface[i] for i in ids])
        if first < len(ids) and not self.is_byte[ids[first]] and out[:1] == b" " and self.surface[ids[first]] != " ⁇ ".encode():
            out = out[1:]
        try:
            out.decode("utf-8")
            return out
        except UnicodeDecodeError:
            return "".join(_characters(out)).encode()


def _characters(raw: bytes) -> Iterator[str]:
    """The characters of ``raw``, with U+FFFD for each byte that belongs to none."""
    at = 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                yield raw[at : at + n].decode("utf-8")
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


class Memo(dict):
    """Segment -> packed ids; when full it starts over and copies from the generation before."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder, self.before = coder, {}

    def __missing__(self, segment: str) -> bytes:
        packed = self.before.get(segment)
        if packed is None:
            packed = self.coder.segment(segment)
        if len(segment) <= MEMO_CHARS:
            if len(self) >= MEMO_SEGMENTS:
                self.before = dict(self)
                self.clear()
            self[segment] = packed
        return packed


def _shipped(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(read_model(path))  # one vocabulary file: about 1 MB


def _coder(shipped) -> Coder:
    pieces = shipped.value
    return per_worker(("pieces", hash(tuple(pieces))), lambda: Coder(pieces))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Rows ``(id, ids array<int>)``; with ``decoded``, also ``decoded`` (binary), the UTF-8 of
    the text that the ids decode to."""
    import numpy as np
    import pyarrow as pa

    shipped = _shipped(df, path)
    src = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shipped)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(k, ROWS_OUT)
                packed = [coder.encode(t) for t in values(part.column(1))]
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(packed), np.int32))
                cols = [part.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)]
                if decoded:
                    cols.append(pa.array([coder.decode(memoryview(p).cast("i")) for p in packed], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, [id_col, "ids", "decoded"][: len(cols)])

    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows ``(id, decoded)``: the UTF-8 (binary) of the text that ids stand for (null: none)."""
    import pyarrow as pa

    shipped = _shipped(df, path)
    src = df.select(F.col(id_col), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    kind = src.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shipped)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(k, ROWS_OUT)
                out = pa.array([coder.decode(i) for i in values(part.column(1))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), out], [id_col, "decoded"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 digests of the rows of ``encode(..., decoded=True)``."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
