"""Byte-level BPE encoding and decoding, exact and in linear time.

A pre-token is encoded by backtracking over vocabulary matches instead of by merging:
take the longest token at the current byte, accept it when it may follow the token before
it, otherwise try the next shorter token that is its prefix, and step back when none is
left. Two tokens may be neighbours exactly when merging by rank would not have joined
bytes across their border; the answer depends on the two tokens alone and is memoised.
Every byte position is given up at most once, so the work is linear in the pre-token.

Matches come from a pyahocorasick automaton over the vocabulary, with bytes mapped to the
256 Latin-1 characters. Pre-tokens repeat, so each worker keeps a bounded memo of encoded
pre-tokens.

Edge cases: null text counts as empty; empty text has no tokens and decodes to no bytes;
rows are handled one by one, so repeated rows, null ids and clashing extra columns change
nothing (only the id and the new columns are returned).
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker

#: Rows per Arrow batch handed back, so that a worker holds few encoded texts at once.
ROWS_OUT = 256
#: Texts beyond this many characters are split into pre-tokens as a stream.
STREAM_CHARS = 1 << 20
MEMO_PIECES = 200_000
MEMO_PAIRS = 1_000_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(t) for t, r in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0..{len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def neighbours(a: int, b: int, joined: dict, left: list[int], right: list[int]) -> bool:
    """Whether merging by rank leaves a border between tokens ``a`` and ``b``.

    Undo the merges on both sides of the border, latest first; at each step, a token for
    the two touching parts whose rank is below the merges undone so far would have been
    made first, across the border.
    """
    below = 1 << 60
    while True:
        made = joined.get((a, b))
        if made is not None and made < below:
            return False
        if a > b:
            below, part = a, right[a]
            if part != a:
                a = part
                continue
            below, part = b + 1, left[b]
            if part == b:
                return True
            b = part
        else:
            below, part = b + 1, left[b]
            if part != b:
                b = part
                continue
            below, part = a, right[a]
            if part == a:
                return True
            a = part


class Codec:
    """Tables of one vocabulary; built on the driver, completed in each worker."""

    def __init__(self, tokens: list[bytes], pattern: str, left: list[int], right: list[int], prefix: list[int],
                 held: int = MEMO_PIECES):
        import ahocorasick
        import regex

        self.tokens, self.left, self.right, self.prefix = tokens, left, right, prefix
        self.size = [len(t) for t in tokens]
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.joined = {(l, r): i for i, (l, r) in enumerate(zip(left, right)) if l != i and l >= 0}
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if left[i] >= 0:  # tokens that no merge makes are found as whole pre-tokens only
                self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.split = regex.compile(pattern)
        self.pairs: dict[int, bool] = {}
        self.memo = Memo(self, held)

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = neighbours(a, b, self.joined, self.left, self.right)
        return got

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n, size, prefix, pairs = len(piece), self.size, self.prefix, self.pairs
        longest = [-1] * (n + 1)
        for end, tok in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[tok]] = tok  # ends come in order, so the longest stays
        given_up: set[int] = set()
        out: list[int] = []
        pos, tok, last = 0, longest[0], -1
        while pos < n:
            while True:
                end = pos + size[tok]
                if end not in given_up:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | tok)
                    if fits or (fits is None and self.compatible(last, tok)):
                        break
                tok = prefix[tok]
                if tok < 0:
                    break
            if tok >= 0:
                out.append(tok)
                last, pos, tok = tok, end, longest[end]
            else:  # nothing fits here: give the position up and retry the token before
                given_up.add(pos)
                tok = out.pop()
                pos -= size[tok]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers (the workers' byte order)."""
        if len(text) <= STREAM_CHARS:
            memo = self.memo
            return b"".join([memo[p] for p in self.split.findall(text)])
        out, memo = bytearray(), self.memo
        for m in self.split.finditer(text):
            out += memo[m[0]]
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        view, tokens = memoryview(ids).cast("I"), self.tokens
        return b"".join(b"".join([tokens[i] for i in view[k : k + (1 << 18)]]) for k in range(0, len(view), 1 << 18))


class Memo(dict):
    """Pre-token -> packed ids. When full, it starts over and keeps the last generation to
    copy from, so frequent pre-tokens are encoded once."""

    def __init__(self, codec: Codec, held: int):
        super().__init__()
        self.codec, self.before, self.held = codec, {}, held

    def __missing__(self, piece: str) -> bytes:
        packed = self.before.get(piece)
        if packed is None:
            packed = array("I", self.codec.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.held:
                self.before = dict(self)
                self.clear()
            self[piece] = packed
        return packed


def merge_tables(tokens: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """For each token: the two tokens its last merge joins (itself for a single byte, -1 for
    a token no merge makes), and the longest shorter token that is its prefix (-1: none)."""
    rank = {t: i for i, t in enumerate(tokens)}
    if any(bytes([b]) not in rank for b in range(256)):
        raise ValueError("the vocabulary must hold every single byte")
    left, right, prefix = [-1] * len(tokens), [-1] * len(tokens), [-1] * len(tokens)
    joined: dict[tuple[int, int], int] = {}
    for i, t in enumerate(tokens):
        if len(t) == 1:
            left[i] = right[i] = i
            continue
        for k in range(len(t) - 1, 0, -1):
            a = rank.get(t[:k])
            if a is None:
                continue
            b = rank.get(t[k:])
            if b is not None and a < i and b < i and left[a] >= 0 and left[b] >= 0 and neighbours(a, b, joined, left, right):
                left[i], right[i] = a, b
                joined[a, b] = i
                break
    for i, t in enumerate(tokens):
        for k in range(len(t) - 1, 0, -1):
            a = rank.get(t[:k])
            if a is not None and left[a] >= 0:
                prefix[i] = a
                break
    return left, right, prefix


def build(path: str, pattern: str) -> tuple:
    """What a worker needs to make a Codec: plain lists, small enough to ship."""
    tokens = read_ranks(path)
    return (tokens, pattern, *merge_tables(tokens))


def _codec(shipped, held: int = MEMO_PIECES) -> Codec:
    parts = shipped.value
    return per_worker(("bpe", hash(tuple(parts[0])), parts[1], held), lambda: Codec(*parts, held))


def _parts(df: DataFrame, path: str, pattern: str):
    return df.sparkSession.sparkContext.broadcast(build(path, pattern))  # one vocabulary file: about 2 MB


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
           held: int = MEMO_PIECES) -> DataFrame:
    """Rows ``(id, ids)``: token ids packed as little-endian unsigned 32-bit integers; with
    ``decoded``, also ``decoded`` (binary), the bytes that the ids decode to. A worker keeps the ids of at
    most twice ``held`` pre-tokens; fewer take less memory and more time, with the same ids."""
    import pyarrow as pa

    shipped = _parts(df, path, pattern)
    src = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, ids binary" + ", decoded binary" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped, held)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(k, ROWS_OUT)
                ids = [codec.encode(t) for t in part.column(1).to_pylist()]
                cols = [part.column(0), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array([codec.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, [id_col, "ids", "decoded"][: len(cols)])

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows ``(id, decoded)``: the bytes that packed ids stand for (null ids: no bytes)."""
    import pyarrow as pa

    shipped = _parts(df, path, pattern)
    src = df.select(F.col(id_col), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    kind = src.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(k, ROWS_OUT)
                out = pa.array([codec.decode(i) for i in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), out], [id_col, "decoded"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 digests of the rows of ``encode(..., decoded=True)``."""
    return encoded.select(
        id_col,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
