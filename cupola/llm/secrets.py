"""Secret scan: pattern findings, widened by a character convolutional network.

Three patterns give the base findings of a text (leftmost, non-overlapping per kind). A
network then scores every other candidate, that is every run of 12 token characters or more
that touches no base span, together with the characters around it, and adds the candidates
above a threshold; base findings always stay.

It is fitted on the base findings of a bounded sample, in a form that no pattern takes: an
assigned value without its key word, an access key without its prefix, a hexadecimal run with
capitals. So it learns what secrets look like, not what the patterns look for. Negatives are the
other candidates of the sample. ``held_out_kinds`` leaves one kind out of the fit at a time and
says how much of it is found.

The network is numpy: characters and their kinds (digit, letter, capital) one-hot with an inside/outside plane, learned filters over
every position of the candidate and its context, ReLU, maximum over the positions inside and
over those outside, one logistic unit. A fold of the findings is held out of the fit: Platt
scaling on it calibrates the score, and the threshold keeps ``recall`` of its findings, with
half the gap to the other candidates to spare. Without findings in the sample there is no network and the base
findings are the result.

Spans are code point offsets, end exclusive.

Edge cases: null text counts as empty and has no findings; rows are scanned one by one, so
repeated rows, null ids and extra columns do not matter; an empty table gives no rows; a
candidate of any length is scored whole, in blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, values

# Kinds in the order of the contract, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
LEFT, RIGHT = 32, 16
WIDTH, FILTERS = 5, 16
#: Character codes, and after them the kinds of characters: digit, small letter, capital, other printable, the rest.
CODES = 129
KIND_OF = np.array([CODES + (0 if chr(c).isdecimal() else 1 if chr(c).islower() else 2 if chr(c).isupper() else 3 if 32 <= c < 127 else 4) for c in range(128)] + [CODES + 4])
#: Positions that the network looks at together; longer windows are taken in blocks.
BLOCK = 1 << 15
#: Texts whose candidates are scored together.
ROWS = 64

_assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_access = re.compile(ACCESS)
_hex = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # runs are maximal, so short ones may be passed over
_candidate = re.compile(CANDIDATE)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind number)`` in order of start, then kind."""
    out = [(m.start(), m.end(), 0) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in _access.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), 2) for m in _hex.finditer(text)]
    out.sort(key=lambda s: (s[0], s[2]))
    return out


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of token characters that touch no known span."""
    out, k, reach = [], 0, -1
    for m in _candidate.finditer(text):
        a, b = m.span()
        while k < len(known) and known[k][0] < b:
            reach = max(reach, known[k][1])
            k += 1
        if reach <= a:
            out.append((a, b))
    return out


def disguised(text: str, without: int | None = None) -> list[tuple[str, int, int, int]]:
    """``(text, start, end, kind number)`` of each base finding as no pattern would take it, in its
    own context; none that touches a finding of kind ``without``."""
    out, known = [], base_spans(text)
    barred = [(a, b) for a, b, k in known if k == without]
    for a, b, kind in known:
        if any(a < e and s < b for s, e in barred):
            continue
        left, value, right = text[max(0, a - LEFT) : a], text[a:b], text[b : b + RIGHT]
        value = _assign.match(value)[2] if kind == 0 else value[len("AKIA") :] if kind == 1 else value
        if base_spans(value):  # a hexadecimal run: letters in both cases, or digits in groups
            if value.isdecimal():
                value = "-".join(value[i : i + 4] for i in range(0, len(value), 4))
            else:
                value = "".join(c.upper() if (i * 7 + a) % 3 == 0 or i % 8 == 7 else c for i, c in enumerate(value))
        out.append((left + value + right, len(left), len(left) + len(value), kind))
    return out


def codes(text: str, a: int, b: int) -> tuple[np.ndarray, int, int]:
    """Character codes (0-127, 128 for all others) of a span with its context, and the span in it."""
    lo, hi = max(0, a - LEFT), min(len(text), b + RIGHT)
    raw = np.frombuffer(text[lo:hi].encode("utf-32-le", "surrogatepass"), "<u4")
    return np.minimum(raw, 128).astype(np.int64), a - lo, b - lo


class Network:
    """Filters over characters, pooled inside and outside the candidate, one logistic unit."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.3, (WIDTH, 2, CODES + 5, FILTERS)).astype(np.float32)
        self.table[:, :, :CODES] *= 0.1  # kinds lead, single characters refine
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 1.0

    def pooled(self, code: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Maxima of the filters centred inside [a, b) and outside it, and their positions (-1: zero)."""
        n, half = len(code), WIDTH // 2
        inside = np.zeros(n, np.int64)
        inside[a:b] = 1
        best, where = np.zeros(2 * FILTERS, np.float32), np.full(2 * FILTERS, -1, np.int64)
        for lo in range(0, n, BLOCK):
            hi = min(n, lo + BLOCK)
            act = np.tile(self.bias, (hi - lo, 1))
            for w in range(WIDTH):
                first, last = max(lo, half - w), min(hi, n + half - w)
                if first < last:
                    at = slice(first + w - half, last + w - half)
                    act[first - lo : last - lo] += self.table[w, inside[at], code[at]] + self.table[w, inside[at], KIND_OF[code[at]]]
            for side in (0, 1):
                rows = np.flatnonzero(inside[lo:hi] == side)
                if len(rows):
                    k = act[rows].argmax(0)
                    top = act[rows[k], np.arange(FILTERS)]
                    s = slice(side * FILTERS, (side + 1) * FILTERS)
                    better = top > best[s]
                    where[s][better] = rows[k][better] + lo
                    best[s][better] = top[better]
        return best, where

    def margin(self, code, a, b) -> float:
        return float(self.pooled(code, a, b)[0] @ self.out + self.out_bias)

    def margins(self, spans: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
        """The margins of many spans, a block of them at a time; a span longer than a block by itself."""
        half, out = WIDTH // 2, np.empty(len(spans))
        zero = np.zeros((WIDTH, 2, 1, FILTERS), np.float32)
        table = np.concatenate([self.table[:, :, :CODES] + self.table[:, :, KIND_OF], zero], 2).reshape(WIDTH, 2 * (CODES + 1), FILTERS)
        todo: list[int] = []

        def block() -> None:
            pad = np.full(half, CODES, np.int64)
            where = np.concatenate([pad, *[np.concatenate([spans[i][0] + np.where((np.arange(len(spans[i][0])) >= spans[i][1]) & (np.arange(len(spans[i][0])) < spans[i][2]), CODES + 1, 0), pad]) for i in todo]])
            n = len(where) - 2 * half
            act = np.tile(self.bias, (n, 1))
            for w in range(WIDTH):
                act += table[w][where[w : w + n]]
            size = np.array([len(spans[i][0]) for i in todo])
            start = np.cumsum(np.append(0, size[:-1] + half))
            a, b = (start + np.array([spans[i][k] for i in todo]) for k in (1, 2))
            ends = start + size
            best = np.zeros((3, len(todo), FILTERS), np.float32)
            act = np.vstack([act, np.zeros((1, FILTERS), np.float32)])
            for k, (lo, hi) in enumerate(((start, a), (a, b), (b, ends))):
                some = np.flatnonzero(lo < hi)
                if len(some):
                    cuts = np.column_stack([lo[some], hi[some]]).ravel()
                    best[k, some] = np.maximum(np.maximum.reduceat(act, cuts)[::2], 0)
            pooled = np.concatenate([np.maximum(best[0], best[2]), best[1]], 1)
            out[todo] = pooled @ self.out + self.out_bias
            todo.clear()

        held = 0
        for i, (code, a, b) in enumerate(spans):
            if len(code) > BLOCK:
                out[i] = self.margin(code, a, b)
                continue
            todo.append(i)
            held += len(code)
            if held > BLOCK:
                block()
                held = 0
        if todo:
            block()
        return out

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30))))

    def fit(self, found: list[tuple[np.ndarray, int, int, int]], epochs: int, seed: int = 5, rate: float = 0.05) -> None:
        """Adagrad on the log-loss; the gradient passes only through the maxima."""
        rng, half = np.random.default_rng(seed), WIDTH // 2
        weight = {y: len(found) / (2 * max(1, sum(f[3] == y for f in found))) for y in (0, 1)}
        g_table, g_bias, g_out, g_ob = (np.full_like(x, 1e-3) for x in (self.table, self.bias, self.out, np.zeros(1, np.float32)))
        for _ in range(epochs):
            for i in rng.permutation(len(found)):
                code, a, b, y = found[i]
                best, where = self.pooled(code, a, b)
                err = np.float32((self.probability_raw(best) - y) * weight[y])
                back = err * self.out
                d_out = err * best + 1e-4 * self.out
                g_out += d_out**2
                self.out -= rate * d_out / np.sqrt(g_out)
                g_ob += err**2
                self.out_bias -= np.float32(rate * err / np.sqrt(g_ob[0]))
                for j in np.flatnonzero(where >= 0):
                    f, p = j % FILTERS, where[j]
                    g_bias[f] += back[j] ** 2
                    self.bias[f] -= rate * back[j] / np.sqrt(g_bias[f])
                    for w in range(WIDTH):
                        q = p + w - half
                        if 0 <= q < len(code):
                            for at in ((w, int(a <= q < b), code[q], f), (w, int(a <= q < b), KIND_OF[code[q]], f)):
                                g_table[at] += back[j] ** 2
                                self.table[at] -= rate * back[j] / np.sqrt(g_table[at])

    def probability_raw(self, best: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(best @ self.out + self.out_bias, -30, 30))))

    def calibrate(self, held: list[tuple[np.ndarray, int, int, int]], recall: float) -> None:
        """Platt scaling on the held-out spans, then a threshold that keeps ``recall`` of the findings:
        half-way (in margins) from there down to the highest other candidate where there is a gap."""
        m = np.array([self.margin(c, a, b) for c, a, b, _ in held])
        y = np.array([f[3] for f in held], float)
        n1, n0 = y.sum(), len(y) - y.sum()
        goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        s, t = 1.0, 0.0
        for _ in range(500):
            p = 1 / (1 + np.exp(-np.clip(s * m + t, -30, 30)))
            s -= 0.05 * float(np.mean((p - goal) * m))
            t -= 0.05 * float(np.mean(p - goal))
        self.scale, self.shift = max(s, 1e-3), t
        found = np.sort(m[y == 1])
        least = float(found[int(np.floor((1 - recall) * len(found)))])
        other = float(m[y == 0].max(initial=-np.inf))
        self.threshold = self.probability(least if not np.isfinite(other) else min(least, (least + other) / 2))


#: Negatives that the fit takes for each finding that it may take.
NEGATIVES = 3


def labelled(texts: list[str], most: int, without: int | None = None) -> list[tuple[np.ndarray, int, int, int]]:
    """Disguised findings (1), at most ``most`` and none that touches kind ``without``, and other candidates
    (0), at most ``NEGATIVES`` times as many."""
    pos, neg = [], []
    for t in texts:
        known = base_spans(t)
        if len(pos) < most:
            pos += [(*codes(d, a, b), 1) for d, a, b, _ in disguised(t, without)]
        if len(neg) < NEGATIVES * most:
            neg += [(*codes(t, a, b), 0) for a, b in candidates(t, known)]
    return pos[:most] + neg[: NEGATIVES * most]


def trained(found: list[tuple[np.ndarray, int, int, int]], recall: float) -> Network | None:
    """A network fitted on three quarters of the labelled spans, with its threshold from the rest."""
    train = [f for i, f in enumerate(found) if i % 4]
    held = [f for i, f in enumerate(found) if i % 4 == 0]
    if not any(f[3] for f in train) or not any(f[3] for f in held) or all(f[3] for f in train):
        return None
    net = Network()
    net.fit(train, epochs=3)
    net.calibrate(held, recall)
    return net


def fit(docs: DataFrame, id_col: str, text_col: str, sample_rows: int, sample_bytes: int, findings: int, recall: float) -> Network | None:
    """A network fitted on the findings of at most ``sample_rows`` rows; None without findings."""
    rows = bounded_rows(docs, id_col, text_col, [], sample_rows, sample_bytes)
    return trained(labelled([r[1] or "" for r in rows], findings), recall)


def held_out_kinds(texts: list[str], others: list[str], findings: int = 400, recall: float = 0.995) -> dict[str, tuple[int, float, float]]:
    """For each kind, ``(findings, share found, share of other candidates added)`` in ``others`` by a
    network that was fitted on ``texts`` without that kind."""
    out = {}
    for k, name in enumerate(KINDS):
        net = trained(labelled(texts, findings, without=k), recall)
        if net is None:
            continue
        hit = lambda t, a, b: net.probability(net.margin(*codes(t, a, b))) >= net.threshold  # noqa: B023, E731
        found = [hit(d, a, b) for t in others for d, a, b, kind in disguised(t) if kind == k]
        clean = [hit(t, a, b) for t in others for a, b in candidates(t, base_spans(t))]
        if found:
            out[name] = (len(found), sum(found) / len(found), sum(clean) / max(1, len(clean)))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 1500, sample_bytes: int = 16 << 20,
         findings: int = 400, recall: float = 0.995) -> DataFrame:
    """Rows ``(id, base, added)``: arrays of ``struct(kind, start, end[, score])`` per document.

    ``sample_rows``, ``sample_bytes`` and ``findings`` bound what the network is fitted on;
    every text of the table is scanned and every candidate scored.
    """
    import pyarrow as pa

    net = fit(docs, id_col, text_col, sample_rows, sample_bytes, findings, recall)
    src = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema[0].dataType.simpleString()
    span = "array<struct<kind:string,start:int,end:int,score:double>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                base, added, of, spans = [], [], [], []
                for i, t in enumerate(values(part.column(1), 64)):
                    known = base_spans(t)
                    base.append([{"kind": KINDS[k], "start": a, "end": b, "score": None} for a, b, k in known])
                    added.append([])
                    if net is not None:
                        more = candidates(t, known)
                        of += [(i, a, b) for a, b in more]
                        spans += [codes(t, a, b) for a, b in more]
                for (i, a, b), m in zip(of, net.margins(spans).tolist() if spans else ()):
                    if (p := net.probability(m)) >= net.threshold:
                        added[i].append({"kind": "network", "start": a, "end": b, "score": p})
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(base, arrow), pa.array(added, arrow)], [id_col, "base", "added"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, base {span}, added {span}")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""

    def joined(col):
        return F.concat_ws(",", F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    order = F.array(*[F.lit(k) for k in (*KINDS, "network")])
    ranked = F.array_sort(
        F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    return found.select(id_col, *[count(k) for k in KINDS], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(ranked).alias("spans"))
