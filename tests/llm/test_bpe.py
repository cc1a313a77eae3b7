import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cupola.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(*bpe.build(PATH, P.PATTERN))


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return list(memoryview(packed).cast("I"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(codec, library, text):
    got = codec.encode(text)
    assert ids(got) == library.encode_ordinary(text)
    assert codec.decode(got) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "ing", "the", " ", "  ", "é", "ß", "00", "'s", "==", "日", "\n"]), max_size=40))
def test_dense_matches_as_the_library(codec, library, parts):
    text = "".join(parts)
    assert ids(codec.encode(text)) == library.encode_ordinary(text)


def test_long_runs_take_linear_time(codec, library):
    for text in ("a" * 20000, " " * 20000 + "x", "ab" * 10000, "аб" * 5000):
        assert ids(codec.encode(text)) == library.encode_ordinary(text)
    big = "=" * (bpe.STREAM_CHARS + 5) + " end"
    assert codec.decode(codec.encode(big)) == big.encode()


def test_small_memo_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 3)
    text = "the quick brown fox jumped over the lazy dogs and the quick foxes"
    fresh = bpe.Codec(*bpe.build(PATH, P.PATTERN))
    assert ids(fresh.encode(text)) == library.encode_ordinary(text)


def test_query_as_the_library(spark, library):
    from cupola.llm.queries import op4_bpe

    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = op4_bpe(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode_ordinary(texts[r["doc_id"]])
        packed = b"".join(i.to_bytes(4, "little") for i in want)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_edges_and_decode(spark, edge_docs, no_docs):
    enc = bpe.encode(edge_docs, PATH, P.PATTERN)
    got = sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in bpe.decode(enc, PATH, P.PATTERN).collect())
    assert got == sorted((r["doc_id"] or 0, r["text"] or "") for r in edge_docs.collect())
    assert bpe.encode(no_docs, PATH, P.PATTERN, decoded=True).count() == 0


def test_a_worker_holds_as_few_pieces_as_asked(spark, codec):
    small = bpe.Codec(*bpe.build(PATH, P.PATTERN), 5)
    for i in range(60):
        text = " ".join(f"word{i}x{j}" for j in range(9))
        assert small.encode(text) == codec.encode(text)
        assert len(small.memo) + len(small.memo.before) <= 10
    df = spark.createDataFrame([(i, f"some words {i} and others") for i in range(300)], "doc_id long, text string")
    assert sorted(bpe.encode(df, PATH, P.PATTERN, held=3).collect()) == sorted(bpe.encode(df, PATH, P.PATTERN).collect())
