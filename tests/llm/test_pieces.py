import hashlib

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cupola.llm import pieces

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return pieces.Coder(pieces.read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(packed):
    return list(memoryview(packed).cast("i"))


def check(coder, library, text):
    got = ids(coder.encode(text))
    assert got == library.encode(text)
    assert coder.decode(got).decode() == library.decode(got)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(coder, library, text):
    check(coder, library, text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "ing", "the", " ", "  ", "     ", "▁", "é", "ß", "00", "'s", "==", "日", "\n", "\t", "ational", "er", "n", "\U0001d518"]), max_size=40))
def test_dense_matches_and_runs_of_spaces_as_the_library(coder, library, parts):
    check(coder, library, "".join(parts))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 400)), max_size=20))
def test_any_ids_decode_as_the_library(coder, library, some):
    assert coder.decode(some).decode() == library.decode(some)


def test_long_runs_take_linear_time(coder, library):
    for text in ("a" * 20000, " " * 20000 + "x", "ab" * 10000, "аб" * 5000, "日本" * 8000, "==" * 9000, "x\n" * 9000):
        check(coder, library, text)
    big = "=" * (1 << 19) + " end"
    assert coder.decode(ids(coder.encode(big))) == big.encode()


def test_small_memos_and_no_cut_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_SEGMENTS", 3)
    monkeypatch.setattr(pieces, "MEMO_PAIRS", 3)
    fresh = pieces.Coder(pieces.read_model(PATH))
    text = "the quick brown fox jumped over the lazy dogs\n and the   quick foxes"
    assert ids(fresh.encode(text)) == library.encode(text)
    fresh.cut = None
    assert ids(fresh.encode(text)) == library.encode(text)


def test_other_models_are_refused(tmp_path):
    raw = open(PATH, "rb").read()
    for old, new in ((b"\x18\x02\x20\x80\xfa\x01", b"\x18\x01\x20\x80\xfa\x01"),):  # model type of the trainer settings
        assert raw.count(old) == 1
        (tmp_path / "m").write_bytes(raw.replace(old, new))
        with pytest.raises(ValueError):
            pieces.read_model(str(tmp_path / "m"))


def test_query_as_the_library(spark, library):
    from cupola.llm.queries import op13_pieces

    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = op13_pieces(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_edges_and_decode(spark, edge_docs, no_docs, library):
    enc = pieces.encode(edge_docs, PATH)
    got = sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in pieces.decode(enc, PATH).collect())
    assert got == sorted((r["doc_id"] or 0, library.decode(library.encode(r["text"] or ""))) for r in edge_docs.collect())
    clash = edge_docs.withColumnRenamed("n_chars", "decoded").withColumnRenamed("score", "text_key")
    assert pieces.digests(pieces.encode(clash, PATH, decoded=True)).count() == edge_docs.count()
    assert pieces.encode(no_docs, PATH, decoded=True).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r[1]) for r in pieces.decode(nulls, PATH).collect()] == [b"", b""]
