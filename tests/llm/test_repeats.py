import hashlib
import random
from collections import Counter

import numpy as np

from cupola.llm import repeats


def brute(rows, w=200):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(x[i : i + w] for _, x in data for i in range(len(x) - w + 1))
    out = Counter()
    for d, x in data:
        gone = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - w + 1):
            if seen[x[i : i + w]] > 1:
                gone[i : i + w] = True
        gone[-1] = False
        spans = int(np.sum(gone & ~np.append(False, gone[:-1])))
        kept = bytes(np.frombuffer(x, np.uint8)[~gone[:-1]]) if x else b""
        out[d, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def check(docs):
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = Counter(tuple(r)[:5] for r in repeats.remove(docs).collect())
    assert got == want, list((got - want).items())[:3] + list((want - got).items())[:3]
    return want


def test_given_documents(spark):
    want = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert sum(k[2] > 0 for k in want) > 3


def texts(seed, n):
    rng = random.Random(seed)
    rand = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    pool = [rand(rng.choice([199, 200, 201, 260, 700])) for _ in range(6)] + ["x" * 450, "ab" * 300, "abc def " * 60]
    return [(i, "".join(rng.choice([rand(rng.randint(0, 300)), rng.choice(pool), rng.choice(pool)[rng.randint(0, 99) :]]) for _ in range(rng.randint(0, 5)))) for i in range(n)]


def test_passages_runs_and_periods(spark):
    check(spark.createDataFrame(texts(1, 150), "doc_id long, text string"))


def test_small_blocks_and_batches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 128)
    for k, v in {"ROWS": 3, "PACK": 20, "CONTEXT_BYTES": 3000, "BUCKET_BYTES": 2000}.items():
        monkeypatch.setattr(repeats, k, v)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark.createDataFrame(texts(2, 80), "doc_id long, text string"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_edges(spark, edge_docs, no_docs):
    check(edge_docs)
    twice = spark.createDataFrame([(1, "q" * 199), (1, "z y" * 100), (1, "z y" * 100), (None, "z y" * 100)], "doc_id long, text string")
    check(twice)
    assert repeats.remove(no_docs).count() == 0
