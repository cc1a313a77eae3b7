import math

import numpy as np
import pytest

from cupola.llm import whitening


def brute(vectors, k=8):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    c = (n * x - s).astype(object)
    cov = np.array([[float((c[:, i] * c[:, j]).sum() / n**3) for j in range(x.shape[1])] for i in range(x.shape[1])])
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return n, dev, (c / n).astype(float) @ w / np.sqrt(e), e / np.trace(cov)


def check(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component int, w string")
    live = [(r["vec_id"], r["embedding"]) for r in df.collect() if r["embedding"] and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    n, dev, want, explained = brute([v for _, v in live])
    got = whitening.whiten(df).collect()
    k = want.shape[1]
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], set()).add(r["whitened"])
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
    assert sorted({(i or 0, d) for i, d in by_id}) == sorted({(i or 0, d) for (i, _), d in zip(live, dev)})
    for c in range(k):
        sign = None
        for (i, _), d, w in zip(live, dev, want[:, c]):
            values = by_id[i, d][c + 1]
            assert len(values) == 1
            (v,) = values
            assert abs(v) == pytest.approx(abs(w), rel=1e-7, abs=1e-8)
            if abs(w) > 1e-6:
                sign = sign or np.sign(v * w)
                assert np.sign(v * w) == sign


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 12)) @ rng.normal(size=(12, 12))
    rows = [(i, [float(c) for c in v], 1, 2, "x") for i, v in enumerate(base)]
    rows = [(i, rows[3][1] if i % 3 == 0 else v, *r) for i, v, *r in rows]  # a third are one vector
    rows += [(i, v, *r) for i, v, *r in rows[:2]]
    rows += [(900, None, 1, 1, "x"), (901, [1.0, None] + [0.0] * 10, 1, 1, "x"), (902, [float("nan")] * 12, 1, 1, "x"),
             (903, [float("-inf")] * 12, None, None, None), (904, [], 1, 1, "x"), (None, [0.25] * 12, None, None, None)]
    check(spark, rows)
    monkeypatch.setattr(whitening, "ROWS", 7)
    check(spark, rows)


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(6)
    check(spark, [(i, [float(a), float(a + b)], 0, 0, "") for i, (a, b) in enumerate(rng.normal(size=(40, 2)))])


def test_large_values_are_summed_exactly():
    rng = np.random.default_rng(7)
    x = rng.integers(-(1 << 45), 1 << 45, (50, 3))
    q = [int(c) for c in x.sum(0) // 50]
    got = dict(whitening._squares(q)(x))
    y = x.astype(object) - np.array(q, object)
    assert got == {(i, j): int((y[:, i] ** 2).sum() if i == j else ((y[:, i] + y[:, j]) ** 2).sum()) for i in range(3) for j in range(i, 3)}
    assert dict(whitening._sums(x << 6)) == {(-1, -1): 50, **{(i, -1): int(x[:, i].astype(object).sum() << 6) for i in range(3)}}


def test_no_variance_other_lengths_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    got = whitening.whiten(spark.createDataFrame([(i, [0.5, 1.0]) for i in range(4)] + [(9, [1.0])], schema)).collect()
    assert len(got) == 8 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(4, 0, None, None, None)}
    got = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], schema)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in got)
    assert {r["component"]: r["explained"] for r in got} == {1: pytest.approx(1.0), 2: pytest.approx(0.0)}
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [0.0])], schema))


def test_query_on_the_table(spark):
    from cupola.llm.queries import op12_whitening

    d = "/root/testdata/sf0.001"
    rows = [r["embedding"] for r in spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()]
    n, dev, want, explained = brute(rows)
    got = op12_whitening(spark, d).orderBy("vec_id", "component").collect()
    assert [r["deviation"] for r in got[::8]] == dev and got[0]["n"] == n
    w = np.array([r["whitened"] for r in got]).reshape(-1, 8)
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-7 and got[0]["identity_error"] < 1e-4
    assert np.allclose([r["explained"] for r in got[:8]], explained, rtol=1e-9)
