import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from cupola.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(level, fanout):
    """All levels above ``level``, by the definition."""
    levels = [level]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h(*x[k : k + fanout]) for k in range(0, len(x), fanout)])
    return levels


def refold(levels, at, digest, fanout):
    proof = ""
    for x in levels[:-1]:
        k = at // fanout * fanout
        run = x[k : k + fanout]
        proof += "".join(run[: at - k] + run[at - k + 1 :])
        digest = h(*run[: at - k], digest, *run[at - k + 1 :])
        at //= fanout
    return digest, proof


def brute(rows, fanout, hit):
    by_lang, out = {}, []
    for r in rows:
        d, text, lang, source, n = r[:5]
        leaf = h(*map(enc, (d, source, lang, n, text)))
        bad = h(*map(enc, (d, source, lang, n + 1, text))) if n is not None and hit(d) else leaf
        by_lang.setdefault(lang, []).append((d is not None, d or 0, leaf, bad, d))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: climb([r[2] for r in sorted(by_lang[x])], fanout) for x in langs}
    top = climb([trees[x][-1][0] for x in langs], fanout)
    for g, x in enumerate(langs):
        for i, (_, _, leaf, bad, d) in enumerate(sorted(by_lang[x])):
            now, proof = refold(trees[x], i, bad, fanout)
            now, more = refold(top, g, now, fanout)
            out.append((d, leaf, trees[x][-1][0], top[-1][0], h(proof + more), now, now == top[-1][0]))
    return sorted(out, key=str)


def hit(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 0


def run(docs, **how):
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(crc, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.build(docs, tampered={"n_chars": more}, **how)


def check(docs, fanout=2, depth=None):
    got = merkle.verify(run(docs, fanout=fanout, depth=depth)).collect()
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, fanout, hit)


def test_edges(spark, edge_docs, no_docs):
    check(edge_docs, 3, 1)
    assert run(no_docs).root is None and merkle.verify(run(no_docs)).count() == 0
    clash = edge_docs.withColumns({c: F.lit(1) for c in ("pos", "key", "digest", "id", "row", "block", "path", "part", "n")})
    check(clash)
    check(edge_docs.limit(1))
    with pytest.raises(ValueError):
        merkle.build(edge_docs, fanout=1)


def test_many_blocks_and_groups_as_the_definition(spark):
    rng = random.Random(2)
    lang = lambda i: "hot" if i % 3 else rng.choice(["a", "ä", "z", None, "Z", ""])
    rows = [(i, f"text {i}" * (i % 5), lang(i), None if i % 11 == 0 else "s", None if i % 13 == 0 else i) for i in range(700)]
    rows += [(-5, "negative", "one row", "s", 1)] + [(7, "same", "a", "s", 7)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for fanout, depth in ((2, 3), (5, 2)):
        check(docs, fanout, depth)
    many = spark.range(300).selectExpr("id as doc_id", "'x' as text", "cast(id as string) as lang", "'s' as source", "1L as n_chars")
    check(many, 2, 3)


def test_paths_fold_to_the_root_without_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = run(docs, fanout=3, depth=2)
    for r in merkle.fold(m).collect():
        now = r["leaf"]
        for left, right in (s.split(",") for s in r["path"].split(";")):
            now = h(left, now, right)
        assert now == m.root
        assert r["proof_sha256"] == h(r["path"].replace(",", "").replace(";", ""))


def test_states_before_slots():
    p = merkle.Parent([b"a", b"b", b"c"])
    assert p.digest.decode() == h("abc")
    assert [p.fold(i, b"x").decode() for i in range(3)] == [h("xbc"), h("axc"), h("abx")]
    assert [s.hexdigest() for s in p.states] == [h(""), h("a"), h("ab")]


def test_sql_on_edges(spark, edge_docs):
    from cupola.llm.oracle_sql import SQL

    con = duckdb.connect()
    con.register("documents", edge_docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    want = con.execute(SQL["op11_merkle"]).fetchall()
    got = merkle.verify(run(edge_docs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
