import random
import re

from cupola.llm import decontaminate

WORD = re.compile(r"[^ \t-\r]+")


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items, threshold=0.75):
    out = set()
    for d, t in docs:
        s = shingle_set(t)
        for i, u in items:
            q = shingle_set(u)
            if q and len(q & s) >= threshold * len(q) - 1e-9:
                out.add((d, i, len(q), len(q & s)))
    return out


def found(docs, items, threshold=0.75):
    got = decontaminate.find(docs, items, threshold).select("doc_id", "item_id", "n_item", "n_shared").collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split())
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(30)]
    docs = []
    for d in range(200):
        parts = [word() for _ in range(rng.randint(0, 300))]
        if d % 3 == 0:
            w = items[rng.randrange(30)][1].split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = "CHANGED"
            at = rng.randint(0, len(parts))
            parts[at:at] = w
        docs.append((d, " \n".join(parts)))
    for threshold in (0.5, 0.75, 1.0):
        want = brute(docs, items, threshold)
        assert want and found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), threshold) == want


def test_given_tables(spark):
    d = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(docs, items) == want
    leaking = {w[0] for w in want}
    kept = {r[0] for r in decontaminate.clean(docs, items).select("doc_id").collect()}
    assert kept == {r[0] for r in docs.select("doc_id").collect()} - leaking


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "Plain text of a few words"), (2, None), (3, ""), (4, "four words are short"), (5, "no id at all but with"), (5, "no id at all but with")], "item_id long, text string")
    assert found(edge_docs, items) == {(1, 1, 2, 2), (4, 1, 2, 2), (None, 5, 2, 2)}
    kept = decontaminate.clean(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 4
    assert found(no_docs, items) == set() and found(edge_docs, items.limit(0)) == set()
    assert decontaminate.clean(edge_docs, items.limit(0)).count() == edge_docs.count()
