import itertools
import random
import zlib
from collections import defaultdict

from cupola.llm import shards


def test_differencing_is_near_the_best():
    rng = random.Random(4)
    for _ in range(20):
        sizes = [rng.randint(1, 30) for _ in range(8)]
        got = shards.differencing(sizes, 3)
        load = lambda a: max(sum(s for s, k in zip(sizes, a) if k == j) for j in range(3))
        best = min(load(a) for a in itertools.product(range(3), repeat=8))
        assert load(got) <= best * 1.2
    assert shards.differencing([], 8) == [] and shards.differencing([5], 8) == [0]


def check(spark, docs, items=4096, n=8):
    rows = docs.select("doc_id", "text").collect()
    got = shards.assign(docs, n, items=items).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted(
        (d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        where[r["size"], r["text_crc32"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())  # equal texts stay together
    loads = [sum(r["size"] for r in got if r["shard"] == k) for k in range(n)]
    groups = defaultdict(int)
    for r in got:
        groups[r["size"], r["text_crc32"]] += r["size"]
    return loads, max(groups.values(), default=0)


def test_bytes_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for items, off in ((64, 0.01), (4096, 0.0001)):
        loads, _ = check(spark, docs, items)
        assert max(loads) - min(loads) <= sum(loads) * off


def test_one_group_with_a_third_of_the_rows(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('hot ', 40), repeat(concat('t', id, ' '), cast(id % 50 as int))) as text")
    loads, hot = check(spark, docs, 128)
    rest = sorted(loads)[:-1]
    assert max(loads) == max(hot, max(rest)) and max(rest) - min(rest) <= sum(rest) * 0.02


def test_edges(spark, edge_docs, no_docs):
    check(spark, edge_docs)
    assert shards.assign(no_docs).count() == 0
