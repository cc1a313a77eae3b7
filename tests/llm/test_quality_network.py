import zlib

from cupola.llm import quality

D = "/root/testdata/sf0.1"


def auc(pairs):
    order = sorted(pairs)
    ones = sum(y for _, y in order)
    rank = sum(i + 1 for i, (_, y) in enumerate(order) if y)
    return (rank - ones * (ones + 1) / 2) / (ones * (len(order) - ones))


def test_held_out_accuracy(spark):
    from cupola.llm.queries import op1_quality

    got = op1_quality(spark, D).join(spark.read.parquet(f"{D}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [(r["score"], r["quality"]) for r in got if r["held_out"]]
    assert auc(held) > 0.99
    assert sum((s >= 0.5) == y for s, y in held) / len(held) > 0.97


def test_score_does_not_depend_on_chunking(spark):
    net = quality.Network()
    text = ("Some clean words, here and there. " * 400 + "LOUD!! WORDS!! " * 5 + "quiet again. " * 700).encode()
    whole, _ = net.pooled(text)
    old = quality.CHUNK
    try:
        quality.CHUNK = 512
        assert abs(net.pooled(text)[0][:-1] - whole[:-1]).max() < 1e-5
    finally:
        quality.CHUNK = old
    before = net.score(text)
    net.prepare()
    assert abs(net.score(text) - before) < 1e-5


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (5, None, 0), (None, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    net = quality.fit(edge_docs, labels)
    got = quality.score(edge_docs, net).collect()
    assert len(got) == edge_docs.count()
    assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert quality.score(no_docs, net).count() == 0
    assert quality.fit(no_docs, labels).score(b"x") == 0.5
    kept = quality.keep(edge_docs, quality.Constant(0.5))
    assert kept.schema == edge_docs.schema and kept.count() == edge_docs.count()
    assert quality.keep(edge_docs, quality.Constant(0.4)).count() == 0


def test_a_long_text_does_not_end_the_sample(spark):
    from pyspark.sql import functions as F

    from cupola.llm.common import bounded_rows

    rows = [(i, "a few words") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = [r[0] for r in docs.orderBy(F.xxhash64(F.lit(11), "doc_id")).collect()]
    docs = docs.withColumn("text", F.when(F.col("doc_id") == order[0], F.repeat(F.lit("x"), 500)).otherwise(F.col("text")))
    assert [tuple(r) for r in bounded_rows(docs, "doc_id", "text", [], 50, 400)] == sorted((i, "a few words") for i in order[1:])
    assert len(bounded_rows(docs.unionByName(docs), "doc_id", "text", [], 50, 100)) == 9
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    assert isinstance(quality.fit(docs, labels, max_bytes=800), quality.Network)
