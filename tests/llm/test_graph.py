import random

import pytest
from pyspark.sql import functions as F

from cupola.llm import graph


@pytest.fixture
def many_partitions(spark):
    new = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


LINKS = [(1000, 1000 + i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 160)] + [(-3, 5), (5, -3), (7, 7)]


def test_few_links_do_not_cost_a_task_and_file_for_every_shuffle_partition(spark, many_partitions):
    got = graph.components(spark.createDataFrame(LINKS, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == brute([x for x in LINKS if x[0] != x[1]])
    assert len(got.inputFiles()) == 1


def test_rounds_of_several_tasks(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(graph, "TASK_ROWS", 100)
    rng = random.Random(4)
    links = LINKS + [(a, b) for a, b in ((rng.randrange(2000, 3000), rng.randrange(2000, 3000)) for _ in range(400)) if a != b]
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == brute([x for x in links if x[0] != x[1]])
    assert got.count() == got.select(F.col("node")).distinct().count()
    assert 1 < len(got.inputFiles()) <= 12
