"""Run a few operators twice in a session that retries failed tasks: once on clean
inputs, once on inputs whose tasks fail on their first attempt. Prints one JSON line.

usage: python tests/helpers/retry_run.py <sf_dir> <checkpoint_dir>
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cupola.operators import metrics as M  # noqa: E402
from cupola.operators import models as ML  # noqa: E402
from cupola.operators import timeline as TL  # noqa: E402
from cupola.sources.tables import lineitem_scores, read_table  # noqa: E402


def flaky(df):
    """Same rows; every task of this stage fails once before it succeeds."""

    def fn(batches):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    return df.mapInPandas(fn, df.schema)


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def main():
    sf_dir, ck = sys.argv[1], sys.argv[2]
    spark = (SparkSession.builder.master("local[4,4]").appName("cupola-retry")
             .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", ck).config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    scores = lineitem_scores(spark, sf_dir)
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type"])
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice", "l_returnflag"]) \
        .withColumn("label", (F.col("l_returnflag") == "R").cast("int")).drop("l_returnflag")
    emb = read_table(spark, sf_dir, "embeddings")
    counts = {"n": F.lit(1), "buys": (F.col("event_type") == "purchase").cast("int")}
    out = {}
    knn = {"knn": lambda m: ML.knn_neighbours(m, m, 3, id_col="vec_id", vec_col="embedding",
                                              exclude_self=True)}
    for name, fn in knn.items():
        clean = rows(fn(emb))
        retried = rows(fn(flaky(emb)))
        out[name] = {"rows": len(clean), "same": clean == retried}
    for name, fn in {
        "auc": lambda s, e, l: M.auc(s, n_buckets=16),
        "roc_points": lambda s, e, l: M.roc_points(s, n_buckets=16),
        "prior_features": lambda s, e, l: TL.prior_features(e, ["user_id"], "ts", "event_id", counts,
                                                            max_bucket_rows=50),
        "stump_search": lambda s, e, l: ML.stump_search(l, ["l_quantity", "l_extendedprice"], "label",
                                                        n_buckets=16),
    }.items():
        clean = rows(fn(scores, ev, li))
        retried = rows(fn(flaky(scores), flaky(ev), flaky(li)))
        out[name] = {"rows": len(clean), "same": clean == retried}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
