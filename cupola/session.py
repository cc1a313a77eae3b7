"""Session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cupola") -> SparkSession:
    """Session for tests and the bench. On a cluster, build your own session and
    pass it in; nothing here is required by the operators."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``, or one already set on the
    context). Only a local-mode session with nothing configured gets a fresh
    temporary folder; a cluster session without the setting is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cupola-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before running")
    return sc._jsc.sc().getCheckpointDir().get()


def materialise(df):
    """Write ``df`` once as a parquet table under the shared checkpoint folder and
    read it back: cuts the lineage (reliably, unlike ``localCheckpoint``) so that a
    table read by several jobs is computed once.

    A table rather than ``checkpoint()``: the rows are computed by one job (a
    reliable checkpoint computes them a second time to write its files unless they
    are cached, and a cached plan keeps every shuffle partition, since adaptive
    execution may not coalesce it), and the read-back is an ordinary scan with
    column pruning, pushed filters and measured size. Written files are committed
    per task, so a retried task leaves no partial output.
    """
    path = table_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Free the disk that shuffles of finished steps hold.

    Spark deletes a shuffle's files when the driver's collector finds that no plan refers to
    them any more, which may be long after the step; this asks the collector to look now.
    """
    spark._jvm.System.gc()


_TABLES: list[str] = []


def table_path(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder, which ``drop_tables`` will delete."""
    import uuid

    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    _TABLES.append(path)
    return path


def drop_tables(spark: SparkSession) -> int:
    """Delete the folders that ``table_path`` has given in this process (all tables of
    ``materialise`` among them) and return how many there were.

    To be called when the results that read them have been written or are no longer needed.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _TABLES:
        path = jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
