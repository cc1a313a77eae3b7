"""Coupon records arriving as files: the same parsers on a Structured Streaming source.

``normalise_coupons`` is a stateless projection, so it applies to a streaming
DataFrame unchanged; the file sink with a checkpoint location gives exactly-once
output across restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cupola.operators.normalise import normalise_coupons


def normalise_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None, **normalise_args) -> DataFrame:
    """Streaming DataFrame of parsed coupons from files landing in ``source_dir``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    return normalise_coupons(reader.load(source_dir), **normalise_args)


def band_counts_stream(coupons: DataFrame, bands_per_unit: int = 10) -> DataFrame:
    """Running coupons / redeemed per discount band (state: one row per band)."""
    band = F.floor(F.col("discount_rate") * F.lit(bands_per_unit)).alias("band")
    return coupons.groupBy(band).agg(F.count(F.lit(1)).alias("n_coupons"),
                                     F.sum(F.col("label").cast("bigint")).alias("n_redeemed"))


def write_stream(df: DataFrame, path: str, checkpoint_location: str, fmt: str = "parquet",
                 output_mode: str = "append", trigger: dict | None = None,
                 query_name: str | None = None) -> StreamingQuery:
    """Start a sink; ``checkpoint_location`` must be on shared storage on a cluster."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if fmt not in ("memory", "console", "noop") else w.start()
