"""Readers for the input tables and the raw coupon view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Schema of a raw coupon record file (text columns are parsed later by normalise_coupons).
COUPON_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("coupon_id", T.StringType()),
        T.StructField("rate_raw", T.StringType()),
        T.StructField("distance", T.StringType()),
        T.StructField("date_received", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One parquet table; ``columns`` prunes the scan (ReadSchema)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_coupons(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = COUPON_SCHEMA,
                 header: bool = True, null_value: str | None = None) -> DataFrame:
    """Raw coupon records with an explicit schema (no inference pass over the data).

    By default text such as ``'null'`` stays text and ``normalise_coupons`` turns the
    missing tokens into NULL while it parses; ``null_value`` makes the CSV reader do
    it for every column. A field that does not fit a typed column becomes NULL;
    ``read_coupons_checked`` sets such records aside instead.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("mode", "PERMISSIVE").option("nanValue", "NaN")
        if null_value is not None:
            reader = reader.option("nullValue", null_value)
        return reader.csv(path)
    return reader.format(fmt).load(path)


def read_coupons_checked(spark: SparkSession, path: str, schema: T.StructType = COUPON_SCHEMA, header: bool = True,
                         null_value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of a coupon CSV file: ``bad`` has the text of every record that does not
    fit the schema (``record``: an id that is no number, missing or surplus fields).

    One pass over the file: the reader marks what it cannot parse, and both parts are written
    to folders of one table under the session's checkpoint folder, so counting either reads
    no CSV again. Their rows add up to the records of the file.
    """
    from cupola.session import table_path

    mark = "_corrupt_record"
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(mark, T.StringType())])) \
        .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", mark).option("nanValue", "NaN")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    out = table_path(spark)
    reader.csv(path).withColumn("_bad", F.col(mark).isNotNull()).write.partitionBy("_bad").parquet(out)
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(mark, T.StringType()), T.StructField("_bad", T.BooleanType())])).parquet(out)
    return table.where(~F.col("_bad")).drop(mark, "_bad"), table.where("_bad").select(F.col(mark).alias("record"))


def coupon_view(spark: SparkSession, sf_dir: str, extra_columns: tuple[str, ...] = ()) -> DataFrame:
    """Raw coupon records derived from ``lineitem`` (FIXTURES.md F4).

    Every line item becomes one issued coupon whose discount text cycles through
    the three formats (``a:b``, ``0.xx``, plain integer) plus the ``'null'`` token,
    whose date text alternates ``yyyyMMdd`` / ``yyyy-MM-dd``, and whose label is
    "returned" as a stand-in for "redeemed". Text is built from integers only.
    ``extra_columns`` carries further ``lineitem`` columns through unchanged.
    """
    base = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax",
            "l_shipdate", "l_returnflag"]
    li = read_table(spark, sf_dir, "lineitem", base + [c for c in extra_columns if c not in base])
    q = F.col("l_quantity").cast("bigint")
    ln4 = F.col("l_linenumber") % 4
    rate_raw = (
        F.when(ln4 == 0, F.concat((F.lit(10) * (q + 1)).cast("string"), F.lit(":"),
                                  (q * (F.col("l_partkey") % 9 + 1)).cast("string")))
        .when(ln4 == 1, F.concat(F.lit("0."), F.lpad((F.lit(99) - F.round(F.col("l_discount") * 100).cast("int"))
                                                      .cast("string"), 2, "0")))
        .when(ln4 == 2, (F.round(F.col("l_tax") * 100).cast("int") % 2).cast("string"))
        .otherwise(F.lit("null"))
    )
    date_raw = F.when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "yyyyMMdd")) \
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", rate_raw.alias("rate_raw"),
                     date_raw.alias("date_raw"), label.alias("label"), *extra_columns)


# DuckDB text of the same view, for oracle queries.
COUPON_VIEW_SQL = """
select l_orderkey, l_linenumber, l_partkey,
  case l_linenumber % 4
    when 0 then concat(cast(10*(1+cast(l_quantity as bigint)) as varchar), ':', cast(cast(l_quantity as bigint)*(1+l_partkey%9) as varchar))
    when 1 then concat('0.', lpad(cast(99-cast(round(l_discount*100) as int) as varchar), 2, '0'))
    when 2 then cast(cast(round(l_tax*100) as int) % 2 as varchar)
    else 'null' end as rate_raw,
  case when l_linenumber % 2 = 0 then strftime(l_shipdate,'%Y%m%d')
       else strftime(l_shipdate,'%Y-%m-%d') end as date_raw,
  case when l_returnflag='R' then 1 else 0 end as label
from lineitem
"""


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with missing values where the event carries none (FIXTURES.md F5):
    error events have no type and no value."""
    ev = read_table(spark, sf_dir, "events")
    is_error = F.col("event_type") == "error"
    return ev.select("event_id", "ts", "user_id",
                     F.when(~is_error, F.col("event_type")).alias("event_type"),
                     F.when(~is_error, F.col("value")).alias("value"), "props")


def events_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` plus a second copy of every click (duplicate records, FIXTURES.md F5)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.unionByName(ev.where(F.col("event_type") == "click"))


# Scores read off lineitem columns, one "model" per column (FIXTURES.md F7 schema).
LINEITEM_SCORE_COLUMNS = {"discount": "l_discount", "tax": "l_tax", "quantity": "l_quantity",
                          "price": "l_extendedprice"}


def lineitem_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long score table ``model, id, score, label`` with label = returned item.

    Discrete columns give heavy ties, the hard case for ROC and AUC; the price is
    nearly continuous, so its distinct scores spread over many score ranges."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", *LINEITEM_SCORE_COLUMNS.values(), "l_returnflag"])
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    scores = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score"))
                       for m, c in LINEITEM_SCORE_COLUMNS.items()])
    return li.select(F.col("l_orderkey").alias("id"), label.alias("label"), F.inline(scores)) \
        .select("model", "id", "score", "label")


def document_features(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Length features of whole texts: characters, words, distinct words, lines
    (``keep`` columns are carried through)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.split(F.trim(text), r"\s+")
    empty = F.trim(text) == ""
    return docs.select(
        "doc_id", *keep,
        F.col("n_chars").cast("double").alias("n_chars"),
        F.when(empty, F.lit(0)).otherwise(F.size(words)).cast("double").alias("n_words"),
        F.when(empty, F.lit(0)).otherwise(F.size(F.array_distinct(F.split(F.lower(F.trim(text)), r"\s+"))))
        .cast("double").alias("n_distinct_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
    )


DOC_FEATURES = ["n_chars", "n_words", "n_distinct_words", "n_lines"]


def labelled_documents(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """``labels`` joined to the length features of their documents (FIXTURES.md F6).

    The join comes first, so only labelled texts are split into words."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", F.col(target).alias("label")])
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    return document_features(labels.join(docs, "doc_id"), keep=("label",))
