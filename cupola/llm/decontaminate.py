"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is found in a document when the document holds at least ``threshold`` of the
item's distinct five-word shingles. Shingles are hashed; the MinHash signature of an item of
``n`` shingles is its ``n - ceil(threshold * n) + 1`` smallest hashes. A document that holds
enough of the item misses fewer shingles than that, so it holds at least one hash of the
signature: nothing is lost, whatever the sizes.

Items are partitioned by size (powers of two). Each partition has the least number of
shingles that a document must have to hold one of its items, and the largest hash that any
of its signatures uses. A document's own signature is its hashes up to the largest hash of
the partitions it is big enough for: as many of its smallest hashes as these items need, a
number that follows the document's size, and the same hashes that the items have chosen.
Hashes that meet give candidate pairs; for these, the shingles themselves are compared.

Words are runs of characters other than ASCII white space, with A-Z in lower case. Only
DataFrame functions run here.

Edge cases: null text counts as empty and holds nothing; an item with fewer than five words
has no shingle and is found nowhere; null ids are kept as null; repeated rows (same id and
text) give one row per item; repeated items are each reported; an empty table on either side
gives no rows; only id and text are read, so extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cupola.session import materialise

from .common import text_key

WORDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text in ASCII lower case."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[ \t-\r]+"), "")


def _over_shingles(w: str, make) -> Column:
    """``make([five word columns])`` for each place of the array column ``w`` where five words start."""
    n = F.size(w) - (WORDS - 1)
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: make([F.get(F.col(w), i + k) for k in range(WORDS)]))
    return F.when(n > 0, each)


def hashes(w: str) -> Column:
    return _over_shingles(w, lambda five: F.xxhash64(*five))


def shingles(w: str) -> Column:
    return F.array_distinct(_over_shingles(w, lambda five: F.concat_ws(" ", *five)))


def find(docs: DataFrame, items: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows ``(id, h1, h2, item, n_item, n_shared, containment)``: items found in documents;
    ``h1, h2`` name the document's text."""
    h1, h2 = text_key(text_col)
    least = F.ceil(F.lit(threshold) * F.col("n_item") - F.lit(1e-9)).cast("int")
    wanted = materialise(
        items.select(F.col(item_col).alias("item"), words(F.col(item_text)).alias("w"))
        .select("item", shingles("w").alias("of_item"), F.array_sort(F.array_distinct(hashes("w"))).alias("hs"))
        .where(F.col("of_item").isNotNull())
        .withColumn("n_item", F.size("of_item"))
        .withColumn("least", least)
        .withColumn("signature", F.slice("hs", F.lit(1), F.col("n_item") - F.col("least") + 1))
        .drop("hs")
    )
    # one row per power of two of the item size: at most 31 rows
    parts = (
        wanted.groupBy(F.floor(F.log2("n_item")).alias("size_class"))
        .agg(F.min("least").alias("least"), F.max(F.element_at("signature", -1)).alias("upto"))
        .orderBy("least")
        .collect()
    )
    upto, bound = None, -(1 << 63)
    for p in parts:  # partitions with larger items come later and need larger documents
        bound = max(bound, p["upto"])
        upto = _step(upto, p["least"], bound)
    src = docs.select(F.col(id_col).alias("doc"), h1.alias("h1"), h2.alias("h2"), F.col(text_col).alias("t"))
    if upto is None:
        upto = F.lit(None).cast("long")
    signed = (
        src.select("doc", "h1", "h2", words(F.col("t")).alias("w"))
        .withColumn("n_words", F.size("w"))
        .withColumn("upto", upto)
        .where(F.col("upto").isNotNull())
        .select("doc", "h1", "h2", hashes("w").alias("hs"), "upto")
        .select("doc", "h1", "h2", F.explode(F.filter("hs", lambda h: h <= F.col("upto"))).alias("h"))
    )
    meet = wanted.select("item", F.explode("signature").alias("h"))
    pairs = materialise(signed.join(meet, "h").select("doc", "h1", "h2", "item").distinct())
    named = pairs.select("doc", "h1", "h2").distinct().select(F.col("doc").alias("d"), F.col("h1").alias("a"), F.col("h2").alias("b"))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    texts = (
        src.join(named, same, "left_semi")
        .select("doc", "h1", "h2", words(F.col("t")).alias("w"))
        .select(F.col("doc").alias("d"), F.col("h1").alias("a"), F.col("h2").alias("b"), shingles("w").alias("of_doc"))
    )
    shared = F.size(F.array_intersect("of_item", "of_doc"))
    return (
        pairs.join(texts, same)
        .join(wanted.select("item", "of_item", "n_item", "least"), "item")
        .select("doc", "h1", "h2", "item", "n_item", shared.alias("n_shared"), "least")
        .where(F.col("n_shared") >= F.col("least"))
        .groupBy("doc", "h1", "h2", "item")
        .agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
        .withColumnsRenamed({"doc": id_col, "item": item_col})
    )


def _step(upto: Column | None, least: int, bound: int) -> Column:
    """Largest hash a document of this many words uses, extended by one size partition."""
    here = F.when(F.col("n_words") - (WORDS - 1) >= least, F.lit(bound).cast("long"))
    return here if upto is None else F.coalesce(here, upto)


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item is found."""
    found = find(docs, items, threshold, id_col, text_col).select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2")).distinct()
    h1, h2 = text_key(text_col)
    return docs.join(found, (h1 == F.col("__h1")) & (h2 == F.col("__h2")), "left_anti")
