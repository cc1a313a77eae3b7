"""One query per operator, with production parameters, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_text, jaccard, lines, merkle, pieces, quality, repeats, secrets, shards, topk, whitening
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_text.extract(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_frame", "n_restored", "n_marked")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lines.report(docs, lines.find(docs, per=lines.PER))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digests(jaccard.link(table(spark, sf_dir, "documents")))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents")).drop("spans")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.verify(merkle.build(table(spark, sf_dir, "documents"), tampered={"n_chars": more}))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encode(table(spark, sf_dir, "documents"), path, decoded=True))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_topk": op2_topk,
    "op3_html": op3_html,
    "op4_bpe": op4_bpe,
    "op5_lines": op5_lines,
    "op6_secrets": op6_secrets,
    "op7_decontaminate": op7_decontaminate,
    "op8_jaccard": op8_jaccard,
    "op9_shards": op9_shards,
    "op10_repeats": op10_repeats,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_pieces": op13_pieces,
}
