"""The registered queries of the training-data operators.

Each applies its operator with production parameters to its whole table and
derives the digest columns.  ORACLE_SQL holds DuckDB SQL where SQL can express
the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, hashing, html_crf, jaccard, packing, pii, quality, quantised, spelling, suffixes, toxicity, trie, warc
from quarry.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_crf.extract(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), 0.9)


@query
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), words=4, percent=85)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return bpe.decode(ids).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op8_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return hashing.search(rows, rows.where("vec_id % 50 = 0"), k=5)


@query
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.trim(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), threshold=50, form="digest")
    return out.withColumnRenamed("kept", "kept_sha256")


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return spelling.variants(spelling.words(docs, least_length=5, least_count=3, garble_every=97), factor=2)


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality.fit(docs, labels.where(~held_out))
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(*trie.rebuilt(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])))
