"""The corpus pipeline: filter, deduplicate, trim, pseudonymise and pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All but the last return the
columns of documents.  Defined cases beyond the operators' own: a null doc_id
links with nothing and stays; repeated rows are one group, of which one stays;
a null text is empty behind the suffix stage; a text that the suffix stage
empties stays as an empty document.  Columns beside doc_id and text pass every
stage as they are, whatever their names; only n_chars follows the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import jaccard, packing, pii, suffixes, toxicity
from quarry.llm.common import handoff
from quarry.sources.tables import read_table

#: Up to so many removed ids (8 bytes each) are broadcast, more are joined.
BROADCAST_IDS = 2_000_000


def _like(docs: DataFrame, out: DataFrame) -> DataFrame:
    """``out`` with the columns of ``docs`` and n_chars of its text."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage's rows with the columns of ``docs``: while it runs, those
    beside doc_id and text have names that no operator uses."""
    plain = {c: c if c in ("doc_id", "text") else f"__column{i}" for i, c in enumerate(docs.columns)}
    out = stage(docs.select(*[F.col(f"`{c}`").alias(x) for c, x in plain.items()]))
    return out.select(*[F.col(x).alias(c) for c, x in plain.items()])


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return _apart(docs, lambda d: toxicity.score(d, model).where("score < 0.5"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingle sets linked at 0.8."""
    rows, ids = docs.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    key = "doc_id"
    if rows != ids:  # an id that repeats can't name a row
        key = "__row"
        docs = handoff(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")
    removed = handoff(jaccard.components(docs, words=5, percent=80, key=key).where("doc_id <> component_id").select(F.col("doc_id").alias(key)), "pipeline-removed")
    if key == "__row":  # rows without an id stay
        removed = docs.where("doc_id is not null").join(removed, key, "left_semi").select(key)
    side = F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed
    return docs.join(side, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns if c != "__row"])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; of a
    character that is cut in part nothing stays."""
    def trimmed(plain: DataFrame) -> DataFrame:
        return suffixes.trim(plain, threshold=50, form="text").withColumnRenamed("kept", "text")

    return _like(docs, _apart(docs, trimmed))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal numbers, dates and addresses."""
    return _like(docs, _apart(docs, pii.pseudonymise))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token sequences; see packing.pack."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_filter),
    ("ngram_jaccard", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("pii", pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: Not expressible in SQL: a trained classifier, BPE tokens, keyed permutations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = handoff(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
