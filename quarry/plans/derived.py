"""Derived tables SR / SC / SL / BK.

Like the original pipeline, whose stages hand off through files (dirty CSV ->
clean CSV -> models), each derived table is written once per session as a
parquet table under the shared checkpoint folder (``spark.checkpoint.dir``)
and read back by the later stages.  This cuts lineage (an executor loss
re-reads the written table instead of recomputing the chain) and keeps each
query's plan small.  ``*_plan`` functions give the lazy, unmaterialised plans.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.bands import transaction_items
from quarry.functions.scoring import with_recommended_track
from quarry.plans.clean import clean_students
from quarry.session import ensure_checkpoint_dir
from quarry.sources.fixtures import raw_students

_WRITTEN: set[str] = set()


def store_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    """Where this session keeps a derived table of ``sf_dir``."""
    tag = hashlib.sha1(f"{spark.sparkContext.applicationId}|{sf_dir.rstrip('/')}".encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/derived/{name}-{tag}"


def materialize(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """Write ``build()`` once per session to the shared folder; read it back."""
    path = store_path(spark, name, sf_dir)
    if path not in _WRITTEN:
        build().write.mode("overwrite").parquet(path)
        _WRITTEN.add(path)
    return spark.read.parquet(path)


def sr_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_students(spark, sf_dir)


def sr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dirty students (written once, like the original dirty CSV)."""
    return materialize(spark, "sr", sf_dir, lambda: sr_plan(spark, sf_dir))


def sc_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full cleaning job over SR (keeps ``row_order`` last)."""
    return clean_students(sr(spark, sf_dir))


def sc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean students (written once, like the original clean CSV)."""
    return materialize(spark, "sc", sf_dir, lambda: sc_plan(spark, sf_dir))


def label_students(clean: DataFrame) -> DataFrame:
    """SL: add ``recommended_track`` from the deterministic scoring rule."""
    return with_recommended_track(clean)


def sl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(spark, "sl", sf_dir, lambda: label_students(sc(spark, sf_dir)))


def baskets(labelled: DataFrame) -> DataFrame:
    """BK: one 11-item basket per labelled student."""
    return labelled.select("student_id", "row_order", transaction_items().alias("items"))


def bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets(sl(spark, sf_dir))


def without_order(df: DataFrame) -> DataFrame:
    return df.drop("row_order")


def sorted_list(c) -> F.Column:
    """Order-insensitive text form of a list column (for exact checks)."""
    return F.concat_ws("|", F.array_sort(c))
