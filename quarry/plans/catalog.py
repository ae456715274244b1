"""Registry of the query keys exposed through ``__spark_entry__.queries()``.

Every query reads the driver tables (or tables Spark derives from them) in
full; there are no id subsets or row caps except where a limit is the
feature itself (top-k rule tables).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["clean_students"](spark, sf_dir)


# Importing the query modules fills QUERIES.
from quarry.plans import (q_clean, q_quality, q_rules, q_ml, q_advise)  # noqa: E402,F401
