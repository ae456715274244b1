"""Row-level cleaning over a stream of raw record files.

The original has no streaming; its per-cell parsers are stateless, so they run
unchanged on a streaming DataFrame.  What needs the whole table (medians,
keep-first dedupe) is not done here: a stream of raw CSV files is parsed
and the typed rows are appended to a parquet sink, with the checkpoint in
the shared checkpoint folder so a restarted query resumes exactly once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.numeric import nullify_outside
from quarry.functions.text import literal_nan_to_null, normalize_id, parse_gpa, parse_grade, standardize_category
from quarry.session import ensure_checkpoint_dir
from quarry.sources.csv_text import stream_text_csv

RAW_COLUMNS = ["row_order"] + [c for c in C.RAW_ORDER if c != "recommended_track"] + ["extra_info"]


def parse_rows(df: DataFrame) -> DataFrame:
    """Stateless part of the cleaning job (works on batch and streaming)."""
    cols = [c for c in df.columns if c != "row_order"]
    df = df.select(F.col("row_order").cast("long").alias("row_order"),
                   *[literal_nan_to_null(c).alias(c) for c in cols])
    return df.select(
        "row_order",
        normalize_id("student_id").alias("student_id"),
        nullify_outside(parse_gpa("gpa"), *C.GPA_RANGE).alias("gpa"),
        *[nullify_outside(parse_grade(g), *C.GRADE_RANGE).alias(g) for g in C.GRADE_COLS],
        standardize_category("interest").alias("interest"))


def start_stream_parse(spark: SparkSession, input_dir: str, output_dir: str,
                       available_now: bool = True, name: str = "raw-parse"):
    """Start the streaming parse: CSV files (all text, header) -> parquet."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    src = stream_text_csv(spark, input_dir, RAW_COLUMNS)
    q = (parse_rows(src).writeStream.format("parquet").option("path", output_dir)
         .option("checkpointLocation", ckpt).outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    return q.start()
