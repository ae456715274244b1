"""All-text CSV scan and write.

The original reads every cell as text and keeps blank cells as ``''``.
Spark's CSV reader turns an unquoted empty field into null, so the scan maps
null back to ``''`` (the ``nullValue`` is set to a character that never
occurs, so no real text is turned into null).  Missing input raises a clear
error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.dedupe import row_position
from quarry.session import hand_off


class MissingInputError(FileNotFoundError):
    pass


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _options(reader):
    return (reader.option("header", True).option("nullValue", "\u0000").option("emptyValue", "")
            .option("multiLine", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def keep_blanks(df: DataFrame) -> DataFrame:
    """Blank cells are '' however the file quotes them."""
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                  keep_blank: bool = True) -> DataFrame:
    """Header CSV, every column text, matched by the header's names: all of
    the file's columns, or ``columns`` of them in that order (a name that the
    header lacks is an error).  Files of one path share a header."""
    try:
        df = _options(spark.read).option("inferSchema", False).csv(path)
    except AnalysisException as e:
        raise _read_error(e, path) from e
    df = df.select(*[F.col(f"`{c}`") for c in _known(df, columns, path)])
    return keep_blanks(df) if keep_blank else df


def _known(df: DataFrame, columns: list[str] | None, path: str) -> list[str]:
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"'{path}' has no column {', '.join(missing)}")
    return columns or df.columns


def _read_error(e: AnalysisException, path: str) -> Exception:
    """A missing path under its own name; anything else as it is."""
    return MissingInputError(f"input not found at '{path}'") if e.getCondition() == "PATH_NOT_FOUND" else e


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, or a table of ``schema`` without rows
    where there is none yet: what a dashboard shows before the first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_numbered_csv(spark: SparkSession, path: str, columns: list[str] | None = None, name: str = "row_order") -> DataFrame:
    """The cells of ``read_text_csv`` with the rows' order in the input: files
    by name, blocks of a file by their start, rows of a block as they stand.

    A block is read by one task from its first row to its last, so numbers that
    rise with the rows of a task order its rows; numbers of different tasks are never
    compared.  The dense number comes from range-partitioned rows, so it is the
    same however the blocks are dealt to tasks.  Cells stay as read."""
    try:
        df = _options(spark.read).option("inferSchema", False).csv(path)
    except AnalysisException as e:
        raise _read_error(e, path) from e
    names = _known(df, columns, path)
    placed = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names], F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    return row_position(hand_off(placed, "numbered"), ["_file", "_block", "_row"], name).drop("_file", "_block", "_row")


def stream_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The same cells from a stream of files.  A stream needs its schema
    beforehand, so the files' headers must be ``columns`` in this order; other
    headers fail the query."""
    return keep_blanks(_options(spark.readStream).option("enforceSchema", False).schema(text_schema(columns)).csv(path))


def write_text_csv(df: DataFrame, path: str) -> None:
    """Header CSV, all columns as text; empty strings are written quoted so
    they survive the round trip as ''."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (out.write.mode("overwrite").option("header", True).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
