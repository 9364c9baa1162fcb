"""CSV files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators.convert import convert_types
from ordermart.schemas import COLUMN_TYPES

# Review comments contain line breaks inside quotes; such a file cannot be split for reading, so one file is one
# task. Large deliveries must come as many files, or be landed as parquet once.
MULTILINE = {"reviews"}
# Blanks at the ends of a field belong to it.
QUOTING = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Text for null where null and empty text must stay apart.
NULL_TEXT = "\\N"


def read_csv(
    spark: SparkSession,
    path: str,
    table: str,
    types: dict[str, str] = COLUMN_TYPES,
    multiline: bool | None = None,
    null_text: str = "",
) -> DataFrame:
    """A source table from CSV files with a header; columns that are not declared stay as text.

    Fields are read as text and then converted by the column rules, so a bad timestamp or integer
    becomes null and a bad number is an error. Only the header is looked at before the job runs.
    """
    multiline = table in MULTILINE if multiline is None else multiline
    df = spark.read.csv(path, header=True, multiLine=multiline, encoding="UTF-8", nullValue=null_text, **QUOTING)
    return convert_types(df, types)


def write_csv(df: DataFrame, path: str, null_text: str = "", compression: str = "none") -> str:
    """Part files with a header each; no row number column.

    By default null is an empty field, as is empty text; another ``null_text`` keeps them apart.
    Compressed files are read like plain ones, each by one task; a file per task that writes keeps them even.
    """
    text = {"timestamp", "timestamp_ntz"}
    out = df.select(*[F.col(c).cast("string").alias(c) if t in text else F.col(c) for c, t in df.dtypes])
    out.write.mode("overwrite").csv(path, header=True, nullValue=null_text, emptyValue='""' if null_text else "", compression=compression, **QUOTING)
    return path


def read_csv_as(spark: SparkSession, path: str, like: DataFrame, null_text: str = NULL_TEXT) -> DataFrame:
    """What ``write_csv`` wrote, with the types of ``like``; line breaks inside fields are kept."""
    back = spark.read.schema(like.schema).csv(path, header=True, multiLine=True, nullValue=null_text, emptyValue="", **QUOTING)
    return back.select(*like.columns)
