"""Types of text columns from their values: all rows, one aggregation, no sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.casts import CASTS
from ordermart.sources.files import read_csv

# How values of a type are written. Text that is a number only to some readers (blanks around it, NaN, 1d) is no number.
INTEGER = r"^[+-]?[0-9]+\z"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?\z"
# From the narrowest type to the widest. A column has the first one that holds all its values; "null" is the type of a
# column without any, and text holds everything. Dates and numbers together are text.
LATTICE = ["null", "int", "bigint", "double", "timestamp_ntz", "string"]


def _type(c: Column) -> Column:
    """The type of a column of text, as an aggregate; it merges over partitions, so every row counts."""

    def all_are(kind: Column) -> Column:
        return F.bool_and(F.when(c.isNotNull(), kind))

    integer = c.rlike(INTEGER)
    return (
        F.when(F.count(c) == 0, "null")
        .when(all_are(integer & c.try_cast("int").isNotNull()), "int")
        .when(all_are(integer & c.try_cast("bigint").isNotNull()), "bigint")
        .when(all_are(c.rlike(NUMBER)), "double")
        .when(all_are(c.rlike(TIMESTAMP) & c.try_cast("timestamp_ntz").isNotNull()), "timestamp_ntz")
        .otherwise("string")
    )


def infer_types(df: DataFrame) -> DataFrame:
    """(position, column_name, type, n_rows, n_nulls) of each column, in the order of the columns, which count from 1.

    Columns that are not text are looked at as the text they are written as. An empty table has columns of type "null".
    """
    # By position, as column names may clash or hold dots.
    text = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    found = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            _type(F.col(f"_{i}")).alias("type"),
            F.count("*").alias("n_rows"),
            (F.count("*") - F.count(f"_{i}")).alias("n_nulls"),
        )
        for i, name in enumerate(df.columns)
    ]
    return text.agg(F.array(*found).alias("found")).select(F.inline("found"))


def read_csv_inferred(spark: SparkSession, path: str, table: str, multiline: bool | None = None) -> DataFrame:
    """A table from CSV files with the types its values have; the files are read once for the types and once for the rows.

    The driver receives a row per column. A column without values stays text, as nothing is known of it.
    """
    text = read_csv(spark, path, table, types={}, multiline=multiline)
    kinds = {r["column_name"]: r["type"] for r in infer_types(text).collect()}
    casts = CASTS | {"bigint": lambda c: c.cast("bigint"), "null": CASTS["string"]}
    return text.withColumns({c: casts[kind](F.col(c)) for c, kind in kinds.items()})
