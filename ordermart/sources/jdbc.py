"""Relational tables over JDBC. The caller gives url, driver and credentials; none are kept here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.columns import nan_to_null, sanitize_columns
from ordermart.operators.keys import surrogate_key

ID = "id"
CHUNK = 100_000  # copies of one row that one task writes out at a time; more are dealt to several tasks, none is lost


def scan_options(table: str, bounds: tuple[int, int] | None, partitions: int, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options. With bounds of the id column the scan runs as that many range queries.

    Bounds only shape the ranges: rows outside of them are read too.
    """
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if bounds:
        low, high = bounds
        options |= {
            "partitionColumn": ID,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def id_bounds(spark: SparkSession, connection: dict[str, str], table: str) -> tuple[int, int] | None:
    """Smallest and largest id, computed by the database; None for an empty table."""
    query = f"SELECT MIN({ID}) AS low, MAX({ID}) AS high FROM {table}"
    row = spark.read.format("jdbc").options(**connection, query=query).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def read_jdbc(spark: SparkSession, connection: dict[str, str], table: str, partitions: int = 32) -> DataFrame:
    """A whole table without its technical id, read in parallel ranges of that id."""
    options = scan_options(table, id_bounds(spark, connection, table), partitions)
    return spark.read.format("jdbc").options(**connection, **options).load().drop(ID)


def relational_rows(df: DataFrame, last_id: int = 0) -> DataFrame:
    """Rows as the relational tables hold them: clean names, all text, a running id after ``last_id``.

    Rows may repeat, so equal rows are counted and told apart by a copy number: ids stay dense, and
    a task that runs again gives the same ids.
    """
    text = nan_to_null(sanitize_columns(df))
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    columns = text.columns
    counted = text.groupBy(*columns).agg(F.count("*").alias("_copies"))
    # A row with very many copies is cut into chunks, which the shuffle deals to different tasks.
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / CHUNK))
    chunked = counted.withColumn("_chunk", F.explode(chunks)).repartition(*columns, "_chunk")
    start = F.col("_chunk") * CHUNK
    numbers = F.sequence(start, F.least(F.col("_copies"), start + CHUNK) - 1)
    single = chunked.select(*columns, F.explode(numbers).alias("_copy"))
    return surrogate_key(single, ID, [*columns, "_copy"], start=last_id + 1).select(ID, *columns)


def write_jdbc(spark: SparkSession, df: DataFrame, connection: dict[str, str], table: str, exists: bool, batch_size: int = 10_000) -> None:
    """Append all rows, creating the table at first.

    Each task commits on its own and may be run again after a loss. ``id`` should be the primary
    key, as ids are repeatable: a second attempt is then refused instead of adding rows twice.
    """
    bounds = id_bounds(spark, connection, table) if exists else None
    rows = relational_rows(df, bounds[1] if bounds else 0)
    rows.write.format("jdbc").options(**connection, dbtable=table, batchsize=str(batch_size)).mode("append").save()
