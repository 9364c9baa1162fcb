"""Catalog tables: publish, scan and list."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.session import SCRATCH_CODEC, application_dir, delete_path, fresh_dir

# Bytes of a source per bucket: a bucket is read by one task, and adaptive execution cannot resize it. Joins sort the rows of
# several tables in memory, where they took some sixty times the bytes that are reported for the compressed source.
BUCKET_BYTES = 4 << 20
# What is reported for frames that are no scans; the session's shuffle partitions decide then.
UNKNOWN_BYTES = 1 << 60


def create_database(spark: SparkSession, name: str, location: str) -> str:
    """Make a database whose tables lie at ``location``; an existing one must lie there already."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    found = spark.catalog.getDatabase(name).locationUri
    if _plain(found) != _plain(location):
        raise ValueError(f"database {name} is at {found}, not at {location}")
    return name


def _plain(path: str) -> str:
    return "/" + path.partition(":")[2].lstrip("/") if path.startswith("file:") else path.rstrip("/")


def stage_database(spark: SparkSession) -> str:
    """A new database for the tables of one call."""
    name = f"ordermart_stage_{uuid.uuid4().hex}"
    return create_database(spark, name, fresh_dir(spark, name))


def application_database(spark: SparkSession, name: str) -> str:
    """A database that lasts as long as the application's folder, under a name of its own for each call."""
    name = f"{name}_{uuid.uuid4().hex}"
    return create_database(spark, name, f"{application_dir(spark)}/{name}")


def count_rows(spark: SparkSession, name: str) -> None:
    """Note the number of rows with the table, so that the optimizer knows how large they are in memory.

    Its files say little: rows that the driver would have to hold to broadcast them take some fifty times their
    compressed bytes. Counting reads the footers only.
    """
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def materialise_table(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``session.materialise`` for a frame that grows with the input and is joined: its rows are counted, too.

    The table lies in the database of the folder, if one is given, which ``drop_folder`` deletes with it.
    """
    spark = df.sparkSession
    folder = folder or f"{application_dir(spark)}/stage/frames-{spark.sparkContext.applicationId}"
    database = create_database(spark, _database_of(folder), folder)
    name = f"`{database}`.`frame_{uuid.uuid4().hex}`"
    df.write.format("parquet").option("compression", SCRATCH_CODEC).saveAsTable(name)
    count_rows(spark, name)
    return spark.table(name)


def _database_of(folder: str) -> str:
    return f"ordermart_stage_{folder.rpartition('/')[2].replace('-', '_').lower()}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and the database of ``materialise_table`` in it."""
    spark.sql(f"DROP DATABASE IF EXISTS `{_database_of(folder)}` CASCADE")
    delete_path(spark, folder)


def publish(df: DataFrame, database: str, table: str, mode: str = "overwrite") -> None:
    """Write a table: ``overwrite`` replaces it, ``append`` adds the rows once more."""
    if mode == "append":
        name = f"`{database}`.`{table}`"
        df.write.mode("append").format("parquet").saveAsTable(name)
        count_rows(df.sparkSession, name)
    else:
        _swapped(df.sparkSession, database, table, lambda name: df.write.format("parquet").saveAsTable(name))


def _swapped(spark: SparkSession, database: str, table: str, write) -> None:
    """Write beside the table and take its place: until then, and after a failure, the old one is there."""
    beside = f"{table}_{uuid.uuid4().hex}"
    try:
        write(f"`{database}`.`{beside}`")
        count_rows(spark, f"`{database}`.`{beside}`")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{beside}`")
        raise
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    spark.sql(f"ALTER TABLE `{database}`.`{beside}` RENAME TO `{database}`.`{table}`")


def size_of(df: DataFrame) -> int:
    """Bytes of a frame as its scans report them; ``UNKNOWN_BYTES`` or more where they do not."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_count(tables: list[DataFrame], bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined with each other: by the size of the largest, as the scans report it."""
    sizes = [size_of(df) for df in tables]
    spark = tables[0].sparkSession
    known = [s for s in sizes if s < UNKNOWN_BYTES]
    if len(known) < len(sizes):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-max(known) // bucket_bytes)))


def publish_bucketed(df: DataFrame, database: str, table: str, key: str | list[str], buckets: int, placed: bool = False) -> None:
    """Replace a table whose files are laid out by ``key``: joins and groupings on it need no exchange.

    Rows that are ``placed`` come from tables of the same buckets and are written where they are.
    """
    _swapped(df.sparkSession, database, table, lambda name: _write_buckets(df, name, key, buckets, "error", placed))


def append_bucketed(df: DataFrame, database: str, table: str, key: str | list[str]) -> None:
    """Add rows to a table that ``publish_bucketed`` has made, in its buckets."""
    name = f"`{database}`.`{table}`"
    _write_buckets(df, name, key, bucket_number(df.sparkSession, database, table), "append")
    count_rows(df.sparkSession, name)


def bucket_number(spark: SparkSession, database: str, table: str) -> int | None:
    """Buckets of a table; None where it has none."""
    layout = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{table}`").collect()
    return next((int(r["data_type"]) for r in layout if r["col_name"] == "Num Buckets"), None)


def _write_buckets(df: DataFrame, name: str, key: str | list[str], buckets: int, mode: str, placed: bool = False) -> None:
    # One shuffle by the same hash, so each bucket is one file instead of one per task.
    keys = [key] if isinstance(key, str) else key
    (df if placed else df.repartition(buckets, *keys)).write.mode(mode).format("parquet").option("compression", SCRATCH_CODEC).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame | None:
    """The table, or None where it does not exist."""
    if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
        return None
    return spark.table(f"`{database}`.`{table}`")


# Names shown to users and the mart each one stands for.
MART_NAMES = {
    "Sales Performance": "dm_sales_performance",
    "Product Category Analysis": "dm_product_category_analysis",
    "Customer Behavior": "dm_customer_behavior",
    "Order Fulfillment": "dm_order_fulfillment",
    "Payment Analysis": "dm_payment_analysis",
}


def read_mart(spark: SparkSession, database: str, shown: str) -> DataFrame | None:
    """A mart by its shown name."""
    return read_table(spark, database, MART_NAMES[shown])


def list_tables(spark: SparkSession, database: str, pattern: str = "Agg_%") -> DataFrame:
    """Names of tables by SQL pattern, in which ``_`` stands for any one character.

    Letter case is ignored, because the session catalog keeps names in lower case.
    """
    if not spark.catalog.databaseExists(database):
        return spark.createDataFrame([], "table_name string")
    tables = spark.sql(f"SHOW TABLES IN `{database}`").filter("not isTemporary")
    return tables.filter(F.col("tableName").ilike(pattern)).select(F.col("tableName").alias("table_name"))


def has_rows(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()
