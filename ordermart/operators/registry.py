"""Surrogate keys that last: a written map from natural key to key, to which each load adds its new natural keys.

``surrogate_key`` numbers the rows of one load. A warehouse that is extended by further loads needs more: a natural key
that was numbered once keeps its number, and a new one gets a number above all that are in use. The map of a dimension is
the table ``keys_<dimension>`` beside it, bucketed by natural key: a load that is looked up in it is shuffled, the map is
not, and only new keys are written. Natural keys are never null, since cleaning has dropped such rows.

One load at a time may extend a map. A load that fails half way leaves keys that no row uses yet; the next run finds them
and goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators.keys import surrogate_key
from ordermart.sources.catalog import append_bucketed, bucket_count, materialise_table, publish_bucketed, read_table


def map_name(dimension: str) -> str:
    return f"keys_{dimension}"


def extend_keys(rows: DataFrame, database: str, dimension: str, key: str, natural_key: list[str]) -> DataFrame:
    """Give every natural key of ``rows`` a key in the map, and return the whole map: (key, natural key).

    New natural keys are numbered from one above the highest key in use, in the order of a digest, so a load gives the
    same numbers however it is distributed.
    """
    spark, name = rows.sparkSession, map_name(dimension)
    fresh = rows.select(*natural_key).distinct()
    known = read_table(spark, database, name)
    if known is None:
        publish_bucketed(surrogate_key(fresh, key, natural_key), database, name, natural_key, bucket_count([rows]))
    else:
        highest = known.agg(F.max(key)).head()[0] or 0
        fresh = fresh.join(known, natural_key, "left_anti")
        append_bucketed(surrogate_key(fresh, key, natural_key, start=highest + 1), database, name, natural_key)
    return read_table(spark, database, name)


def keyed(rows: DataFrame, keys: DataFrame, key: str, natural_key: list[str]) -> DataFrame:
    """Rows with the key of their natural key in front; all natural keys must be in the map."""
    return rows.join(keys, natural_key).select(key, *rows.columns)


def merged_dimension(spark: SparkSession, rows: DataFrame, database: str, dimension: str, key: str) -> DataFrame:
    """The published dimension with the load's keyed rows: a key's newest attributes replace older ones."""
    old = read_table(spark, database, dimension)
    if old is None:
        return rows
    return materialise_table(old.join(rows.select(key), key, "left_anti").unionByName(rows))
