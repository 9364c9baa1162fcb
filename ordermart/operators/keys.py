"""Dense surrogate keys 1..n without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.session import materialise

# Leading hex digits of the digest that form a group. Keys are dense with any number of them; which row gets which key
# follows from the number, that is, from the order of magnitude of the table.
LEAST_DIGITS, MOST_DIGITS = 3, 5
ROWS_PER_GROUP = 1_000_000


def group_digits(rows: int) -> int:
    """Digits for groups of at most about ``ROWS_PER_GROUP`` rows; 5 digits, a million groups, serve 10^12 rows."""
    digits = LEAST_DIGITS
    while digits < MOST_DIGITS and rows > ROWS_PER_GROUP * 16**digits:
        digits += 1
    return digits


def surrogate_key(df: DataFrame, name: str, natural_key: list[str], start: int = 1) -> DataFrame:
    """Prepend a dense key. The natural key must identify a row; equal inputs always get equal keys.

    Rows are put in groups by a digest of the natural key and numbered inside each group; the size
    of the groups before it is then added. Group and order depend only on the row, so a lost
    executor or a second run changes nothing, and the digest keeps groups even. The digest is
    written once with the rows; sizes and numbers are both taken from that copy.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key])
    rows = materialise(df.withColumn("_digest", F.substring(F.md5(text), 1, MOST_DIGITS)))
    digits = group_digits(rows.count())
    group = F.substring("_digest", 1, digits)
    before = F.sum("_size").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    # At most 16 ** MOST_DIGITS rows, whatever the size of the input.
    offsets = rows.groupBy(group.alias("_group")).agg(F.count("*").alias("_size"))
    offsets = offsets.select("_group", F.coalesce(before, F.lit(0)).alias("_before"))
    rest = [c for c in df.columns if c not in natural_key]
    in_group = F.row_number().over(Window.partitionBy("_group").orderBy(*natural_key, *rest))
    numbered = rows.withColumn("_group", group).withColumn("_number", in_group).join(F.broadcast(offsets), "_group")
    key = F.col("_before") + F.col("_number") + (start - 1)
    return numbered.select(key.cast("bigint").alias(name), *df.columns)
