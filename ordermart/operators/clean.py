"""Missing value rules: constant, mean, median and cross-column fills, then the any-null drop."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.operators.fanout import KEY, LINE_TABLES, ROWS_PER_SLICE, LineCounts, fan_out
from ordermart.operators.merge import LOOKUPS, distinct_names, left_join, order_rows
from ordermart.operators.statistics import merged_statistics, wide_statistics
from ordermart.schemas import (
    CLEAN_COLUMNS,
    MEAN_COLUMNS,
    MEDIAN_COLUMNS,
    NOT_AVAILABLE,
    NOT_AVAILABLE_COLUMNS,
    RENAMES,
    SOURCE_COLUMNS,
    UNKNOWN,
    UNKNOWN_COLUMNS,
)
from ordermart.session import at_once

STATISTIC_COLUMNS = MEAN_COLUMNS + MEDIAN_COLUMNS
# Rows looked at first when it is only asked whether a column has a value; the full test follows if they do not tell.
PROBE = 20
# Columns in which a null drops no line; orders have a date for it.
MAY_BE_NULL = {"reviews": ("review_creation_date",)}


def fill_constants(df: DataFrame) -> DataFrame:
    values = {c: NOT_AVAILABLE for c in NOT_AVAILABLE_COLUMNS} | {c: UNKNOWN for c in UNKNOWN_COLUMNS}
    return df.na.fill({c: v for c, v in values.items() if c in df.columns})


def fill_statistics(df: DataFrame, numbers: dict[str, float]) -> DataFrame:
    """Fill missing numbers; filled integer columns become double, as their median may be."""
    filled = [c for c in STATISTIC_COLUMNS if c in df.columns]
    return df.withColumns({c: F.coalesce(_present(df, c), F.lit(numbers.get(c)).cast("double")) for c in filled})


def _present(df: DataFrame, c: str) -> Column:
    """The column as double, with NaN counted as missing."""
    return F.when(~F.isnan(c), F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c).cast("double")


def review_date(raw: str = "review_creation_date") -> Column:
    """Falls back on the delivery date as it was before that column is itself filled."""
    return F.coalesce(F.col(raw), F.col("order_delivered_customer_date"))


def timestamp_chain() -> dict[str, Column]:
    approved = F.coalesce(F.col("order_approved_at"), F.col("order_purchase_timestamp"))
    return {
        "order_approved_at": approved,
        "order_delivered_carrier_date": F.coalesce(F.col("order_delivered_carrier_date"), approved),
        "order_delivered_customer_date": F.coalesce(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        ),
    }


def rename(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RENAMES)


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column.

    Spelled as predicates, not ``na.drop``, so that the optimizer turns left joins into inner ones.
    """
    return df.filter(is_complete(df, columns))


def is_complete(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Whether a row has no null in any column."""
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    checks = []
    for c in columns or df.columns:
        checks.append(F.col(c).isNotNull())
        if c in floats:
            checks.append(~F.isnan(c))
    return reduce(Column.__and__, checks)


def clean_wide(df: DataFrame) -> DataFrame:
    """All rules on an already merged table. Statistics come from ``df``, before any row is dropped."""
    numbers = wide_statistics(df, [c for c in STATISTIC_COLUMNS if c in df.columns])
    filled = fill_statistics(fill_constants(df), numbers)
    # One projection: every expression sees the columns as they were.
    dated = filled.withColumns({"review_creation_date": review_date(), **timestamp_chain()})
    return drop_incomplete(rename(dated))


@dataclass
class CleanTables:
    """The cleaned table before its rows multiply: orders, and the lines that go with them.

    ``items`` carry their product and seller; these are also kept apart, one row each.
    ``orders.delivered`` tells whether the order had a delivery date before the fill, and
    ``orders.delivered_at`` which one.
    """

    orders: DataFrame
    payments: DataFrame
    reviews: DataFrame
    items: DataFrame
    products: DataFrame
    sellers: DataFrame
    # Lines per order, perhaps counted before cleaning, when there were more of them.
    lines: LineCounts
    # Items before their product and seller are joined, for who joins written copies of those.
    bare_items: DataFrame | None = None
    # The fills of missing numbers.
    numbers: dict[str, float] | None = None
    # The database that holds the tables once they are staged.
    staged_in: str | None = None
    # Buckets by order that all order tables lie in; None where one of them lies otherwise.
    buckets: int | None = None


def have_values(sources: dict[str, DataFrame], columns: list[str]) -> bool:
    """Whether each of these filled columns has a value somewhere in the merged table.

    A value counts if its line belongs to an order. A few lines with values in all the columns
    usually settle it; where none of them does, the whole tables are asked.
    """
    tables = {t: [c for c in columns if c in SOURCE_COLUMNS[t] and c in sources[t].columns] for t in (*LINE_TABLES, "products")}
    tables = {t: names for t, names in tables.items() if names}
    if not tables:
        return True
    spark, orders = sources["orders"].sparkSession, sources["orders"].select(KEY)

    def few(df: DataFrame, key: str) -> list:
        return [r[0] for r in df.select(key).filter(F.col(key).isNotNull()).limit(PROBE).collect()]

    def orders_of(table: str) -> list:
        """Orders of a few lines that have a value in every column asked for."""
        present = sources[table].filter(reduce(Column.__and__, [_present(sources[table], c).isNotNull() for c in tables[table]]))
        if table != "products":
            return few(present, KEY)
        ids = few(present, "product_id")
        return few(sources["items"].filter(F.col("product_id").isin(ids)), KEY) if ids else []

    def occur(table: str) -> bool:
        rows = sources["items" if table == "products" else table].join(orders, KEY, "left_semi")
        if table == "products":
            rows = sources["products"].join(rows.select("product_id"), "product_id", "left_semi")
        return _all_occur(rows, tables[table])

    keys = at_once(spark, {t: lambda t=t: orders_of(t) for t in tables})
    asked = sorted({k for found in keys.values() for k in found})
    known = {r[0] for r in orders.filter(F.col(KEY).isin(asked)).distinct().collect()} if asked else set()
    open_tables = [t for t, found in keys.items() if not known & set(found)]
    return all(at_once(spark, {t: lambda t=t: occur(t) for t in open_tables}).values())


def _all_occur(rows: DataFrame, names: list[str]) -> bool:
    found = rows.agg(*[F.coalesce(F.bool_or(_present(rows, c).isNotNull()), F.lit(False)).alias(c) for c in names]).first()
    return all(found)


def clean_tables(
    sources: dict[str, DataFrame],
    columns: list[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    numbers: dict[str, float] | None = None,
) -> CleanTables:
    """All rules applied table by table.

    A merged row survives if its order, payment, review and item each pass, so each table is filled
    and filtered on its own. ``columns`` names the filled numeric columns the caller reads; of the
    others it is only asked whether they have any value, as one without drops every row. With ``numbers``
    the fills are given and nothing is asked.
    """
    sources = distinct_names(sources)
    wanted = [c for c in STATISTIC_COLUMNS if columns is None or c in columns]
    lines = LineCounts(sources, rows_per_slice)
    if numbers is None:
        numbers = merged_statistics(sources, wanted, lines)
        complete = have_values(sources, [c for c in STATISTIC_COLUMNS if c not in wanted])
    else:
        complete = True
    if not complete:
        sources = sources | {"orders": sources["orders"].filter(F.lit(False))}

    def cleaned(df: DataFrame, allow: tuple[str, ...] = ()) -> DataFrame:
        df = filled(df, wanted, numbers)
        return drop_incomplete(df, [c for c in df.columns if c not in allow])

    # Categories are translated per product, and lookups are cleaned before items meet them.
    products = cleaned(left_join(sources["products"], sources["translation"], LOOKUPS["translation"]))
    sellers, items = cleaned(sources["sellers"]), cleaned(sources["items"])
    delivered_at = F.col("order_delivered_customer_date")
    orders = order_rows(sources).withColumns({"delivered": delivered_at.isNotNull(), "delivered_at": delivered_at})
    return CleanTables(
        orders=drop_incomplete(
            orders.withColumns(timestamp_chain()), [c for c in orders.columns if c != "delivered_at"]
        ),
        payments=cleaned(sources["payments"]),
        reviews=cleaned(sources["reviews"], MAY_BE_NULL["reviews"]),
        items=item_lookups(items, products, sellers),
        products=products,
        sellers=sellers,
        lines=lines,
        bare_items=items,
        numbers=numbers,
    )


def filled(df: DataFrame, wanted: list[str], numbers: dict[str, float]) -> DataFrame:
    """A table with its missing values filled, without the statistic columns that are not wanted."""
    df = df.drop(*[c for c in STATISTIC_COLUMNS if c not in wanted])
    return rename(fill_statistics(fill_constants(df), numbers))


def survives(df: DataFrame, table: str, columns: list[str] | None) -> DataFrame:
    """Lines with a column ``_complete``: whether cleaning keeps them, if every column that is filled has a number to fill with."""
    wanted = [c for c in STATISTIC_COLUMNS if columns is None or c in columns]
    df = filled(df, wanted, dict.fromkeys(wanted, 0.0))
    return df.withColumn("_complete", is_complete(df, [c for c in df.columns if c not in MAY_BE_NULL.get(table, ())]))


def complete_lookup(df: DataFrame) -> DataFrame:
    """Rows of a lookup table that no rule drops, without the columns whose fill is a statistic."""
    return drop_incomplete(rename(fill_constants(df.drop(*STATISTIC_COLUMNS))))


def item_lookups(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Cleaned items with their product and seller; without either they are incomplete."""
    return items.join(products, LOOKUPS["products"]).join(sellers, LOOKUPS["sellers"])


def join_clean(tables: CleanTables) -> DataFrame:
    """The cleaned wide table from the cleaned tables: only inner joins on the order."""
    wide = fan_out(tables.orders, {t: getattr(tables, t) for t in LINE_TABLES}, tables.lines.hot(*LINE_TABLES), "inner")
    dated = F.coalesce(F.col("review_creation_date"), F.col("delivered_at"))
    extra = [c for c in wide.columns if c not in (*CLEAN_COLUMNS, "delivered", "delivered_at")]
    declared = [c for c in CLEAN_COLUMNS if c in wide.columns]
    return wide.withColumn("review_creation_date", dated).filter(dated.isNotNull()).select(*declared, *extra)


def clean_sources(sources: dict[str, DataFrame], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Merge and clean in one plan; the merged table is never built for its statistics."""
    return join_clean(clean_tables(sources, rows_per_slice=rows_per_slice))
