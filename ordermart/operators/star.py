"""Star schema: five dimensions with dense keys and the order fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions.casts import lenient_int
from ordermart.operators.clean import CleanTables
from ordermart.operators.fanout import KEY, LINE_TABLES, fan_out
from ordermart.operators.keys import surrogate_key
from ordermart.operators.registry import extend_keys, keyed, merged_dimension
from ordermart.operators.weights import item_lines, payment_lines, per_order, review_lines
from ordermart.schemas import DIMENSIONS, FACT_COLUMNS, FACT_LOOKUPS, FACT_MEASURES
from ordermart.session import at_once
from ordermart.sources.catalog import materialise_table

# Columns that identify a dimension row.
NATURAL_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_sellers": ["seller_id"],
    "dim_products": ["product_id"],
    "dim_payment_types": ["payment_type"],
    "dim_reviews": ["review_id", "order_id"],
}


def dimension(df: DataFrame, name: str) -> DataFrame:
    """Distinct dimension rows of any frame that has the columns, with their key."""
    key, columns = DIMENSIONS[name]
    return surrogate_key(df.select(*columns).distinct(), key, NATURAL_KEYS[name])


def look_up_keys(df: DataFrame, dimensions: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """Replace business keys by surrogate keys."""
    for name in names:
        business, key = FACT_LOOKUPS[name]
        df = df.join(dimensions[name].select(business, key), business, "left").drop(business)
    return df


def star_from_wide(df: DataFrame) -> dict[str, DataFrame]:
    """The six tables from a cleaned and typed wide table."""
    star = {name: dimension(df, name) for name in DIMENSIONS}
    business = [b for b, _ in FACT_LOOKUPS.values()]
    fact = look_up_keys(df.select(*FACT_MEASURES, *business), star, list(FACT_LOOKUPS))
    return star | {"fact_orders": fact.select(*FACT_COLUMNS)}


def build_dimension(tables: CleanTables, name: str) -> DataFrame:
    """A dimension from the cleaned tables: rows that occur in at least one complete order."""
    return dimension(dimension_rows(tables, name), name)


def dimension_rows(tables: CleanTables, name: str) -> DataFrame:
    """Rows of a dimension without their key, perhaps repeated.

    Only ids travel through the order joins; the attributes are attached to the distinct ids.
    """
    if name == "dim_customers":
        return per_order(tables, "payments", "reviews", "items")
    if name == "dim_payment_types":
        return payment_lines(tables, ["payment_type"], [])
    if name == "dim_reviews":
        return review_lines(tables, ["review_id", "review_score"], [])
    business = NATURAL_KEYS[name]
    used = item_lines(tables, business, []).select(*business).distinct()
    lookup = tables.products if name == "dim_products" else tables.sellers
    return lookup.join(used, business, "left_semi")


def extend_dimension(tables: CleanTables, database: str, name: str) -> DataFrame:
    """The dimension of a further load: new natural keys are added to the key map, known ones keep their key.

    Returns the published rows with those of the load, one row per natural key.
    """
    key, columns = DIMENSIONS[name]
    natural = NATURAL_KEYS[name]
    rows = materialise_table(dimension_rows(tables, name).select(*columns).distinct())
    # A natural key with two sets of attributes in one load keeps the first in their order, so that it has one row.
    rest = [c for c in columns if c not in natural]
    if rest:
        rows = rows.groupBy(*natural).agg(F.min(F.struct(*rest)).alias("_rest")).select(*natural, "_rest.*").select(*columns)
    keys = extend_keys(rows, database, name, key, natural)
    return merged_dimension(rows.sparkSession, keyed(rows, keys, key, natural), database, name, key)


def key_maps(dimensions: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The keys the facts look up, written once and narrow.

    A numbered dimension is a plan of unknown size, which would be numbered again for each use and for which all items
    are shuffled; a written map that is small is broadcast, by its counted rows.
    """
    spark = next(iter(dimensions.values())).sparkSession
    return at_once(spark, {name: lambda name=name, c=c: materialise_table(dimensions[name].select(*c)) for name, c in FACT_LOOKUPS.items()})


def build_fact(tables: CleanTables, dimensions: dict[str, DataFrame]) -> DataFrame:
    """One row per order x payment x review x item.

    Keys are looked up before the rows multiply. An inner lookup is enough for a left one here: a
    row without a key has no complete order and would not reach the fact table.
    """

    def keyed(df: DataFrame, names: list[str]) -> DataFrame:
        for name in names:
            business, key = FACT_LOOKUPS[name]
            df = df.join(dimensions[name].select(business, key), business)
        return df

    facts = lambda df: [c for c in df.columns if c in FACT_COLUMNS and c != KEY]
    in_place = tables.buckets and tables.lines.hot(*LINE_TABLES) is None
    if in_place and tables.lines.largest["orders"] == 1:
        # Only ids move to their customer and back; the orders stay where they are.
        orders = tables.orders.join(keyed(tables.orders.select(KEY, "customer_id"), ["dim_customers"]).drop("customer_id"), KEY)
    else:
        orders = keyed(tables.orders, ["dim_customers"])
    payments = keyed(tables.payments, ["dim_payment_types"])
    items = tables.items
    if in_place:
        # Items of orders that are not complete are dropped where they lie, before they move to their product and back.
        items = items.join(tables.orders.select(KEY), KEY, "left_semi")
    items = keyed(items, ["dim_sellers", "dim_products"])
    reviews = tables.reviews.select(KEY, F.col("review_creation_date").isNotNull().alias("_dated"))
    lines = {
        "payments": payments.select(KEY, *facts(payments)),
        "reviews": reviews,
        "items": items.select(KEY, *facts(items)),
    }
    wide = fan_out(orders.select(KEY, "delivered", *facts(orders)), lines, tables.lines.hot(*LINE_TABLES), "inner")
    wide = wide.filter(F.col("_dated") | F.col("delivered"))
    return wide.withColumn("payment_installments", lenient_int(F.col("payment_installments"))).select(*FACT_COLUMNS)


def build_star(tables: CleanTables) -> dict[str, DataFrame]:
    star = {name: build_dimension(tables, name) for name in DIMENSIONS}
    return star | {"fact_orders": build_fact(tables, key_maps(star))}
