"""Row counts of the cleaned wide table without its rows.

In the wide table an item appears once per payment and review of its order, and likewise for
payments and reviews. Sums over the wide table are therefore sums over one of the cleaned tables,
each value times the number of rows the other tables add. Nothing multiplies, so nothing explodes
for an order with very many lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.casts import exact_sum
from ordermart.operators.clean import CleanTables
from ordermart.operators.fanout import KEY, join_order_rows

COUNTS = ["n_payments", "n_reviews", "n_items"]


def per_order(tables: CleanTables, *names: str, sums: bool = True) -> DataFrame:
    """Orders with the counts and sums of the named line tables; orders without such lines drop out.

    payments: ``n_payments``, ``paid``; reviews: ``n_reviews``; items: ``n_items`` and,
    where prices are filled, ``priced``. Without ``sums`` lines are only counted. Orders that carry all counts already are returned as they are.
    """
    out = tables.orders
    if all(c in out.columns for c in COUNTS):
        return out
    if "payments" in names:
        paid = [exact_sum(F.col("payment_value")).alias("paid")] if sums else []
        out = out.join(tables.payments.groupBy(KEY).agg(F.count("*").alias("n_payments"), *paid), KEY)
    if "reviews" in names:
        dated = F.col("review_creation_date").isNotNull()
        reviews = tables.reviews.groupBy(KEY).agg(
            F.count_if(dated).alias("_dated"), F.count_if(~dated).alias("_undated")
        )
        usable = F.col("_dated") + F.when(F.col("delivered"), F.col("_undated")).otherwise(0)
        out = out.join(reviews, KEY).withColumn("n_reviews", usable).filter("n_reviews > 0")
    if "items" in names:
        priced = [exact_sum(F.col("price")).alias("priced")] if sums and "price" in tables.items.columns else []
        out = out.join(tables.items.groupBy(KEY).agg(F.count("*").alias("n_items"), *priced), KEY)
    return out


# Counts of the lines that cleaning keeps, taken with those of all lines.
KEPT = ["_kept_payments", "_kept_dated", "_kept_undated", "_kept_items"]


def kept_lines() -> dict[str, dict[str, Column]]:
    """``KEPT`` per table, of lines that tell in ``_complete`` whether they are kept."""
    dated, complete = F.col("review_creation_date").isNotNull(), F.col("_complete")
    return {
        "payments": {"_kept_payments": F.count_if(complete)},
        "reviews": {"_kept_dated": F.count_if(complete & dated), "_kept_undated": F.count_if(complete & ~dated)},
        "items": {"_kept_items": F.count_if(complete)},
    }


def counted_orders(orders: DataFrame, counts: DataFrame) -> DataFrame:
    """Orders with the counts of ``per_order`` from ``KEPT``: their lines are not read again."""
    out = orders.join(counts.filter("_kept_payments > 0 AND _kept_items > 0").select(KEY, *KEPT), KEY)
    usable = F.col("_kept_dated") + F.when(F.col("delivered"), F.col("_kept_undated")).otherwise(0)
    counted = {"n_payments": F.col("_kept_payments"), "n_reviews": usable, "n_items": F.col("_kept_items")}
    return out.withColumns(counted).drop(*KEPT).filter("n_reviews > 0")


def item_lines(
    tables: CleanTables, columns: list[str], order_columns: list[str], orders: DataFrame | None = None
) -> DataFrame:
    """Cleaned items with columns of their order; ``order_columns`` may name counts of ``per_order``."""
    orders = per_order(tables, "payments", "reviews") if orders is None else orders
    orders = orders.select(KEY, *order_columns)
    return join_order_rows(tables.items.select(KEY, *columns), orders, "items", tables.lines.hot("items"))


def payment_lines(tables: CleanTables, columns: list[str], order_columns: list[str]) -> DataFrame:
    orders = per_order(tables, "reviews", "items").select(KEY, *order_columns)
    return join_order_rows(tables.payments.select(KEY, *columns), orders, "payments", tables.lines.hot("payments"))


def review_lines(tables: CleanTables, columns: list[str], order_columns: list[str]) -> DataFrame:
    orders = per_order(tables, "payments", "items").select(KEY, "delivered", *order_columns)
    reviews = tables.reviews.select(KEY, "review_creation_date", *columns)
    joined = join_order_rows(reviews, orders, "reviews", tables.lines.hot("reviews"))
    return joined.filter(F.col("review_creation_date").isNotNull() | F.col("delivered")).select(
        KEY, *columns, *order_columns
    )
