"""The five data marts, over a wide table or straight from the cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.casts import as_double, exact_sum, weighted, weighted_money_sum
from ordermart.functions.columns import shipping_seconds
from ordermart.operators.clean import CleanTables
from ordermart.operators.fanout import KEY
from ordermart.operators.weights import item_lines, payment_lines, per_order

DELIVERED = "order_delivered_customer_date"
PURCHASED = "order_purchase_timestamp"


def money(c: str) -> Column:
    """Sum that is 0, not null, when there is nothing to add."""
    return F.coalesce(as_double(exact_sum(F.col(c))), F.lit(0.0))


def mean(c: str) -> Column:
    return as_double(exact_sum(F.col(c))) / F.nullif(F.count(c), F.lit(0))


# --- over a wide table -----------------------------------------------------------------------


def wide_sales_performance(df: DataFrame) -> DataFrame:
    # Two steps instead of a distinct count: sums per order first, then orders are rows.
    per_order = df.filter("customer_id is not null").groupBy("customer_id", "order_id").agg(
        exact_sum(F.col("payment_value")).alias("paid"), F.count("payment_value").alias("n")
    )
    return per_order.groupBy("customer_id").agg(*_sales_measures(F.sum("paid"), F.sum("n"), F.count("order_id")))


def _sales_measures(paid: Column, n: Column, orders: Column) -> list[Column]:
    total = as_double(paid)
    return [
        F.coalesce(total, F.lit(0.0)).alias("total_revenue"),
        orders.alias("total_orders"),
        (total / F.nullif(n, F.lit(0))).alias("avg_order_value"),
    ]


def wide_product_category_analysis(df: DataFrame) -> DataFrame:
    return (
        df.filter("product_category_name is not null")
        .groupBy("product_category_name")
        .agg(
            F.count("order_id").alias("total_sales"),
            money("payment_value").alias("total_revenue"),
            mean("price").alias("avg_price"),
        )
    )


def wide_customer_behavior(df: DataFrame) -> DataFrame:
    df = df.filter("customer_id is not null")
    spent = df.groupBy("customer_id", "order_id").agg(exact_sum(F.col("payment_value")).alias("paid"))
    spent = spent.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.coalesce(as_double(F.sum("paid")), F.lit(0.0)).alias("total_spent")
    )
    products = df.select("customer_id", "product_id").distinct()
    products = products.groupBy("customer_id").agg(F.count("product_id").alias("distinct_products"))
    return spent.join(products, "customer_id").select("customer_id", "total_orders", "distinct_products", "total_spent")


def delivered_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(DELIVERED).isNotNull())


def with_shipping_time(df: DataFrame) -> DataFrame:
    return df.withColumn("shipping_time", shipping_seconds(DELIVERED, PURCHASED))


def wide_order_fulfillment(df: DataFrame) -> DataFrame:
    """Every status of the frame is kept, with zeros where no order was delivered."""
    df = df.filter("order_status is not null")
    delivered = F.col(DELIVERED).isNotNull()
    seconds = F.when(delivered, shipping_seconds(DELIVERED, PURCHASED).cast("decimal(20,0)"))
    # A conditional aggregate keeps all statuses without joining a list of them back.
    return df.groupBy("order_status").agg(*_shipping(F.sum(seconds), F.count_if(delivered & F.col("order_id").isNotNull())))


def _shipping(seconds: Column, rows: Column) -> list[Column]:
    average = as_double(seconds) / F.nullif(rows, F.lit(0))
    return [
        F.coalesce(average, F.lit(0.0)).cast("bigint").alias("avg_shipping_time"),
        rows.alias("total_orders"),
    ]


def wide_payment_analysis(df: DataFrame) -> DataFrame:
    return (
        df.filter("payment_type is not null")
        .groupBy("payment_type")
        .agg(money("payment_value").alias("total_revenue"), F.count("order_id").alias("total_transactions"))
    )


WIDE_MARTS = {
    "dm_sales_performance": wide_sales_performance,
    "dm_product_category_analysis": wide_product_category_analysis,
    "dm_customer_behavior": wide_customer_behavior,
    "dm_order_fulfillment": wide_order_fulfillment,
    "dm_payment_analysis": wide_payment_analysis,
}


# --- straight from the cleaned tables --------------------------------------------------------


def _paid_orders(tables: CleanTables) -> DataFrame:
    """One row per customer and order: wide rows and money paid in them."""
    orders = per_order(tables, "payments", "reviews", "items")
    return orders.groupBy("customer_id", KEY).agg(
        weighted_money_sum(F.col("paid"), F.expr("n_reviews * n_items")).alias("paid"),
        F.sum(F.expr("n_payments * n_reviews * n_items")).alias("n"),
    )


def sales_performance(tables: CleanTables) -> DataFrame:
    orders = _paid_orders(tables)
    return orders.groupBy("customer_id").agg(*_sales_measures(F.sum("paid"), F.sum("n"), F.count(KEY)))


def product_category_analysis(tables: CleanTables) -> DataFrame:
    rows = F.expr("n_payments * n_reviews")
    lines = item_lines(tables, ["product_category_name", "price"], ["n_payments", "n_reviews", "paid"])
    return lines.groupBy("product_category_name").agg(
        F.sum(rows).alias("total_sales"),
        as_double(weighted_money_sum(F.col("paid"), F.col("n_reviews"))).alias("total_revenue"),
        (as_double(weighted_money_sum(F.col("price"), rows)) / F.sum(rows)).alias("avg_price"),
    )


def customer_behavior(tables: CleanTables) -> DataFrame:
    spent = _paid_orders(tables).groupBy("customer_id").agg(
        F.count(KEY).alias("total_orders"), as_double(F.sum("paid")).alias("total_spent")
    )
    products = item_lines(tables, ["product_id"], ["customer_id"]).select("customer_id", "product_id").distinct()
    products = products.groupBy("customer_id").agg(F.count("product_id").alias("distinct_products"))
    return spent.join(products, "customer_id").select("customer_id", "total_orders", "distinct_products", "total_spent")


def order_fulfillment(tables: CleanTables) -> DataFrame:
    """After cleaning every order has a delivery date, so no status is left without rows."""
    orders = with_shipping_time(delivered_only(per_order(tables, "payments", "reviews", "items")))
    rows = F.expr("n_payments * n_reviews * n_items")
    return orders.groupBy("order_status").agg(
        *_shipping(F.sum(weighted(F.col("shipping_time"), rows, scale=0)), F.sum(rows))
    )


def payment_analysis(tables: CleanTables) -> DataFrame:
    rows = F.expr("n_reviews * n_items")
    lines = payment_lines(tables, ["payment_type", "payment_value"], ["n_reviews", "n_items"])
    return lines.groupBy("payment_type").agg(
        as_double(weighted_money_sum(F.col("payment_value"), rows)).alias("total_revenue"),
        F.sum(rows).alias("total_transactions"),
    )


MARTS = {
    "dm_sales_performance": sales_performance,
    "dm_product_category_analysis": product_category_analysis,
    "dm_customer_behavior": customer_behavior,
    "dm_order_fulfillment": order_fulfillment,
    "dm_payment_analysis": payment_analysis,
}
