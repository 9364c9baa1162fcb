"""Reporting queries over the aggregates and marts: totals, shares, top customers, chart series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.casts import MEAN_SCALE, as_double, exact, exact_sum
from ordermart.functions.columns import thousands
from ordermart.session import materialise

# The totals shown for each mart, as (column, kind).
KPIS = {
    "dm_sales_performance": [("total_revenue", "money"), ("avg_order_value", "mean"), ("total_orders", "count")],
    "dm_product_category_analysis": [("total_sales", "count"), ("total_revenue", "money"), ("avg_price", "mean")],
    "dm_customer_behavior": [("total_orders", "count"), ("distinct_products", "count"), ("total_spent", "money")],
    "dm_order_fulfillment": [("total_orders", "count")],
    "dm_payment_analysis": [("total_revenue", "money"), ("total_transactions", "count")],
}

# The columns of each chart, as table -> (label columns, measures).
CHARTS = {
    "category_sales": ("Agg_sales_by_category", ["category"], ["total_sales"]),
    "category_freight": ("Agg_sales_by_category", ["category"], ["total_sales", "total_freight", "total_orders"]),
    "state_sales": ("Agg_sales_by_customer_state", ["customer_state"], ["total_sales"]),
    "state_customers": ("Agg_sales_by_customer_state", ["customer_state"], ["unique_customers"]),
    "seller_sales": ("Agg_sales_by_seller", ["seller_id", "seller_state"], ["total_sales"]),
    "month_sales": ("Agg_monthly_sales_trend", ["month"], ["total_sales"]),
    "month_orders": ("Agg_monthly_sales_trend", ["month"], ["total_orders"]),
    "product_score": ("Agg_avg_review_score", ["product_id", "category"], ["avg_review_score"]),
    "mart_category_sales": ("dm_product_category_analysis", ["product_category_name"], ["total_sales"]),
    "mart_category_price": ("dm_product_category_analysis", ["product_category_name"], ["avg_price"]),
    "customer_spending": ("dm_customer_behavior", ["customer_id"], ["total_orders", "total_spent"]),
    "status_shipping": ("dm_order_fulfillment", ["order_status"], ["avg_shipping_time"]),
    "type_revenue": ("dm_payment_analysis", ["payment_type"], ["total_revenue"]),
}


def _kpi(c: str, kind: str) -> Column:
    if kind == "money":
        return as_double(exact_sum(F.col(c))).alias(c)
    if kind == "mean":
        # Unweighted mean over the rows of the mart, added up without rounding.
        return (as_double(F.sum(exact(F.col(c), 38, MEAN_SCALE))) / F.nullif(F.count(c), F.lit(0))).alias(c)
    return F.sum(c).cast("bigint").alias(c)


def kpis(mart: DataFrame, name: str) -> DataFrame:
    """One row with the totals of a mart."""
    return mart.agg(*[_kpi(c, kind) for c, kind in KPIS[name]])


def formatted(totals: DataFrame, name: str) -> DataFrame:
    """The totals as text: money and means with two decimals, counts as they are."""
    text = {"money": thousands, "mean": thousands, "count": lambda c: c.cast("string")}
    return totals.select(*[text[kind](F.col(c)).alias(c) for c, kind in KPIS[name]])


def share_of_total(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Measure per key and its share of the whole; without a share where the whole is 0.

    The grouped rows are written once, because both the rows and the total read them.
    """
    value = exact_sum(F.col(measure)) if dict(df.dtypes)[measure] == "double" else F.sum(measure)
    grouped = materialise(df.groupBy(key).agg(value.alias("_value")))
    total = grouped.agg(F.sum("_value").alias("_total")).scalar()
    cast = "double" if dict(df.dtypes)[measure] == "double" else "bigint"
    return grouped.select(
        key,
        F.col("_value").cast(cast).alias(measure),
        (as_double(F.col("_value")) / F.nullif(as_double(total), F.lit(0.0))).alias("share"),
    )


def reviews_by_category(reviews: DataFrame) -> DataFrame:
    """Bars per category stack one segment per product: both columns add up."""
    return reviews.groupBy("category").agg(
        F.sum("total_reviews").cast("bigint").alias("total_reviews"),
        as_double(F.sum(exact(F.col("avg_review_score"), 38, MEAN_SCALE))).alias("stacked_avg_review_score"),
    )


def top_customers(sales: DataFrame, n: int = 10) -> DataFrame:
    """Highest revenue first; ties go to the lowest customer id."""
    return sales.orderBy(F.col("total_revenue").desc_nulls_last(), "customer_id").limit(n)


def chart(table: DataFrame, name: str) -> DataFrame:
    """The columns one chart reads, in label order."""
    _, labels, measures = CHARTS[name]
    return table.select(*labels, *measures).orderBy(*labels)


def chart_series(tables: dict[str, DataFrame]) -> DataFrame:
    """All charts in long form: (chart, label, measure, value), each table read once."""
    parts = []
    for table in dict.fromkeys(t for t, _, _ in CHARTS.values()):
        points = [
            F.struct(
                F.lit(name).alias("chart"),
                F.concat_ws(" / ", *[F.col(c).cast("string") for c in labels]).alias("label"),
                F.lit(m).alias("measure"),
                F.col(m).cast("double").alias("value"),
            )
            for name, (source, labels, measures) in CHARTS.items()
            if source == table
            for m in measures
        ]
        parts.append(tables[table].select(F.explode(F.array(*points)).alias("point")).select("point.*"))
    return reduce(DataFrame.unionAll, parts)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*order).limit(n)
