"""The five sales and review aggregates, over star tables or straight from the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions.casts import SCORE_SCALE, as_double, exact_sum, weighted, weighted_money_sum
from ordermart.functions.columns import year_month
from ordermart.operators.clean import CleanTables
from ordermart.operators.fanout import KEY
from ordermart.operators.weights import item_lines, per_order


def money(c: str):
    return as_double(exact_sum(F.col(c)))


# --- over star tables ------------------------------------------------------------------------


def star_sales_by_category(star: dict[str, DataFrame]) -> DataFrame:
    sales = _per_key(star, "product_key", exact_sum(F.col("freight_value")).alias("freight"))
    return (
        sales.join(star["dim_products"], "product_key")
        .groupBy(F.col("product_category_name_english").alias("category"))
        .agg(
            as_double(F.sum("sales")).alias("total_sales"),
            as_double(F.sum("freight")).alias("total_freight"),
            F.sum("orders").alias("total_orders"),
        )
    )


def star_sales_by_customer_state(star: dict[str, DataFrame]) -> DataFrame:
    return (
        _per_key(star, "customer_key")
        .join(star["dim_customers"], "customer_key")
        .groupBy("customer_state")
        .agg(
            as_double(F.sum("sales")).alias("total_sales"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("orders").alias("total_orders"),
        )
    )


def _per_key(star: dict[str, DataFrame], key: str, *more) -> DataFrame:
    """Fact rows summed per surrogate key: what meets the dimension is one row per key, small and even."""
    return star["fact_orders"].groupBy(key).agg(
        exact_sum(F.col("price")).alias("sales"), F.count("order_id").alias("orders"), *more
    )


def star_sales_by_seller(star: dict[str, DataFrame]) -> DataFrame:
    sales = _per_key(star, "seller_key")
    return (
        sales.join(star["dim_sellers"], "seller_key")
        .groupBy("seller_id", "seller_state")
        .agg(as_double(F.sum("sales")).alias("total_sales"), F.sum("orders").alias("total_orders"))
    )


def star_monthly_sales_trend(star: dict[str, DataFrame]) -> DataFrame:
    return (
        star["fact_orders"]
        .groupBy(year_month("order_purchase_timestamp").alias("month"))
        .agg(money("price").alias("total_sales"), F.count("order_id").alias("total_orders"))
        .orderBy("month")
    )


def star_avg_review_score(star: dict[str, DataFrame]) -> DataFrame:
    """Every fact row meets every review of its order, although it already stands for one of them."""
    scores = star["dim_reviews"].groupBy("order_id").agg(
        exact_sum(F.col("review_score"), SCORE_SCALE).alias("scores"),
        F.count("review_score").alias("n_scores"),
        F.count("review_id").alias("n_ids"),
    )
    # Rows per (order, product) first: far fewer rows meet the reviews.
    rows = star["fact_orders"].groupBy("order_id", "product_key").agg(F.count("*").alias("n"))
    joined = rows.join(scores, "order_id").join(star["dim_products"], "product_key")
    return _review_result(joined)


def _review_result(joined: DataFrame) -> DataFrame:
    total = as_double(F.sum(weighted(F.col("scores"), F.col("n"), SCORE_SCALE)))
    count = F.sum(F.col("n_scores") * F.col("n"))
    return joined.groupBy("product_id", F.col("product_category_name_english").alias("category")).agg(
        (total / count).alias("avg_review_score"),
        F.sum(F.col("n_ids") * F.col("n")).alias("total_reviews"),
    )


STAR_AGGREGATES = {
    "Agg_sales_by_category": star_sales_by_category,
    "Agg_sales_by_customer_state": star_sales_by_customer_state,
    "Agg_sales_by_seller": star_sales_by_seller,
    "Agg_monthly_sales_trend": star_monthly_sales_trend,
    "Agg_avg_review_score": star_avg_review_score,
}


# --- straight from the cleaned tables --------------------------------------------------------


def _rows(*counts: str):
    """Wide rows that one row here stands for."""
    product = F.col(counts[0])
    for c in counts[1:]:
        product = product * F.col(c)
    return product


def _total(c: str, rows):
    return as_double(weighted_money_sum(F.col(c), rows))


def sales_by_category(tables: CleanTables) -> DataFrame:
    rows = _rows("n_payments", "n_reviews")
    lines = item_lines(
        tables, ["product_category_name_english", "price", "freight_value"], ["n_payments", "n_reviews"]
    )
    return lines.groupBy(F.col("product_category_name_english").alias("category")).agg(
        _total("price", rows).alias("total_sales"),
        _total("freight_value", rows).alias("total_freight"),
        F.sum(rows).alias("total_orders"),
    )


def sales_by_customer_state(tables: CleanTables) -> DataFrame:
    orders = per_order(tables, "payments", "reviews", "items")
    by_customer = orders.groupBy("customer_state", "customer_id").agg(
        weighted_money_sum(F.col("priced"), _rows("n_payments", "n_reviews")).alias("sales"),
        F.sum(_rows("n_payments", "n_reviews", "n_items")).alias("n"),
    )
    return by_customer.groupBy("customer_state").agg(
        as_double(F.sum("sales")).alias("total_sales"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("n").alias("total_orders"),
    )


def sales_by_seller(tables: CleanTables) -> DataFrame:
    rows = _rows("n_payments", "n_reviews")
    lines = item_lines(tables, ["seller_id", "seller_state", "price"], ["n_payments", "n_reviews"])
    return lines.groupBy("seller_id", "seller_state").agg(
        _total("price", rows).alias("total_sales"), F.sum(rows).alias("total_orders")
    )


def monthly_sales_trend(tables: CleanTables) -> DataFrame:
    orders = per_order(tables, "payments", "reviews", "items")
    return (
        orders.groupBy(year_month("order_purchase_timestamp").alias("month"))
        .agg(
            _total("priced", _rows("n_payments", "n_reviews")).alias("total_sales"),
            F.sum(_rows("n_payments", "n_reviews", "n_items")).alias("total_orders"),
        )
        .orderBy("month")
    )


def avg_review_score(tables: CleanTables) -> DataFrame:
    """The distinct reviews of each order count once for every wide row of its products."""
    orders = per_order(tables, "payments", "reviews").join(_order_scores(tables), KEY)
    for c in ("scores", "n_scores", "n_ids"):
        undated = F.when(F.col("delivered"), F.col(f"{c}_undated")).otherwise(0)
        orders = orders.withColumn(c, F.col(f"{c}_dated") + undated)
    lines = item_lines(
        tables,
        ["product_id", "product_category_name_english"],
        ["n_payments", "n_reviews", "scores", "n_scores", "n_ids"],
        orders,
    )
    return _review_result(lines.withColumn("n", _rows("n_payments", "n_reviews")))


def _order_scores(tables: CleanTables) -> DataFrame:
    """Sums over the distinct reviews per order, apart for reviews with and without an own date."""
    distinct = tables.reviews.groupBy(KEY, "review_id", "review_score").agg(
        F.bool_or(F.col("review_creation_date").isNotNull()).alias("dated")
    )
    sums = []
    for suffix, chosen in (("dated", F.col("dated")), ("undated", ~F.col("dated"))):
        score = F.when(chosen, F.col("review_score"))
        sums += [
            F.coalesce(exact_sum(score, SCORE_SCALE), F.lit(0)).alias(f"scores_{suffix}"),
            F.count(score).alias(f"n_scores_{suffix}"),
            F.count(F.when(chosen, F.col("review_id"))).alias(f"n_ids_{suffix}"),
        ]
    return distinct.groupBy(KEY).agg(*sums)


AGGREGATES = {
    "Agg_sales_by_category": sales_by_category,
    "Agg_sales_by_customer_state": sales_by_customer_state,
    "Agg_sales_by_seller": sales_by_seller,
    "Agg_monthly_sales_trend": monthly_sales_trend,
    "Agg_avg_review_score": avg_review_score,
}
