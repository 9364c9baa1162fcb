"""The eight order tables derived from the driver's TPC-H-like parquet files (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators.convert import convert_types

# Translated categories; PROMO has no translation on purpose.
TRANSLATION = [
    ("STANDARD", "standard"),
    ("ECONOMY", "economy"),
    ("MEDIUM", "medium"),
    ("SMALL", "small"),
    ("LARGE", "large"),
]
TRANSLATION_COLUMNS = "product_category_name, product_category_name_english"

# Columns of the driver's files. Declared, so that no job runs to look at the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
ZIP_TYPES = {"customer_zip_code_prefix": "int", "seller_zip_code_prefix": "int"}


def _places(tables, df: DataFrame, nation_key: str) -> DataFrame:
    """Add nation and region names."""
    return df.join(tables("nation"), F.col(nation_key) == F.col("n_nationkey")).join(
        tables("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def load_raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source frames as delivered: nulls present, zip prefixes still text."""

    def tables(name: str) -> DataFrame:
        return read_driver_table(spark, sf_dir, name)

    # Written as SQL expressions: a plan of the same columns, built with one call per table.
    order = tables("orders")
    orders = order.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderstatus AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "IF(o_orderkey % 50 = 0, NULL, o_orderdate + INTERVAL 1 HOUR) AS order_approved_at",
        "IF(o_orderkey % 30 = 0, NULL, o_orderdate + INTERVAL 2 DAY) AS order_delivered_carrier_date",
        "IF(o_orderkey % 20 = 0, NULL, o_orderdate + INTERVAL 9 DAY) AS order_delivered_customer_date",
        "o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date",
    )
    customers = _places(tables, tables("customer"), "c_nationkey").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_unique_id",
        "LPAD(CAST(c_custkey % 1000 AS STRING), 5, '0') AS customer_zip_code_prefix",
        "n_name AS customer_city",
        "r_name AS customer_state",
    )
    sellers = _places(tables, tables("supplier"), "s_nationkey").selectExpr(
        "s_suppkey AS seller_id",
        "LPAD(CAST(s_suppkey % 1000 AS STRING), 5, '0') AS seller_zip_code_prefix",
        "n_name AS seller_city",
        "r_name AS seller_state",
    )
    items = tables("lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "IF(l_linenumber = 7, NULL, l_extendedprice) AS price",
        "IF(l_linenumber = 6, NULL, l_quantity) AS freight_value",
    )
    products = tables("part").selectExpr(
        "p_partkey AS product_id",
        "IF(p_partkey % 25 = 0, NULL, p_type) AS product_category_name",
        "IF(p_partkey % 50 = 0, NULL, CAST(LENGTH(p_name) AS DOUBLE)) AS product_name_lenght",
        "IF(p_partkey % 50 = 0, NULL, CAST(LENGTH(p_name) * 10 AS DOUBLE)) AS product_description_lenght",
        "IF(p_partkey % 15 = 0, NULL, CAST(p_size % 5 AS DOUBLE)) AS product_photos_qty",
        "IF(p_partkey % 16 = 0, NULL, p_retailprice) AS product_weight_g",
        "IF(p_partkey % 17 = 0, NULL, CAST(p_size AS DOUBLE)) AS product_length_cm",
        "IF(p_partkey % 18 = 0, NULL, CAST(p_size + 1 AS DOUBLE)) AS product_height_cm",
        "IF(p_partkey % 19 = 0, NULL, CAST(p_size + 2 AS DOUBLE)) AS product_width_cm",
    )
    pairs = ", ".join(f"('{name}', '{english}')" for name, english in TRANSLATION)
    translation = spark.sql(f"SELECT * FROM VALUES {pairs} AS t({TRANSLATION_COLUMNS})")
    # Every order has one payment or, every tenth order, two: one row per array element.
    main = (
        "NAMED_STRUCT('payment_sequential', 1, 'payment_type', IF(o_orderkey % 43 = 0, NULL, o_orderpriority), "
        "'payment_installments', CAST(1 + o_orderkey % 4 AS INT), 'payment_value', o_totalprice)"
    )
    voucher = (
        "NAMED_STRUCT('payment_sequential', 2, 'payment_type', 'VOUCHER', 'payment_installments', 1, "
        "'payment_value', o_totalprice / 4)"
    )
    payments = (
        order.filter("o_orderkey % 37 <> 0")
        .selectExpr("o_orderkey AS order_id", f"EXPLODE(IF(o_orderkey % 10 = 0, ARRAY({main}, {voucher}), ARRAY({main}))) AS p")
        .select("order_id", "p.*")
    )
    first = (
        "NAMED_STRUCT('review_id', event_id, "
        "'review_score', IF(event_type = 'error', NULL, CAST(1 + event_id % 5 AS DOUBLE)), "
        "'review_comment_title', IF(event_type = 'click', NULL, event_type), "
        "'review_comment_message', IF(event_type = 'signup', NULL, props), "
        "'review_creation_date', IF(event_type = 'view', NULL, ts))"
    )
    second = (
        "NAMED_STRUCT('review_id', event_id + 1000000000, 'review_score', 5.0D, 'review_comment_title', CAST(NULL AS STRING), "
        "'review_comment_message', CAST(NULL AS STRING), 'review_creation_date', ts)"
    )
    reviews = (
        tables("events")
        .selectExpr("event_id AS order_id", f"EXPLODE(IF(event_id % 8 = 0, ARRAY({first}, {second}), ARRAY({first}))) AS r")
        .select("r.review_id", "order_id", "r.review_score", "r.review_comment_title", "r.review_comment_message", "r.review_creation_date")
    )
    return {
        "orders": orders,
        "customers": customers,
        "payments": payments,
        "reviews": reviews,
        "items": items,
        "products": products,
        "translation": translation,
        "sellers": sellers,
    }


def translation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The translation table as a source of its own: a row for each category of the products but the untranslated one."""
    parts = read_driver_table(spark, sf_dir, "part").filter("p_type <> 'PROMO'")
    return parts.selectExpr("p_type AS product_category_name", "LOWER(p_type) AS product_category_name_english").distinct()


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source frames after the ingest conversion; the numeric ids of the test data stay numeric."""
    return {name: convert_types(df, ZIP_TYPES) for name, df in load_raw_sources(spark, sf_dir).items()}
