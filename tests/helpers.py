"""Comparison and small hand-made inputs."""

from datetime import datetime

from ordermart.schemas import SOURCE_COLUMNS

EMPTY = "~"


def rows_of(df):
    """Rows as sorted tuples, columns in name order."""
    names = sorted(df.columns)
    return sorted(tuple(EMPTY if r[n] is None else _plain(r[n]) for n in names) for r in df.select(*names).collect())


def _plain(value):
    return f"{value!r}" if isinstance(value, float) else str(value)


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    assert rows_of(left) == rows_of(right)


def day(n):
    return datetime(2024, 1, n)


def frame(spark, table, rows):
    """A source table from dicts; columns that are not named are null."""
    columns = SOURCE_COLUMNS[table]
    schema = ", ".join(f"{c} {t}" for c, t in columns.items())
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema).coalesce(1)


def order(i, **more):
    return {
        "order_id": i,
        "customer_id": "c1",
        "order_status": "delivered",
        "order_purchase_timestamp": day(1),
        "order_estimated_delivery_date": day(20),
    } | more


def payment(i, n=1, value=10.0, **more):
    return {"order_id": i, "payment_sequential": n, "payment_type": "card", "payment_installments": 2, "payment_value": value} | more


def review(i, name, **more):
    return {"review_id": name, "order_id": i, "review_score": 4.0, "review_creation_date": day(9)} | more


def item(i, n=1, **more):
    return {
        "order_id": i,
        "order_item_id": n,
        "product_id": "p1",
        "seller_id": "s1",
        "shipping_limit_date": day(5),
        "price": 100.0,
        "freight_value": 5.0,
    } | more


def product(name="p1", **more):
    columns = {c: 1.0 for c in SOURCE_COLUMNS["products"] if c.startswith("product_") and c != "product_category_name"}
    return columns | {"product_id": name, "product_category_name": "toys"} | more


def small_sources(spark, orders, payments, reviews, items, products=None):
    return {
        "orders": frame(spark, "orders", orders),
        "customers": frame(
            spark,
            "customers",
            [{"customer_id": "c1", "customer_unique_id": "u1", "customer_zip_code_prefix": 1, "customer_city": "a", "customer_state": "A"}],
        ),
        "payments": frame(spark, "payments", payments),
        "reviews": frame(spark, "reviews", reviews),
        "items": frame(spark, "items", items),
        "products": frame(spark, "products", products or [product()]),
        "translation": frame(spark, "translation", [{"product_category_name": "toys", "product_category_name_english": "toys"}]),
        "sellers": frame(
            spark, "sellers", [{"seller_id": "s1", "seller_zip_code_prefix": 2, "seller_city": "b", "seller_state": "B"}]
        ),
    }
