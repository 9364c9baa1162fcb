"""Declared columns of every source table and the column groups the rules refer to."""

from __future__ import annotations

# Source columns (source spelling) and the type each one ends up with.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "int",
        "customer_city": "string",
        "customer_state": "string",
    },
    "payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "double",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
    },
    "items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "double",
        "freight_value": "double",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "double",
        "product_description_lenght": "double",
        "product_photos_qty": "double",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "int",
        "seller_city": "string",
        "seller_state": "string",
    },
}

# The two misspelled source columns and their corrected names.
RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

# Fill rules of the cleaning step.
NOT_AVAILABLE = "Not Available"
NOT_AVAILABLE_COLUMNS = ["review_comment_title", "review_comment_message"]
UNKNOWN = "Unknown"
UNKNOWN_COLUMNS = ["payment_type", "product_category_name", "product_category_name_english"]
MEAN_COLUMNS = ["review_score"]
MEDIAN_COLUMNS = [
    "payment_sequential",
    "payment_installments",
    "order_item_id",
    "price",
    "freight_value",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]

# Columns of the wide table, in join order; a key shared by two tables appears once.
MERGED_COLUMNS: list[str] = list(dict.fromkeys(c for t in SOURCE_COLUMNS.values() for c in t))
CLEAN_COLUMNS: list[str] = [RENAMES.get(c, c) for c in MERGED_COLUMNS]

# Type of every column under both its source and its corrected name.
COLUMN_TYPES: dict[str, str] = {c: t for cols in SOURCE_COLUMNS.values() for c, t in cols.items()}
COLUMN_TYPES.update({new: COLUMN_TYPES[old] for old, new in RENAMES.items()})

# Columns of the star schema and its natural keys.
DIMENSIONS: dict[str, tuple[str, list[str]]] = {
    "dim_customers": (
        "customer_key",
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    ),
    "dim_sellers": ("seller_key", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]),
    "dim_products": (
        "product_key",
        [
            "product_id",
            "product_category_name",
            "product_category_name_english",
            "product_name_length",
            "product_description_length",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ],
    ),
    "dim_payment_types": ("payment_type_key", ["payment_type"]),
    "dim_reviews": ("review_key", ["review_id", "order_id", "review_score"]),
}
FACT_MEASURES = [
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "shipping_limit_date",
    "payment_installments",
    "payment_value",
    "price",
    "freight_value",
]
FACT_LOOKUPS = {
    "dim_customers": ("customer_id", "customer_key"),
    "dim_sellers": ("seller_id", "seller_key"),
    "dim_products": ("product_id", "product_key"),
    "dim_payment_types": ("payment_type", "payment_type_key"),
}
FACT_COLUMNS = FACT_MEASURES + [key for _, key in FACT_LOOKUPS.values()]
