"""The same results as plain SQL over the driver's views, built in layers of common table expressions.

This SQL works row by row on the multiplied wide table, as opposed to the counted plans of the
library, so the two agree only if the counting is right.
"""

from __future__ import annotations

import re

from ordermart.operators.insights import CHARTS as CHART_COLUMNS
from ordermart.schemas import (
    CLEAN_COLUMNS,
    COLUMN_TYPES,
    DIMENSIONS,
    FACT_COLUMNS,
    FACT_LOOKUPS,
    FACT_MEASURES,
    MEDIAN_COLUMNS,
    MERGED_COLUMNS,
    RENAMES,
    SOURCE_COLUMNS,
)

SOURCES = """
src_orders as (
  select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as order_status,
    o_orderdate as order_purchase_timestamp,
    case when o_orderkey % 50 = 0 then null else o_orderdate + interval '1' hour end as order_approved_at,
    case when o_orderkey % 30 = 0 then null else o_orderdate + interval '2' day end as order_delivered_carrier_date,
    case when o_orderkey % 20 = 0 then null else o_orderdate + interval '9' day end as order_delivered_customer_date,
    o_orderdate + interval '20' day as order_estimated_delivery_date
  from orders),
src_customers as (
  select c_custkey as customer_id, c_name as customer_unique_id,
    cast(lpad(cast(c_custkey % 1000 as varchar), 5, '0') as int) as customer_zip_code_prefix,
    n_name as customer_city, r_name as customer_state
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
src_sellers as (
  select s_suppkey as seller_id, cast(lpad(cast(s_suppkey % 1000 as varchar), 5, '0') as int) as seller_zip_code_prefix,
    n_name as seller_city, r_name as seller_state
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
src_items as (
  select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id, l_suppkey as seller_id,
    l_shipdate as shipping_limit_date,
    case when l_linenumber = 7 then null else l_extendedprice end as price,
    case when l_linenumber = 6 then null else l_quantity end as freight_value
  from lineitem),
src_products as (
  select p_partkey as product_id,
    case when p_partkey % 25 = 0 then null else p_type end as product_category_name,
    case when p_partkey % 50 = 0 then null else cast(length(p_name) as double) end as product_name_lenght,
    case when p_partkey % 50 = 0 then null else cast(length(p_name) * 10 as double) end as product_description_lenght,
    case when p_partkey % 15 = 0 then null else cast(p_size % 5 as double) end as product_photos_qty,
    case when p_partkey % 16 = 0 then null else p_retailprice end as product_weight_g,
    case when p_partkey % 17 = 0 then null else cast(p_size as double) end as product_length_cm,
    case when p_partkey % 18 = 0 then null else cast(p_size + 1 as double) end as product_height_cm,
    case when p_partkey % 19 = 0 then null else cast(p_size + 2 as double) end as product_width_cm
  from part),
src_translation as (
  select * from (values ('STANDARD','standard'),('ECONOMY','economy'),('MEDIUM','medium'),('SMALL','small'),('LARGE','large'))
    t(product_category_name, product_category_name_english)),
src_payments as (
  select o_orderkey as order_id, 1 as payment_sequential,
    case when o_orderkey % 43 = 0 then null else o_orderpriority end as payment_type,
    cast(1 + o_orderkey % 4 as int) as payment_installments, o_totalprice as payment_value
  from orders where o_orderkey % 37 <> 0
  union all
  select o_orderkey, 2, 'VOUCHER', 1, o_totalprice / 4 from orders where o_orderkey % 10 = 0 and o_orderkey % 37 <> 0),
src_reviews as (
  select event_id as review_id, event_id as order_id,
    case when event_type = 'error' then null else cast(1 + event_id % 5 as double) end as review_score,
    case when event_type = 'click' then null else event_type end as review_comment_title,
    case when event_type = 'signup' then null else props end as review_comment_message,
    case when event_type = 'view' then null else ts end as review_creation_date
  from events
  union all
  select event_id + 1000000000, event_id, 5.0, null, null, ts from events where event_id % 8 = 0)
"""

MERGED = f"""
merged as (
  select {", ".join(MERGED_COLUMNS)}
  from src_orders
  left join src_customers using (customer_id)
  left join src_payments using (order_id)
  left join src_reviews using (order_id)
  left join src_items using (order_id)
  left join src_products using (product_id)
  left join src_translation using (product_category_name)
  left join src_sellers using (seller_id))
"""

# Only the columns the statistics need: the merged rows once more, but narrow.
STATS = f"""
narrow as (
  select review_score, {", ".join(MEDIAN_COLUMNS)}
  from src_orders
  left join src_payments using (order_id)
  left join src_reviews using (order_id)
  left join src_items using (order_id)
  left join src_products using (product_id)),
stats as materialized (
  select avg(review_score) as mean_review_score,
    {", ".join(f"median(cast({c} as double)) as median_{c}" for c in MEDIAN_COLUMNS)}
  from narrow)
"""


def _cleaned_column(c: str) -> str:
    if c in MEDIAN_COLUMNS:
        return f"coalesce(cast({c} as double), median_{c}) as {c}"
    return {
        "review_score": "coalesce(review_score, mean_review_score) as review_score",
        "review_comment_title": "coalesce(review_comment_title, 'Not Available') as review_comment_title",
        "review_comment_message": "coalesce(review_comment_message, 'Not Available') as review_comment_message",
        "review_creation_date": "coalesce(review_creation_date, order_delivered_customer_date) as review_creation_date",
        "payment_type": "coalesce(payment_type, 'Unknown') as payment_type",
        "product_category_name": "coalesce(product_category_name, 'Unknown') as product_category_name",
        "product_category_name_english": "coalesce(product_category_name_english, 'Unknown') as product_category_name_english",
        "product_name_length": "product_name_lenght as product_name_length",
        "product_description_length": "product_description_lenght as product_description_length",
        "order_approved_at": "coalesce(order_approved_at, order_purchase_timestamp) as order_approved_at",
        "order_delivered_carrier_date": "coalesce(order_delivered_carrier_date, order_approved_at, "
        "order_purchase_timestamp) as order_delivered_carrier_date",
        "order_delivered_customer_date": "coalesce(order_delivered_customer_date, order_estimated_delivery_date) "
        "as order_delivered_customer_date",
    }.get(c, c)


CLEANED = f"""
filled as (
  select {", ".join(_cleaned_column(c) for c in CLEAN_COLUMNS)}
  from merged cross join stats),
cleaned as materialized (
  select * from filled where {" and ".join(f"{c} is not null" for c in CLEAN_COLUMNS)})
"""

NATURAL_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_sellers": ["seller_id"],
    "dim_products": ["product_id"],
    "dim_payment_types": ["payment_type"],
    "dim_reviews": ["review_id", "order_id"],
}


def dense_key(natural_key: list[str], name: str) -> str:
    text = ", ".join(f"cast({c} as varchar)" for c in natural_key)
    order = ", ".join(natural_key)
    return f"row_number() over (order by substr(md5(concat_ws('|', {text})), 1, 3), {order}) as {name}"


def _dimension(name: str) -> str:
    key, columns = DIMENSIONS[name]
    return (
        f"{name} as (select {dense_key(NATURAL_KEYS[name], key)}, {', '.join(columns)} "
        f"from (select distinct {', '.join(columns)} from cleaned))"
    )


STAR = ",\n".join(_dimension(n) for n in DIMENSIONS) + f""",
fact_orders as (
  select {", ".join("cast(c.payment_installments as int) as payment_installments" if m == "payment_installments" else "c." + m for m in FACT_MEASURES)},
    {", ".join(key for _, key in FACT_LOOKUPS.values())}
  from cleaned c
  {" ".join(f"left join {d} on c.{b} = {d}.{b}" for d, (b, _) in FACT_LOOKUPS.items())})
"""


def money(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(18,4))) as double)"


REPORTS = f"""
agg_sales_by_category as (
  select product_category_name_english as category, {money("price")} as total_sales,
    {money("freight_value")} as total_freight, count(order_id) as total_orders
  from cleaned group by product_category_name_english),
agg_sales_by_customer_state as (
  select customer_state, {money("price")} as total_sales, count(distinct customer_id) as unique_customers,
    count(order_id) as total_orders
  from cleaned group by customer_state),
agg_sales_by_seller as (
  select seller_id, seller_state, {money("price")} as total_sales, count(order_id) as total_orders
  from cleaned group by seller_id, seller_state),
agg_monthly_sales_trend as (
  select strftime(order_purchase_timestamp, '%Y-%m') as month, {money("price")} as total_sales,
    count(order_id) as total_orders
  from cleaned group by strftime(order_purchase_timestamp, '%Y-%m')),
agg_avg_review_score as (
  select c.product_id, c.product_category_name_english as category,
    cast(sum(cast(cast(r.review_score as varchar) as decimal(28,16))) as double) / count(r.review_score) as avg_review_score,
    count(r.review_id) as total_reviews
  from cleaned c join (select distinct review_id, order_id, review_score from cleaned) r on c.order_id = r.order_id
  group by c.product_id, c.product_category_name_english),
dm_sales_performance as (
  select customer_id, {money("payment_value")} as total_revenue, count(distinct order_id) as total_orders,
    {money("payment_value")} / count(payment_value) as avg_order_value
  from cleaned group by customer_id),
dm_product_category_analysis as (
  select product_category_name, count(order_id) as total_sales, {money("payment_value")} as total_revenue,
    {money("price")} / count(price) as avg_price
  from cleaned group by product_category_name),
dm_customer_behavior as (
  select customer_id, count(distinct order_id) as total_orders, count(distinct product_id) as distinct_products,
    {money("payment_value")} as total_spent
  from cleaned group by customer_id),
dm_order_fulfillment as (
  select order_status,
    cast(trunc(cast(sum(date_diff('second', order_purchase_timestamp, order_delivered_customer_date)) as double)
      / count(*)) as bigint) as avg_shipping_time,
    count(order_id) as total_orders
  from cleaned where order_delivered_customer_date is not null group by order_status),
dm_payment_analysis as (
  select payment_type, {money("payment_value")} as total_revenue, count(order_id) as total_transactions
  from cleaned group by payment_type)
"""

LAYERS = [SOURCES, MERGED, STATS, CLEANED, STAR, REPORTS]


def _tables_of(layers: list[str]) -> dict[str, str]:
    """Each named expression of the layers, in order."""
    text = ",\n".join(layer.strip() for layer in layers) + ",\n"
    starts = [(m.start(), m.group(1)) for m in re.finditer(r"^(\w+) as (?:materialized )?\(", text, re.MULTILINE)]
    ends = [at for at, _ in starts[1:]] + [len(text)]
    return {name: text[at:end].rstrip().rstrip(",") for (at, name), end in zip(starts, ends, strict=True)}


def sql(select: str) -> str:
    """The statement with just the expressions it needs."""
    tables = _tables_of(LAYERS)
    needed, todo = set(), [select]
    while todo:
        text = todo.pop()
        for name in tables:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(tables[name].partition("(")[2])
    parts = [text for name, text in tables.items() if name in needed]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select


def total(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(28,4))) as double) as {c}"


def count(c: str) -> str:
    return f"cast(sum({c}) as bigint) as {c}"


def mean(c: str) -> str:
    return f"{lossless(c)} / count({c}) as {c}"


def lossless(c: str) -> str:
    """Sum of doubles as they are written, without rounding."""
    return f"cast(sum(cast(cast({c} as varchar) as decimal(38,20))) as double)"


def share(table: str, key: str, measure: str, kind: str) -> str:
    value = "decimal(28,4)" if kind == "double" else "bigint"
    return (
        f"select {key}, cast(v as {kind}) as {measure}, cast(v as double) / cast(sum(v) over () as double) as share "
        f"from (select {key}, sum(cast({measure} as {value})) as v from {table} group by {key})"
    )


def series(chart: str, table: str, label: str, measure: str) -> str:
    return f"select '{chart}' as chart, {label} as label, '{measure}' as measure, cast({measure} as double) as value from {table}"


CHARTS = " union all ".join(
    [
        series("category_sales", "agg_sales_by_category", "category", "total_sales"),
        series("category_freight", "agg_sales_by_category", "category", "total_sales"),
        series("category_freight", "agg_sales_by_category", "category", "total_freight"),
        series("category_freight", "agg_sales_by_category", "category", "total_orders"),
        series("state_sales", "agg_sales_by_customer_state", "customer_state", "total_sales"),
        series("state_customers", "agg_sales_by_customer_state", "customer_state", "unique_customers"),
        series("seller_sales", "agg_sales_by_seller", "cast(seller_id as varchar) || ' / ' || seller_state", "total_sales"),
        series("month_sales", "agg_monthly_sales_trend", "month", "total_sales"),
        series("month_orders", "agg_monthly_sales_trend", "month", "total_orders"),
        series("product_score", "agg_avg_review_score", "cast(product_id as varchar) || ' / ' || category", "avg_review_score"),
        series("mart_category_sales", "dm_product_category_analysis", "product_category_name", "total_sales"),
        series("mart_category_price", "dm_product_category_analysis", "product_category_name", "avg_price"),
        series("customer_spending", "dm_customer_behavior", "cast(customer_id as varchar)", "total_orders"),
        series("customer_spending", "dm_customer_behavior", "cast(customer_id as varchar)", "total_spent"),
        series("status_shipping", "dm_order_fulfillment", "order_status", "avg_shipping_time"),
        series("type_revenue", "dm_payment_analysis", "payment_type", "total_revenue"),
    ]
)


def preview(name: str) -> str:
    key, _ = DIMENSIONS[name]
    natural = " || '|' || ".join(f"cast({c} as varchar)" for c in NATURAL_KEYS[name])
    return f"select '{name}' as table_name, {key} as row_key, {natural} as natural_key from {name} where {key} <= 5"


TABLES = [
    "agg_sales_by_category",
    "agg_sales_by_customer_state",
    "agg_sales_by_seller",
    "agg_monthly_sales_trend",
    "agg_avg_review_score",
    "dm_sales_performance",
    "dm_product_category_analysis",
    "dm_customer_behavior",
    "dm_order_fulfillment",
    "dm_payment_analysis",
]
PUBLISHED = [*DIMENSIONS, "fact_orders", *TABLES]

def _converted(c: str) -> str:
    """A column after its conversion, under its corrected name."""
    kind, name = COLUMN_TYPES[c], RENAMES.get(c, c)
    if c == "payment_installments":
        return "case when order_id % 9 = 0 and order_id % 5 <> 0 then null else payment_installments end as payment_installments"
    if c == "order_approved_at":
        return "case when order_id % 7 = 0 then null else order_approved_at end as order_approved_at"
    if kind == "string":
        return f"cast({c} as varchar) as {name}"
    return f"{c} as {name}"


def formatted(name: str, columns: list[tuple[str, str]]) -> str:
    text = {"total": "format('{{:,.2f}}', {0}) as {0}", "mean": "format('{{:,.2f}}', {0}) as {0}", "count": "cast({0} as varchar) as {0}"}
    inner = ", ".join({"total": total, "mean": mean, "count": count}[kind](c) for c, kind in columns)
    return f"select {', '.join(text[kind].format(c) for c, kind in columns)} from (select {inner} from {name})"


def first_rows(name: str, order: str) -> str:
    return f"select * from {name} order by {order} limit 5"


CHART_TABLES = {
    name: f"select {', '.join([*labels, *measures])} from {table.lower()}" for name, (table, labels, measures) in CHART_COLUMNS.items()
}
TRANSLATION_FILE = (
    "select distinct p_type as product_category_name, lower(p_type) as product_category_name_english from part where p_type <> 'PROMO'"
)


def inferred(table: str) -> str:
    """Each column's type by the shape of its text; dates and numbers together are text."""
    rows = f"({TRANSLATION_FILE})" if table == "translation" else f"src_{table}"
    whole, number = "'[+-]?[0-9]+'", "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"
    moment = "'[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?'"
    kinds = {
        "int": f"regexp_full_match(v, {whole}) and try_cast(v as int) is not null",
        "bigint": f"regexp_full_match(v, {whole}) and try_cast(v as bigint) is not null",
        "double": f"regexp_full_match(v, {number})",
        "timestamp_ntz": f"regexp_full_match(v, {moment}) and try_cast(v as timestamp) is not null",
    }
    first = " ".join(
        f"when count(*) filter (where v is not null and not coalesce({holds}, false)) = 0 then '{kind}'" for kind, holds in kinds.items()
    )
    return " union all ".join(
        f"select '{table}' as table_name, {i} as position, '{c}' as column_name, case when count(v) = 0 then 'null' {first} "
        f"else 'string' end as type, count(*) as n_rows, count(*) - count(v) as n_nulls "
        f"from (select nullif(cast({c} as varchar), '') as v from {rows})"
        for i, c in enumerate(SOURCE_COLUMNS[table], 1)
    )


SELECTS: dict[str, str] = {
    "join_customers": "select * from src_orders left join src_customers using (customer_id)",
    "join_payments": "select * from src_orders left join src_payments using (order_id)",
    "join_reviews": "select * from src_orders left join src_reviews using (order_id)",
    "join_items": "select * from src_orders left join src_items using (order_id)",
    "join_products": "select * from src_items left join src_products using (product_id)",
    "join_translation": "select * from src_products left join src_translation using (product_category_name)",
    "join_sellers": "select * from src_items left join src_sellers using (seller_id)",
    "merge_wide": "select * from merged",
    "clean_const_fill": "select order_id, review_id, coalesce(review_comment_title, 'Not Available') as review_comment_title, "
    "coalesce(review_comment_message, 'Not Available') as review_comment_message from merged",
    "clean_unknown_fill": "select order_id, product_id, coalesce(payment_type, 'Unknown') as payment_type, "
    "coalesce(product_category_name, 'Unknown') as product_category_name, "
    "coalesce(product_category_name_english, 'Unknown') as product_category_name_english from merged",
    "clean_mean_fill": "select order_id, review_id, coalesce(review_score, mean_review_score) as review_score "
    "from src_orders left join src_payments using (order_id) left join src_reviews using (order_id) "
    "left join src_items using (order_id) cross join stats",
    "clean_median_fill": f"select order_id, {', '.join(f'coalesce(cast({c} as double), median_{c}) as {c}' for c in MEDIAN_COLUMNS)} "
    "from merged cross join stats",
    "clean_review_date": "select order_id, review_id, coalesce(review_creation_date, order_delivered_customer_date) "
    "as review_creation_date from merged",
    "clean_rename": "select product_id, product_name_lenght as product_name_length, "
    "product_description_lenght as product_description_length from src_products",
    "clean_timestamp_chain": "select order_id, coalesce(order_approved_at, order_purchase_timestamp) as order_approved_at, "
    "coalesce(order_delivered_carrier_date, order_approved_at, order_purchase_timestamp) as order_delivered_carrier_date, "
    "coalesce(order_delivered_customer_date, order_estimated_delivery_date) as order_delivered_customer_date from src_orders",
    "clean_dropna": "select order_id, payment_sequential, review_id, order_item_id, product_id, price from merged where "
    + " and ".join(f"{c} is not null" for c in MERGED_COLUMNS),
    "clean_wide": "select * from cleaned",
    "clean_merged": "select * from cleaned",
    "convert_types": "select "
    + ", ".join(_converted(c) for c in MERGED_COLUMNS)
    + " from merged",
    "nan_to_null": "select * replace (case when event_id % 10 = 0 then null else value end as value) from events",
    "sanitize_columns": "select c_custkey, c_name as full_name, c_nationkey, c_acctbal as account___balance, "
    "c_mktsegment as market_segment from customer",
    "shipping_time": "select order_id, coalesce(date_diff('second', order_purchase_timestamp, "
    "order_delivered_customer_date), 0) as shipping_time from src_orders",
    "filter_delivered": "select * from src_orders where order_delivered_customer_date is not null",
    "surrogate_key": f"select {dense_key(['order_id'], 'order_key')}, order_id, order_status from src_orders",
    **{name: f"select * from {name}" for name in PUBLISHED},
    **{f"star_{name}": f"select * from {name}" for name in TABLES if name.startswith("agg")},
    **{f"wide_{name}": f"select * from {name}" for name in TABLES if name.startswith("dm")},
    "kpi_sales_performance": f"select {total('total_revenue')}, {mean('avg_order_value')}, {count('total_orders')} "
    "from dm_sales_performance",
    "kpi_product_category": f"select {count('total_sales')}, {total('total_revenue')}, {mean('avg_price')} "
    "from dm_product_category_analysis",
    "kpi_customer_behavior": f"select {count('total_orders')}, {count('distinct_products')}, {total('total_spent')} "
    "from dm_customer_behavior",
    "kpi_order_fulfillment": f"select {count('total_orders')} from dm_order_fulfillment",
    "kpi_payment_analysis": f"select {total('total_revenue')}, {count('total_transactions')} from dm_payment_analysis",
    "kpi_formatted": formatted("dm_payment_analysis", [("total_revenue", "total"), ("total_transactions", "count")]),
    "kpi_formatted_sales": formatted(
        "dm_sales_performance", [("total_revenue", "total"), ("avg_order_value", "mean"), ("total_orders", "count")]
    ),
    "kpi_formatted_category": formatted(
        "dm_product_category_analysis", [("total_sales", "count"), ("total_revenue", "total"), ("avg_price", "mean")]
    ),
    "kpi_formatted_customer": formatted(
        "dm_customer_behavior", [("total_orders", "count"), ("distinct_products", "count"), ("total_spent", "total")]
    ),
    "share_sales_by_seller_state": share("agg_sales_by_seller", "seller_state", "total_sales", "double"),
    "share_orders_by_status": share("dm_order_fulfillment", "order_status", "total_orders", "bigint"),
    "share_transactions_by_type": share("dm_payment_analysis", "payment_type", "total_transactions", "bigint"),
    "reviews_by_category": f"select category, {count('total_reviews')}, {lossless('avg_review_score')} "
    "as stacked_avg_review_score from agg_avg_review_score group by category",
    "top10_customers": "select * from dm_sales_performance order by total_revenue desc, customer_id limit 10",
    "chart_series": CHARTS,
    "preview_dims": " union all ".join(preview(name) for name in DIMENSIONS),
    **{f"preview_{name}": first_rows(name, key) for name, (key, _) in DIMENSIONS.items()},
    "preview_fact_orders": first_rows("fact_orders", ", ".join(FACT_COLUMNS)),
    **{f"chart_{name}": select for name, select in CHART_TABLES.items()},
    "src_csv": "select * from src_customers",
    "src_csv_orders": "select * from src_orders",
    "src_csv_payments": "select * from src_payments",
    "src_csv_reviews": "select * from src_reviews",
    "src_csv_items": "select * from src_items",
    "src_csv_products": "select * from src_products",
    "src_csv_translation": TRANSLATION_FILE,
    "src_csv_sellers": "select * from src_sellers",
    "src_csv_inferred": " union all ".join(inferred(table) for table in SOURCE_COLUMNS),
    "sink_csv_roundtrip": "select * replace (case when review_id % 3 = 0 then '' else review_comment_title end as review_comment_title, "
    "case when review_id % 4 = 0 and review_comment_message is not null "
    "then 'two' || chr(10) || 'lines, \"quoted\" ' || review_comment_message else review_comment_message end "
    "as review_comment_message) from merged",
    "star_append": " union all ".join(
        f"select '{name}' as table_name, 2 * count(*) as n_rows from {name}" for name in [*DIMENSIONS, "fact_orders"]
    ),
    "snapshot_refresh": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, true as old_reader_kept from {name}" for name in PUBLISHED
    ),
    "star_keys_stable": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, count(*) as natural_keys, count(*) as row_keys, count(*) as highest_key, "
        f"cast(0 as bigint) as moved_keys, cast(0 as bigint) as lost_keys from (select distinct {', '.join(keys)} from cleaned "
        "where order_id % 3 <> 0 or order_id % 5 <> 0)"
        for name, keys in NATURAL_KEYS.items()
    ),
    **{
        f"incremental_{name}": f"select * from {name}"
        for name in ("agg_sales_by_customer_state", "agg_avg_review_score", "dm_customer_behavior")
    },
    "star_extended_sales": "select * from agg_sales_by_seller",
    "job_from_files": "select * from agg_sales_by_customer_state",
    "sink_append": "select order_id, order_status, cast(2 * count(*) as bigint) as copies from src_orders group by order_id, order_status",
    "sink_overwrite": "select order_id, order_status, count(*) as copies from src_orders group by order_id, order_status",
    "scan_table": "select * from dm_payment_analysis",
    "list_agg_tables": "select * from (values "
    + ", ".join(f"('{name}')" for name in TABLES if name.startswith("agg"))
    + ") t(table_name)",
    "relational_rows": f"select 1000 + {dense_key(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment', 'copy_number'], 'id')}, "
    "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer' as table_name "
    "from (select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, "
    "cast(c_acctbal as varchar) as c_acctbal, c_mktsegment, 0 as copy_number from customer)",
    "warehouse_refresh": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {name}" for name in PUBLISHED
    ),
}


def oracle() -> dict[str, str]:
    return {name: sql(select) for name, select in SELECTS.items()}
