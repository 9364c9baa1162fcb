"""Every query of the library over the driver's tables: name -> (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.columns import nan_to_null, sanitize_columns, table_name
from ordermart.operators import aggregates, clean, insights, marts, star
from ordermart.operators.convert import convert_types, parse_types, refuse_unparsed
from ordermart.operators.keys import surrogate_key
from ordermart.operators.merge import LOOKUPS, left_join, merge_wide
from ordermart.operators.statistics import merged_statistics
from ordermart.operators.fanout import LINE_TABLES, LineCounts
from ordermart.plans.incremental import IncrementalResults
from ordermart.plans.refresh import extend_star, publish_aggregates, publish_star, refresh, refresh_snapshot, stage
from ordermart.schemas import (
    COLUMN_TYPES,
    DIMENSIONS,
    FACT_LOOKUPS,
    MEDIAN_COLUMNS,
    NOT_AVAILABLE_COLUMNS,
    RENAMES,
    UNKNOWN_COLUMNS,
)
from ordermart.session import at_once, configure, fresh_dir, materialise
from ordermart.sources.catalog import application_database, list_tables, publish, read_mart, read_table, stage_database
from ordermart.sources.files import NULL_TEXT, read_csv, read_csv_as, write_csv
from ordermart.sources.infer import infer_types
from ordermart.sources.jdbc import relational_rows
from ordermart.sources.testdata import load_raw_sources, load_sources, read_driver_table, translation_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Filled numeric columns each result reads. The statistics of the others are not computed; that they have a value at
# all is checked, as a column without one drops every row.
READS = {
    "Agg_sales_by_category": ["price", "freight_value"],
    "Agg_sales_by_customer_state": ["price"],
    "Agg_sales_by_seller": ["price"],
    "Agg_monthly_sales_trend": ["price"],
    "Agg_avg_review_score": ["review_score"],
    "dm_sales_performance": [],
    "dm_product_category_analysis": ["price"],
    "dm_customer_behavior": [],
    "dm_order_fulfillment": [],
    "dm_payment_analysis": [],
    "dim_customers": [],
    "dim_sellers": [],
    "dim_products": [c for c in DIMENSIONS["dim_products"][1] if c in MEDIAN_COLUMNS],
    "dim_payment_types": [],
    "dim_reviews": ["review_score"],
    "fact_orders": ["payment_installments", "price", "freight_value"],
}
BUILDERS = aggregates.AGGREGATES | marts.MARTS


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        return build

    return register


def cleaned(spark: SparkSession, sf_dir: str, *results: str) -> clean.CleanTables:
    columns = sorted({c for r in results for c in READS[r]})
    return clean.clean_tables(load_sources(spark, sf_dir), columns)


def staged(spark: SparkSession, sf_dir: str, *results: str) -> clean.CleanTables:
    """The cleaned tables written once, for queries that read them several times."""
    columns = sorted({c for r in results for c in READS[r]})
    return stage(spark, load_sources(spark, sf_dir), columns, results=any(r in BUILDERS for r in results))


def dimensions(spark: SparkSession, tables: clean.CleanTables, names: list[str]) -> dict[str, DataFrame]:
    """Dimensions side by side; each writes its rows once when it is numbered."""
    return at_once(spark, {name: lambda name=name: star.build_dimension(tables, name) for name in names})


def result(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An aggregate or mart straight from the sources."""
    return BUILDERS[name](cleaned(spark, sf_dir, name))


# --- joins -------------------------------------------------------------------------------------

for _name, _left, _right, _key in [
    ("join_customers", "orders", "customers", LOOKUPS["customers"]),
    ("join_payments", "orders", "payments", "order_id"),
    ("join_reviews", "orders", "reviews", "order_id"),
    ("join_items", "orders", "items", "order_id"),
    ("join_products", "items", "products", LOOKUPS["products"]),
    ("join_translation", "products", "translation", LOOKUPS["translation"]),
    ("join_sellers", "items", "sellers", LOOKUPS["sellers"]),
]:

    @query(_name)
    def _join(spark, sf_dir, left=_left, right=_right, key=_key):
        sources = load_sources(spark, sf_dir)
        return left_join(sources[left], sources[right], key)


@query("merge_wide")
def _merge_wide(spark, sf_dir):
    return merge_wide(load_sources(spark, sf_dir))


# --- cleaning ----------------------------------------------------------------------------------


@query("clean_const_fill")
def _const_fill(spark, sf_dir):
    merged = clean.fill_constants(merge_wide(load_sources(spark, sf_dir)))
    return merged.select("order_id", "review_id", *NOT_AVAILABLE_COLUMNS)


@query("clean_unknown_fill")
def _unknown_fill(spark, sf_dir):
    merged = clean.fill_constants(merge_wide(load_sources(spark, sf_dir)))
    return merged.select("order_id", "product_id", *UNKNOWN_COLUMNS)


@query("clean_mean_fill")
def _mean_fill(spark, sf_dir):
    sources = load_sources(spark, sf_dir)
    lines = LineCounts(sources)
    merged = merge_wide(sources, lines=lines).select("order_id", "review_id", "review_score")
    return clean.fill_statistics(merged, merged_statistics(sources, ["review_score"], lines))


@query("clean_median_fill")
def _median_fill(spark, sf_dir):
    sources = load_sources(spark, sf_dir)
    lines = LineCounts(sources)
    merged = merge_wide(sources, lines=lines).select("order_id", *MEDIAN_COLUMNS)
    return clean.fill_statistics(merged, merged_statistics(sources, MEDIAN_COLUMNS, lines))


@query("clean_review_date")
def _review_date(spark, sf_dir):
    merged = merge_wide(load_sources(spark, sf_dir))
    return merged.select("order_id", "review_id", clean.review_date().alias("review_creation_date"))


@query("clean_rename")
def _rename(spark, sf_dir):
    return clean.rename(load_sources(spark, sf_dir)["products"]).select("product_id", *RENAMES.values())


@query("clean_timestamp_chain")
def _timestamp_chain(spark, sf_dir):
    orders = load_sources(spark, sf_dir)["orders"].withColumns(clean.timestamp_chain())
    return orders.select("order_id", *clean.timestamp_chain())


@query("clean_dropna")
def _dropna(spark, sf_dir):
    rows = clean.drop_incomplete(merge_wide(load_sources(spark, sf_dir)))
    return rows.select("order_id", "payment_sequential", "review_id", "order_item_id", "product_id", "price")


@query("clean_wide")
def _clean_wide(spark, sf_dir):
    return clean.clean_sources(load_sources(spark, sf_dir))


@query("clean_merged")
def _clean_merged(spark, sf_dir):
    return clean.clean_wide(merge_wide(load_sources(spark, sf_dir)))


def as_delivered(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All columns as text, with bad timestamps, integers written as 2.0 and integers in words."""

    def text(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])

    out = {name: text(df) for name, df in sources.items()}
    payments, orders = out["payments"], out["orders"]
    count = F.col("payment_installments")
    written = F.when(F.col("order_id") % 5 == 0, F.concat(count, F.lit(".0"))).when(F.col("order_id") % 9 == 0, "many").otherwise(count)
    approved = F.when(F.col("order_id") % 7 == 0, "unknown").otherwise(F.col("order_approved_at"))
    return out | {
        "payments": payments.withColumn("payment_installments", written),
        "orders": orders.withColumn("order_approved_at", approved),
    }


@query("convert_types")
def _convert_types(spark, sf_dir):
    """All 36 columns of the eight tables, delivered as text, one row per order and line."""
    sources = as_delivered(load_raw_sources(spark, sf_dir))
    # Texts are parsed before the merge repeats them; what is no number is an error only in a merged row.
    types = COLUMN_TYPES | {old: COLUMN_TYPES[new] for old, new in RENAMES.items()}
    merged = merge_wide({name: parse_types(df, types) for name, df in sources.items()})
    return convert_types(clean.rename(refuse_unparsed(merged)))


@query("nan_to_null")
def _nan_to_null(spark, sf_dir):
    events = read_driver_table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return nan_to_null(events.withColumn("value", value))


@query("sanitize_columns")
def _sanitize_columns(spark, sf_dir):
    customers = read_driver_table(spark, sf_dir, "customer")
    return sanitize_columns(customers.withColumnsRenamed({"c_name": "full-name", "c_mktsegment": "market segment", "c_acctbal": "account - balance"}))


@query("shipping_time")
def _shipping_time(spark, sf_dir):
    return marts.with_shipping_time(load_sources(spark, sf_dir)["orders"]).select("order_id", "shipping_time")


@query("filter_delivered")
def _filter_delivered(spark, sf_dir):
    return marts.delivered_only(load_sources(spark, sf_dir)["orders"])


# --- star schema -------------------------------------------------------------------------------


@query("surrogate_key")
def _surrogate_key(spark, sf_dir):
    orders = load_sources(spark, sf_dir)["orders"].select("order_id", "order_status")
    return surrogate_key(orders, "order_key", ["order_id"])


for _name in DIMENSIONS:

    @query(_name)
    def _dimension(spark, sf_dir, name=_name):
        return star.build_dimension(cleaned(spark, sf_dir, name), name)


@query("fact_orders")
def _fact_orders(spark, sf_dir):
    tables = staged(spark, sf_dir, "fact_orders", *FACT_LOOKUPS)
    return star.build_fact(tables, star.key_maps(dimensions(spark, tables, list(FACT_LOOKUPS))))


# --- aggregates and marts ----------------------------------------------------------------------

for _name in BUILDERS:

    @query(_name.lower())
    def _result(spark, sf_dir, name=_name):
        return result(spark, sf_dir, name)


for _name, _build in aggregates.STAR_AGGREGATES.items():

    @query("star_" + _name.lower())
    def _star_aggregate(spark, sf_dir, build=_build):
        """The same aggregate as joins of star tables."""
        tables = staged(spark, sf_dir, "fact_orders", *DIMENSIONS)
        tables_of_star = dimensions(spark, tables, list(DIMENSIONS))
        return build(tables_of_star | {"fact_orders": star.build_fact(tables, star.key_maps(tables_of_star))})


for _name, _build in marts.WIDE_MARTS.items():

    @query("wide_" + _name)
    def _wide_mart(spark, sf_dir, build=_build):
        """The same mart over the cleaned wide table."""
        return build(clean.clean_sources(load_sources(spark, sf_dir)))


# --- reports -----------------------------------------------------------------------------------

for _name, _mart in [
    ("kpi_sales_performance", "dm_sales_performance"),
    ("kpi_product_category", "dm_product_category_analysis"),
    ("kpi_customer_behavior", "dm_customer_behavior"),
    ("kpi_order_fulfillment", "dm_order_fulfillment"),
    ("kpi_payment_analysis", "dm_payment_analysis"),
]:

    @query(_name)
    def _kpi(spark, sf_dir, mart=_mart):
        return insights.kpis(result(spark, sf_dir, mart), mart)


for _name, _mart in [
    ("kpi_formatted_sales", "dm_sales_performance"),
    ("kpi_formatted_category", "dm_product_category_analysis"),
    ("kpi_formatted_customer", "dm_customer_behavior"),
    ("kpi_formatted", "dm_payment_analysis"),
]:

    @query(_name)
    def _kpi_formatted(spark, sf_dir, mart=_mart):
        return insights.formatted(insights.kpis(result(spark, sf_dir, mart), mart), mart)


for _name, _table, _key, _measure in [
    ("share_sales_by_seller_state", "Agg_sales_by_seller", "seller_state", "total_sales"),
    ("share_orders_by_status", "dm_order_fulfillment", "order_status", "total_orders"),
    ("share_transactions_by_type", "dm_payment_analysis", "payment_type", "total_transactions"),
]:

    @query(_name)
    def _share(spark, sf_dir, table=_table, key=_key, measure=_measure):
        return insights.share_of_total(result(spark, sf_dir, table), key, measure)


@query("reviews_by_category")
def _reviews_by_category(spark, sf_dir):
    return insights.reviews_by_category(result(spark, sf_dir, "Agg_avg_review_score"))


@query("top10_customers")
def _top10_customers(spark, sf_dir):
    return insights.top_customers(result(spark, sf_dir, "dm_sales_performance"))


@query("chart_series")
def _chart_series(spark, sf_dir):
    names = list(dict.fromkeys(t for t, _, _ in insights.CHARTS.values()))
    tables = staged(spark, sf_dir, *names)
    return insights.chart_series({name: BUILDERS[name](tables) for name in names})


for _name, (_table, _labels, _) in insights.CHARTS.items():

    @query("chart_" + _name)
    def _chart(spark, sf_dir, name=_name, table=_table):
        """One chart's columns in label order."""
        return insights.chart(result(spark, sf_dir, table), name)


def _star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = staged(spark, sf_dir, "fact_orders", *DIMENSIONS)
    built = dimensions(spark, tables, list(DIMENSIONS))
    return built | {"fact_orders": star.build_fact(tables, star.key_maps(built))}


for _name, (_key, _) in DIMENSIONS.items():

    @query("preview_" + _name)
    def _preview(spark, sf_dir, name=_name, key=_key):
        """The first five rows of a dimension, all columns."""
        return insights.preview(star.build_dimension(cleaned(spark, sf_dir, name), name), [key])


@query("preview_fact_orders")
def _preview_fact(spark, sf_dir):
    """The first five rows of the fact table by order, all columns; further columns settle ties."""
    fact = _star_tables(spark, sf_dir)["fact_orders"]
    return insights.preview(fact, ["order_id", *[c for c in fact.columns if c != "order_id"]])


@query("preview_dims")
def _preview_dims(spark, sf_dir):
    """The first five rows of each dimension, as (table, key, natural key)."""
    tables = staged(spark, sf_dir, *DIMENSIONS)
    parts = []
    for name, (key, _) in DIMENSIONS.items():
        first = insights.preview(star.build_dimension(tables, name), [key])
        natural = F.concat_ws("|", *[F.col(c).cast("string") for c in star.NATURAL_KEYS[name]])
        parts.append(first.select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), natural.alias("natural_key")))
    return reduce(DataFrame.unionAll, parts)


# --- sources and sinks -------------------------------------------------------------------------


for _name, _table in [
    ("src_csv", "customers"),
    ("src_csv_orders", "orders"),
    ("src_csv_payments", "payments"),
    ("src_csv_reviews", "reviews"),
    ("src_csv_items", "items"),
    ("src_csv_products", "products"),
    ("src_csv_translation", "translation"),
    ("src_csv_sellers", "sellers"),
]:

    @query(_name)
    def _src_csv(spark, sf_dir, table=_table):
        """A source table written as CSV and read with its declared types; the ids are numeric here."""
        raw = translation_file(spark, sf_dir) if table == "translation" else load_raw_sources(spark, sf_dir)[table]
        path = write_csv(raw, fresh_dir(spark, f"csv-{table}"))
        ids = {c: F.col(c).cast("bigint") for c, t in raw.dtypes if t == "bigint"}
        return read_csv(spark, path, table).withColumns(ids)


@query("src_csv_inferred")
def _src_csv_inferred(spark, sf_dir):
    """Type and nulls of each column of the eight tables, from CSV files of text: a row per table and column."""
    raw = load_raw_sources(spark, sf_dir) | {"translation": translation_file(spark, sf_dir)}
    paths = at_once(spark, {t: lambda t=t, df=df: write_csv(df, fresh_dir(spark, f"csv-{t}")) for t, df in raw.items()})
    found = [infer_types(read_csv(spark, path, t, types={})).select(F.lit(t).alias("table_name"), "*") for t, path in paths.items()]
    return reduce(DataFrame.unionAll, found)


@query("sink_csv_roundtrip")
def _sink_csv_roundtrip(spark, sf_dir):
    """The merged table to CSV and back, with line breaks, quotes and empty text in its comments."""
    merged = merge_wide(load_sources(spark, sf_dir))
    title = F.when(F.col("review_id") % 3 == 0, "").otherwise(F.col("review_comment_title"))
    message = F.when(F.col("review_id") % 4 == 0, F.concat(F.lit('two\nlines, "quoted" '), "review_comment_message"))
    merged = merged.withColumns({"review_comment_title": title, "review_comment_message": F.coalesce(message, "review_comment_message")})
    path = write_csv(merged, fresh_dir(spark, "csv-merged"), NULL_TEXT, "gzip")
    return read_csv_as(spark, path, merged)


def _copies(df: DataFrame) -> DataFrame:
    return df.groupBy("order_id", "order_status").agg(F.count("*").alias("copies"))


@query("sink_append")
def _sink_append(spark, sf_dir):
    """Appending the same rows twice doubles them."""
    database = stage_database(spark)
    orders = load_sources(spark, sf_dir)["orders"]
    publish(orders, database, "appended_orders", "overwrite")
    publish(orders, database, "appended_orders", "append")
    return _copies(read_table(spark, database, "appended_orders"))


@query("sink_overwrite")
def _sink_overwrite(spark, sf_dir):
    """Overwriting leaves one copy."""
    database = stage_database(spark)
    orders = load_sources(spark, sf_dir)["orders"]
    publish(orders, database, "replaced_orders", "overwrite")
    publish(orders, database, "replaced_orders", "overwrite")
    return _copies(read_table(spark, database, "replaced_orders"))


def _row_counts(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    counts = [
        read_table(spark, database, n).agg(F.count("*").alias("n_rows")).select(F.lit(n.lower()).alias("table_name"), "n_rows")
        for n in names
    ]
    return reduce(DataFrame.unionAll, counts)


@query("star_append")
def _star_append(spark, sf_dir):
    """The star schema appended twice: every table has each of its rows twice."""
    database = stage_database(spark)
    tables = staged(spark, sf_dir, "fact_orders", *DIMENSIONS)
    for _ in range(2):
        publish_star(spark, tables, database, "append")
    return _row_counts(spark, database, [*DIMENSIONS, "fact_orders"])


def part_of_orders(sources: dict[str, DataFrame], kept) -> dict[str, DataFrame]:
    """Sources of a load that brings only some of the orders, with their lines."""
    return sources | {t: sources[t].filter(kept) for t in ("orders", *LINE_TABLES)}


@query("star_keys_stable")
def _star_keys_stable(spark, sf_dir):
    """Two overlapping loads under lasting keys: rows, natural keys, keys, highest key, moved keys of each table.

    The first load lacks one order in three; the second lacks one in five, so most orders come twice.
    """
    database = stage_database(spark)
    sources = load_sources(spark, sf_dir)
    columns = sorted({c for r in ("fact_orders", *DIMENSIONS) for c in READS[r]})
    first = {}
    for load, kept in enumerate((F.col("order_id") % 3 != 0, F.col("order_id") % 5 != 0)):
        tables = stage(spark, part_of_orders(sources, kept), columns, results=False)
        extend_star(spark, tables, database)
        if not load:
            first = {name: materialise(read_table(spark, database, name)) for name in DIMENSIONS}
    parts = []
    for name, (key, _) in DIMENSIONS.items():
        natural = star.NATURAL_KEYS[name]
        both = read_table(spark, database, name).join(first[name].select(F.col(key).alias("_old"), *natural), natural, "full")
        here = F.col(key).isNotNull()
        parts.append(both.agg(
            F.count(key).alias("n_rows"),
            F.count_distinct(F.when(here, F.struct(*natural))).alias("natural_keys"),
            F.count_distinct(key).alias("row_keys"),
            F.max(key).alias("highest_key"),
            F.count_if(here & (F.col("_old") != F.col(key))).alias("moved_keys"),
            F.count_if(~here).alias("lost_keys"),
        ).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionAll, parts)


@query("star_extended_sales")
def _star_extended_sales(spark, sf_dir):
    """Sales by seller over a star schema made by two overlapping loads: each order counts once."""
    database = stage_database(spark)
    sources = load_sources(spark, sf_dir)
    columns = sorted({c for r in ("fact_orders", *DIMENSIONS) for c in READS[r]})
    for load in (part_of_orders(sources, F.col("order_id") % 3 != 0), sources):
        extend_star(spark, stage(spark, load, columns, results=False), database)
    return aggregates.STAR_AGGREGATES["Agg_sales_by_seller"]({n: read_table(spark, database, n) for n in [*DIMENSIONS, "fact_orders"]})


@query("scan_table")
def _scan_table(spark, sf_dir):
    """A published mart read back by its shown name."""
    database = stage_database(spark)
    publish(result(spark, sf_dir, "dm_payment_analysis"), database, "dm_payment_analysis")
    return read_mart(spark, database, "Payment Analysis")


@query("list_agg_tables")
def _list_agg_tables(spark, sf_dir):
    database = stage_database(spark)
    tables = staged(spark, sf_dir, *aggregates.AGGREGATES)
    publish_aggregates(spark, tables, database)
    publish(marts.MARTS["dm_payment_analysis"](tables), database, "dm_payment_analysis")
    return list_tables(spark, database)


@query("relational_rows")
def _relational_rows(spark, sf_dir):
    """Rows as they are loaded into a relational table: all text with a running id."""
    rows = relational_rows(read_driver_table(spark, sf_dir, "customer"), last_id=1000)
    return rows.withColumn("table_name", F.lit(table_name(f"{sf_dir}/customer.parquet")))


@query("warehouse_refresh")
def _warehouse_refresh(spark, sf_dir):
    """A full refresh: rows of each published table."""
    database = application_database(spark, "ordermart_warehouse")
    refresh(spark, load_raw_sources(spark, sf_dir), database)
    return _row_counts(spark, database, [*DIMENSIONS, "fact_orders", *BUILDERS])


for _name in ("Agg_sales_by_customer_state", "Agg_avg_review_score", "dm_customer_behavior"):

    @query("incremental_" + _name.lower())
    def _incremental(spark, sf_dir, name=_name):
        """The result after a first load and one that brings the other orders and some of the first once more."""
        sources = load_sources(spark, sf_dir)
        kept = IncrementalResults(spark, fresh_dir(spark, "incremental"))
        kept.load(part_of_orders(sources, F.col("order_id") % 4 != 0))
        kept.load(part_of_orders(sources, F.col("order_id") % 4 < 2))
        return kept.results()[name]


@query("snapshot_refresh")
def _snapshot_refresh(spark, sf_dir):
    """Two versions of the whole warehouse: rows by table of the one in force, and whether a reader that had opened the
    first version before the second was published still reads what it did."""
    place = fresh_dir(spark, "snapshots")
    raw = load_raw_sources(spark, sf_dir)
    reader = refresh_snapshot(spark, part_of_orders(raw, F.col("order_id") % 3 != 0), place)
    before = {n: reader.read(n).count() for n in reader.names()}
    now = refresh_snapshot(spark, raw, place)
    rows = []
    for name in now.names():
        same = reader.read(name).agg((F.count("*") == before[name]).alias("old_reader_kept"))
        count = now.read(name).agg(F.count("*").alias("n_rows"))
        rows.append(count.select(F.lit(name.lower()).alias("table_name"), "n_rows", same.select("old_reader_kept").scalar().alias("old_reader_kept")))
    return reduce(DataFrame.unionAll, rows)


@query("job_from_files")
def _job_from_files(spark, sf_dir):
    """The whole job from CSV files of all eight tables, ids as text: the sales per customer state it publishes."""
    raw = load_raw_sources(spark, sf_dir)
    paths = at_once(spark, {t: lambda t=t, df=df: write_csv(df, fresh_dir(spark, f"csv-{t}"), compression="gzip") for t, df in raw.items()})
    files = {t: read_csv(spark, path, t, types={}) for t, path in paths.items()}
    database = application_database(spark, "ordermart_job")
    refresh(spark, files, database, types=COLUMN_TYPES)
    return read_table(spark, database, "Agg_sales_by_customer_state")
