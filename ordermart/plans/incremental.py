"""Aggregates and marts kept up to date by buckets of orders, instead of a rebuild for every load.

Orders and their lines are landed in buckets by a hash of the order. A load brings orders, each with all of its lines, and
the whole lookup tables; an order that comes again replaces what was landed. For the buckets with changed orders, and those
that hold orders of a changed customer, product, translation or seller, the *state* is computed anew and takes the place of
the old one (dynamic partition overwrite). Nothing else of the orders and lines is read.

A state row is a partial sum that can be added to others: of one bucket, by the keys of a result. Means and medians of the
whole data fill missing numbers, and every load moves them; so a state keeps what is there and how often something is
missing apart, and a result adds ``missing x fill`` at the end. The fills come from the state as well: distinct values by
bucket with their weight. All sums are decimals or counts, so the results are those of a full rebuild, digit for digit.

The item lines are joined with their orders once and written with their amounts already times the row counts. The states of
item lines are aggregations of that frame, each with the sums its results read. Every bucket of a table is written by one task.

A load that fails is run again: it replaces the same buckets, and the lookups, by which changes are found, are landed last.
One load at a time.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.casts import (
    MONEY_SCALE,
    SCORE_SCALE,
    as_double,
    exact_sum,
    joined_parts,
    money_parts,
    weighted,
    weighted_money,
    weighted_money_sum,
)
from ordermart.functions.columns import year_month
from ordermart.operators.clean import STATISTIC_COLUMNS, clean_tables, have_values
from ordermart.operators.fanout import KEY, LINE_TABLES
from ordermart.operators.marts import with_shipping_time
from ordermart.operators.merge import LOOKUPS
from ordermart.operators.statistics import long_values, numbers_of, weighted_lines
from ordermart.operators.weights import item_lines, payment_lines, per_order
from ordermart.session import at_once, delete_path, materialise

BUCKETS = 64
BUCKET = "_bucket"
ORDER_TABLES = ["orders", *LINE_TABLES]
# Numbers the results read that may be missing, by table.
FILLED = {"items": ["price", "freight_value"], "reviews": ["review_score"]}
FILLED_COLUMNS = [c for columns in FILLED.values() for c in columns]
# Keys and amounts of the states of item lines: a result adds up the rows of the one that has its keys.
LINE_STATES = {
    "categories": (["product_category_name", "product_category_name_english"], ["sales", "freight", "revenue"]),
    "sellers": (["seller_id", "seller_state"], ["sales"]),
    "customer_months": (["customer_id", "customer_state", "month"], ["sales"]),
    "customer_products": (["customer_id", "product_id"], []),
}
STATES = [*LINE_STATES, "customers", "statuses", "payments", "reviews", "values"]


def with_fill(total: Column, missing: Column, fill: Column, scale: int = MONEY_SCALE) -> Column:
    """A sum of what is there plus the fill for what is missing. 36 digits each, so that the sum keeps all its places."""
    kind = f"decimal(36,{scale})"
    filled = weighted_money(fill, missing) if scale == MONEY_SCALE else weighted(fill, missing, scale)
    return total.cast(kind) + filled.cast(kind)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def _missing(c: str, kind: str) -> Column:
    nan = F.isnan(c) if kind in ("double", "float") else F.lit(False)
    return F.when(F.col(c).isNull() | nan, 1).otherwise(0)


def bucket_state(sources: dict[str, DataFrame], buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """The states of the orders in ``sources``, each with its bucket."""
    flagged = dict(sources)
    for table, columns in FILLED.items():
        kinds = dict(sources[table].dtypes)
        flagged[table] = sources[table].withColumns({f"{c}_missing": _missing(c, kinds[c]) for c in columns})
    tables = clean_tables(flagged, FILLED_COLUMNS, numbers={c: 0.0 for c in FILLED_COLUMNS})
    spark, bucket = sources["orders"].sparkSession, bucket_of(buckets).alias(BUCKET)
    names = ["product_id", "product_category_name", "product_category_name_english", "seller_id", "seller_state"]
    read = {
        "payments": ["payment_type", "payment_value"],
        "reviews": ["review_id", "review_score", "review_score_missing", "review_creation_date"],
        "items": [*names, "price", "price_missing", "freight_value", "freight_value_missing"],
    }
    tables = replace(tables, **at_once(spark, {t: lambda t=t: materialise(getattr(tables, t).select(KEY, *read[t])) for t in read}))
    columns = ["customer_id", "customer_state", "order_status", "delivered", "n_payments", "n_reviews", "n_items", "paid"]
    orders = with_shipping_time(per_order(tables, *LINE_TABLES))
    tables = replace(tables, orders=materialise(orders.select(KEY, *columns, "shipping_time", year_month("order_purchase_timestamp").alias("month"))))

    orders, lines = tables.orders, materialise(_lines(tables, names, bucket))
    wide = F.expr("n_payments * n_reviews * n_items")
    paid = orders.groupBy(bucket, "customer_id", KEY).agg(
        weighted_money_sum(F.col("paid"), F.expr("n_reviews * n_items")).alias("paid"), F.sum(wide).alias("n")
    )
    payments = payment_lines(tables, ["payment_type", "payment_value"], ["n_reviews", "n_items"])
    copies = F.expr("n_reviews * n_items")
    values = [long_values(weighted_lines(sources, t, cs, tables.lines).withColumn(BUCKET, bucket), cs, "weight", BUCKET) for t, cs in FILLED.items()]
    return {name: _line_state(lines, *parts) for name, parts in LINE_STATES.items()} | {
        "customers": paid.groupBy(BUCKET, "customer_id").agg(F.sum("paid").alias("paid"), F.sum("n").alias("n"), F.count(KEY).alias("orders")),
        "statuses": orders.groupBy(bucket, "order_status").agg(F.sum(weighted(F.col("shipping_time"), wide, scale=0)).alias("seconds"), F.sum(wide).alias("n")),
        "payments": payments.groupBy(bucket, "payment_type").agg(weighted_money_sum(F.col("payment_value"), copies).alias("revenue"), F.sum(copies).alias("n")),
        "reviews": lines.groupBy(BUCKET, "product_id", "product_category_name_english").agg(
            F.sum("scores").alias("scores"), *[F.sum(F.col(c) * F.col("n")).alias(c) for c in ("scores_missing", "n_scores", "n_ids")]
        ),
        "values": reduce(DataFrame.unionByName, values).groupBy(BUCKET, "name", "value").agg(F.sum("weight").alias("weight")),
    }


def _lines(tables, names: list[str], bucket: Column) -> DataFrame:
    """Items with what the states read: amounts times their row counts in two parts each, and the scores of their order."""
    orders = tables.orders.join(_order_scores(tables), KEY)
    coarse, fine = money_parts(F.col("paid"), F.col("n_reviews"))
    orders = orders.withColumns({"revenue_coarse": coarse, "revenue_fine": fine, "n": F.expr("n_payments * n_reviews")})
    orders = orders.withColumn("scores", weighted(F.col("scores"), F.col("n"), SCORE_SCALE))
    scores = ["scores", "scores_missing", "n_scores", "n_ids"]
    of_order = ["customer_id", "customer_state", "month", "n", "revenue_coarse", "revenue_fine", *scores]
    lines = item_lines(tables, [*names, "price", "price_missing", "freight_value", "freight_value_missing"], of_order, orders)
    amounts = [bucket]
    for c, name in (("price", "sales"), ("freight_value", "freight")):
        coarse, fine = money_parts(F.col(c), F.col("n"))
        amounts += [coarse.alias(f"{name}_coarse"), fine.alias(f"{name}_fine"), (F.col(f"{c}_missing") * F.col("n")).alias(f"{name}_missing")]
    return lines.select(*names, *of_order, *amounts)


def _line_state(lines: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    sums = []
    for c in amounts:
        sums.append(joined_parts(F.sum(f"{c}_coarse"), F.sum(f"{c}_fine")).alias(c))
        if f"{c}_missing" in lines.columns:
            sums.append(F.sum(f"{c}_missing").alias(f"{c}_missing"))
    return lines.groupBy(BUCKET, *keys).agg(*sums, F.sum("n").alias("n"))


def _order_scores(tables) -> DataFrame:
    """Scores of the distinct reviews of an order."""
    dated = F.bool_or(F.col("review_creation_date").isNotNull()).alias("dated")
    distinct = tables.reviews.groupBy(KEY, "review_id", "review_score", "review_score_missing").agg(dated)
    used = distinct.join(tables.orders.select(KEY, "delivered"), KEY).filter("dated OR delivered")
    return used.groupBy(KEY).agg(
        exact_sum(F.col("review_score"), SCORE_SCALE).alias("scores"), F.sum("review_score_missing").alias("scores_missing"),
        F.count("*").alias("n_scores"), F.count("review_id").alias("n_ids"),
    )


def results(states: dict[str, DataFrame], numbers: dict[str, float]) -> dict[str, DataFrame]:
    """The ten results from the states of all buckets. numbers: the fills; without one of them there are no rows."""
    complete = all(c in numbers for c in FILLED_COLUMNS)
    if not complete:
        states = {n: df.filter(F.lit(False)) for n, df in states.items()}
    fill = lambda c: F.lit(numbers.get(c, 0.0))
    sales = as_double(with_fill(F.sum("sales"), F.sum("sales_missing"), fill("price")))
    freight = as_double(with_fill(F.sum("freight"), F.sum("freight_missing"), fill("freight_value")))
    lines = lambda name, *keys: states[name].groupBy(*keys)
    n = F.sum("n")
    customers = lines("customer_months", "customer_id", "customer_state").agg(
        with_fill(F.sum("sales"), F.sum("sales_missing"), fill("price")).alias("sales"), n.alias("n")
    )
    products = states["customer_products"].select("customer_id", "product_id").distinct()
    products = products.groupBy("customer_id").agg(F.count("product_id").alias("distinct_products"))
    spent = states["customers"].groupBy("customer_id").agg(F.sum("paid").alias("paid"), n.alias("n"), F.sum("orders").alias("total_orders"))
    scores = as_double(with_fill(F.sum("scores"), F.sum("scores_missing"), fill("review_score"), SCORE_SCALE))
    seconds = as_double(F.sum("seconds")) / n
    return {
        "Agg_sales_by_category": lines("categories", "product_category_name_english")
        .agg(sales.alias("total_sales"), freight.alias("total_freight"), n.alias("total_orders"))
        .withColumnRenamed("product_category_name_english", "category"),
        "Agg_sales_by_customer_state": customers.groupBy("customer_state").agg(
            as_double(F.sum("sales")).alias("total_sales"), F.count("customer_id").alias("unique_customers"), n.alias("total_orders")
        ),
        "Agg_sales_by_seller": lines("sellers", "seller_id", "seller_state").agg(sales.alias("total_sales"), n.alias("total_orders")),
        "Agg_monthly_sales_trend": lines("customer_months", "month").agg(sales.alias("total_sales"), n.alias("total_orders")).orderBy("month"),
        "Agg_avg_review_score": states["reviews"].groupBy("product_id", F.col("product_category_name_english").alias("category")).agg(
            (scores / F.sum("n_scores")).alias("avg_review_score"), F.sum("n_ids").alias("total_reviews")
        ),
        "dm_sales_performance": spent.select(
            "customer_id", as_double(F.col("paid")).alias("total_revenue"), "total_orders", (as_double(F.col("paid")) / F.col("n")).alias("avg_order_value")
        ),
        "dm_product_category_analysis": lines("categories", "product_category_name").agg(
            n.alias("total_sales"), as_double(F.sum("revenue")).alias("total_revenue"), (sales / n).alias("avg_price")
        ),
        "dm_customer_behavior": spent.join(products, "customer_id").select(
            "customer_id", "total_orders", "distinct_products", as_double(F.col("paid")).alias("total_spent")
        ),
        "dm_order_fulfillment": states["statuses"].groupBy("order_status").agg(seconds.cast("bigint").alias("avg_shipping_time"), n.alias("total_orders")),
        "dm_payment_analysis": states["payments"].groupBy("payment_type").agg(as_double(F.sum("revenue")).alias("total_revenue"), n.alias("total_transactions")),
    }


class IncrementalResults:
    """Landed buckets and states in a folder that all executors share. The number of buckets is given once, for good."""

    def __init__(self, spark: SparkSession, place: str, buckets: int = BUCKETS) -> None:
        self.spark, self.place, self.buckets = spark, place.rstrip("/"), buckets

    def _landed(self, name: str) -> str:
        return f"{self.place}/landed/{name}"

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def landed(self, name: str, buckets: list[int] | None = None) -> DataFrame | None:
        """A landed table, or some buckets of it; None before the first load."""
        if not self._exists(self._landed(name)):
            return None
        df = self.spark.read.parquet(self._landed(name))
        if name not in ORDER_TABLES:
            return df
        return (df if buckets is None else df.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def _replace(self, df: DataFrame, path: str, buckets: list[int]) -> None:
        """Put the rows in place of these buckets' old ones; a bucket without rows is emptied."""
        # One shuffle, so each bucket is one file instead of one per task.
        df.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        filled = {r[0] for r in df.select(BUCKET).distinct().collect()}  # at most the number of buckets
        for b in set(buckets) - filled:
            delete_path(self.spark, f"{path}/{BUCKET}={b}")

    def changed_buckets(self, load: dict[str, DataFrame], ids: DataFrame) -> list[int]:
        """Buckets of the load's orders, whose ids are given, and of landed orders whose lookup rows the load changes."""
        parts = [ids.select(bucket_of(self.buckets).alias(BUCKET))]
        if self.landed("orders") is not None:
            changed = {n: self._changed(n, key, load[n]) for n, key in LOOKUPS.items()}
            products = load["products"].join(changed["translation"], LOOKUPS["translation"], "left_semi").select("product_id")
            changed["products"] = changed["products"].union(products).distinct()
            for name, table in (("customers", "orders"), ("products", "items"), ("sellers", "items")):
                if not changed[name].isEmpty():
                    touched = self.landed(table).join(changed[name], LOOKUPS[name], "left_semi")
                    parts.append(touched.select(bucket_of(self.buckets).alias(BUCKET)))
        return sorted(r[0] for r in reduce(DataFrame.union, parts).distinct().collect())

    def _changed(self, name: str, key: str, new: DataFrame) -> DataFrame:
        old = self.landed(name).select(*new.columns)
        return materialise(old.exceptAll(new).union(new.exceptAll(old)).select(key).distinct())

    def load(self, load: dict[str, DataFrame]) -> list[int]:
        """Take a load in and compute the states it changes; the changed buckets."""
        load = at_once(self.spark, {n: lambda df=df: materialise(df) for n, df in load.items()})
        ids = [load[t].filter(F.col(KEY).isNotNull()).select(KEY) for t in ORDER_TABLES]
        again = materialise(reduce(DataFrame.union, ids).distinct())
        buckets = self.changed_buckets(load, again)

        def land(table: str) -> None:
            rows, old = load[table].filter(F.col(KEY).isNotNull()), self.landed(table, buckets)
            if old is not None:
                # Written apart first, because it is put in the place of what it reads.
                rows = materialise(old.join(again, KEY, "left_anti").unionByName(rows))
            self._replace(rows.withColumn(BUCKET, bucket_of(self.buckets)), self._landed(table), buckets)

        at_once(self.spark, {t: lambda t=t: land(t) for t in ORDER_TABLES})
        sources = load | {t: self.landed(t, buckets) for t in ORDER_TABLES}
        states = bucket_state(sources, self.buckets)
        states = at_once(self.spark, {n: lambda df=df: materialise(df) for n, df in states.items()})
        at_once(self.spark, {n: lambda n=n, df=df: self._replace(df, f"{self.place}/state/{n}", buckets) for n, df in states.items()})
        for name in LOOKUPS:
            load[name].write.mode("overwrite").parquet(self._landed(name))
        return buckets

    def states(self) -> dict[str, DataFrame]:
        return {n: self.spark.read.parquet(f"{self.place}/state/{n}") for n in STATES}

    def results(self) -> dict[str, DataFrame]:
        """The ten results over everything that was loaded."""
        states = self.states()
        values = materialise(states.pop("values").groupBy("name", "value").agg(F.sum("weight").alias("weight")))
        others = [c for c in STATISTIC_COLUMNS if c not in FILLED_COLUMNS]
        complete = have_values({n: self.landed(n) for n in [*ORDER_TABLES, *LOOKUPS]}, others)
        return results(states, numbers_of(values, FILLED_COLUMNS) if complete else {})
