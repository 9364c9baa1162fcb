"""Slicing of large orders changes no result."""

import pytest
from helpers import day, item, order, payment, product, review, same, small_sources
from pyspark.sql import functions as F

from ordermart.operators.aggregates import AGGREGATES
from ordermart.operators.clean import STATISTIC_COLUMNS, clean_sources, clean_tables, clean_wide
from ordermart.operators.fanout import LINE_TABLES, LineCounts, hot_orders
from ordermart.operators.marts import MARTS, WIDE_MARTS
from ordermart.operators.merge import merge_wide
from ordermart.operators.star import build_star
from ordermart.operators.statistics import merged_statistics, wide_statistics

TINY = 3


@pytest.fixture(scope="module")
def hot_sources(spark):
    """One order owns most lines, with many exact copies; one has no reviews, one no payments."""
    orders = [order("big"), order("small"), order("none"), order("unpaid", order_delivered_customer_date=day(8))]
    payments = [payment("big", n) for n in (1, 2, 3)] + [payment("small"), payment("none", value=2.5)]
    reviews = [review("big", "r1"), review("big", "r2", review_creation_date=None), review("small", "r3", review_score=None)]
    reviews += [review("unpaid", "r4", review_creation_date=None)]
    items = [item("big") for _ in range(40)] + [item("big", n, price=float(n)) for n in range(20)]
    items += [item("small", price=None), item("none"), item("unpaid", product_id="p2")]
    return small_sources(spark, orders, payments, reviews, items, [product(), product("p2", product_weight_g=None)])


def test_large_orders_are_found(hot_sources):
    assert LineCounts(hot_sources).hot(*LINE_TABLES) is None
    found = {r["order_id"]: r for r in LineCounts(hot_sources, TINY).hot(*LINE_TABLES).collect()}
    assert set(found) == {"big"}
    assert [found["big"][f"_s_{t}"] for t in LINE_TABLES] == [2, 1, 60]


@pytest.mark.parametrize("name", ["hot_sources", "sources"])
def test_merge_keeps_every_row(name, request):
    sources = request.getfixturevalue(name)
    same(merge_wide(sources, rows_per_slice=TINY), merge_wide(sources))
    same(merge_wide(sources, null_safe=True), merge_wide(sources))


@pytest.mark.parametrize("name", ["hot_sources", "sources"])
def test_clean_keeps_every_row(name, request):
    sources = request.getfixturevalue(name)
    plain = clean_wide(merge_wide(sources))
    same(clean_sources(sources), plain)
    same(clean_sources(sources, rows_per_slice=TINY), plain)


@pytest.mark.parametrize("name", ["hot_sources", "sources"])
def test_statistics(name, request):
    sources = request.getfixturevalue(name)
    expected = wide_statistics(merge_wide(sources), STATISTIC_COLUMNS)
    assert merged_statistics(sources, STATISTIC_COLUMNS) == expected
    assert merged_statistics(sources, STATISTIC_COLUMNS, LineCounts(sources, TINY)) == expected


@pytest.fixture(scope="module")
def tables(hot_sources):
    """Cleaned tables that are sliced, and the same without slices."""
    return clean_tables(hot_sources, rows_per_slice=TINY), clean_tables(hot_sources)


@pytest.mark.parametrize("result", [*AGGREGATES, *MARTS])
def test_results(result, tables):
    build = (AGGREGATES | MARTS)[result]
    same(build(tables[0]), build(tables[1]))


def test_star(tables):
    sliced = build_star(tables[0])
    for name, df in build_star(tables[1]).items():
        same(sliced[name], df)


def cells(spark, numbers, spread):
    """A hot order with so many equal rows per table, and the slices of each table."""
    from ordermart.operators.fanout import slice_rows

    hot = spark.createDataFrame([("big", *spread)], "order_id string, _s_payments long, _s_reviews long, _s_items long")
    out = {}
    for table, n in zip(LINE_TABLES, numbers, strict=True):
        rows = spark.range(n, numPartitions=1).select(F.lit("big").alias("order_id"), F.lit(1).alias("x"))
        found = slice_rows(rows, hot, table).groupBy("_slice").count().collect()
        out[table] = {r["_slice"]: r["count"] for r in found}
    return out


def test_equal_rows_of_one_split_share_the_slices(spark):
    found = cells(spark, (1, 1, 1000), (1, 1, 8))
    assert found["items"] == {n: 125 for n in range(8)}
    assert found["payments"] == {n: 1 for n in range(8)}


def test_three_large_tables_make_a_grid(spark):
    counts = spark.createDataFrame([("big", 1, 1000, 1000, 1000)], "order_id string, n_orders long, n_payments long, n_reviews long, n_items long")
    row = hot_orders(counts, LINE_TABLES, 4000).first()
    spread = [row[f"_s_{t}"] for t in LINE_TABLES]
    per_slice = [-(-1000 // s) for s in spread]
    assert per_slice[0] * per_slice[1] * per_slice[2] <= 2 * 4000
    found = cells(spark, (6, 4, 10), (3, 2, 5))
    assert {len(c) for c in found.values()} == {30}
    assert all(found["payments"][k] * found["reviews"][k] * found["items"][k] == 2 * 2 * 2 for k in range(30))


def lookups_twice(spark, sources):
    """Some customers, products, translations and sellers twice, with the same or other attributes."""
    twice = dict(sources)
    for name, key in (("customers", "customer_id"), ("products", "product_id"), ("sellers", "seller_id")):
        twice[name] = sources[name].union(sources[name].filter(F.col(key) % 3 == 0))
    other = sources["translation"].filter("product_category_name = 'SMALL'").withColumn("product_category_name_english", F.lit("little"))
    return twice | {"translation": sources["translation"].union(other)}


def test_repeated_lookup_keys_multiply_as_in_the_merge(spark, sources):
    twice = lookups_twice(spark, sources)
    merged = merge_wide(twice)
    assert merged_statistics(twice, STATISTIC_COLUMNS) == wide_statistics(merged, STATISTIC_COLUMNS)
    wide = clean_wide(merged)
    same(clean_sources(twice), wide)
    tables = clean_tables(twice)
    for name, build in MARTS.items():
        same(build(tables), WIDE_MARTS[name](wide))
    total = wide.count()
    assert AGGREGATES["Agg_sales_by_seller"](tables).agg(F.sum("total_orders")).first()[0] == total
    assert AGGREGATES["Agg_sales_by_category"](tables).agg(F.sum("total_orders")).first()[0] == total
