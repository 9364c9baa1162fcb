"""Results kept up to date by buckets of orders, against full rebuilds."""

import os

import pytest
from helpers import item, order, payment, product, review, rows_of, small_sources
from pyspark.sql import functions as F

from ordermart.operators.clean import clean_tables
from ordermart.plans.incremental import FILLED_COLUMNS, IncrementalResults
from ordermart.plans.queries import BUILDERS, part_of_orders


def compare(kept, sources):
    full = clean_tables(sources, FILLED_COLUMNS)
    found = kept.results()
    assert set(found) == set(BUILDERS)
    for name, build in BUILDERS.items():
        assert rows_of(found[name]) == rows_of(build(full)), name


def test_two_loads_equal_one(spark, sources, tmp_path):
    """Means and medians move with the second load; so do the fills of orders that it does not bring."""
    kept = IncrementalResults(spark, str(tmp_path / "kept"), 8)
    kept.load(part_of_orders(sources, F.col("order_id") % 7 != 0))
    kept.load(part_of_orders(sources, F.col("order_id") % 7 < 2))
    compare(kept, sources)


def world(spark, names, products, **more):
    """Orders by name with amounts of four places, some missing; some with two reviews or payments."""
    orders, payments, reviews, items = [], [], [], []
    for k, name in enumerate(names):
        orders.append(order(name, order_delivered_customer_date=None))
        payments += [payment(name, j, 10.1234 + k) for j in range(1, 2 + k % 2)]
        reviews += [review(name, f"r{name}{j}", review_score=None if (k + j) % 3 == 0 else 1.0 + (k + j) % 5) for j in range(1 + k % 3)]
        items += [item(name, j, product_id=f"p{(k + j) % 3}", price=None if (k * j) % 4 == 1 else 3.0001 + k + more.get("add", 0)) for j in range(1, 3)]
    return small_sources(spark, orders, payments, reviews, items, products)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("kept"))
    kept = IncrementalResults(spark, place, 64)
    first = world(spark, [f"a{k}" for k in range(12)], [product("p0"), product("p1"), product("p2", product_category_name=None)])
    kept.load(first)
    return kept, first, place


def states(place):
    """Files of the states by bucket."""
    found = {}
    for folder, _, files in os.walk(f"{place}/state"):
        if "_bucket=" in folder:
            found.setdefault(int(folder.rpartition("=")[2]), set()).update(f for f in files if f.endswith(".parquet"))
    return found


def test_a_load_touches_its_buckets_only(spark, loaded):
    kept, first, place = loaded
    compare(kept, first)
    before = states(place)
    second = world(spark, ["a3", "b1", "b2"], [product("p0"), product("p1"), product("p2", product_category_name=None)], add=5)
    changed = kept.load(second)
    after = states(place)
    assert 1 <= len(changed) <= 3
    assert {b: f for b, f in before.items() if b not in changed} == {b: f for b, f in after.items() if b not in changed}
    names = ["orders", "payments", "reviews", "items"]
    both = second | {t: first[t].filter("order_id <> 'a3'").unionByName(second[t]) for t in names}
    compare(kept, both)
    plan = kept.landed("items", changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan or "PartitionFilters: [isnotnull(_bucket" in plan
    # A changed product: the buckets of its orders are computed anew, though no order comes with the load.
    third = {t: df.limit(0) if t in names else df for t, df in world(spark, ["x"], [product("p0", product_category_name="other"), product("p1")]).items()}
    touched = kept.load(third)
    assert touched
    compare(kept, third | {t: both[t] for t in names})
    assert kept.load(third) == []


def test_no_rows_where_a_filled_column_has_no_value(spark, tmp_path):
    kept = IncrementalResults(spark, str(tmp_path / "kept"), 4)
    bare = small_sources(spark, [order("a")], [payment("a")], [review("a", "r")], [item("a", price=None)])
    kept.load(bare)
    assert all(df.count() == 0 for df in kept.results().values())
    kept.load(small_sources(spark, [order("b")], [payment("b")], [review("b", "r")], [item("b", price=7.5)]))
    assert kept.results()["Agg_sales_by_seller"].collect()[0]["total_sales"] == 15.0


def test_each_bucket_is_one_file(spark, tmp_path):
    """However many tasks hold rows of a bucket, one of them writes it."""
    kept, path = IncrementalResults(spark, str(tmp_path / "kept"), 4), str(tmp_path / "table")
    rows = spark.range(1000, numPartitions=8).withColumn("_bucket", (F.col("id") % 4).cast("int"))
    kept._replace(rows, path, [0, 1, 2, 3])
    assert {b: len([f for f in os.listdir(f"{path}/_bucket={b}") if f.endswith(".parquet")]) for b in range(4)} == dict.fromkeys(range(4), 1)
    assert spark.read.parquet(path).count() == 1000
