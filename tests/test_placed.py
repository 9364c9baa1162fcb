"""Lines are written once, by order and before they are cleaned; what follows shuffles none of them by order again."""

import pytest
from pyspark.sql import functions as F
from helpers import day, item, order, payment, product, review, same, small_sources

from ordermart.operators import statistics
from ordermart.operators.aggregates import AGGREGATES
from ordermart.operators.clean import clean_tables
from ordermart.operators.fanout import LINE_TABLES
from ordermart.operators.marts import MARTS
from ordermart.operators.star import build_dimension, build_fact, build_star, key_maps
from ordermart.operators.statistics import weighted_lines
from ordermart.operators.weights import COUNTS, per_order
from ordermart.plans import refresh as module
from ordermart.plans.refresh import refresh, stage
from ordermart.schemas import DIMENSIONS
from ordermart.sources.catalog import read_table, stage_database


@pytest.fixture(scope="module")
def odd(spark):
    """Orders without lines, lines without an order or with none that is known, items of products and sellers that are
    missing or incomplete, missing values of all fills, and an order that comes twice."""
    products = [product("p1"), product("p2", product_category_name=None, product_weight_g=None), product("p3", product_name_lenght=None)]
    return small_sources(
        spark,
        [order("a"), order("b", order_delivered_customer_date=day(8)), order("c"), order("c"), order(None), order("d", customer_id="c9"), order("e")],
        [payment("a"), payment("a", 2, 3.25, payment_installments=4), payment("b", payment_type=None), payment("c", value=None), payment(None), payment("z"), payment("d")],
        [review("a", "r1"), review("b", "r2", review_creation_date=None), review("b", "r3", review_score=None), review("c", "r4"), review(None, "r5"), review("e", "r6")],
        [item("a"), item("a", 2, price=None), item("b", product_id="p2", freight_value=None), item("b", 2, product_id="p3"), item("b", 3, product_id="p9"),
         item("c", seller_id="s9"), item("c", 2, price=1.5), item("c", None), item(None), item("z"), item("a", 3, product_id=None), item("a", 4, shipping_limit_date=None)],
        products,
    )


@pytest.mark.parametrize("results", [True, False])
def test_placed_tables_give_the_same_results(spark, odd, results):
    tables, plain = stage(spark, odd, results=results), clean_tables(odd)
    assert read_table(spark, tables.staged_in, "placed_items").count() == 11
    assert read_table(spark, tables.staged_in, "items") is None
    star, expected = build_star(tables), build_star(plain)
    for name in star:
        same(star[name], expected[name])
    for name in ("Agg_sales_by_category", "Agg_avg_review_score", "dm_payment_analysis") if results else ():
        build = (AGGREGATES | MARTS)[name]
        same(build(tables), build(plain))


def test_weights_need_no_exchange_by_order(spark, odd):
    tables = stage(spark, odd)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = {"items": read_table(spark, tables.staged_in, "placed_items")}
        plan = weighted_lines(placed, "items", ["price"], tables.lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_refresh_lands_only_lookups_beside_the_placed_tables(spark, sources, monkeypatch):
    landed, land = [], module.land
    monkeypatch.setattr(module, "land", lambda spark, sources, folder: landed.extend(sources) or land(spark, sources, folder))
    refresh(spark, sources, stage_database(spark))
    assert sorted(landed) == ["customers", "products", "sellers", "translation"]


def test_staging_a_star_reads_the_placed_lines_once(spark, odd, monkeypatch):
    """Lines that cleaning keeps are counted with all the others; where a fill is no number, what is left is counted."""
    calls, counted = [], module.per_order
    monkeypatch.setattr(module, "per_order", lambda *a, **k: calls.append(a) or counted(*a, **k))
    columns = ["price", "freight_value", "payment_installments"]
    same(stage(spark, odd, columns, results=False).orders.select("order_id", *COUNTS), per_order(clean_tables(odd, columns), *LINE_TABLES).select("order_id", *COUNTS))
    assert not calls
    bare = odd | {"items": odd["items"].withColumn("price", F.lit(None).cast("double"))}
    assert stage(spark, bare, columns, results=False).orders.count() == 0 and calls


def test_items_of_incomplete_orders_do_not_move(spark, odd):
    tables = stage(spark, odd, results=False)
    star = {name: build_dimension(tables, name) for name in DIMENSIONS}
    fact = build_fact(tables, key_maps(star))
    assert "LeftSemi" in fact._jdf.queryExecution().optimizedPlan().toString()
    same(fact, build_star(clean_tables(odd))["fact_orders"])


def test_product_weights_need_no_groups_of_order_and_product(spark, odd, monkeypatch):
    tables, seen = stage(spark, odd), []
    placed = odd | {t: read_table(spark, tables.staged_in, f"placed_{t}") for t in ("items", "counts")}
    placed["counts"] = placed.pop("counts")
    monkeypatch.setattr(statistics, "weighted_numbers", lambda spark, parts: seen.extend(parts))
    for sources in (placed, odd):
        statistics.merged_statistics(sources, ["product_weight_g"])
    own, plain = [df._jdf.queryExecution().optimizedPlan().toString() for df, _ in seen]
    assert own.count("Aggregate") == 1 and plain.count("Aggregate") == 2
    same(*[df.select("product_id", "weight") for df, _ in seen])


def test_orders_stay_in_place_while_their_customer_is_looked_up(spark, odd):
    """Only ids are shuffled by customer, where no order comes twice."""
    twice = odd | {"orders": odd["orders"].unionAll(odd["orders"].filter("order_id = 'a'"))}
    once = odd | {"orders": odd["orders"].dropDuplicates(["order_id"])}
    for sources, in_place in ((once, True), (twice, False)):
        tables = stage(spark, sources, results=False)
        star = {name: build_dimension(tables, name) for name in DIMENSIONS}
        fact = build_fact(tables, key_maps(star))
        assert tables.lines.largest["orders"] == (1 if in_place else 2)
        # The orders themselves, those items must belong to and, in place, their ids.
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(f"{tables.staged_in}.orders[") == (3 if in_place else 2)
        same(fact, build_star(clean_tables(sources))["fact_orders"])
