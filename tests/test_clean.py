"""Fill order, drops, casts and other traps of the cleaning and typing rules."""

import math

import pytest
from helpers import day, item, order, payment, product, review, small_sources
from pyspark.sql import functions as F

from ordermart.functions.casts import exact_sum, lenient_int, lenient_timestamp, strict_double
from ordermart.functions.columns import nan_to_null, sanitize_columns, shipping_seconds, table_name, thousands
from ordermart.operators.clean import clean_sources, clean_tables, clean_wide
from ordermart.operators.convert import convert_types
from ordermart.operators.marts import MARTS, WIDE_MARTS
from ordermart.operators.merge import merge_wide
from ordermart.operators.star import build_star, star_from_wide
from ordermart.operators.statistics import merged_statistics
from ordermart.plans.refresh import WHOLE_NUMBERS, stage
from ordermart.schemas import MERGED_COLUMNS


def both_ways(sources):
    fused = {(r["order_id"], r["review_id"]): r for r in clean_sources(sources).collect()}
    plain = {(r["order_id"], r["review_id"]): r for r in clean_wide(merge_wide(sources)).collect()}
    assert fused == plain
    return fused


def test_review_date_uses_the_delivery_date_before_its_own_fill(spark):
    orders = [order("open"), order("done", order_delivered_customer_date=day(8))]
    reviews = [review(o, o + "_r", review_creation_date=None) for o in ("open", "done")] + [review("open", "dated")]
    rows = both_ways(
        small_sources(spark, orders, [payment("open"), payment("done")], reviews, [item("open"), item("done")])
    )
    assert set(rows) == {("done", "done_r"), ("open", "dated")}
    assert rows[("done", "done_r")]["review_creation_date"] == day(8)
    assert rows[("open", "dated")]["order_delivered_customer_date"] == day(20)


def test_timestamp_chain(spark):
    orders = [order("a"), order("b", order_approved_at=day(2)), order("c", order_delivered_carrier_date=day(3))]
    names = ["a", "b", "c"]
    rows = both_ways(
        small_sources(spark, orders, [payment(n) for n in names], [review(n, n) for n in names], [item(n) for n in names])
    )
    got = {k[0]: (r["order_approved_at"], r["order_delivered_carrier_date"]) for k, r in rows.items()}
    assert got == {"a": (day(1), day(1)), "b": (day(2), day(2)), "c": (day(1), day(3))}


def test_orders_without_a_part_vanish_but_count_in_the_statistics(spark):
    """Means and medians are taken over the multiplied rows, before any is dropped."""
    orders = [order("full"), order("unpaid")]
    reviews = [review("full", "r1", review_score=1.0), review("full", "r2", review_score=None), review("unpaid", "r3", review_score=5.0)]
    items = [item("full", 1, price=None), item("full", 2, price=10.0), item("unpaid", 1, price=30.0)]
    rows = clean_sources(small_sources(spark, orders, [payment("full"), payment("full", 2)], reviews, items)).collect()
    assert len(rows) == 2 * 2 * 2 and {r["order_id"] for r in rows} == {"full"}
    # Prices 10 four times and 30 once; scores 1 four times and 5 once.
    assert {r["price"] for r in rows} == {10.0}
    assert {r["review_score"] for r in rows} == {1.0, 9.0 / 5}


def test_a_column_without_any_value_drops_everything(spark):
    sources = small_sources(spark, [order("a")], [payment("a")], [review("a", "r")], [item("a", price=None)])
    assert clean_wide(merge_wide(sources)).count() == 0
    assert clean_sources(sources).count() == 0


@pytest.mark.parametrize("column", ["price", "freight_value", "product_weight_g", "payment_sequential", "review_score"])
def test_an_empty_column_that_is_not_read_drops_everything_too(spark, sources, column):
    empty = {n: df.withColumn(column, F.lit(None).cast(dict(df.dtypes)[column])) if column in df.columns else df for n, df in sources.items()}
    for columns in (None, [], ["order_item_id"]):
        tables = clean_tables(empty, columns)
        assert MARTS["dm_payment_analysis"](tables).count() == 0


def test_a_value_of_a_line_without_order_does_not_count(spark):
    sources = small_sources(spark, [order("a")], [payment("a")], [review("a", "r")], [item("a", price=None), item("lost", price=3.0)])
    assert clean_wide(merge_wide(sources)).count() == 0
    assert MARTS["dm_payment_analysis"](clean_tables(sources, [])).count() == 0


def test_undeclared_columns_take_part(spark):
    """An extra column stays through the merge and its nulls drop rows; names shared by two tables are told apart."""
    sources = small_sources(spark, [order("a"), order("b")], [payment("a"), payment("b")], [review("a", "r"), review("b", "s")], [item("a"), item("b")])
    note = F.when(F.col("order_id") == "a", "kept")
    sources["payments"] = sources["payments"].withColumn("note", note)
    sources["sellers"] = sources["sellers"].withColumn("note", F.lit("shop")).withColumn("rank", F.lit(1))
    merged = merge_wide(sources)
    assert [c for c in merged.columns if c not in MERGED_COLUMNS] == ["note_x", "note_y", "rank"]
    assert {r["order_id"] for r in clean_wide(merged).collect()} == {"a"}
    (row,) = clean_sources(sources).collect()
    assert (row["note_x"], row["note_y"], row["rank"]) == ("kept", "shop", 1)
    assert MARTS["dm_payment_analysis"](clean_tables(sources, [])).first()["total_transactions"] == 1


def test_amounts_lose_no_digits(spark):
    small = spark.createDataFrame([(0.00004,)] * 10, "price double")
    with pytest.raises(Exception, match="price: not a number"):
        small.agg(exact_sum(F.col("price"), 4)).collect()
    assert float(small.agg(exact_sum(F.col("price"))).first()[0]) == 0.0004
    with pytest.raises(Exception, match="price: not a number"):
        spark.createDataFrame([(1.5e-24,)], "price double").agg(exact_sum(F.col("price"))).collect()
    large = spark.createDataFrame([(1e15,), (0.25,)], "price double")
    assert float(large.agg(exact_sum(F.col("price"))).first()[0]) == 1e15 + 0.25
    with pytest.raises(Exception, match="price: not a number"):
        spark.createDataFrame([(1e30,)], "price double").agg(exact_sum(F.col("price"))).collect()


@pytest.mark.parametrize("column", ["payment_sequential", "payment_installments", "order_item_id"])
def test_a_fractional_median_stops_the_job(spark, column):
    """Values 1 and 2 and one missing: the fill is 1.5, which the final conversion refuses."""
    values = dict(zip("abc", (1, 2, None), strict=True))
    payments = [payment(o, **({column: v} if column != "order_item_id" else {})) for o, v in values.items()]
    items = [item(o, v if column == "order_item_id" else 1) for o, v in values.items()]
    sources = small_sources(spark, [order(o) for o in values], payments, [review(o, o) for o in values], items)
    with pytest.raises(Exception, match="not a 32-bit integer"):
        stage(spark, sources, types=WHOLE_NUMBERS)


def test_nan_counts_as_missing(spark):
    sources = small_sources(
        spark,
        [order("a"), order("b")],
        [payment("a"), payment("b", value=math.nan)],
        [review("a", "r", review_score=math.nan), review("b", "s", review_score=2.0)],
        [item("a", price=math.nan), item("b", price=7.0)],
    )
    (row,) = both_ways(sources).values()
    assert (row["order_id"], row["price"], row["review_score"]) == ("a", 7.0, 2.0)


def test_product_length_is_never_filled(spark):
    products = [product(), product("p2", product_name_lenght=None), product("p3", product_category_name=None)]
    items = [item("a", n, product_id=f"p{n}") for n in (1, 2, 3, 4)]
    rows = clean_sources(small_sources(spark, [order("a")], [payment("a")], [review("a", "r")], items, products))
    got = {(r["product_id"], r["product_category_name"], r["product_category_name_english"]) for r in rows.collect()}
    assert got == {("p1", "toys", "toys"), ("p3", "Unknown", "Unknown")}


def test_fractional_median_of_an_integer_column_is_an_error_when_typed(spark):
    items = [item("a", 1), item("a", 2), item("a", None)]
    cleaned = clean_sources(small_sources(spark, [order("a")], [payment("a")], [review("a", "r")], items))
    assert {r["order_item_id"] for r in cleaned.collect()} == {1.0, 1.5, 2.0}
    with pytest.raises(Exception, match="not a 32-bit integer"):
        convert_types(cleaned).collect()


def test_casts(spark):
    df = spark.createDataFrame([("2.0",), ("7",), ("x",), (None,), ("nan",), ("00042",)], "v string")
    assert [r[0] for r in df.select(lenient_int(F.col("v"))).collect()] == [2, 7, None, None, None, 42]
    edge = spark.createDataFrame([("-2147483648",), ("2147483647",)], "v string")
    assert [r[0] for r in edge.select(lenient_int(F.col("v"))).collect()] == [-(2**31), 2**31 - 1]
    for bad in ("1.5", "3000000000", "-2147483649"):
        with pytest.raises(Exception, match="not a 32-bit integer"):
            spark.createDataFrame([(bad,)], "v string").select(lenient_int(F.col("v"))).collect()
    times = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",), (None,)], "v string")
    assert [r[0] is None for r in times.select(lenient_timestamp(F.col("v"))).collect()] == [False, True, True]
    numbers = spark.createDataFrame([("1.5",), (None,), ("NaN",)], "v string")
    assert [r[0] for r in numbers.select(strict_double(F.col("v"))).collect()] == [1.5, None, None]
    with pytest.raises(Exception, match="not a number"):
        times.select(strict_double(F.col("v"))).collect()


def test_convert_skips_absent_columns(spark):
    df = convert_types(spark.createDataFrame([("5", "x")], "payment_installments string, other string"))
    assert df.dtypes == [("payment_installments", "int"), ("other", "string")]


def test_column_helpers(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2)], "`a-b c` double, n int")
    assert sanitize_columns(df).columns == ["a_b_c", "n"]
    assert [r[0] for r in nan_to_null(sanitize_columns(df)).orderBy("n").collect()] == [None, 2.0]
    assert table_name("data/some_table.csv") == "some_table"
    assert spark.range(1).select(thousands(F.lit(12345.678))).first()[0] == "12,345.68"


def test_shipping_seconds_cut_toward_zero(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00' AS p, timestamp_ntz'2023-12-31 23:59:58.5' AS d "
        "UNION ALL SELECT timestamp_ntz'2024-01-01', null"
    )
    assert sorted(r[0] for r in df.select(shipping_seconds("d", "p")).collect()) == [-1, 0]


def test_statuses_without_deliveries_stay_with_zeros(spark):
    """Marts over a wide table that was not cleaned: null keys go, statuses stay, sums of nothing are 0."""
    sources = small_sources(
        spark,
        [order("a", order_delivered_customer_date=day(3)), order("b", order_status="canceled"), order("c", order_status=None)],
        [payment("a"), payment("b", payment_type=None)],
        [],
        [item("a")],
    )
    wide = merge_wide(sources)
    fulfilment = {r["order_status"]: (r["avg_shipping_time"], r["total_orders"]) for r in WIDE_MARTS["dm_order_fulfillment"](wide).collect()}
    assert fulfilment == {"delivered": (2 * 86400, 1), "canceled": (0, 0)}
    assert [r["payment_type"] for r in WIDE_MARTS["dm_payment_analysis"](wide).collect()] == ["card"]


def test_wide_and_table_star_agree(sources):
    from helpers import same

    from ordermart.functions.casts import lenient_int as as_int

    wide = clean_sources(sources).withColumn("payment_installments", as_int(F.col("payment_installments")))
    from_wide = star_from_wide(wide)
    for name, df in build_star(clean_tables(sources)).items():
        same(df, from_wide[name])
