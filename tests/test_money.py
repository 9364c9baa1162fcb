"""Amounts as floating-point arithmetic and 32-bit storage leave them, against sums of fractions."""

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from helpers import item, order, payment, review, small_sources
from pyspark.sql import functions as F

from ordermart.functions.casts import as_double, exact_sum, weighted_money, weighted_money_sum
from ordermart.operators.clean import clean_sources, clean_tables
from ordermart.plans.incremental import with_fill
from ordermart.plans.queries import BUILDERS

# A sum and a difference with a rounding error, a 32-bit price, four places, a whole number, a large amount, a refund.
AMOUNTS = [0.1 + 0.2, 0.1 - 0.09, float(np.float32(9.99)), 12.3456, 7.0, 123456789.123456, -0.1 - 0.2]


def fraction(value):
    return Fraction(Decimal(repr(value)))


@pytest.mark.parametrize("value", AMOUNTS)
def test_one_amount(spark, value):
    df = spark.createDataFrame([(value, 3)], "price double, n bigint")
    row = df.agg(exact_sum(F.col("price")).alias("a"), weighted_money_sum(F.col("price"), F.col("n")).alias("b")).first()
    assert Fraction(row["a"]) == fraction(value)
    assert Fraction(row["b"]) == 3 * fraction(value)
    assert Fraction(df.select(weighted_money(F.col("price"), F.col("n"))).first()[0]) == 3 * fraction(value)


def test_many_amounts_in_any_order(spark):
    rng = np.random.default_rng(4)
    values = [float(v) for v in np.exp(rng.normal(3, 3, 2000))]
    values = [v for v in values if v > 0.01] + [float(np.float32(v)) for v in values if v > 0.01] + AMOUNTS
    weights = [int(w) for w in rng.integers(1, 10**9, len(values))]
    expected = float(sum(fraction(v) * w for v, w in zip(values, weights)))
    for seed in (1, 2):
        at = np.random.default_rng(seed).permutation(len(values))
        df = spark.createDataFrame([(values[k], weights[k]) for k in at], "price double, n bigint").repartition(3)
        assert df.agg(as_double(weighted_money_sum(F.col("price"), F.col("n")))).first()[0] == expected


def test_no_amounts(spark):
    df = spark.createDataFrame([(None, 1), (2.5, None)], "price double, n bigint")
    assert df.agg(weighted_money_sum(F.col("price"), F.col("n"))).first()[0] is None


def test_too_many_places_or_digits(spark):
    for value in (1.5e-24, 1e19):
        df = spark.createDataFrame([(value, 1)], "price double, n bigint")
        with pytest.raises(Exception, match="price: not a number"):
            df.agg(weighted_money_sum(F.col("price"), F.col("n"))).collect()


@pytest.fixture(scope="module")
def noisy(spark):
    """An order per amount with two payments, a review or two, and two items; a price is missing."""
    orders, payments, reviews, items = [], [], [], []
    for k, value in enumerate(AMOUNTS):
        name = f"o{k}"
        orders.append(order(name, order_delivered_customer_date=None))
        payments += [payment(name, 1, value), payment(name, 2, value / 3)]
        reviews += [review(name, f"r{k}{j}") for j in range(1 + k % 2)]
        items += [item(name, 1, price=value, freight_value=value / 7), item(name, 2, price=None if k == 3 else value * 1.1)]
    return small_sources(spark, orders, payments, reviews, items)


def test_results_take_them(spark, noisy):
    """Totals straight from the tables against fractions over the wide rows."""
    tables = clean_tables(noisy)
    rows = clean_sources(noisy).select("payment_value", "price", "freight_value").collect()
    paid, sold, freight = (float(sum(fraction(r[k]) for r in rows)) for k in range(3))
    assert BUILDERS["dm_payment_analysis"](tables).first()["total_revenue"] == paid
    assert BUILDERS["dm_sales_performance"](tables).first()["total_revenue"] == paid
    category = BUILDERS["Agg_sales_by_category"](tables).first()
    assert (category["total_sales"], category["total_freight"]) == (sold, freight)
    assert BUILDERS["Agg_sales_by_customer_state"](tables).first()["total_sales"] == sold


def test_fills_of_states_take_them(spark):
    """A total of what is there plus a fill with many places for what is missing."""
    df = spark.createDataFrame([(0.1 + 0.2, 3)], "price double, missing bigint")
    total = with_fill(exact_sum(F.col("price")), F.sum("missing"), F.lit(0.1 - 0.09))
    assert Fraction(df.agg(total).first()[0]) == fraction(0.1 + 0.2) + 3 * fraction(0.1 - 0.09)
