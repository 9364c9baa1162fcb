"""Sums of amounts: hundredths as integers, all others as decimals."""

from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ordermart.functions.casts import UNITS_LIMIT, exact_sum, hundredths, weighted_money_sum

# Hundredths and others, at and beyond the limit up to which hundredths are added as integers.
AMOUNTS = [0.01, -19.99, 0.0, -0.0, 1e-3, 0.1 + 0.2, 12.345, 7.0, UNITS_LIMIT / 100, UNITS_LIMIT / 100 + 0.01, 5e9, 123456789.123456, None]


def test_hundredths(spark):
    df = spark.createDataFrame([(v,) for v in [*AMOUNTS, float("nan"), float("inf")]], "v double")
    found = [r[0] for r in df.select(hundredths(F.col("v"))).collect()]
    assert found == [1, -1999, 0, 0, None, None, None, 700, UNITS_LIMIT, *[None] * 6]
    assert df.select(hundredths(F.lit(1).cast("decimal(38,19)"))).first()[0] is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_mixed_amounts_and_weights(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for weights in ([1, 3, 1000], [0, -2, 10**7]):
            rows = [(v, w) for v in AMOUNTS for w in weights] + [(2.5, None)]
            df = spark.createDataFrame(rows, "v double, n bigint").repartition(3)
            row = df.agg(exact_sum(F.col("v")).alias("a"), weighted_money_sum(F.col("v"), F.col("n")).alias("b")).first()
            number = lambda v: Fraction(Decimal(repr(v)))
            assert Fraction(row["a"]) == sum(number(v) for v, _ in rows if v is not None)
            assert Fraction(row["b"]) == sum(number(v) * w for v, w in rows if v is not None and w is not None)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_money_is_added_as_integers(spark):
    plan = spark.range(3).select(F.col("id").cast("double")).groupBy().agg(exact_sum(F.col("id")))._jdf.queryExecution().optimizedPlan().toString()
    assert "try_sum" in plan
