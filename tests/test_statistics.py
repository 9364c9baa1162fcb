"""Distributed medians against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordermart.operators import statistics
from ordermart.operators.statistics import Bracket, brackets, keep_long, long_values, mean, medians, weighted_numbers


@pytest.mark.parametrize("seed,sort_rows", [(0, 10_000_000), (1, 10_000_000), (2, 1), (3, 1)])
def test_medians_match(spark, seed, sort_rows, monkeypatch):
    monkeypatch.setattr(statistics, "SORT_ROWS", sort_rows)
    monkeypatch.setattr(statistics, "BINS", 16)
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    frame = pd.DataFrame(
        {
            "near_unique": rng.normal(0, 1e6, n),
            "coarse": rng.integers(-3, 4, n).astype(float),
            "tails": np.exp(rng.normal(0, 12, n)),
            "narrow": 50000 + rng.random(n),
            "weight": rng.integers(1, 5, n),
        }
    )
    columns = ["near_unique", "coarse", "tails", "narrow"]
    df = spark.createDataFrame(frame).repartition(3)
    repeated = frame.loc[frame.index.repeat(frame["weight"])]

    def values(names, ranges):
        return keep_long(long_values(df, names, "weight"), ranges)

    for narrow in (None, brackets(df, columns, "weight")):
        got = medians(columns, values, narrow)
        for c in columns:
            assert got[c] == pytest.approx(repeated[c].median(), rel=1e-15, abs=1e-300)
    assert mean(df, "coarse", "weight")["coarse"] == pytest.approx(repeated["coarse"].mean(), abs=1e-12)


def test_no_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert medians(["v"], lambda names, ranges: long_values(df, names)) == {}
    assert mean(df, "v") == {}
    assert brackets(df.withColumn("weight", F.lit(1)), ["v"], "weight") == {}


@pytest.mark.parametrize("sort_rows", [10_000_000, 1])
def test_brackets_take_two_passes(spark, monkeypatch, sort_rows):
    """Weights of many sizes; the bracket holds a small part, and one look at it is enough."""
    rng = np.random.default_rng(5)
    n = 60_000
    frame = pd.DataFrame({"v": rng.lognormal(3, 2, n), "tied": rng.integers(0, 4, n).astype(float), "weight": 1 << rng.integers(0, 12, n)})
    df = spark.createDataFrame(frame).repartition(8)
    narrow = brackets(df, ["v", "tied"], "weight")
    monkeypatch.setattr(statistics, "SORT_ROWS", sort_rows)
    looks = []

    def values(names, ranges):
        looks.append(list(names))
        return keep_long(long_values(df, names, "weight"), ranges)

    got = medians(["v", "tied"], values, narrow)
    order = frame.sort_values("v")
    upto = order["weight"].cumsum()
    assert got["v"] == order["v"][upto >= (upto.iloc[-1] + 1) // 2].iloc[0]
    assert got["tied"] in (1.0, 2.0)
    inside = frame["v"].between(narrow["v"].low, narrow["v"].high)
    assert frame["weight"][inside].sum() < 0.02 * frame["weight"].sum()
    assert narrow["v"].rows == pytest.approx(frame["weight"][inside].sum(), rel=0.5)
    # Where the bracket is small enough to be counted value by value, one look settles it.
    assert looks == [["v", "tied"]] if sort_rows > 1 else len(looks) <= 4


@pytest.mark.parametrize("low,high", [(-5.0, 3.0), (1e6, 1e7), (float("-inf"), float("inf")), (40.0, 40.0)])
def test_brackets_that_miss(spark, low, high):
    """The median does not depend on what the sketch says."""
    frame = pd.DataFrame({"v": np.random.default_rng(1).normal(40, 9, 501), "weight": 1})
    df = spark.createDataFrame(frame)
    got = medians(["v"], lambda names, ranges: keep_long(long_values(df, names, "weight"), ranges), {"v": Bracket(low, high, 10.0)})
    assert got["v"] == frame["v"].median()


def test_weighted_numbers(spark):
    """Parts with a mean, a median, rows of weight nought, nulls, NaN and infinite values; a part without rows."""
    reviews = spark.createDataFrame([(5.0, 3), (None, 9), (1.0, 1), (float("nan"), 4), (2.0, 0)], "review_score double, weight long")
    items = spark.createDataFrame([(1.0, 2), (float("inf"), 2), (7.5, 1), (float("-inf"), 2), (None, 5)], "price double, weight long")
    empty = spark.createDataFrame([], "payment_sequential int, weight long")
    got = weighted_numbers(spark, [(reviews, ["review_score"]), (items, ["price"]), (empty, ["payment_sequential"])])
    assert got == {"review_score": 4.0, "price": 1.0}
