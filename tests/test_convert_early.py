"""Texts parsed before a join repeats them."""

import pytest
from helpers import item, order, payment, product, review, rows_of, small_sources
from pyspark.sql import functions as F

from ordermart.functions.columns import nan_to_null
from ordermart.operators import clean
from ordermart.operators.convert import convert_types, parse_types, refuse_unparsed
from ordermart.operators.merge import merge_wide
from ordermart.plans import queries

TYPES = {"i": "int", "d": "double", "t": "timestamp_ntz", "s": "string"}


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "i string, d string, t string, s string")


def test_parsed_texts_equal_converted_ones(spark):
    df = texts(spark, ("2.0", "1.5", "2024-01-02 03:04:05", "a"), ("many", "NaN", "unknown", ""), (None, None, None, None), ("NaN", "-0.0", "", "b"))
    found, wanted = refuse_unparsed(parse_types(df, TYPES)), convert_types(df, TYPES)
    assert found.dtypes == wanted.dtypes
    assert rows_of(found) == rows_of(wanted)
    typed = wanted.withColumn("d", F.coalesce("d", F.lit(float("nan"))))
    assert rows_of(convert_types(typed, TYPES)) == rows_of(nan_to_null(typed))


@pytest.mark.parametrize("bad", [("2.5", "1", None, None), ("99999999999", "1", None, None), ("1", "much", None, None), ("1", "", None, None)])
def test_a_bad_text_is_an_error_where_its_row_is_used(spark, bad):
    parsed = parse_types(texts(spark, bad, ("1", "1", None, "kept")), TYPES)
    assert refuse_unparsed(parsed.filter("s = 'kept'")).count() == 1
    with pytest.raises(Exception, match="not a number of its type"):
        refuse_unparsed(parsed).collect()


def test_merged_texts_are_parsed_before_they_multiply(spark, monkeypatch):
    orders = [order("a"), order("b")]
    payments = [payment("a"), payment("a", 2), payment("b")]
    sources = small_sources(spark, orders, payments, [review("a", "r")], [item("a"), item("a", 2), item("b", product_id="none")], [product()])
    monkeypatch.setattr(queries, "load_raw_sources", lambda *_: sources)
    monkeypatch.setattr(queries, "as_delivered", lambda s: {n: df.select(*[F.col(c).cast("string") for c in df.columns]) for n, df in s.items()})
    found = queries.QUERIES["convert_types"](spark, "")
    texts_of = {n: df.select(*[F.col(c).cast("string") for c in df.columns]) for n, df in sources.items()}
    late = convert_types(clean.rename(merge_wide(texts_of)))
    assert found.dtypes == late.dtypes
    assert rows_of(found) == rows_of(late)
    # No text is parsed above the joins.
    above = [df._jdf.queryExecution().optimizedPlan().toString().partition("Join")[0] for df in (found, late)]
    assert ["timestamp_ntz)" in plan for plan in above] == [False, True]
