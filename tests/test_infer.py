"""Types of CSV columns from their values."""

import pytest

from ordermart.sources.files import write_csv
from ordermart.sources.infer import infer_types, read_csv_inferred

CASES = {
    "null": [None, None],
    "int": ["1", "-2", "+3", None, "007", "2147483647"],
    "bigint": ["1", "2147483648", "-9223372036854775808"],
    "double": ["1", "2.5", ".5", "3.", "1e-3", "99999999999999999999"],
    "timestamp_ntz": ["2024-02-29", "2024-01-01 10:00", "2024-01-01T10:00:00.123456", None],
    "string": ["1", "x"],
}


def test_each_type(spark):
    n = max(len(v) for v in CASES.values())
    rows = [tuple(v[i] if i < len(v) else None for v in CASES.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CASES)).repartition(3)
    found = infer_types(df).orderBy("position").collect()
    assert [(r["column_name"], r["type"]) for r in found] == [(c, c) for c in CASES]
    assert [r["n_nulls"] for r in found] == [n - sum(v is not None for v in values) for values in CASES.values()]
    assert {r["n_rows"] for r in found} == {n}


@pytest.mark.parametrize(
    "values", [["1", "2024-01-01"], ["1.5", "NaN"], [" 1"], ["1d"], ["2023-02-29"], ["2024-01-01 25:00"], ["1", ""], ["0x1"], ["٣"], ["1\n"]]
)
def test_text_that_only_looks_like_something(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert infer_types(df).first()["type"] == "string"


def test_one_value_in_many_decides(spark):
    """The last of many rows is read like the first."""
    df = spark.range(200_000).selectExpr("if(id = 199999, 'none', cast(id as string)) as v", "cast(id as string) as w")
    assert [r["type"] for r in infer_types(df).orderBy("position").collect()] == ["string", "int"]


def test_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string").toDF("a.b", "a", "a")
    assert [(r["column_name"], r["type"]) for r in infer_types(df).orderBy("position").collect()] == [("a.b", "int"), ("a", "string"), ("a", "double")]
    empty = spark.createDataFrame([], "a string, b int")
    assert [(r["type"], r["n_rows"], r["n_nulls"]) for r in infer_types(empty).collect()] == [("null", 0, 0), ("null", 0, 0)]


def test_one_scan_without_python(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = infer_types(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_read_with_inferred_types(spark, tmp_path):
    rows = [("1", "2.5", "2024-01-01 00:00:00", "3000000000", "a,b", None), ("2", "3", None, "4", 'say "hi"\nthere', None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    back = read_csv_inferred(spark, write_csv(df, str(tmp_path / "t")), "orders", multiline=True)
    assert [t for _, t in back.dtypes] == ["int", "double", "timestamp_ntz", "bigint", "string", "string"]
    assert sorted((r["a"], r["b"], r["d"], r["e"]) for r in back.collect()) == [(1, 2.5, 3000000000, "a,b"), (2, 3.0, 4, 'say "hi"\nthere')]
