"""Dense keys, catalog tables, CSV files, relational rows."""

import pytest
from helpers import item, order, payment, product, review, same, small_sources
from pyspark.sql import functions as F

from ordermart.operators import insights
from ordermart.operators.keys import surrogate_key
from ordermart.operators.registry import extend_keys, keyed
from ordermart.operators.star import NATURAL_KEYS
from ordermart.plans.refresh import extend_star, publish_star, refresh, stage
from ordermart.schemas import DIMENSIONS, FACT_LOOKUPS
from ordermart.sources import jdbc
from ordermart.session import clear_stage
from ordermart.sources.catalog import application_database, bucket_count, bucket_number, create_database, has_rows, list_tables, publish, read_table, stage_database
from ordermart.sources.files import NULL_TEXT, read_csv, read_csv_as, write_csv


def test_keys_are_dense_and_repeatable(spark):
    df = spark.range(20000).select(F.concat(F.lit("id"), "id").alias("name"), F.col("id").alias("v"))
    keys = surrogate_key(df, "key", ["name"])
    stats = keys.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()
    assert tuple(stats) == (1, 20000, 20000)
    same(keys, surrogate_key(df.repartition(7), "key", ["name"]))
    assert surrogate_key(df, "key", ["name"], start=101).agg(F.min("key")).first()[0] == 101


def test_append_doubles_and_overwrite_replaces(spark):
    db = stage_database(spark)
    df = spark.range(3)
    publish(df, db, "t")
    publish(df, db, "t", "append")
    assert read_table(spark, db, "t").count() == 6
    publish(df, db, "t")
    assert read_table(spark, db, "t").count() == 3


def test_a_failed_overwrite_leaves_the_old_table(spark):
    db = stage_database(spark)
    publish(spark.range(3), db, "t")
    with pytest.raises(Exception, match="broken"):
        publish(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), db, "t")
    assert read_table(spark, db, "t").count() == 3
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["t"]


def test_a_database_keeps_its_place(spark, tmp_path):
    create_database(spark, "placed", str(tmp_path / "a"))
    create_database(spark, "placed", str(tmp_path / "a"))
    with pytest.raises(ValueError, match="placed is at"):
        create_database(spark, "placed", str(tmp_path / "b"))


def test_buckets_follow_the_size(spark, sources):
    least = spark.sparkContext.defaultParallelism
    assert bucket_count([sources["orders"]]) == least
    assert bucket_count([sources["orders"], sources["items"]], bucket_bytes=100) > 10 * least


def test_appending_the_star_twice_doubles_every_table(spark, sources):
    tables = stage(spark, sources)
    db = stage_database(spark)
    publish_star(spark, tables, db, "append")
    once = {n: read_table(spark, db, n).count() for n in [*DIMENSIONS, "fact_orders"]}
    publish_star(spark, tables, db, "append")
    assert {n: read_table(spark, db, n).count() for n in once} == {n: 2 * k for n, k in once.items()}


def test_keys_last_over_loads(spark):
    """A natural key keeps its key, new ones go above, attributes and facts of the newest load stay."""
    db = stage_database(spark)
    first = small_sources(
        spark,
        [order("a"), order("b", customer_id="c1")],
        [payment("a"), payment("b", payment_type="cash")],
        [review("a", "r1"), review("b", "r2")],
        [item("a"), item("b", product_id="p2")],
        [product("p1"), product("p2")],
    )
    second = small_sources(
        spark,
        [order("b"), order("c")],
        [payment("b", payment_type="voucher"), payment("c")],
        [review("b", "r2", review_score=1.0), review("c", "r3")],
        [item("b", product_id="p0"), item("c", product_id="p2")],
        [product("p0"), product("p2", product_weight_g=9.0)],
    )
    keys = []
    for load in (first, second):
        extend_star(spark, stage(spark, load), db)
        keys.append({n: {tuple(r[c] for c in NATURAL_KEYS[n]): r[DIMENSIONS[n][0]] for r in read_table(spark, db, n).collect()} for n in DIMENSIONS})
    for name in DIMENSIONS:
        old, new = keys[0][name], keys[1][name]
        assert {k: new[k] for k in old} == old
        assert sorted(new.values()) == list(range(1, len(new) + 1))
        assert min([new[k] for k in new if k not in old], default=len(old) + 1) == len(old) + 1
    assert set(keys[1]["dim_products"]) == {("p0",), ("p1",), ("p2",)}
    weights = {r["product_id"]: r["product_weight_g"] for r in read_table(spark, db, "dim_products").collect()}
    assert weights == {"p0": 1.0, "p1": 1.0, "p2": 9.0}
    facts = {r["order_id"]: r for r in read_table(spark, db, "fact_orders").collect()}
    assert sorted(facts) == ["a", "b", "c"]
    assert facts["b"]["product_key"] == keys[1]["dim_products"]["p0",]
    assert facts["b"]["payment_type_key"] == keys[1]["dim_payment_types"]["voucher",]
    # The same load once more changes nothing.
    before = [sorted(map(str, read_table(spark, db, n).collect())) for n in [*DIMENSIONS, "fact_orders"]]
    extend_star(spark, stage(spark, second), db)
    assert [sorted(map(str, read_table(spark, db, n).collect())) for n in [*DIMENSIONS, "fact_orders"]] == before


def test_facts_of_a_later_load_replace_old_ones_in_place(spark, sources, monkeypatch):
    """Old facts are not shuffled by order; a load in other buckets keeps the buckets of the table."""
    from ordermart.plans import refresh as module

    db, plans, write = stage_database(spark), [], module.publish_bucketed
    monkeypatch.setattr(module, "publish_bucketed", lambda df, *a, **k: plans.append((a[1], df)) or write(df, *a, **k))
    extend_star(spark, stage(spark, sources, results=False), db)
    once = sorted(map(str, read_table(spark, db, "fact_orders").collect()))
    buckets = bucket_number(spark, db, "fact_orders")
    assert buckets
    for other in (buckets, buckets + 1):
        plans.clear()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            extend_star(spark, stage(spark, sources, results=False, buckets=other), db)
            plan = dict(plans)["fact_orders"]._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert ("RepartitionByExpression" in plan) == (other != buckets)
        assert bucket_number(spark, db, "fact_orders") == buckets
        assert sorted(map(str, read_table(spark, db, "fact_orders").collect())) == once


def test_looking_keys_up_leaves_the_map_in_place(spark):
    db = stage_database(spark)
    rows = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).alias("part"))
    extend_keys(rows.filter("id % 2 = 0"), db, "dim", "k", ["name", "part"])
    keys = extend_keys(rows, db, "dim", "k", ["name", "part"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keyed(rows, keys, "k", ["name", "part"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1
    assert keys.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first()[:] == (1, 5000, 5000)


def test_frames_built_first_and_read_in_any_order(spark, sf_dir):
    from ordermart.plans.queries import QUERIES

    names = ["star_agg_sales_by_seller", "star_agg_sales_by_category", "scan_table", "src_csv", "sink_append"]
    built = [(n, QUERIES[n](spark, sf_dir)) for n in names + names]
    rows = {}
    for n, df in reversed(built):
        assert rows.setdefault(n, sorted(map(str, df.collect()))) == sorted(map(str, df.collect()))


def test_empty_text_and_null_stay_apart_in_csv(spark, tmp_path):
    df = spark.createDataFrame([("two\nlines", 1.5), ("", None), (None, 2.0), ('a "quoted", text', 3.0), ("\r\n", 4.0)], "t string, v double")
    path = write_csv(df, str(tmp_path / "x"), NULL_TEXT)
    same(read_csv_as(spark, path, df), df)


def test_undeclared_columns_are_read_as_text(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,note,seller_zip_code_prefix\ns1,007,12\n")
    assert read_csv(spark, str(path), "sellers").dtypes == [("seller_id", "string"), ("note", "string"), ("seller_zip_code_prefix", "int")]


def test_shares_of_nothing(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "k string, v double")
    assert sorted((r["k"], r["v"], r["share"]) for r in insights.share_of_total(df, "k", "v").collect()) == [("a", 0.0, None), ("b", 0.0, None)]


def test_table_listing(spark):
    db = stage_database(spark)
    for name in ("Agg_one", "aggregate_two", "dm_three"):
        publish(spark.range(1), db, name)
    # The underscore of the pattern matches any character.
    assert sorted(r[0] for r in list_tables(spark, db).collect()) == ["agg_one", "aggregate_two"]
    assert list_tables(spark, "no_such_database").count() == 0
    assert read_table(spark, db, "missing") is None
    assert has_rows(read_table(spark, db, "Agg_one")) and not has_rows(None)


def test_csv_text_and_types(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_bytes(
        "﻿review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date\n"
        'r1,o1,4.0,"a ""quoted"" title","two\nlines",2024-01-02 03:04:05\n'
        "r2,o2,,,,sometime".encode()
    )
    first, second = read_csv(spark, str(path), "reviews").orderBy("review_id").collect()
    assert first["review_comment_title"] == 'a "quoted" title' and first["review_comment_message"] == "two\nlines"
    assert first["review_score"] == 4.0 and str(first["review_creation_date"]) == "2024-01-02 03:04:05"
    assert second["review_score"] is None and second["review_creation_date"] is None
    back = write_csv(read_csv(spark, str(path), "reviews"), str(tmp_path / "out"))
    same(read_csv(spark, back, "reviews"), read_csv(spark, str(path), "reviews"))


def test_translation_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "translation.csv"
    path.write_bytes("﻿product_category_name,product_category_name_english\nspielzeug,toys".encode())
    assert [tuple(r) for r in read_csv(spark, str(path), "translation").collect()] == [("spielzeug", "toys")]


def test_jdbc_options():
    assert jdbc.scan_options("t", None, 8) == {"dbtable": "t", "fetchsize": "10000"}
    options = jdbc.scan_options("t", (1, 90), 8)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "90")


def test_relational_rows_number_copies(spark, monkeypatch):
    monkeypatch.setattr(jdbc, "CHUNK", 10)
    df = spark.createDataFrame([("x", 1.5)] * 37 + [("y", None), ("z", float("nan"))], "`a-b` string, v double")
    rows = jdbc.relational_rows(df, last_id=5)
    assert rows.columns == ["id", "a_b", "v"] and dict(rows.dtypes)["v"] == "string"
    got = rows.collect()
    assert sorted(r["id"] for r in got) == list(range(6, 6 + 39))
    assert sum(r["a_b"] == "x" and r["v"] == "1.5" for r in got) == 37
    assert {r["a_b"] for r in got if r["v"] is None} == {"y", "z"}


def test_top_customers_break_ties_by_id(spark):
    sales = spark.createDataFrame([(i, None if i == 9 else 5.0 if i % 2 else 1.0) for i in range(30)], "customer_id int, total_revenue double")
    assert [r["customer_id"] for r in insights.top_customers(sales).collect()] == [1, 3, 5, 7, 11, 13, 15, 17, 19, 21]


def test_charts_select_their_columns(spark):
    table = spark.createDataFrame([("b", 2.0, 1), ("a", 1.0, 1)], "month string, total_sales double, total_orders int")
    assert [tuple(r) for r in insights.chart(table, "month_sales").collect()] == [("a", 1.0), ("b", 2.0)]


@pytest.fixture(scope="module")
def warehouse(spark, sources):
    database = application_database(spark, "refresh_test")
    refresh(spark, sources, database)
    assert not any(r["tableName"].startswith("stage") for r in spark.sql(f"SHOW TABLES IN {database}").collect())
    return lambda name: read_table(spark, database, name)


def test_warehouse_invariants(warehouse):
    fact = warehouse("fact_orders")
    n = fact.count()
    assert n == 4725
    for name, (key, _) in DIMENSIONS.items():
        low, high, distinct, rows = warehouse(name).agg(F.min(key), F.max(key), F.count_distinct(key), F.count("*")).first()
        assert (low, high, distinct) == (1, rows, rows)
    for name, (_, key) in FACT_LOOKUPS.items():
        assert fact.join(warehouse(name), key, "left_anti").count() == 0
    assert warehouse("Agg_sales_by_category").agg(F.sum("total_orders")).first()[0] == n
    paid = warehouse("dm_payment_analysis").agg(F.sum("total_revenue")).first()[0]
    assert paid == pytest.approx(warehouse("dm_sales_performance").agg(F.sum("total_revenue")).first()[0], rel=1e-12)
    shares = insights.share_of_total(warehouse("Agg_sales_by_seller"), "seller_state", "total_sales")
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1.0)


def test_staged_joins_need_no_exchange_by_order(spark, sources):
    tables = stage(spark, sources, ["price"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from ordermart.operators.weights import item_lines

        plan = item_lines(tables, ["price"], ["n_payments"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_large_orders_are_staged_without_buckets(spark, sources, monkeypatch):
    from ordermart.operators.clean import clean_tables
    from ordermart.operators.marts import MARTS
    from ordermart.plans import refresh as module

    database = stage_database(spark)
    monkeypatch.setattr(module, "stage_database", lambda spark: database)
    monkeypatch.setattr(module, "clean_tables", lambda s, columns: clean_tables(s, columns, rows_per_slice=3))
    tables = stage(spark, sources, [])
    layout = spark.sql(f"DESCRIBE EXTENDED {database}.items").collect()
    assert not any(row["col_name"] == "Bucket Columns" for row in layout)
    same(MARTS["dm_payment_analysis"](tables), MARTS["dm_payment_analysis"](clean_tables(sources, [])))


def test_clearing_the_stage_drops_its_databases(spark):
    database = stage_database(spark)
    publish(spark.range(2), database, "t")
    clear_stage(spark)
    assert not spark.catalog.databaseExists(database)
