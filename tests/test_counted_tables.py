"""Tables that the job writes count as large as their rows, not as their compressed files: the driver holds what is broadcast."""

from helpers import item, order, payment, product, review, small_sources
from pyspark.sql import functions as F

from ordermart.operators import statistics
from ordermart.operators.fanout import LineCounts
from ordermart.operators.star import key_maps
from ordermart.plans.refresh import land, stage
from ordermart.schemas import FACT_LOOKUPS
from ordermart.session import fresh_dir, materialise
from ordermart.sources.catalog import append_bucketed, drop_folder, materialise_table, publish, publish_bucketed, read_table, size_of, stage_database

ROWS = 600_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ids(spark, n=ROWS):
    return spark.range(n).select("id", F.lit(1).alias("a"), F.lit(1).alias("b"), F.lit(1).alias("c"))


def test_a_bucketed_table_is_as_large_as_its_rows(spark):
    db = stage_database(spark)
    publish_bucketed(ids(spark), db, "t", "id", 4)
    table = read_table(spark, db, "t")
    assert size_of(table) >= ROWS * 20
    # 600,000 rows of 24 bytes are over 10 MB, whatever their files have.
    assert "BroadcastHashJoin" not in plan(spark.range(1 << 30).join(table.select("id", "a", "b"), "id"))
    assert "BroadcastHashJoin" in plan(spark.range(1 << 30).join(read_table(spark, db, "t").filter("id < 5").limit(5), "id"))


def test_appended_rows_are_counted(spark):
    db = stage_database(spark)
    publish_bucketed(ids(spark, 10), db, "t", "id", 4)
    append_bucketed(ids(spark), db, "t", "id")
    publish(ids(spark, 10), db, "plain")
    publish(ids(spark), db, "plain", "append")
    for name in ("t", "plain"):
        assert size_of(read_table(spark, db, name)) >= ROWS * 20


def test_written_frames_that_are_joined_are_counted(spark):
    assert size_of(materialise_table(ids(spark))) >= ROWS * 20
    tables = {t: spark.range(ROWS).withColumnRenamed("id", "order_id") for t in ("orders", "payments", "reviews", "items")}
    assert size_of(LineCounts(tables).frame) >= ROWS * 40
    dimensions = {n: spark.range(ROWS).select(F.col("id").alias(b), F.col("id").alias(k)) for n, (b, k) in FACT_LOOKUPS.items()}
    for df in key_maps(dimensions).values():
        assert size_of(df) >= ROWS * 16
        assert "BroadcastHashJoin" not in plan(spark.range(1 << 30).withColumnRenamed("id", df.columns[0]).join(df, df.columns[0], "left"))


def test_staged_counts_are_as_large_as_their_rows(spark):
    n = 300
    one = [order(i) for i in range(n)], [payment(i) for i in range(n)], [review(i, f"r{i}") for i in range(n)], [item(i) for i in range(n)]
    for results in (True, False):
        tables = stage(spark, small_sources(spark, *one), ["price"], buckets=2, results=results)
        for name in ("placed_counts", "placed_items", "orders"):
            table = read_table(spark, tables.staged_in, name)
            assert size_of(table) >= n * table._jdf.schema().defaultSize()
        assert tables.orders.count() == n


def test_products_are_not_broadcast_for_their_statistics(spark, monkeypatch):
    one = [order(1)], [payment(1)], [review(1, "r1")], [item(1)], [product()]
    sources, seen = small_sources(spark, *one), []
    sources["products"] = materialise(sources["products"])
    monkeypatch.setattr(statistics, "weighted_numbers", lambda spark, parts: seen.extend(parts) or {})
    statistics.merged_statistics(sources, ["product_weight_g"])
    (joined, _), = seen
    # Above the grouping by product.
    assert "SortMergeJoin [product_id" in plan(joined).split("HashAggregate")[0]
    assert [r["weight"] for r in joined.collect()] == [1]


def test_landed_lookups_are_counted_and_dropped(spark):
    folder = fresh_dir(spark, "landed")
    landed = land(spark, {"customers": ids(spark).withColumnRenamed("id", "customer_id")}, folder)["customers"]
    assert size_of(landed) >= ROWS * 20
    orders = spark.range(1 << 30).withColumnRenamed("id", "customer_id")
    assert "BroadcastHashJoin" not in plan(orders.join(landed.select("customer_id", "a", "b"), "customer_id", "left"))
    drop_folder(spark, folder)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    assert not spark.catalog.databaseExists("ordermart_stage_" + folder.rpartition("/")[2].replace("-", "_"))
