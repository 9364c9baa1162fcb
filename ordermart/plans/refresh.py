"""The whole job: convert and land the sources, stage the cleaned tables, publish star schema, aggregates and marts."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from math import isnan

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators.aggregates import AGGREGATES
from ordermart.operators.clean import STATISTIC_COLUMNS, CleanTables, clean_tables, complete_lookup, item_lookups, survives
from ordermart.operators.convert import convert_types
from ordermart.operators.fanout import KEY, LINE_TABLES, ROWS_PER_SLICE, LineCounts, counts_in_place, largest_group
from ordermart.operators.marts import MARTS
from ordermart.operators.merge import LOOKUPS, distinct_names, left_join, order_rows
from ordermart.operators.star import build_dimension, build_fact, extend_dimension, key_maps
from ordermart.operators.weights import COUNTS, counted_orders, kept_lines, per_order
from ordermart.schemas import COLUMN_TYPES, DIMENSIONS, FACT_COLUMNS, FACT_LOOKUPS, MEDIAN_COLUMNS, NOT_AVAILABLE_COLUMNS
from ordermart.session import at_once, fresh_dir
from ordermart.sources.catalog import UNKNOWN_BYTES, bucket_count, bucket_number, drop_folder, materialise_table, publish, publish_bucketed, read_table, size_of, stage_database
from ordermart.sources.snapshots import Snapshot, publish_snapshot

# Product and seller columns that results group by.
ITEM_COLUMNS = ["product_id", "product_category_name", "product_category_name_english", "seller_id", "seller_state"]
LOOKUP_COLUMNS = {c for name in ("dim_products", "dim_sellers") for c in DIMENSIONS[name][1]}
# Columns that the star schema is built from.
STAR_COLUMNS = {KEY, "delivered", "review_creation_date", *FACT_COLUMNS, *[b for b, _ in FACT_LOOKUPS.values()]}
STAR_COLUMNS |= {c for name in ("dim_customers", "dim_reviews") for c in DIMENSIONS[name][1]}
# Integer columns whose fill may be a fraction, which the final conversion refuses.
WHOLE_NUMBERS = {c: t for c, t in COLUMN_TYPES.items() if t == "int"}


def stage(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    columns: list[str] | None = None,
    types: dict[str, str] | None = None,
    buckets: int | None = None,
    results: bool = True,
    folder: str | None = None,
) -> CleanTables:
    """Write the tables once, to a database of this call, and return the cleaned ones.

    They have the size of the sources, not of the multiplied wide table. All are bucketed by order,
    so joins on the order find their rows in place. Lines are written before they are cleaned, so that what the
    rules need to know of all rows is computed in place, too; the rules are applied as they are read. Where a lookup
    repeats a key or an order is too large for one task, lines are cleaned first and written afterwards, a table with
    such an order as it comes. Orders carry the counts of their lines, so most results
    need one join or none. Products and sellers are written first: items meet the written copies, whose
    size is known, and keep the columns that results group by. Comments, which nothing is built from, are
    not written. With a ``folder`` the sources are read once, as ``land`` does, lookups first. Without ``results`` only a star schema can be built from the tables: they lack the columns
    and sums of the aggregates and marts, but for those that ``types`` check.
    ``types`` convert the cleaned columns; ``session.clear_stage`` deletes the tables.
    """
    typed = (lambda df: convert_types(df, types)) if types else (lambda df: df)
    if folder:
        # Lines that are files are left there until they are placed; a source of unknown size is landed as lookups are.
        files = [t for t in ("orders", *LINE_TABLES) if size_of(sources[t]) < UNKNOWN_BYTES]
        sources = sources | land(spark, {t: df for t, df in sources.items() if t not in files}, folder)
    buckets = buckets or bucket_count([sources[name] for name in ("orders", *LINE_TABLES)])
    database = stage_database(spark)
    star_only = not results and not types
    placed = _place(spark, distinct_names(sources), database, buckets, star_only, columns)
    if folder and placed is None:
        sources = sources | land(spark, {t: sources[t] for t in files}, folder)
    tables = clean_tables(placed or sources, columns)
    tables = replace(tables, **{n: typed(getattr(tables, n)) for n in ("orders", "payments", "reviews", "products", "sellers")})
    large = {name for name in LINE_TABLES if tables.lines.hot(name) is not None}

    def write(name: str, df: DataFrame, in_place: bool = False) -> DataFrame:
        if name in large:
            publish(df, database, name)
        else:
            publish_bucketed(df, database, name, KEY, buckets, in_place)
        return read_table(spark, database, name)

    def write_lookup(name: str) -> DataFrame:
        publish(getattr(tables, name), database, name)
        return read_table(spark, database, name)

    def lines(df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if (c in STAR_COLUMNS if star_only else c not in NOT_AVAILABLE_COLUMNS)])

    lookups = at_once(spark, {name: lambda name=name: write_lookup(name) for name in ("products", "sellers")})
    in_place = placed is not None and not large
    if in_place:
        items = typed(_found_items(tables, lookups["products"]))
    else:
        grouped = [df.select(*[c for c in df.columns if c in ITEM_COLUMNS or c not in LOOKUP_COLUMNS]) for df in lookups.values()]
        items = typed(item_lookups(tables.bare_items.select(*[c for c in tables.bare_items.columns if not c.startswith(FOUND)]), *grouped))
    frames = {name: lines(df) for name, df in {"items": items, "payments": tables.payments, "reviews": tables.reviews}.items()}
    if in_place:
        if types:
            at_once(spark, {name: lambda df=df: _refuse(df, types) for name, df in frames.items()})
    else:
        frames = at_once(spark, {name: lambda name=name, df=df: write(name, df) for name, df in frames.items()})
    written = replace(tables, **lookups, **frames, bare_items=None)
    wanted = [c for c in STATISTIC_COLUMNS if columns is None or c in columns]
    fills = [tables.numbers.get(c) for c in wanted]
    if in_place and star_only and not any(n is None or isnan(n) for n in fills):
        orders = counted_orders(tables.orders, placed["counts"])
    else:
        # A fill that is no number drops lines, so what is left of them is counted.
        orders = per_order(written, *LINE_TABLES, sums=results)
    if star_only:
        orders = orders.select(*[c for c in orders.columns if c in STAR_COLUMNS or c in COUNTS])
    return replace(written, orders=write("orders", orders, in_place), staged_in=database, buckets=None if large else buckets)


# Columns that items have from their product and seller before they are cleaned: null where there is none that is complete.
FOUND = "_found_"


def _place(spark: SparkSession, sources: dict[str, DataFrame], database: str, buckets: int, star_only: bool, columns: list[str] | None) -> dict[str, DataFrame] | None:
    """The sources with orders and lines laid out by order, so that counting, statistics and cleaning shuffle none of
    them by order again. Orders have met their customer, and items their product and seller, of which they keep the
    columns that results group by or, for a star schema only, a mark. Comments are left out. For a star schema lines that
    cleaning keeps are counted with the others.

    None where a lookup repeats a key, which multiplies rows, or where an order may be too large for one task.
    """
    counted = LineCounts(sources)
    if any(counted.repeated.values()):
        return None
    sizes = at_once(spark, {t: lambda t=t: largest_group(sources[t]) for t in LINE_TABLES})
    if max(sizes.values()) > ROWS_PER_SLICE:
        return None

    def found(df: DataFrame, key: str) -> DataFrame:
        kept = [c for c in df.columns if c != key and (c in ITEM_COLUMNS or c not in LOOKUP_COLUMNS)] if not star_only else []
        return df.select(key, F.lit(1).alias(FOUND + key), *[F.col(c).alias(FOUND + c) for c in kept])

    # Written first, as the join of all items with a lookup of unknown size would shuffle them.
    products = left_join(sources["products"], sources["translation"], LOOKUPS["translation"])
    lookups = {"product_id": products, "seller_id": sources["sellers"]}
    lookups = at_once(spark, {k: lambda k=k, df=df: materialise_table(found(complete_lookup(df), k)) for k, df in lookups.items()})
    frames = {
        "items": reduce(lambda items, k: left_join(items, lookups[k], k), lookups, sources["items"]),
        "orders": order_rows(sources),
        "payments": sources["payments"],
        "reviews": sources["reviews"].drop(*NOT_AVAILABLE_COLUMNS),
    }

    def write(name: str, df: DataFrame, in_place: bool = False) -> DataFrame:
        publish_bucketed(df.filter(F.col(KEY).isNotNull()), database, f"placed_{name}", KEY, buckets, in_place)
        return read_table(spark, database, f"placed_{name}")

    placed = at_once(spark, {name: lambda name=name, df=df: write(name, df) for name, df in frames.items()})
    if star_only:
        judged = {t: survives(placed[t], t, columns) for t in LINE_TABLES}
        counts = counts_in_place(placed | judged, kept_lines())
    else:
        counts = counts_in_place(placed)
    counts = write("counts", counts, in_place=True)
    return {t: sources[t] for t in ("products", "translation", "sellers")} | placed | {"counts": counts}


def _found_items(tables: CleanTables, products: DataFrame) -> DataFrame:
    """Cleaned items that have met their product and seller; cleaning has dropped those without."""
    names = [c for c in tables.bare_items.columns if c not in (FOUND + "product_id", FOUND + "seller_id")]
    items = tables.bare_items.select(*[F.col(c).alias(c.removeprefix(FOUND)) if c.startswith(FOUND) else F.col(c) for c in names])
    fills = [tables.numbers.get(c) for c in products.columns if c in MEDIAN_COLUMNS]
    if any(n is None or isnan(n) for n in fills):
        # A fill that is no number drops products, and their items with them.
        items = items.join(products.select("product_id"), "product_id", "left_semi")
    return items


def _refuse(df: DataFrame, types: dict[str, str]) -> None:
    """Convert every number, so that one of another type stops the job before anything is published."""
    numbers = [c for c in df.columns if types.get(c) in ("int", "double")]
    if numbers:
        df.agg(*[F.max(c) for c in numbers]).collect()


def publish_all(spark: SparkSession, tables: dict[str, DataFrame], database: str, mode: str = "overwrite") -> None:
    at_once(spark, {n: lambda n=n, df=df: publish(df, database, n, mode) for n, df in tables.items()})


def publish_star(spark: SparkSession, tables: CleanTables, database: str, mode: str = "overwrite") -> None:
    """All six tables. The fact table looks its keys up in the dimensions just built, not in older copies of them."""
    dimensions = at_once(spark, {name: lambda name=name: build_dimension(tables, name) for name in DIMENSIONS})
    publish_all(spark, dimensions | {"fact_orders": build_fact(tables, key_maps(dimensions))}, database, mode)


def extend_star(spark: SparkSession, tables: CleanTables, database: str) -> None:
    """Add a load to the star schema under lasting keys: a natural key has one key and one row, whatever loads bring it.

    The fact rows of an order that comes again replace those it has. Dimensions are published before the facts, so every
    key that a fact row has is in its dimension at any time.
    """
    dimensions = at_once(spark, {name: lambda name=name: extend_dimension(tables, database, name) for name in DIMENSIONS})
    publish_all(spark, dimensions, database)
    dimensions = {name: read_table(spark, database, name) for name in DIMENSIONS}
    fact = build_fact(tables, dimensions)
    old = read_table(spark, database, "fact_orders")
    buckets = tables.buckets if tables.lines.hot(*LINE_TABLES) is None else None
    # Facts lie by order as the staged tables do, so the next load finds those that it replaces in place.
    laid_out = bucket_number(spark, database, "fact_orders") if buckets and old is not None else None
    if old is not None:
        again = tables.lines.frame.filter("n_orders > 0").select(KEY)
        if laid_out and laid_out != buckets:
            again, fact = again.repartition(laid_out, KEY), fact.repartition(laid_out, KEY)
        fact = old.join(again, KEY, "left_anti").unionByName(fact)
    if buckets:
        publish_bucketed(fact, database, "fact_orders", KEY, laid_out or buckets, placed=True)
    else:
        publish(fact, database, "fact_orders")


def publish_aggregates(spark: SparkSession, tables: CleanTables, database: str) -> None:
    publish_all(spark, {name: build(tables) for name, build in AGGREGATES.items()}, database)


def publish_marts(spark: SparkSession, tables: CleanTables, database: str) -> None:
    publish_all(spark, {name: build(tables) for name, build in MARTS.items()}, database)


def warehouse(spark: SparkSession, tables: CleanTables) -> dict[str, DataFrame]:
    """All 16 tables of the warehouse."""
    dimensions = at_once(spark, {name: lambda name=name: build_dimension(tables, name) for name in DIMENSIONS})
    results = {name: build(tables) for name, build in (AGGREGATES | MARTS).items()}
    return dimensions | {"fact_orders": build_fact(tables, key_maps(dimensions))} | results


def land(spark: SparkSession, sources: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Each source read and converted once: what follows reads the same rows, however often, and knows their number."""
    return at_once(spark, {name: lambda df=df: materialise_table(df, folder) for name, df in sources.items()})


def typed_sources(sources: dict[str, DataFrame], types: dict[str, str]) -> dict[str, DataFrame]:
    return {name: convert_types(df, types) for name, df in sources.items()}


def refresh(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    database: str,
    types: dict[str, str] = WHOLE_NUMBERS,
    mode: str = "overwrite",
) -> None:
    """The job from the sources as they are read to every table of the warehouse, an existing database.

    ``types`` convert the sources before the merge and the cleaned columns after it, so a fill that
    is no whole number is an error in an integer column. With ``append`` the star schema is added to
    the one that is there, numbered anew; with ``extend`` it is added under lasting keys. Aggregates and
    marts are always replaced. What was landed and staged on the way is deleted.
    """
    folder = fresh_dir(spark, "landed")
    try:
        tables = stage(spark, typed_sources(sources, types), types=types, folder=folder)
        try:
            if mode == "extend":
                extend_star(spark, tables, database)
            else:
                publish_star(spark, tables, database, mode)
            publish_aggregates(spark, tables, database)
            publish_marts(spark, tables, database)
        finally:
            spark.sql(f"DROP DATABASE `{tables.staged_in}` CASCADE")
    finally:
        drop_folder(spark, folder)


def refresh_snapshot(spark: SparkSession, sources: dict[str, DataFrame], place: str, types: dict[str, str] = WHOLE_NUMBERS) -> Snapshot:
    """The job from the sources to a new version of all 16 tables, put in force in one step."""
    folder = fresh_dir(spark, "landed")
    try:
        tables = stage(spark, typed_sources(sources, types), types=types, folder=folder)
        try:
            return publish_snapshot(spark, warehouse(spark, tables), place)
        finally:
            spark.sql(f"DROP DATABASE `{tables.staged_in}` CASCADE")
    finally:
        drop_folder(spark, folder)
