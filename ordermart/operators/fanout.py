"""Joins of order tables that stay balanced when one order owns a large part of all rows.

The joins on ``order_id`` run in one stage, where adaptive execution cannot split a skewed key
(and never on the optional side of an outer join). So orders that would give one task too many
rows are looked for first. Usually there are none and the joins stay plain. Where there are, such
an order is cut into slices: its largest table is spread over them, and if that is not enough the
next ones too, which gives a grid of slices; each row is repeated only for the slices of the other
tables. All other orders have the single slice 0.
"""

from __future__ import annotations

from functools import cached_property, reduce
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.session import at_once, materialise
from ordermart.sources.catalog import materialise_table

# Joined rows of one order that a single task takes. Orders beyond it are sliced: same rows, another plan.
ROWS_PER_SLICE = 4_000_000
# Large orders that are broadcast; with more of them the slices are looked up by a shuffle join.
BROADCAST_ORDERS = 1_000_000
KEY = "order_id"
LINE_TABLES = ["payments", "reviews", "items"]
# Lookup tables by the table that meets them, and their key.
LOOKUP_OF = {
    "orders": [("customers", "customer_id")],
    "items": [("products", "product_id"), ("sellers", "seller_id")],
    "products": [("translation", "product_category_name")],
}


def copies_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """Keys that a lookup table holds more than once: (key, _copies)."""
    return lookup.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_copies")).filter("_copies > 1")


def with_copies(df: DataFrame, repeated: list[tuple[str, DataFrame]], name: str = "_rows") -> DataFrame:
    """Add the number of rows that joining the lookups makes of each row."""
    df = df.withColumn(name, F.lit(1).cast("bigint"))
    for key, copies in repeated:
        df = df.join(copies, key, "left").withColumn(name, F.col(name) * F.coalesce("_copies", F.lit(1))).drop("_copies")
    return df


class LineCounts:
    """Rows of each table per order as they stand in the merged table, counted on first use and written once.

    A lookup table that holds a key twice multiplies the rows that meet it, as the merge does. A table ``counts`` among
    the others holds the numbers of all orders that occur; no lookup repeats a key then.
    """

    def __init__(self, tables: dict[str, DataFrame], rows_per_slice: int = ROWS_PER_SLICE):
        self.sources = tables
        self.tables = {t: tables[t] for t in ["orders", *LINE_TABLES]}
        self.rows_per_slice = rows_per_slice
        self._hot: dict[tuple[str, ...], DataFrame | None] = {}

    @cached_property
    def repeated(self) -> dict[str, list[tuple[str, DataFrame]]]:
        """Per table the lookups with repeated keys: (key, (key, _copies)). Usually none."""
        if "counts" in self.sources:
            return {t: [] for t in LOOKUP_OF}
        lookups = {(t, n): (k, self.sources[n]) for t, pairs in LOOKUP_OF.items() for n, k in pairs if n in self.sources}
        spark = self.tables["orders"].sparkSession
        found = at_once(spark, {n: lambda k=k, df=df: not copies_per_key(df, k).isEmpty() for n, (k, df) in lookups.items()})
        out = {t: [(lookups[t, n][0], copies_per_key(lookups[t, n][1], lookups[t, n][0])) for t2, n in lookups if t2 == t and found[t, n]] for t in LOOKUP_OF}
        if out["products"]:
            # Copies of a product's translation count as copies of the product.
            products = with_copies(self.sources["products"].select("product_id", "product_category_name"), out["products"])
            copies = products.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.sum("_rows").alias("_copies"))
            out["items"] = [("product_id", copies.filter("_copies > 1")), *[(k, c) for k, c in out["items"] if k != "product_id"]]
        return out

    @cached_property
    def frame(self) -> DataFrame:
        """(order_id, n_orders, n_payments, n_reviews, n_items): one aggregation that reads only the keys."""
        if "counts" in self.sources:
            return self.sources["counts"]
        parts = []
        for name, df in self.tables.items():
            repeated = self.repeated.get(name, [])
            rows = with_copies(df.select(KEY, *[k for k, _ in repeated]), repeated)
            parts.append(rows.select(KEY, *[(F.col("_rows") if name == other else F.lit(0).cast("bigint")).alias(f"n_{other}") for other in self.tables]))
        sums = [F.sum(f"n_{t}").alias(f"n_{t}") for t in self.tables]
        return materialise_table(reduce(DataFrame.unionAll, parts).filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(*sums))

    @cached_property
    def largest(self) -> dict[str, int]:
        """Most lines of a single order, per table, and most rows of an order itself."""
        row = self.frame.agg(*[F.max(f"n_{t}").alias(t) for t in self.tables]).first()
        return {t: max(row[t] or 0, 1) for t in self.tables}

    def hot(self, *names: str) -> DataFrame | None:
        """Orders too large for one slice when these tables meet; None, as usual, without any."""
        if names not in self._hot:
            self._hot[names] = self._find(names)
        return self._hot[names]

    def _find(self, names: tuple[str, ...]) -> DataFrame | None:
        if len(names) == 1 and "frame" not in self.__dict__ and self.tables[names[0]].count() <= self.rows_per_slice:
            return None
        if prod(self.largest[t] for t in names) <= self.rows_per_slice:
            return None
        hot = materialise(hot_orders(self.frame, list(names), self.rows_per_slice))
        n = hot.count()
        if not n:
            return None
        return F.broadcast(hot) if n <= BROADCAST_ORDERS else hot


def largest_group(df: DataFrame, groups: int = 65_536) -> int:
    """Rows of the largest of some groups of orders, no fewer than those of any one order: the keys are not shuffled."""
    sizes = df.filter(F.col(KEY).isNotNull()).groupBy(F.pmod(F.xxhash64(KEY), F.lit(groups)).alias("_group")).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def counts_in_place(tables: dict[str, DataFrame], more: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """The counts of ``LineCounts`` for the orders that occur, from tables that are laid out by order: nothing is shuffled.

    ``more`` are further counts of the lines of a table, by name.
    """
    further = {t: [c.alias(name) for name, c in (more or {}).get(t, {}).items()] for t in LINE_TABLES}
    counts = [tables[t].groupBy(KEY).agg(F.count("*").alias(f"n_{t}"), *further.get(t, [])) for t in ("orders", *LINE_TABLES)]
    joined = reduce(lambda left, right: left.join(right, KEY, "left"), counts)
    return joined.na.fill(0, [c for c in joined.columns if c not in (KEY, "n_orders")])


def hot_orders(counts: DataFrame, names: list[str], rows_per_slice: int) -> DataFrame:
    """Orders whose joined rows exceed one slice: (order_id, _s_payments, _s_reviews, _s_items).

    The numbers say over how many slices each table is spread; their product is the size of the
    grid. The largest table goes first, and as far as its rows reach; what is still missing is
    taken from the next. Every row stands for more than ``rows_per_slice`` joined rows.
    """
    sizes = {t: F.greatest(F.col(f"n_{t}"), F.lit(1)) if t in names else F.lit(1).cast("bigint") for t in LINE_TABLES}
    joined = reduce(Column.__mul__, [sizes[t].cast("double") for t in names])
    by_size = F.sort_array(F.array(*[F.struct(sizes[t].alias("n"), F.lit(t).alias("t")) for t in LINE_TABLES]), asc=False)
    rows = counts.filter(joined > rows_per_slice).select(KEY, F.ceil(joined / rows_per_slice).alias("_want"), by_size.alias("_by"))
    for k in range(len(LINE_TABLES)):
        size = F.col("_by")[k]["n"]
        rows = rows.withColumn(f"_take{k}", F.least(F.col("_want"), size)).withColumn(
            "_want", F.greatest(F.ceil(F.col("_want") / F.least(F.col("_want"), size)), F.lit(1))
        )
    taken = {t: F.coalesce(*[F.when(F.col("_by")[k]["t"] == t, F.col(f"_take{k}")) for k in range(len(LINE_TABLES))]) for t in LINE_TABLES}
    return rows.select(KEY, *[taken[t].cast("bigint").alias(f"_s_{t}") for t in LINE_TABLES])


def slice_rows(df: DataFrame, hot: DataFrame, table: str) -> DataFrame:
    """Repeat each row for the slices it takes part in: ``_slice``, and the grid where there is one.

    Rows of large orders are numbered and written once before they are dealt, so equal rows spread
    as well as others, and a task that runs again finds the same numbers.
    """
    grid = [f"_s_{t}" for t in LINE_TABLES]
    small = df.join(hot, KEY, "left_anti").select("*", *[F.lit(None).cast("bigint").alias(g) for g in grid], F.lit(0).cast("bigint").alias("_slice"))
    # Null keys never match and stay with the small orders.
    large = materialise(df.join(hot, KEY).withColumn("_number", F.monotonically_increasing_id()))
    before, after = F.lit(1).cast("bigint"), F.lit(1).cast("bigint")
    own = F.lit(1).cast("bigint")
    if table in LINE_TABLES:
        at = LINE_TABLES.index(table)
        before = reduce(Column.__mul__, [F.col(g) for g in grid[:at]], before)
        after = reduce(Column.__mul__, [F.col(g) for g in grid[at + 1 :]], after)
        own = F.col(grid[at])
    else:
        before = reduce(Column.__mul__, [F.col(g) for g in grid], before)
    place = F.pmod("_number", own)
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), before * after - 1),
        lambda k: (F.floor(k / after) * own + place) * after + F.pmod(k, after),
    )
    dealt = large.withColumn("_slice", F.explode(cells)).drop("_number")
    return small.unionByName(dealt)


def fan_out(center: DataFrame, tables: dict[str, DataFrame], hot: DataFrame | None, how: str = "left") -> DataFrame:
    """Join the line tables to their orders: one row per order x payment x review x item."""
    if hot is None:
        return reduce(lambda left, right: left.join(right, KEY, how), tables.values(), center)
    grid = [f"_s_{t}" for t in LINE_TABLES]
    out = slice_rows(center, hot, "")
    for name, df in tables.items():
        lines = slice_rows(df, hot, name).drop(*grid).withColumn(f"_{name}", F.lit(1))
        out = out.join(lines, [KEY, "_slice"], how)
    if how == "left":
        # A spread table always has rows for its order; an empty slice of it is no result row.
        for name in tables:
            out = out.filter(~F.coalesce((F.col(f"_s_{name}") > 1) & F.col(f"_{name}").isNull(), F.lit(False)))
    columns = center.columns + [c for df in tables.values() for c in df.columns if c != KEY]
    return out.select(*columns)


def join_order_rows(lines: DataFrame, orders: DataFrame, table: str, hot: DataFrame | None) -> DataFrame:
    """Inner join of one line table with per-order rows; ``hot`` is found for that table alone."""
    if hot is None:
        return lines.join(orders, KEY)
    grid = [f"_s_{t}" for t in LINE_TABLES]
    left = slice_rows(lines, hot, table).drop(*grid)
    right = slice_rows(orders, hot, "").drop(*grid)
    return left.join(right, [KEY, "_slice"]).drop("_slice")
