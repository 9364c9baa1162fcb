"""Exact means and medians of columns, as plain numbers.

A median takes two passes. The first builds quantile sketches, which bracket the middle; the second
counts the values inside the bracket one by one and all others as two lumps, below and above. Only
sketches and the values of the bracket are shuffled, never a whole column. A bracket with too many
rows to sort, or one that missed the middle, is split by further passes, so the median is exact
whatever the sketch says. Values that are already counted need no sketch: a log scale histogram does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.functions.casts import SCORE_SCALE, weighted
from ordermart.operators.fanout import KEY, LINE_TABLES, LineCounts, join_order_rows, with_copies
from ordermart.schemas import MEAN_COLUMNS, MEDIAN_COLUMNS, SOURCE_COLUMNS
from ordermart.session import at_once, materialise

# Log scale bins are about 0.1 % wide: all doubles fall into 1.5 million of them, and an outlier does
# not push the other values into the same bin.
LOG_BINS_PER_UNIT = 1024
# Even bins of every further pass, and the rows of a bin that are sorted instead of split once more. Both shape the
# plan only: the median is exact with any values.
BINS = 4096
SORT_ROWS = 10_000_000

# Size of a quantile sketch (a rank is off by about a thousandth of the rows), the quantiles read from it, and the share of
# the rows that a bracket reaches to either side of the middle. These shape the plan only, too.
SKETCH_K = 4096
GRID = 1024
REACH = 0.004

# Lowest and highest value still in question per column; None stands for all values.
Ranges = dict[str, tuple[float, float]] | None


def long_values(df: DataFrame, columns: list[str], weight: str | None = None, *keep: str) -> DataFrame:
    """(name, value, weight) for each value of the columns, missing ones left out, with columns to keep."""
    rows = df.select(
        *keep,
        *[F.col(c).cast("double").alias(c) for c in columns],
        (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("weight"),
    )
    return rows.unpivot([*keep, "weight"], columns, "name", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))


def keep_long(long: DataFrame, ranges: Ranges) -> DataFrame:
    """Long values in the range of their own column."""
    if ranges is None:
        return long
    return long.filter(
        reduce(Column.__or__, [(F.col("name") == c) & F.col("value").between(*r) for c, r in ranges.items()])
    )


@dataclass
class Bracket:
    """Values that enclose the middle of a column, as far as a sketch can tell, and about how many rows lie between them."""

    low: float
    high: float
    rows: float

    def bin_of(self) -> Column:
        """The value itself inside the bracket, or an even bin where it holds too many rows; one bin below, one above."""
        value = F.col("value")
        inside = value
        if self.rows > SORT_ROWS and np.isfinite(self.high - self.low) and self.low < self.high:
            inside = F.floor((value - self.low) / (self.high - self.low) * BINS).cast("double")
        return F.when(value < self.low, float("-inf")).when(value > self.high, float("inf")).otherwise(inside)


def brackets(rows: DataFrame, columns: list[str], weight: str) -> dict[str, Bracket]:
    """Brackets of the columns over rows that each count ``weight`` times (1 or more), in one pass.

    A sketch takes no weights, so there is one per binary digit of the weight: a row of weight 5 goes to the
    sketches of 1 and of 4, whose ranks count once and four times. That is at most 63 sketches per column, each
    of bounded size; the driver receives ``GRID`` quantiles of each. A column without any value is absent.
    """
    digits = F.expr(f"filter(sequence(0, length(bin(`{weight}`)) - 1), d -> getbit(`{weight}`, d) = 1)")
    values = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    by_digit = rows.withColumn("_digit", F.explode(digits)).groupBy("_digit")
    sketched = by_digit.agg(
        *[F.count(v).alias(f"n_{i}") for i, v in enumerate(values.values())],
        *[F.kll_sketch_agg_double(v, SKETCH_K).alias(f"s_{i}") for i, v in enumerate(values.values())],
    )
    # As SQL text: one call to the JVM, not one per number.
    steps = F.expr(f"array({', '.join(f'{(g + 0.5) / GRID!r}D' for g in range(GRID))})")
    read = [F.when(F.col(f"n_{i}") > 0, F.kll_sketch_get_quantile_double(f"s_{i}", steps)).alias(f"q_{i}") for i in range(len(columns))]
    found = sketched.select("_digit", *[f"n_{i}" for i in range(len(columns))], *read).collect()
    out = {}
    for i, c in enumerate(columns):
        parts = [(r[f"n_{i}"] * 2.0 ** r["_digit"], r[f"q_{i}"]) for r in found if r[f"n_{i}"]]
        if parts:
            out[c] = _bracket(parts)
    return out


def _bracket(parts: list[tuple[float, list[float]]]) -> Bracket:
    """From evenly spaced quantiles of each part and the rows the part stands for."""
    points = np.concatenate([q for _, q in parts])
    mass = np.concatenate([np.full(len(q), n / len(q)) for n, q in parts])
    order = np.argsort(points, kind="stable")
    points, upto = points[order], np.cumsum(mass[order])
    total = upto[-1]
    # A quantile stands for its whole step, so the bracket also gives away a step at each end.
    reach = total * (REACH + 1 / GRID) + 1
    first, last = np.searchsorted(upto, [total / 2 - reach, total / 2 + reach])
    low = points[first - 1] if first > 0 else -np.inf
    high = points[last + 1] if last + 1 < len(points) else np.inf
    between = upto[min(last + 1, len(points) - 1)] - (upto[first - 1] if first > 0 else 0)
    return Bracket(float(low), float(high), float(between))


def medians(
    columns: list[str], values: Callable[[list[str], Ranges], DataFrame], bracketed: dict[str, Bracket] | None = None
) -> dict[str, float]:
    """Interpolating medians; ``values(columns, ranges)`` gives the long values to count, ``bracketed`` where to look first.

    The driver receives two rows per column and pass at most. A column without any value is absent.
    """
    found: dict[str, float] = {}
    todo, ranges, ranks = list(columns), None, None
    size = F.signum("value") * F.log1p(F.abs("value") * 1000)
    bin_of = F.floor(size * LOG_BINS_PER_UNIT)
    for c, b in (bracketed or {}).items():
        bin_of = F.when(F.col("name") == c, b.bin_of()).otherwise(bin_of)
    bin_of = bin_of.cast("double")
    while todo:
        rows = _middle_bins(values(todo, ranges), bin_of, ranks).collect()
        by_name = {c: sorted((r for r in rows if r["name"] == c), key=lambda r: r["bin"]) for c in todo}
        found |= {c: b[0]["low"] * 0.5 + b[-1]["low"] * 0.5 for c, b in by_name.items() if b and _single(b)}
        left = {c: b for c, b in by_name.items() if b and not _single(b)}
        todo = list(left)
        ranges = {c: (b[0]["low"], b[-1]["high"]) for c, b in left.items()}
        ranks = {c: (b[0]["first"] - b[0]["before"], b[0]["last"] - b[0]["before"]) for c, b in left.items()}
        bin_of = F.col("value")
        for c, b in left.items():
            if sum(r["n"] for r in b) > SORT_ROWS:
                low, high = ranges[c]
                bin_of = F.when(F.col("name") == c, F.floor((F.col("value") - low) / (high - low) * BINS)).otherwise(bin_of)
        bin_of = bin_of.cast("double")
    return found


def _single(bins: list) -> bool:
    return all(b["low"] == b["high"] for b in bins)


def _middle_bins(long: DataFrame, bin_of: Column, ranks: dict[str, tuple[int, int]] | None) -> DataFrame:
    """The one or two bins per name that hold the middle; ``ranks`` are its two positions, if known."""
    name = Window.partitionBy("name")
    upto = F.sum("n").over(name.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    if ranks is None:
        total = F.sum("n").over(name)
        first, last = F.floor((total - 1) / 2) + 1, F.floor(total / 2) + 1
    else:
        position = lambda i: F.coalesce(*[F.when(F.col("name") == c, F.lit(r[i])) for c, r in ranks.items()])
        first, last = position(0), position(1)
    return (
        long.groupBy("name", bin_of.alias("bin"))
        .agg(F.sum("weight").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumns({"upto": upto, "first": first, "last": last})
        .filter((F.col("upto") >= F.col("first")) & (F.col("upto") - F.col("n") < F.col("last")))
        .withColumn("before", F.col("upto") - F.col("n"))
    )


def mean(rows: DataFrame, c: str, weight: str | None = None) -> dict[str, float]:
    """Mean of one column, added up in decimals; absent without any value."""
    value = F.col(c).cast("double")
    weight_of = F.col(weight) if weight else F.lit(1)
    present = rows.filter(value.isNotNull() & ~F.isnan(value)).select(value.alias("value"), weight_of.alias("weight"))
    counted = present.groupBy("value").agg(F.sum("weight").alias("n"))
    total = F.sum(weighted(F.col("value").alias(c), F.col("n"), SCORE_SCALE)).cast("double")
    found = counted.agg((total / F.sum("n")).alias("mean")).first()["mean"]
    return {} if found is None else {c: found}


def counted_values(long: DataFrame) -> DataFrame:
    """Distinct values of each column with their summed weight, written once: all passes read these."""
    return materialise(long.groupBy("name", "value").agg(F.sum("weight").alias("weight")))


def wide_statistics(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Mean or median of each column over the rows of ``df``, which are computed once."""
    if not columns:
        return {}
    values = counted_values(long_values(df, columns))
    return numbers_of(values, columns)


def numbers_of(values: DataFrame, columns: list[str]) -> dict[str, float]:
    of_medians = [c for c in columns if c in MEDIAN_COLUMNS]
    numbers = medians(of_medians, lambda cs, ranges: keep_long(values.filter(F.col("name").isin(cs)), ranges))
    for c in columns:
        if c in MEAN_COLUMNS:
            numbers |= mean(values.filter(F.col("name") == c).select(F.col("value").alias(c), "weight"), c, "weight")
    return numbers


def weighted_lines(sources: dict[str, DataFrame], table: str, columns: list[str], lines: LineCounts) -> DataFrame:
    """Columns of a line table with their order and ``weight``, the number of merged rows a line appears in."""
    by_lookup = lines.repeated.get(table, [])
    a, b = [F.greatest(F.col(f"n_{t}"), F.lit(1)) for t in LINE_TABLES if t != table]
    weights = lines.frame.filter("n_orders > 0").select(KEY, (F.col("n_orders") * a * b).alias("weight"))
    rows = sources[table].select(KEY, *columns, *[k for k, _ in by_lookup])
    rows = join_order_rows(rows, weights, table, lines.hot(table))
    if by_lookup:
        rows = with_copies(rows, by_lookup).withColumn("weight", F.col("weight") * F.col("_rows"))
    return rows


def merged_statistics(
    sources: dict[str, DataFrame], columns: list[str], lines: LineCounts | None = None
) -> dict[str, float]:
    """The same numbers over the merged table, without building it.

    A payment appears in the merged table once per review and item of its order, and likewise for
    reviews and items; a lookup row that repeats its key multiplies once more. So each value is
    taken once from its own table with that count as weight. ``lines`` are the counts of the
    sources, if there are some already.
    """
    if not columns:
        return {}
    lines = lines or LineCounts(sources)
    orders = lines.frame.filter("n_orders > 0")
    repeated = lines.repeated

    parts: dict[str, tuple[DataFrame, list[str]]] = {}
    for table in LINE_TABLES:
        of_table = [c for c in columns if c in SOURCE_COLUMNS[table]]
        if of_table:
            parts[table] = weighted_lines(sources, table, of_table, lines), of_table
    of_products = [c for c in columns if c in SOURCE_COLUMNS["products"]]
    if of_products:
        # Lines per order and product first, so that one order with very many lines is a few rows; then weights per
        # product. The join with products repeats rows as the merge does; sellers are counted.
        sellers = [(k, c) for k, c in repeated["items"] if k == "seller_id"]
        items = with_copies(sources["items"].select(KEY, "product_id", *[k for k, _ in sellers]), sellers)
        # Where lines lie by order already, none has so many, and their rows meet the weights as they are.
        grouped = items if "counts" in sources else items.groupBy(KEY, "product_id").agg(F.sum("_rows").alias("_rows"))
        a, b = [F.greatest(F.col(f"n_{t}"), F.lit(1)) for t in LINE_TABLES if t != "items"]
        weights = orders.select(KEY, (F.col("n_orders") * a * b).alias("weight"))
        per_product = grouped.join(weights, KEY).groupBy("product_id").agg(F.sum(F.col("_rows") * F.col("weight")).alias("weight"))
        products = with_copies(sources["products"].select("product_id", "product_category_name", *of_products), repeated["products"])
        # Weights lie by product already. Products are as many, and the bytes of their files are no measure for a broadcast.
        joined = per_product.join(products.hint("merge"), "product_id").withColumn("weight", F.col("weight") * F.col("_rows"))
        parts["products"] = joined, of_products
    return weighted_numbers(sources["orders"].sparkSession, list(parts.values()))


def weighted_numbers(spark: SparkSession, parts: list[tuple[DataFrame, list[str]]]) -> dict[str, float]:
    """Mean or median of the columns of each part, whose rows have a ``weight``.

    The rows are written once, narrow and as they are; the sketches and the exact pass scan that.
    """

    def written(df: DataFrame, columns: list[str]) -> DataFrame:
        numbers = [F.col(c).cast("double").alias(c) for c in columns]
        return materialise(df.select(*numbers, F.col("weight").cast("bigint").alias("weight")).filter("weight > 0"))

    def apart(task: Callable, kinds: list[str]) -> list:
        """The task over each part that has columns of the kind, side by side."""
        own = [(df, [c for c in columns if c in kinds]) for df, columns in stored]
        return list(at_once(spark, {str(i): lambda p=p: task(*p) for i, p in enumerate(own) if p[1]}).values())

    stored = [
        (df, columns)
        for df, (_, columns) in zip(
            at_once(spark, {str(i): lambda p=p: written(*p) for i, p in enumerate(parts)}).values(), parts, strict=True
        )
    ]

    def medians_of(df: DataFrame, columns: list[str]) -> dict[str, float]:
        narrow = brackets(df, columns, "weight")
        return medians(list(narrow), lambda cs, ranges: keep_long(long_values(df, cs, "weight"), ranges), narrow)

    def means_of(df: DataFrame, columns: list[str]) -> dict[str, float]:
        return reduce(dict.__or__, [mean(df, c, "weight") for c in columns])

    return reduce(dict.__or__, [*apart(medians_of, MEDIAN_COLUMNS), *apart(means_of, MEAN_COLUMNS)], {})
