"""Left joins of the eight source tables into one wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.operators.fanout import LINE_TABLES, ROWS_PER_SLICE, LineCounts, fan_out
from ordermart.schemas import MERGED_COLUMNS

# Key of each lookup table.
LOOKUPS = {
    "customers": "customer_id",
    "products": "product_id",
    "translation": "product_category_name",
    "sellers": "seller_id",
}


def left_join(left: DataFrame, right: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Left join on one column; with ``null_safe`` a null key matches a null key."""
    if not null_safe:
        return left.join(right, key, "left")
    other = right.withColumnRenamed(key, f"_{key}")
    return left.join(other, F.col(key).eqNullSafe(F.col(f"_{key}")), "left").drop(f"_{key}")


# Order in which the tables meet, with their keys.
STEPS = [("customers", "customer_id"), *[(t, "order_id") for t in LINE_TABLES], *[(t, LOOKUPS[t]) for t in ("products", "translation", "sellers")]]


def distinct_names(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources with names that no two tables share but for the keys.

    Undeclared columns take part in the merge. Where a table brings a name that is there already,
    the earlier one gets ``_x`` and the later one ``_y``, step by step in merge order.
    """
    owners = {c: ("orders", c) for c in sources["orders"].columns}
    names = {t: {c: c for c in df.columns} for t, df in sources.items()}
    for table, key in STEPS:
        for c in sources[table].columns if table in sources else []:
            if c == key:
                continue
            if c in owners:
                owner, original = owners.pop(c)
                names[owner][original] = f"{c}_x"
                owners[f"{c}_x"] = (owner, original)
                names[table][c] = f"{c}_y"
            owners[names[table][c]] = (table, c)
    return {t: df.withColumnsRenamed({c: n for c, n in names[t].items() if c != n}) for t, df in sources.items()}


def extra_columns(sources: dict[str, DataFrame]) -> list[str]:
    """Undeclared columns in merge order."""
    every = [c for t in ("orders", *[t for t, _ in STEPS]) for c in sources[t].columns]
    return list(dict.fromkeys(c for c in every if c not in MERGED_COLUMNS))


def order_rows(sources: dict[str, DataFrame]) -> DataFrame:
    """Orders with their customer; without a table of customers they have theirs already."""
    if "customers" not in sources:
        return sources["orders"]
    return left_join(sources["orders"], sources["customers"], LOOKUPS["customers"])


def item_rows(sources: dict[str, DataFrame]) -> DataFrame:
    """Items with product, translated category and seller, joined before the rows multiply."""
    # Categories are translated per product, not per item.
    products = left_join(sources["products"], sources["translation"], LOOKUPS["translation"])
    return left_join(left_join(sources["items"], products, LOOKUPS["products"]), sources["sellers"], LOOKUPS["sellers"])


def merge_wide(
    sources: dict[str, DataFrame],
    null_safe: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    lines: LineCounts | None = None,
) -> DataFrame:
    """Order x payment x review x item rows with all lookups, unmatched sides null.

    All columns stay: the declared ones first, then the others. ``null_safe`` lets null keys match
    null keys; it joins table after table, because an order without items then has a null product
    that may match. ``lines`` are the counts of the sources, if there are some already.
    """
    sources = distinct_names(sources)
    declared = [c for c in MERGED_COLUMNS if any(c in df.columns for df in sources.values())]
    columns = declared + extra_columns(sources)
    if null_safe:
        out = sources["orders"]
        for name, key in STEPS:
            out = left_join(out, sources[name], key, null_safe=True)
        return out.select(*columns)
    tables = {"payments": sources["payments"], "reviews": sources["reviews"], "items": item_rows(sources)}
    hot = (lines or LineCounts(sources, rows_per_slice)).hot(*LINE_TABLES)
    return fan_out(order_rows(sources), tables, hot).select(*columns)
