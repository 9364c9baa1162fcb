"""Type conversion by column name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.casts import CASTS, parsed
from ordermart.schemas import COLUMN_TYPES


def convert_types(df: DataFrame, types: dict[str, str] = COLUMN_TYPES) -> DataFrame:
    """Cast the columns named in ``types`` by their rule; leave the others as they are, and those that have their type."""
    kinds = dict(df.dtypes)
    todo = {c for c in df.columns if c in types and (kinds[c] != types[c] or types[c] == "double")}
    if not todo:
        return df
    return df.select(*[_converted(c, kinds[c], types[c]).alias(c) if c in todo else F.col(c) for c in df.columns])


def _converted(c: str, kind: str, wanted: str) -> Column:
    """A number that is one already only loses its NaN, without the cast and its check."""
    return F.when(~F.isnan(c), F.col(c)) if kind == wanted == "double" else CASTS[wanted](F.col(c))


def parse_types(df: DataFrame, types: dict[str, str] = COLUMN_TYPES) -> DataFrame:
    """The same casts for rows that a join multiplies or drops afterwards: each text is parsed once.

    A text that is an error is kept as ``_bad_<column>``, for ``refuse_unparsed`` to raise it where the row is used.
    """
    columns = []
    for c in df.columns:
        value, bad = parsed(F.col(c), types[c]) if c in types else (F.col(c), None)
        columns += [value.alias(c)] if bad is None else [value.alias(c), bad.alias(f"_bad_{c}")]
    return df.select(*columns)


def refuse_unparsed(df: DataFrame) -> DataFrame:
    """Columns after ``parse_types``; a text that could not be parsed is an error."""

    def value(c: str) -> Column:
        bad = F.col(f"_bad_{c}")
        if f"_bad_{c}" not in df.columns:
            return F.col(c)
        return F.when(bad.isNull(), F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"{c}, not a number of its type: "), bad)).cast(kinds[c])).alias(c)

    kinds = dict(df.dtypes)
    return df.select(*[value(c) for c in df.columns if not c.startswith("_bad_")])
