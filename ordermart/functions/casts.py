"""Column casts with the lenient and strict rules of the type conversion step."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1

# Decimal places of amounts: any double from a thousandth up, with the noise of earlier float arithmetic or of 32-bit
# storage, is held digit for digit. A value with more of them is an error, never cut.
MONEY_SCALE = 19
# Places of the greater part of an amount when it is multiplied; see ``weighted_money``.
COARSE_SCALE = 4
# Hundredths up to which amounts are added as integers: eight billion rows of a group cannot overflow a long.
UNITS_LIMIT = 2**30
# Places that hold any double between 1 and 10 exactly as it is written: scores, given or filled with a mean.
SCORE_SCALE = 16
# Places for means of amounts: exact for doubles from a thousandth up.
MEAN_SCALE = 20


def lenient_timestamp(c: Column) -> Column:
    """Text that is no timestamp becomes null."""
    return c.try_cast("timestamp_ntz")


def lenient_int(c: Column) -> Column:
    """Text that is no number becomes null; a number that is no 32-bit integer is an error."""
    number = c.try_cast("double")
    number = F.when(~F.isnan(number), number)
    fits = (number % 1 == 0) & number.between(INT_MIN, INT_MAX)
    problem = F.concat(F.lit("not a 32-bit integer: "), c.cast("string"))
    return F.when(number.isNull() | fits, number.cast("int")).otherwise(F.raise_error(problem).cast("int"))


def strict_double(c: Column) -> Column:
    """Text that is no number is an error, with ANSI mode on or off; NaN becomes null."""
    number = c.try_cast("double")
    problem = F.concat(F.lit("not a number: "), c.cast("string"))
    bad = c.isNotNull() & number.isNull()
    return F.when(bad, F.raise_error(problem).cast("double")).when(~F.isnan(number), number)


CASTS = {
    "string": lambda c: c.cast("string"),
    "timestamp_ntz": lenient_timestamp,
    "int": lenient_int,
    "double": strict_double,
}


def parsed(c: Column, kind: str) -> tuple[Column, Column | None]:
    """The value of a cast, and the text that makes the cast an error; null where there is none, None if it never is."""
    number = c.try_cast("double")
    number = F.when(~F.isnan(number), number)
    if kind == "int":
        fits = (number % 1 == 0) & number.between(INT_MIN, INT_MAX)
        return F.when(fits, number.cast("int")), F.when(number.isNotNull() & ~fits, c.cast("string"))
    if kind == "double":
        return number, F.when(c.isNotNull() & c.try_cast("double").isNull(), c.cast("string"))
    return CASTS[kind](c), None


def exact(c: Column, digits: int, scale: int) -> Column:
    """The column as decimal, digit for digit; a value that does not fit is an error that names the column."""
    number = c.try_cast(f"decimal({digits},{scale})")
    name = str(c).removeprefix("Column<'").removesuffix("'>")
    problem = F.concat(F.lit(f"{name}: not a number of {digits - scale} digits and {scale} decimal places: "), c.cast("string"))
    fits = c.isNull() | F.coalesce(number.cast("double") == c.cast("double"), F.lit(False))
    return F.when(fits, number).otherwise(F.raise_error(problem).cast(f"decimal({digits},{scale})"))


def hundredths(c: Column) -> Column:
    """A double of at most two decimal places as a whole number of hundredths; null for all others, also for other types.

    A double that equals k / 100 is written with two places, so k hundredths are its value digit for digit.
    """
    number = c.cast("double")
    units = F.rint(number * 100)
    fits = (F.typeof(c) == "double") & (F.abs(units) <= UNITS_LIMIT) & (units / 100 == number)
    return F.when(fits, units.cast("bigint"))


def _total(units: Column, others: Column, n_others: Column, scale: int) -> Column:
    """Sum of hundredths, which are added as integers, and the sum of the other amounts; null without any.

    A sum that no long holds is an error, with ANSI mode on or off.
    """
    kind, total, n = f"decimal(37,{scale})", F.try_sum(units), F.count(units)
    too_large = F.raise_error(F.lit("a total of amounts is too large")).cast("bigint")
    whole = (F.when((n > 0) & total.isNull(), too_large).otherwise(total) * F.lit(Decimal("0.01"))).cast(kind)
    return F.when(n == 0, others).when(n_others == 0, whole).otherwise(whole + others.cast(kind))


def exact_sum(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Sum in decimal arithmetic, so the result does not depend on the order of the rows.

    Amounts of whole hundredths are added as integers, the others as decimals.
    """
    units = hundredths(c)
    other = units.isNull()
    return _total(units, F.sum(F.when(other, exact(c, 38, scale))), F.count_if(other & c.isNotNull()), scale)


def weighted(c: Column, weight: Column, scale: int) -> Column:
    """A value times a row count. 22 and 15 digits give a product of 38, so no digit is rounded away."""
    return exact(c, 22, scale) * weight.cast("decimal(15,0)")


def money_parts(c: Column, weight: Column) -> tuple[Column, Column]:
    """An amount times a row count as two products, of its first four places and of the rest: both have room for every digit."""
    amount, rows = exact(c, 37, MONEY_SCALE), weight.cast("decimal(15,0)")
    coarse = amount.cast(f"decimal(22,{COARSE_SCALE})")
    fine = (amount - coarse).cast(f"decimal({MONEY_SCALE + 1},{MONEY_SCALE})")
    return coarse * rows, fine * rows


def joined_parts(coarse: Column, fine: Column) -> Column:
    """37 digits each, so that the sum keeps all its places; a total of 10^18 or more is an error."""
    kind = f"decimal(37,{MONEY_SCALE})"
    return coarse.cast(kind) + fine.cast(kind)


def weighted_money(c: Column, weight: Column) -> Column:
    """An amount times a row count, exact."""
    return joined_parts(*money_parts(c, weight))


def weighted_money_sum(c: Column, weight: Column) -> Column:
    """Sum of amounts, each times a row count, exact in any order of the rows; null without any amount."""
    rows = weight.cast("bigint")
    units = F.when(rows.between(0, UNITS_LIMIT), hundredths(c) * rows)
    units = F.when(F.abs(units) <= UNITS_LIMIT, units)
    other = units.isNull()
    coarse, fine = money_parts(c, weight)
    others = joined_parts(F.sum(F.when(other, coarse)), F.sum(F.when(other, fine)))
    return _total(units, others, F.count_if(other & c.isNotNull() & weight.isNotNull()), MONEY_SCALE)


def as_double(c: Column) -> Column:
    return c.cast("double")
