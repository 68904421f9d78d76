"""Column expressions that turn staging text into typed values.

Two families. *Guarded* ones (snowflake profile) accept a value only when the whole text has
the expected shape; *loose* ones (star profile) parse whatever a lenient cast would. Both give
NULL for anything else, so they are safe under ANSI mode. With ``strict=True`` a guarded value
that has the right shape but does not fit its type raises instead.

All of them are built-in expressions: they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. `\z` and not `$`: in Java `$` also matches before a trailing newline.
DIGITS = r"^[0-9]+\z"
PLAIN_DECIMAL = r"^[0-9]+([.][0-9]+)?\z"
US_DATE = "M/d/yyyy"  # takes 3/5/2021 as well as 03/05/2021

# A number whose fraction a lenient text-to-int cast cuts off; blanks around are trimmed.
FRACTION = r"^[\s\p{Cntrl}]*([+-]?)([0-9]*)[.][0-9]*[\s\p{Cntrl}]*\z"


def or_empty(column: Column) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(column, F.lit(""))


def not_blank(column: Column) -> Column:
    """True for text that is neither NULL nor empty."""
    return column.isNotNull() & (column != "")


def unusable(parsed: Column, source: str) -> Column:
    """Text was given in the column ``source`` but no value came out of it."""
    return not_blank(F.col(source)) & parsed.isNull()


def broken_rules(rules: dict[str, Column]) -> Column:
    """The names of the rules that hold, as an array. Flattened and not compacted: a function with a
    lambda is interpreted, and with it every rule in it and the projection around it."""
    none = F.array_repeat(F.lit(""), 0)
    found = [F.when(rule, F.array(F.lit(name))).otherwise(none) for name, rule in rules.items()]
    return F.flatten(F.array(*found)) if found else none


def _cast(column: Column, sql_type: str, strict: bool) -> Column:
    return column.cast(sql_type) if strict else column.try_cast(sql_type)


def guarded_int(column: Column, strict: bool = False) -> Column:
    """Unsigned digits only; sign, blanks or a fraction give NULL."""
    return F.when(column.rlike(DIGITS), _cast(column, "int", strict))


def guarded_decimal(column: Column, precision: int, scale: int, strict: bool = False) -> Column:
    """Unsigned plain decimal notation only, rounded half up to ``scale``."""
    fits = column.rlike(PLAIN_DECIMAL)
    return F.when(fits, _cast(column, f"decimal({precision},{scale})", strict))


def us_date(column: Column, strict: bool = False) -> Column:
    """Month/day/year text to a date; empty text is NULL in both modes."""
    # The formatter raises and catches on text that is no date, which is slow: empty text is spared it.
    parse = F.to_date if strict else F.try_to_date
    return F.when(not_blank(column), parse(column, US_DATE))


def loose_int(column: Column) -> Column:
    """Lenient text-to-int: trims, keeps the sign, cuts a fraction off, NULL on overflow."""
    # `try_cast` takes all but the fraction, so the pattern is tried on few values only.
    sign, whole = (F.regexp_extract(column, FRACTION, group) for group in (1, 2))
    cut = F.when(column.rlike(FRACTION), F.concat(sign, F.lit("0"), whole).try_cast("int"))
    return F.coalesce(column.try_cast("int"), cut)


def loose_double(column: Column) -> Column:
    """Lenient text-to-double: exponents and signs are fine, garbage is NULL."""
    return column.try_cast("double")


def money(column: Column) -> Column:
    """Signed amount, exact to eight decimals. A decimal, so that sums do not depend on the order
    of rows."""
    return column.try_cast("decimal(28,8)")
