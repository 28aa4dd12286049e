"""Scalar expressions of the listing fact, and the rounding used everywhere.

Wide aggregations are built from SQL text: hundreds of Column calls from Python
take longer than planning the query.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def as_date(value: date | str | Column) -> Column:
    """A date literal from a date or ISO string; a Column is passed through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def days_on_lot(first: Column, last: Column) -> Column:
    """Days a car was listed, counting both ends."""
    return F.datediff(last, first) + 1


def miles_per_year(mileage: Column, model_year: Column, as_of: date | str | Column) -> Column:
    """Whole miles per year of age.

    A car of the current or a coming model year keeps its mileage. A model year
    that is not a number gives NULL, and so does an empty one.
    """
    miles = F.round(mileage).cast("int")
    built = F.trim(model_year).try_cast("int")
    this_year = F.year(as_date(as_of))
    age = (this_year - built).cast("decimal(10,2)")
    return (
        F.when(~model_year.rlike("^[0-9]*$"), None)
        .when(built >= this_year, miles.cast("decimal(10,2)"))
        .otherwise((miles.cast("decimal(10,0)") / age).cast("decimal(10,2)"))
    )


def seen_since(last_seen: Column, as_of: date | str, days: int) -> Column:
    """True when the car was last seen less than `days` days before `as_of`, up to `as_of`."""
    return (last_seen > F.date_sub(as_date(as_of), days)) & (last_seen <= as_date(as_of))


def snapshot_flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def pair_key(left: Column, right: Column) -> Column:
    """Two ids joined with `*`; NULL when either is NULL."""
    return F.concat(left.cast("string"), F.lit("*"), right.cast("string"))


def ymm_label(model_year: Column, make_id: Column, model_id: Column) -> Column:
    """Year, make and model ids written together as one number.

    Different triples can give the same label, so group by the three columns
    and keep this for display. A non-numeric year gives NULL.
    """
    text = F.concat(model_year, make_id.cast("string"), model_id.cast("string"))
    return text.try_cast("bigint")


def named(expressions: Mapping[str, str]) -> list[Column]:
    """Columns from SQL text, by name."""
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def hundredths(value: str) -> str:
    """SQL text: a measure with two decimals as a whole number of hundredths."""
    return f"bigint(cast({value} as {MONEY}) * 100)"


def total(x: str, copies: str) -> str:
    """SQL text: sum of hundredths over copies.

    Whole numbers add up alike in every order. A group beyond 9.2e16 units would
    leave the range of bigint; Spark's ANSI mode, the default, then raises.
    """
    return f"sum({x} * {copies})"


def mean_of(hundredths: str, count: str) -> str:
    """SQL text: mean from a sum of hundredths; NULL for an empty group."""
    return f"({hundredths} / 100D / nullif({count}, 0))"


def whole(value: str) -> str:
    """SQL text: rounded half up to a whole number."""
    return f"bigint(round({value}))"


def share(part: str, total: str) -> str:
    """SQL text: ratio of two counts to six digits."""
    return f"round(double({part}) / {total}, 6)"
