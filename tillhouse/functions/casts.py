"""Text to typed values. A value that does not parse becomes NULL and never fails the job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money(c: Column) -> Column:
    """DECIMAL(18,2), rounding halves away from zero."""
    return c.try_cast("decimal(18,2)")


def to_number(c: Column) -> Column:
    """A number with ten decimals; what is larger than 28 digits becomes NULL."""
    return c.try_cast("decimal(38,10)")


def to_whole(c: Column) -> Column:
    """A whole number; fractions round half away from zero."""
    return c.try_cast("decimal(38,0)").try_cast("bigint")


def to_timestamp(c: Column) -> Column:
    """A timestamp without zone, from second or microsecond text."""
    return c.try_cast("timestamp_ntz")


def to_boolean(c: Column) -> Column:
    """true/t/yes/y/1/on and their opposites, any case."""
    word = F.lower(F.trim(c))
    return (
        F.when(word == "on", F.lit(True)).when(word == "off", F.lit(False))
        .otherwise(c.try_cast("boolean"))
    )


def moment(value: datetime | str) -> Column:
    """A literal point in time; every run passes its own instead of asking a clock."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    """20250115 for 15 January 2025."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def iso_text(c: Column) -> Column:
    """`2025-01-15 10:20:30`."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
