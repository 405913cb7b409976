"""Row tests used by the quarantine rules, the profiling report and the raw queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.schema import ORPHAN


def missing(name: str) -> Column:
    return F.col(name).isNull()


def blank(name: str) -> Column:
    """NULL, empty or only spaces."""
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def is_orphan(name: str) -> Column:
    """The sentinel of a lost parent; NULL for a NULL key."""
    return F.col(name) == ORPHAN


def not_orphan(name: str) -> Column:
    """Also drops NULL keys when used as a filter."""
    return F.col(name) != ORPHAN


def no_digit(name: str) -> Column:
    """A value is present and holds no digit at all."""
    return F.col(name).isNotNull() & ~F.col(name).rlike("[0-9]")


def not_money(name: str) -> Column:
    """Does not parse as an amount; a NULL counts as not parsing."""
    return casts.to_money(F.col(name)).isNull()


def type_mismatch(name: str, data_type: str = "decimal(18,2)") -> Column:
    """A value is present but does not parse as `data_type`."""
    return F.col(name).isNotNull() & F.col(name).try_cast(data_type).isNull()


def negative_money(name: str) -> Column:
    return casts.to_money(F.col(name)) < 0


def negative(name: str) -> Column:
    """Below zero by any amount and of any size, which a decimal would round or not hold."""
    return F.col(name).try_cast("double") < 0


def not_a_date(name: str) -> Column:
    return casts.to_timestamp(F.col(name)).isNull()


def future(name: str, as_of: Column) -> Column:
    return casts.to_timestamp(F.col(name)) > as_of
