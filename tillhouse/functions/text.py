"""Labels for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(year: Column, month: Column) -> Column:
    """`2025-01`."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def inr_label(amount: Column, decimals: int = 1, gap: str = " ") -> Column:
    """Indian money text: crores from ten million, lakhs from a hundred thousand, else plain."""
    value = amount.cast("double")
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value >= 1e7, F.concat(F.lit("₹"), F.format_number(value / 1e7, decimals), F.lit(f"{gap}Cr")))
        .when(value >= 1e5, F.concat(F.lit("₹"), F.format_number(value / 1e5, decimals), F.lit(f"{gap}L")))
        .otherwise(F.concat(F.lit("₹"), F.format_number(value, 0)))
    )


def bin_label(start: Column, end: Column) -> Column:
    """`0–250`, both ends rounded half to even."""
    whole = [F.rint(edge).cast("bigint").cast("string") for edge in (start, end)]
    return F.concat(whole[0], F.lit("–"), whole[1])


def business_key(prefix: str, width: int, number: Column) -> Column:
    """`C0000042` for prefix C and width 7."""
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))
