"""Row changes as new frames; nothing is updated in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns in the rows where `condition` is true; NULL counts as false."""
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Keep the rows where `condition` is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
