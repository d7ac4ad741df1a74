"""Null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def filled(df: DataFrame, name: str, value, dtype: str) -> Column:
    """Replace null (and NaN) by ``value`` in the column's own type, then cast."""
    own_type = df.schema[name].dataType
    fill = F.lit(value).cast(own_type)
    source = F.col(name)
    if isinstance(own_type, (DoubleType, FloatType)):
        source = F.nanvl(source, fill)
    return F.coalesce(source, fill).try_cast(dtype)


def fill_and_cast(df: DataFrame, name: str, value, dtype: str) -> DataFrame:
    return df.withColumn(name, filled(df, name, value, dtype))


def fill_gaps(df: DataFrame, names: list[str], value: int = -1, dtype: str = "int") -> DataFrame:
    """Fill several columns in one projection."""
    return df.withColumns({name: filled(df, name, value, dtype) for name in names})
