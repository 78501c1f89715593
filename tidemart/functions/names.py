"""Column names."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel(name: str) -> str:
    """snake_case (any letter case) to camelCase."""
    head, *tail = name.lower().split("_")
    return head + "".join(part.capitalize() for part in tail)


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel(c) for c in df.columns])
