"""Checks of a stored table: repeated keys, first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(table: DataFrame, key: list[str]) -> DataFrame:
    """Key values seen more than once, with ``DuplicateCount``."""
    return (
        table.groupBy(*key).agg(F.count("*").alias("DuplicateCount")).where("DuplicateCount > 1")
    )


def preview(table: DataFrame, order: str = "ID", n: int = 1000) -> DataFrame:
    """The first ``n`` rows by ``order``, all columns."""
    return table.orderBy(order).limit(n)
