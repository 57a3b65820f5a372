"""The row that holds for each identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: Column, order: Column, columns: dict[str, Column], key_name: str = "id") -> DataFrame:
    """One row per non-null key: `columns` of the row with the greatest `order` (nulls lowest;
    ties go to the greatest remaining values, so the result is defined), and `first_at`, the
    least `order`. Partial aggregation first, so repeated deliveries cost no shuffle."""
    src = df.select(key.alias("k"), order.alias("o"), *[c.alias(n) for n, c in columns.items()]).filter("k is not null")
    got = src.groupBy("k").agg(F.max(F.struct("o", *columns)).alias("m"), F.min("o").alias("first_at"))
    return got.select(F.col("k").alias(key_name), *[F.col("m")[n].alias(n) for n in columns], "first_at")
