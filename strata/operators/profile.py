"""Column profiles per load from unpivoted column-value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.sliced import weighted_quantile

_NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def value_counts(df: DataFrame, load: str, columns: list[str], labels: list | None = None) -> DataFrame:
    """(column_name, load, value, number, n): how often each column holds each value in each
    load. Values are as written, as text; `number` is the value of numeric columns. A null stays
    null, and so does a null load. One scan, counted on the map side before the shuffle. `labels`
    stand for the columns' names; short ones make for less to shuffle."""
    kinds = dict(df.dtypes)
    names = dict(zip(columns, labels or columns, strict=True))
    cells = [F.struct(F.lit(names[c]).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    long = df.select(F.col(load).alias("load"), F.explode(F.array(*cells)).alias("x"))
    counts = long.groupBy("x.column_name", "load", "x.value").agg(F.count("*").alias("n"))
    numeric = [names[c] for c in columns if kinds[c] in _NUMERIC or kinds[c].startswith("decimal")]
    return counts.withColumn("number", F.when(F.col("column_name").isin(numeric), F.col("value")).cast("double"))


def shares(counts: DataFrame, domains: dict[str, Column] | None = None) -> DataFrame:
    """Per column and load from `value_counts`: rows, nulls, distinct values, range, breaches of
    the domain (`domains`: per column a condition on F.col("value") that holds for valid values),
    and the departure from the whole table: total variation distance, population stability index
    and chi-square of the non-null values. Every figure is exact.

    `whole_` columns hold the table's own figures. Numbers have a numeric range and texts one of
    text. A load without non-null values has null range and departure."""
    valid = F.lit(None).cast("boolean")
    for name, ok in (domains or {}).items():
        valid = F.when(F.col("column_name") == name, ok).otherwise(valid)
    # a value has at most one row a load here, so its window is small
    counts = counts.withColumn("t", F.sum("n").over(Window.partitionBy("column_name", "value")))
    per_value = counts.withColumn("breach", F.when(F.col("value").isNotNull() & ~valid, F.col("n")).otherwise(0))
    held = F.col("value").isNotNull()
    some = lambda c: F.when(held, c)
    figures = [
        F.sum("n").alias("rows"), F.sum(F.when(~held, F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(held.cast("int")).cast("long").alias("distinct_values"), F.sum("breach").alias("breaches"),
        F.min(some(F.col("number"))).alias("min_number"), F.max(some(F.col("number"))).alias("max_number"),
        *[f(F.when(F.col("number").isNull(), F.col("value"))).alias(n) for f, n in ((F.min, "min_value"), (F.max, "max_value"))],
    ]
    by_load = per_value.groupBy("column_name", "load").agg(*figures)
    w = Window.partitionBy("column_name")  # one row per column and load
    by_load = by_load.select("*", F.sum("rows").over(w).alias("whole_rows"), F.sum("nulls").over(w).alias("whole_nulls"))
    # departure: only values that the load holds need a row; the others enter by what is left over,
    # in psi by the column's total of q * ln(q / tiny) less that of the values held
    base = by_load.select(F.col("column_name").alias("_column"), F.col("load").alias("_load"), (F.col("rows") - F.col("nulls")).alias("held"), (F.col("whole_rows") - F.col("whole_nulls")).alias("whole_held"))
    p, q = F.col("n") / F.col("held"), F.col("t") / F.col("whole_held")
    tiny = F.lit(1e-6)
    absent = F.log(F.greatest(q, tiny) / tiny)
    away = (
        counts.filter(held).join(base, (F.col("column_name") == F.col("_column")) & F.col("load").eqNullSafe(F.col("_load")))
        .groupBy("column_name", "load").agg(
            F.sum(F.abs(p - q)).alias("_d"), F.sum(q).alias("_q"),
            F.sum((p - q) * F.log(F.greatest(p, tiny) / F.greatest(q, tiny))).alias("_psi"),
            F.sum(q * absent).alias("_own"), F.sum(F.col("n") / F.col("whole_held") * absent).alias("_part"),
            F.sum((p - q) * (p - q) / q * F.col("held")).alias("_chi"), F.max("held").alias("_h"),
        )
        .select(
            F.col("column_name").alias("_column"), F.col("load").alias("_load"), ((F.col("_d") + F.greatest(1 - F.col("_q"), F.lit(0.0))) / 2).alias("variation"),
            (F.col("_psi") + F.greatest(F.sum("_part").over(w) - F.col("_own"), F.lit(0.0))).alias("psi"), (F.col("_chi") + F.greatest(1 - F.col("_q"), F.lit(0.0)) * F.col("_h")).alias("chi_square"),
        )
    )
    same = (F.col("column_name") == F.col("_column")) & F.col("load").eqNullSafe(F.col("_load"))
    return by_load.join(away, same, "left").drop("_column", "_load")


def load_medians(df: DataFrame, load: str, value: str, strata: list[str]) -> DataFrame:
    """(strata, load, n, load_median, whole_median): exact medians of the non-null values per
    stratum, in each load and in the whole table. Rows with a null stratum or load, and NaN,
    don't count."""
    counts = (
        df.select(*strata, F.col(load).alias("load"), F.col(value).cast("double").alias("v"))
        .filter(F.col("v").isNotNull() & ~F.isnan("v")).dropna(subset=[*strata, "load"])
        .groupBy(*strata, "load", "v").agg(F.count("*").alias("w"))
    )
    sizes = counts.groupBy(*strata, "load").agg(F.sum("w").alias("n"))
    own = weighted_quantile(counts, [*strata, "load"], "v", "w", 0.5, "load_median")
    whole = weighted_quantile(counts, strata, "v", "w", 0.5, "whole_median")
    return sizes.join(own, [*strata, "load"]).join(whole, strata)
