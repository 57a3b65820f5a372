"""Totals over trailing periods, days without activity included."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trailing_runs(
    daily: DataFrame, *, entity: str, day: str, measures: list[str], periods: list[int], first_day: str, last_day: str,
) -> DataFrame:
    """Runs of days (from_day..to_day) per entity on which every measure m and its totals
    m_<p> over the p days ending with each day stay the same.

    The total over p days is P(d) - P(d - p), P the cumulative sum of the measure. P changes only
    at days with activity, so the difference changes only there and p days later; both prefix
    sums are carried forward between those days by one cumulative sum of signed steps. Days
    without activity thus cost nothing until they are expanded. Activity is summed per entity and
    day first, so an entity has at most as many rows as the calendar has days times
    (periods + 2), however often it occurs.

    Rows with a null entity or day, or a day outside the calendar, don't count; a null measure
    counts as 0. Days before the first activity form a run of zeros. An empty input gives no rows."""
    lo, hi = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    base = (
        daily.select(F.col(entity).alias("entity"), F.col(day).cast("date").alias("day"), *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
        .filter(F.col("entity").isNotNull() & F.col("day").between(lo, hi))
        .groupBy("entity", "day").agg(*[F.sum(m).cast("long").alias(m) for m in measures])
    )
    names = [m for m in measures] + [f"{m}_{p}" for m in measures for p in periods]

    def steps(days: int, **signs: int) -> F.Column:
        """A step at `days` after the activity: signs says which sums change, by the measure."""
        fields = []
        for m in measures:
            fields.append((F.col(m) * signs.get("own", 0)).alias(m))
            fields.extend((F.col(m) * signs.get(f"p{p}", 0)).alias(f"{m}_{p}") for p in periods)
        return F.struct(F.date_add("day", days).alias("at"), *fields)

    arrive = {"own": 1} | {f"p{p}": 1 for p in periods}
    parts = [steps(0, **arrive), steps(1, own=-1), *[steps(p, **{f"p{p}": -1}) for p in periods]]
    moved = base.select("entity", F.explode(F.array(*parts)).alias("x")).select("entity", "x.*").filter(F.col("at") <= hi)
    opened = base.select("entity").distinct().select("entity", lo.alias("at"), *[F.lit(0).cast("long").alias(n) for n in names])
    points = moved.unionByName(opened).groupBy("entity", "at").agg(*[F.sum(n).alias(n) for n in names])
    w = Window.partitionBy("entity").orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return points.select(
        "entity", F.col("at").alias("from_day"),
        F.coalesce(F.date_sub(F.lead("at").over(w), 1), hi).alias("to_day"),
        *[F.sum(n).over(upto).cast("long").alias(n) for n in names],
    )


def each_day(runs: DataFrame) -> DataFrame:
    """One row per day of the runs, as `day`."""
    rest = [c for c in runs.columns if c not in ("from_day", "to_day")]
    return runs.select(F.explode(F.sequence("from_day", "to_day")).alias("day"), *rest)
