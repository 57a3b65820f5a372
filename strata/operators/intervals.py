"""Continuous periods and gaps of overlapping intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.sliced import SLICES, boundaries, previous, row_number, slice_of
from strata.session import written


def periods_and_gaps(df: DataFrame, *, entity: Column, start: Column, end: Column, slices: int = SLICES) -> DataFrame:
    """(entity, kind, start, end, intervals): the maximal unions ("period") of an entity's closed
    intervals, with how many intervals each holds, and the "gap"s between successive ones.

    Starts and ends are sorted independently per entity. With s(k) the k-th start and e(k) the
    k-th end, everything up to rank k is over before the rest begins exactly if s(k+1) > e(k):
    such a rank closes a period, and the next-ranked start opens the following one. Intervals
    that touch share an instant and belong together. Ranks are found per time slice with carried
    counts and starts meet ends by an aggregate over (entity, rank), so no entity is gathered in
    one task. The usable intervals are written once, since two passes follow.

    Intervals with a null entity, start or end, or that end before they start, are ignored;
    repeated rows count as intervals of their own; zero length is allowed."""
    src = written(df.select(entity.alias("entity"), start.alias("s"), end.alias("e")).filter("entity is not null and s is not null and e >= s"), "intervals")
    cuts = boundaries(src, "s", slices)
    # starts (side 0) and ends (side 1) in one pass, ranked apart
    sides = src.select("entity", F.posexplode(F.array("s", "e")).alias("side", "at")).withColumn("_slice", slice_of(F.col("at"), cuts))
    ranked = row_number(sides, ["entity", "side"], ["at"], "k")
    # an end of rank k meets the start of rank k + 1; rank 0 holds the first start and no end: it opens the first period
    starts = F.col("side") == 0
    paired = ranked.groupBy("entity", (F.col("k") - F.when(starts, 1).otherwise(0)).alias("k")).agg(
        F.max(F.when(starts, F.col("at"))).alias("next_start"), F.max(F.when(~starts, F.col("at"))).alias("closed"), F.max(F.when(~starts, F.col("_slice"))).alias("_slice"),
    ).withColumn("_slice", F.coalesce("_slice", F.lit(-1)))
    edges = paired.filter("closed is null or next_start is null or next_start > closed")
    closing = previous(edges, ["entity"], ["k"], ["k", "next_start"]).filter("closed is not null")
    row = lambda kind, a, b, n: F.struct(F.lit(kind).alias("kind"), F.col(a).alias("start"), F.col(b).alias("end"), n.cast("long").alias("intervals"))
    period, gap = row("period", "prev_next_start", "closed", F.col("k") - F.col("prev_k")), row("gap", "closed", "next_start", F.lit(0))
    both = F.array_compact(F.array(period, F.when(F.col("next_start").isNotNull(), gap)))
    return closing.select("entity", F.explode(both).alias("x")).select("entity", "x.*")
