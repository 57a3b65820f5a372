"""Window functions whose partitions stay small when one entity holds much of the data.

A plain window gathers an entity's rows in one task. Here the order column is cut into slices
at quantiles of all rows, windows run per (entity, slice), and what earlier slices contribute
comes from one row per (entity, slice), aggregated on the map side. An entity with a third of
all rows is thereby spread over as many tasks as there are slices.

The number of slices follows the number of rows: `slices` of them at least, and so many that one
holds about SLICE_ROWS rows, so the largest window group stays the same size as the data grow.
Results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 32
#: Rows that one slice holds at most, over all entities, if values are spread evenly in it.
SLICE_ROWS = 2_000_000


@dataclass(frozen=True)
class Cuts:
    """Ascending cut points at quantiles; the stretch between two is cut evenly into `parts`."""

    points: list = field(default_factory=list)
    least: float | None = None
    greatest: float | None = None
    parts: int = 1


def boundaries(df: DataFrame, column: str, slices: int = SLICES) -> Cuts:
    """Cut points of a numeric column, from one pass: at most slices-1 approximate quantiles
    (mergeable sketches), and the even parts between them that the row count asks for. Without
    points for an empty or all-null column."""
    steps = [i / slices for i in range(1, slices)] or [0.5]
    got = df.agg(F.percentile_approx(column, steps, 1000).alias("b"), F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(column).alias("n")).first()
    points = sorted(set(got["b"] or [])) if slices > 1 else []
    return Cuts(points, got["lo"], got["hi"], max(1, -(-got["n"] // (slices * SLICE_ROWS))))


def slice_of(c: Column, cuts: Cuts) -> Column:
    """Number of the value's slice, ascending with the value: the cut points at or below it, as a
    balanced tree of comparisons, and the even part within; nulls 0."""
    points = cuts.points

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c < F.lit(points[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    at = tree(0, len(points))
    if cuts.parts > 1:
        edges = F.array(*[F.lit(float(x)) for x in (cuts.least, *points, cuts.greatest)])
        lo, hi = F.element_at(edges, at + 1), F.element_at(edges, at + 2)
        inside = F.when(hi > lo, F.floor((c - lo) / (hi - lo) * cuts.parts)).otherwise(F.lit(0))
        at = at * cuts.parts + F.least(F.greatest(inside, F.lit(0)), F.lit(cuts.parts - 1)).cast("int")
    return F.when(c.isNull(), F.lit(0)).otherwise(at)


def sliced(df: DataFrame, order: str, name: str = "_slice", slices: int = SLICES) -> DataFrame:
    """`df` with the slice number of its (numeric) order column."""
    return df.withColumn(name, slice_of(F.col(order), boundaries(df, order, slices)).cast("int"))


def _carried(df: DataFrame, keys: list[str], aggs: list[Column], over: dict, slice_col: str) -> DataFrame:
    """One row per (keys, slice): `over` maps names to functions of a window over the slices of
    the keys."""
    per = df.groupBy(*keys, slice_col).agg(*aggs)
    w = Window.partitionBy(*keys).orderBy(slice_col)
    return per.select(*keys, slice_col, *[f(w).alias(n) for n, f in over.items()])


def row_number(df: DataFrame, keys: list[str], order: list, out: str, slice_col: str = "_slice") -> DataFrame:
    """row_number() over (partition by keys order by order), exact across slices. The first
    order column must be the one that was sliced; `order` must be total for a defined result."""
    offset = _carried(
        df, keys, [F.count("*").alias("_n")],
        {"_before": lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))},
        slice_col,
    )
    local = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys, slice_col).orderBy(*order)))
    return local.join(offset, [*keys, slice_col]).withColumn(out, F.col(out) + F.col("_before")).drop("_before")


def neighbour(df: DataFrame, keys: list[str], order: list, columns: list[str], prefix: str, *, ahead: bool = False, slice_col: str = "_slice") -> DataFrame:
    """Adds <prefix><column>: the columns of the preceding row (lag), or with `ahead` of the next
    (lead), exact across slices; null where there is none. Null values of that row stay null."""
    pack = F.struct(*columns)
    at = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    edge, step = (F.min, F.lead) if ahead else (F.max, F.lag)
    outer = _carried(
        df, keys, [edge(F.struct(at.alias("o"), pack.alias("p"))).alias("_m")],
        {"_in": lambda w: step(F.col("_m.p")).over(w)}, slice_col,
    )
    w = Window.partitionBy(*keys, slice_col).orderBy(*order)
    out = df.withColumn("_near", step(pack).over(w)).join(outer, [*keys, slice_col])
    got = F.coalesce("_near", "_in")
    return out.select(*df.columns, *[got[c].alias(f"{prefix}{c}") for c in columns])


def previous(df: DataFrame, keys: list[str], order: list, columns: list[str], slice_col: str = "_slice") -> DataFrame:
    """`neighbour` under prev_<column>."""
    return neighbour(df, keys, order, columns, "prev_", slice_col=slice_col)


def following(df: DataFrame, keys: list[str], order: str, out: str, slice_col: str = "_slice", ties: Sequence[str] = ()) -> DataFrame:
    """Adds `out`: the order value of the next row (lead), exact across slices; null in the last.
    Rows of equal order value follow each other by `ties`."""
    first = _carried(
        df, keys, [F.min(order).alias("_f")], {"_next": lambda w: F.lead("_f").over(w)}, slice_col
    )
    w = Window.partitionBy(*keys, slice_col).orderBy(order, *ties)
    return (
        df.withColumn("_lead", F.lead(order).over(w)).join(first, [*keys, slice_col])
        .select(*df.columns, F.coalesce("_lead", "_next").alias(out))
    )


def filled_forward(df: DataFrame, keys: list[str], order: str, columns: list[str], slice_col: str = "_slice", ties: Sequence[str] = ()) -> DataFrame:
    """For each column c, c becomes its last non-null value up to the row and was_<c> the same up
    to the row before; _first tells the first row of the keys. Exact across slices. Rows of equal
    order value follow each other by `ties`."""
    aggs = [F.count("*").alias("_n")] + [
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), *ties, F.col(c).alias("v")))).alias(f"_l_{c}")
        for c in columns
    ]
    early = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    over = {"_before": lambda w: F.coalesce(F.sum("_n").over(early(w)), F.lit(0))} | {
        f"_in_{c}": (lambda w, c=c: F.last(f"_l_{c}", ignorenulls=True).over(early(w))["v"]) for c in columns
    }
    carry = _carried(df, keys, aggs, over, slice_col)
    w = Window.partitionBy(*keys, slice_col).orderBy(order, *ties)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), early(w)
    rest = [c for c in df.columns if c not in columns]
    local = df.select(
        *rest, F.row_number().over(w).alias("_rn"),
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in columns],
        *[F.last(c, ignorenulls=True).over(before).alias(f"was_{c}") for c in columns],
    )
    joined = local.join(carry, [*keys, slice_col])
    return joined.select(
        *rest, ((F.col("_rn") == 1) & (F.col("_before") == 0)).alias("_first"),
        *[F.coalesce(c, f"_in_{c}").alias(c) for c in columns],
        *[F.coalesce(f"was_{c}", f"_in_{c}").alias(f"was_{c}") for c in columns],
    )


def sums_before(df: DataFrame, keys: list[str], order: list, values: dict[str, str], slice_col: str = "_slice") -> DataFrame:
    """Adds for each out -> value of `values` the sum of the value over the rows of the keys before
    this one, exact across slices; 0 in the first. `order` must be total for a defined result."""
    early = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda w, c: F.coalesce(F.sum(c).over(early(w)), F.lit(0))
    outs = list(values)
    carry = _carried(df, keys, [F.sum(v).alias(f"_s_{o}") for o, v in values.items()], {f"_e_{o}": (lambda w, o=o: total(w, f"_s_{o}")) for o in outs}, slice_col)
    w = Window.partitionBy(*keys, slice_col).orderBy(*order)
    local = df.select("*", *[total(w, v).alias(f"_o_{o}") for o, v in values.items()]).join(carry, [*keys, slice_col])
    return local.select(*df.columns, *[(F.col(f"_o_{o}") + F.col(f"_e_{o}")).alias(o) for o in outs])


def sum_before(df: DataFrame, keys: list[str], order: list, value: str, out: str, slice_col: str = "_slice") -> DataFrame:
    """`sums_before` of one value."""
    return sums_before(df, keys, order, {out: value}, slice_col)


def _cell(v: Column) -> Column:
    """A monotone whole number of a double: 64 cells an octave."""
    return (F.signum(v) * F.floor(F.log2(F.abs(v) * 1e6 + 1) * 64)).cast("long")


def weighted_quantile(df: DataFrame, groups: list[str], value: str, weight: str, q: float, out: str) -> DataFrame:
    """Exact q-quantile (linear between neighbours, as SQL's percentile_cont) of `value`, each
    row counting `weight` times, per group. Nulls and NaN must be gone; groups may be null-free
    only. Values are pre-aggregated, ranked per cell of nearly equal values with carried counts,
    so that no group is gathered in one task."""
    base = df.groupBy(*groups, value).agg(F.sum(weight).alias("_w")).withColumn("_cell", _cell(F.col(value)))
    cells = base.groupBy(*groups, "_cell").agg(F.sum("_w").alias("_cw"))
    w = Window.partitionBy(*groups)
    cells = cells.select(
        *groups, "_cell", "_cw", F.sum("_cw").over(w).alias("_n"),
        (F.sum("_cw").over(w.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cw")).alias("_before"),
    )
    at = (F.col("_n") - 1) * F.lit(q)
    cells = cells.withColumn("_lo", F.floor(at)).withColumn("_hi", F.ceil(at)).withColumn("_part", at - F.floor(at))
    inside = lambda r: (F.col("_before") <= F.col(r)) & (F.col(r) < F.col("_before") + F.col("_cw"))
    wanted = cells.filter(inside("_lo") | inside("_hi"))
    run = F.sum("_w").over(Window.partitionBy(*groups, "_cell").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = base.join(wanted, [*groups, "_cell"]).withColumn("_end", F.col("_before") + run)
    holds = lambda r: (F.col("_end") - F.col("_w") <= F.col(r)) & (F.col(r) < F.col("_end"))
    return ranked.groupBy(*groups).agg(
        F.max(F.when(holds("_lo"), F.col(value))).alias("_a"),
        F.max(F.when(holds("_hi"), F.col(value))).alias("_b"),
        F.max("_part").alias("_part"),
    ).select(*groups, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias(out))


def bounded(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """`df` marked for broadcast if a count shows at most `most_rows` rows, else as it is, so
    that the join shuffles. `df` should be written already: the count reads it."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
