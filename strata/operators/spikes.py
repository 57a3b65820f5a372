"""Implausible readings: impossible values, extreme spikes, stuck devices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.sliced import SLICES, bounded, boundaries, row_number, slice_of, weighted_quantile
from strata.session import written

#: Cells of the tail histogram: this many to a factor of e.
CELLS = 50


def readings(df: DataFrame, *, row_id: Column, source: Column, code: Column, entity: Column, at: Column, value: Column) -> DataFrame:
    """One row per reading with a value: repeated deliveries of an id are one reading (if they
    differ, the greatest row). Null ids, values and NaN are left out; a null source or code is a
    source or code of its own (empty text)."""
    v = value.cast("double")
    src = df.select(
        row_id.alias("id"), F.coalesce(source, F.lit("")).alias("source"), F.coalesce(code, F.lit("")).alias("code"),
        entity.alias("entity"), at.alias("at"), v.alias("v"),
    ).filter("id is not null and v is not null and not isnan(v)")
    return src.groupBy("id").agg(F.max(F.struct("source", "code", "entity", "at", "v")).alias("r")).select("id", "r.*")


def _tail(edges: np.ndarray, n: np.ndarray, risk: float) -> float:
    """The value exceeded at `risk`, by peaks over threshold: a generalised Pareto law is fitted
    to what lies above the 80 % quantile. The likelihood is censored above the 95 % quantile and
    at the last two values at least (a peak there counts only as "beyond"), so that spikes cannot
    bend the fit. A weak prior keeps the shape near -0.1 where there are few peaks. edges:
    values, ascending; n: how often each occurs."""
    total = n.sum()
    cum = np.cumsum(n)
    at = lambda k: edges[min(np.searchsorted(cum, max(k, 1)), len(edges) - 1)]
    u, cap = at(0.80 * total), at(min(0.95 * total, total - 2))
    over = edges > u
    k = n[over].sum()
    if k == 0 or cap <= u:
        return float(cap)
    x, m = edges[over] - u, n[over]
    inside = x < cap - u
    xi = np.linspace(-0.6, 0.4, 41)[:, None]
    sigma = ((cap - u) * np.geomspace(0.1, 5.0, 80))[None, :]
    xi = np.where(np.abs(xi) < 1e-6, 1e-6, xi)

    def log_sf(y: float | np.ndarray) -> np.ndarray:
        return -np.log(np.maximum(1 + xi * y / sigma, 1e-12)) / xi

    like = log_sf(cap - u) * m[~inside].sum() - 0.5 * ((xi + 0.1) / 0.15) ** 2
    for y, c in zip(x[inside], m[inside], strict=True):
        like = like + c * (log_sf(y) * (1 + xi) - np.log(sigma))
    i, j = np.unravel_index(np.argmax(like), like.shape)
    share = k / total
    return float(u + sigma[0, j] / xi[i, 0] * ((risk / share) ** -xi[i, 0] - 1)) if risk < share else float(u)


def _border(cells: pd.DataFrame, risk: float, far: float) -> float:
    """Distance from which the readings behind `cells` are spikes (inf: none): `far` times the
    farthest distance of any reading whose residual lies within the fitted cutoff."""
    by_e = cells.groupby("e_cell", sort=True).agg({"e_lo": "min", "e_hi": "max", "n": "sum"})
    cut = _tail(by_e["e_hi"].to_numpy(float), by_e["n"].to_numpy(float), risk)
    regular = (cells["e_lo"] <= cut).to_numpy()
    lo, hi = cells["d_lo"].to_numpy(float), cells["d_hi"].to_numpy(float)
    body = hi[regular].max() if regular.any() else 0.0
    beyond = ~regular & (hi > 0) & (hi >= body * far * (1 - 1e-9))
    # a body of equal values: whatever differs from it and lies beyond the cutoff is far off
    return float(max(body * far * (1 - 1e-9), 0.0 if body > 0 else max(lo[beyond].min(), 5e-324))) if beyond.any() else float("inf")


def spike_borders(r: DataFrame, *, risk: float = 0.001, far: float = 1.5, least: int = 100) -> DataFrame:
    """(source, code, median, border): readings whose |log(value / median)| is at least `border`
    are spikes.

    1. Exact median per source and code; approximate median of log value per source, code and
       month, drawn towards the former as if it held twenty readings more: what lies off it is
       the seasonal residual.
    2. Both distances, |log ratio| and |residual|, are counted in a two-dimensional histogram per
       source and code, with cells of 1/50 on a log scale that keep their exact least and greatest
       values: a few thousand cells at most, whatever the number of readings.
    3. Peaks over threshold on the residuals give the cutoff that regular readings exceed at the
       fixed `risk`; readings within it are the regular body.
    4. Exact check: of the readings beyond the cutoff those are spikes that lie at least `far`
       times as far out as every reading within it.

    A source with fewer than `least` readings of a code has too few peaks for a tail of its own;
    its distances, taken off its own median and levels, are judged by the tail and body fitted to
    the distances of all sources of the code."""
    pos = F.col("v") > 0
    med = weighted_quantile(r.withColumn("w", F.lit(1)), ["source", "code"], "v", "w", 0.5, "median")
    month = F.date_trunc("month", F.timestamp_micros("at"))
    logs = r.filter(pos).withColumn("season", F.coalesce(month, F.lit("1900-01-01").cast("timestamp")))
    season = logs.groupBy("source", "code", "season").agg(F.percentile_approx(F.log("v"), 0.5, 500).alias("mid"), F.count("*").alias("c"))
    med, season = bounded(written(med, "median")), bounded(written(season, "season"))
    off = (
        logs.join(med, ["source", "code"]).join(season, ["source", "code", "season"])
        .filter("median > 0")
        .withColumn("level", (F.col("mid") * F.col("c") + F.log("median") * 20) / (F.col("c") + 20))
        .select("source", "code", F.abs(F.log(F.col("v") / F.col("median"))).alias("d"), F.abs(F.log("v") - F.col("level")).alias("e"))
    )
    cell = lambda c: F.floor(F.log(F.greatest(F.col(c), F.lit(1e-9))) * CELLS)
    cells = written(off.groupBy("source", "code", cell("d").alias("d_cell"), cell("e").alias("e_cell")).agg(
        F.count("*").alias("n"), F.min("d").alias("d_lo"), F.max("d").alias("d_hi"), F.min("e").alias("e_lo"), F.max("e").alias("e_hi")
    ), "cells")
    sizes = cells.groupBy("source", "code").agg(F.sum("n").alias("size"))
    own = F.col("size") >= least
    of_code = cells.groupBy("code", "d_cell", "e_cell").agg(
        F.sum("n").alias("n"), *[f(c).alias(c) for f, c in ((F.min, "d_lo"), (F.max, "d_hi"), (F.min, "e_lo"), (F.max, "e_hi"))]
    )

    def fitted(groups: list[str]):
        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({**{g: [pdf[g].iloc[0]] for g in groups}, "border": [_border(pdf, risk, far)]})

        return fit

    single = cells.join(sizes.filter(own), ["source", "code"], "left_semi").groupBy("source", "code").applyInPandas(fitted(["source", "code"]), "source string, code string, border double")
    few = sizes.filter(~own).select("source", "code")
    shared = of_code.join(few.select("code").distinct(), "code", "left_semi").groupBy("code").applyInPandas(fitted(["code"]), "code string, border double")
    return single.unionByName(few.join(shared, "code").select("source", "code", "border")).join(med, ["source", "code"])


def stuck_runs(r: DataFrame, *, least: int = 6, slices: int = SLICES) -> DataFrame:
    """Ids of the readings in runs of at least `least` successive equal values of one entity, code
    and source, in order of (at, id).

    The difference between a reading's rank in its series and among the equal values of its series
    is constant exactly along a run. Only series with a value that occurs `least` times are
    ranked; ranks are found per time slice, so a hot series is spread over tasks. Readings with a
    null entity or time are left out."""
    keys = ["entity", "code", "source"]
    usable = r.filter("entity is not null and at is not null")
    often = usable.groupBy(*keys, "v").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select(*keys).distinct()
    some = usable.join(bounded(written(often, "series")), keys, "left_semi")
    cut = some.withColumn("_slice", slice_of(F.col("at"), boundaries(r, "at", slices)))
    ranked = row_number(row_number(cut, keys, ["at", "id"], "k"), [*keys, "v"], ["at", "id"], "j")
    run = [*keys, "v", "run"]
    ranked = ranked.withColumn("run", F.col("k") - F.col("j")).select(*run, "id", "_slice")
    long = ranked.groupBy(*run).agg(F.count("*").alias("n")).filter(F.col("n") >= least).select(*run)
    return ranked.join(long, run, "left_semi").select("id")


def implausible(r: DataFrame, *, risk: float = 0.001, far: float = 1.5, least: int = 6) -> DataFrame:
    """(id, reason) of the `readings` that are "impossible" (zero or less), a "spike" (see
    `spike_borders`) or "stuck" (see `stuck_runs`); one row per reason. The readings are written
    once to the shared folder, since several passes follow. An empty input gives no rows."""
    r = written(r, "readings")
    border = bounded(written(spike_borders(r, risk=risk, far=far), "borders"))
    spikes = r.filter("v > 0").join(border, ["source", "code"]).filter(F.abs(F.log(F.col("v") / F.col("median"))) >= F.col("border"))
    tell = lambda df, why: df.select("id", F.lit(why).alias("reason"))
    return tell(r.filter("v <= 0"), "impossible").unionByName(tell(spikes, "spike")).unionByName(tell(stuck_runs(r, least=least), "stuck"))
