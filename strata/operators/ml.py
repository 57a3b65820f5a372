"""Splits, models and metrics on DataFrames; nothing is collected but fitted parameters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.privacy import digest_bucket
from strata.operators.sliced import filled_forward, previous, sliced, sum_before
from strata.session import written


def entity_split(df: DataFrame, entity: str, test_share: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds `split`: all rows of an entity are train or all are test. An entity's side is its hash
    alone, so no ranking and no shuffle is needed, and it stays when data are added."""
    cut = int(test_share * 10_000)
    side = digest_bucket(F.concat(F.lit(f"{seed}|"), F.col(entity).cast("string")), 10_000) < cut
    return df.withColumn("split", F.when(side, "test").otherwise("train"))


def temporal_split(df: DataFrame, at: str, train_share: float = 0.75) -> DataFrame:
    """Adds `split`: in order of the (numeric) time, the first `train_share` of the rows are train,
    and so is whatever has the time of the last of them; rows without a time are test. The cut is
    exact: rows are counted per time, and counts added up per time slice."""
    counts = written(df.filter(F.col(at).isNotNull()).groupBy(F.col(at).alias("t")).agg(F.count("*").alias("n")), "times")
    k = int((counts.agg(F.sum("n")).first()[0] or 0) * train_share)
    ranked = sum_before(sliced(counts, "t"), [], ["t"], "n", "below")
    last = ranked.filter((F.col("below") < k) & (F.col("below") + F.col("n") >= k)).first()  # one row
    train = F.col(at) <= F.lit(last["t"]) if last else F.lit(False)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def fit_codes(train: DataFrame, column: str, most: int = 10_000) -> dict[str, int]:
    """Codes of a categorical column in order of value; at most `most` values."""
    values = [r[0] for r in train.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column}: more than {most} values")
    return {v: i for i, v in enumerate(sorted(values))}


def encoded(df: DataFrame, column: str, codes: dict[str, int], out: str | None = None) -> DataFrame:
    """Code of each value; -1 for values not seen in training."""
    pairs = [x for v, i in codes.items() for x in (F.lit(v), F.lit(i))]
    code = F.coalesce(F.create_map(*pairs)[F.col(column)], F.lit(-1)) if pairs else F.lit(-1)
    return df.withColumn(out or f"{column}_code", code)


def vectorised(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    return VectorAssembler(inputCols=columns, outputCol=out).transform(filled)


def probability(c: str = "probability") -> Column:
    return vector_to_array(F.col(c))[1]


def calibrated_classifier(train: DataFrame, features: list[str], label: str, *, depth: int = 3, iterations: int = 50, seed: int = 42, isotonic_from: int | None = 40):
    """A boosted-tree model with a calibration of its raw score, fitted on the fifth of the
    training rows the trees have not seen: isotonic from `isotonic_from` training rows on, logistic
    with fewer or if it is None. Returns a function from a frame to the frame with `score` in [0, 1]."""
    rows = vectorised(train.withColumn("_label", F.col(label).cast("double")), features)
    fold = F.pmod(F.xxhash64("features", "_label"), F.lit(5))
    trees = GBTClassifier(labelCol="_label", maxDepth=depth, maxIter=iterations, seed=seed).fit(rows.filter(fold != 0))
    raw = lambda df: VectorAssembler(inputCols=["_raw"], outputCol="_score").transform(
        trees.transform(df).withColumn("_raw", vector_to_array("rawPrediction")[1]).drop("probability", "prediction", "rawPrediction")
    )
    held = raw(rows.filter(fold == 0))
    kinds = held.select("_label").distinct().count()
    if kinds < 2:  # nothing to calibrate on: the trees' own probability
        return lambda df: trees.transform(vectorised(df, features)).withColumn("score", probability()).drop("features", "rawPrediction", "probability", "prediction")
    if isotonic_from is not None and train.count() >= isotonic_from:
        steps = IsotonicRegression(featuresCol="_score", labelCol="_label", predictionCol="score").fit(held)
        return lambda df: steps.transform(raw(vectorised(df, features))).drop("features", "_raw", "_score")
    scale = LogisticRegression(featuresCol="_score", labelCol="_label").fit(held)
    return lambda df: scale.transform(raw(vectorised(df, features))).withColumn("score", probability()).drop("features", "_raw", "_score", "rawPrediction", "probability", "prediction")


def clusters(df: DataFrame, columns: list[str], k: int = 3, seed: int = 42) -> DataFrame:
    """Adds `cluster` by k-means on standardised columns, and `mean_value` of its members."""
    pipe = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="_std", withMean=True), KMeans(featuresCol="_std", predictionCol="cluster", k=k, seed=seed)])
    rows = vectorised(df, columns)
    out = pipe.fit(rows).transform(rows).drop("features", "_std")
    mean = sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns) / len(columns)
    return out.join(out.groupBy("cluster").agg(F.avg(mean).alias("mean_value")), "cluster")


def subgroup_metrics(df: DataFrame, slices: list[str], label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """(slice, level, n, positive_rate, accuracy, brier, auc) for each level of each slice column,
    null levels too. AUC comes from mid-ranks over (level, score) counts, so rows are aggregated
    before anything is ordered; null if a level has one class only. Rows with a null score don't
    count."""
    cells = F.explode(F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("level")) for s in slices]))
    y, p = F.col(label).cast("int"), F.col(score).cast("double")
    counts = df.select(cells.alias("x"), y.alias("y"), p.alias("p")).filter("p is not null").groupBy("x.slice", "x.level", "p").agg(
        F.count("*").alias("n"), F.sum("y").alias("pos"), F.sum(((F.col("p") >= threshold).cast("int") == F.col("y")).cast("int")).alias("right"),
        F.sum((F.col("p") - F.col("y")) ** 2).alias("err"),
    )
    # scores are ranked per stretch of scores with carried counts: a level may have a score a row
    counts = written(counts.withColumn("_level", F.coalesce(F.concat(F.lit("="), "level"), F.lit("~"))), "scores")
    before = sum_before(sliced(counts, "p"), ["slice", "_level"], ["p"], "n", "_below")
    ranked = before.withColumn("mid", F.col("_below") + (F.col("n") + 1) / 2)
    agg = ranked.groupBy("slice", "level").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("_p"), F.sum("right").alias("_r"), F.sum("err").alias("_e"), F.sum(F.col("mid") * F.col("pos")).alias("_m")
    )
    pos, neg = F.col("_p"), F.col("n") - F.col("_p")
    return agg.select(
        "slice", "level", "n", (pos / F.col("n")).alias("positive_rate"), (F.col("_r") / F.col("n")).alias("accuracy"), (F.col("_e") / F.col("n")).alias("brier"),
        F.when((pos > 0) & (neg > 0), (F.col("_m") - pos * (pos + 1) / 2) / (pos * neg)).alias("auc"),
    )


def _nearest_free(rows: pd.DataFrame) -> pd.DataFrame:
    """Greedy pairs of one run of scores. Full and empty scores are skipped by links to the next
    score with a free control on either side, so a treated costs about constant time."""
    treated = rows[rows["side"]].sort_values("ident")
    control = rows[~rows["side"]].sort_values(["s", "ident"])
    caliper, names = rows["caliper"].iloc[0], control["ident"].to_numpy()
    levels, at = np.unique(control["s"].to_numpy(), return_index=True)
    nxt, end = at.tolist(), [*at.tolist()[1:], len(names)]
    n = len(levels)
    up, down = list(range(n + 1)), list(range(n + 1))  # down is shifted by one; n and 0 mean none

    def find(links: list[int], i: int) -> int:
        while links[i] != i:
            links[i] = links[links[i]]
            i = links[i]
        return i

    scores = treated["s"].to_numpy()
    got = []
    for who, s, i in zip(treated["ident"].to_numpy(), scores, np.searchsorted(levels, scores), strict=True):
        above, below = find(up, int(i)), find(down, int(i)) - 1
        gaps = [(abs(s - levels[k]), k) for k in (below, above) if 0 <= k < n]
        gap, k = min(gaps, default=(np.inf, 0))
        if gap > caliper:
            continue
        got.append((who, names[nxt[k]], gap))
        nxt[k] += 1
        if nxt[k] == end[k]:
            up[k], down[k + 1] = k + 1, k
    return pd.DataFrame(got, columns=["treated", "control", "gap"])


def matched_pairs(treated: DataFrame, control: DataFrame, score: str, ident: str, caliper: float) -> DataFrame:
    """(treated, control, gap): one-to-one pairs within the caliper. In order of `ident` each
    treated takes the nearest control that is still free, of equally near ones that of the lower
    score and then the lower `ident`. Rows with a null `ident` or score, or NaN, have no pair.

    Scores more than the caliper apart from the next are the borders of runs, which don't compete
    and are matched in parallel. Within a run each choice depends on the ones before, so a run is
    one task that holds its identifiers and scores."""
    def side(df: DataFrame, is_treated: bool) -> DataFrame:
        rows = df.select(F.lit(is_treated).alias("side"), F.col(ident).alias("ident"), F.col(score).cast("double").alias("s"))
        return rows.filter(F.col("ident").isNotNull() & F.col("s").isNotNull() & ~F.isnan("s"))

    both = written(side(treated, True).unionByName(side(control, False)), "match")
    near = previous(sliced(both.select("s").distinct(), "s"), [], ["s"], ["s"])
    starts = near.withColumn("run", F.when(F.col("prev_s").isNull() | (F.col("s") - F.col("prev_s") > caliper), F.col("s")))
    runs = filled_forward(starts, [], "s", ["run"]).select("s", "run")
    kind = both.schema["ident"].dataType.simpleString()
    return (
        both.join(runs, "s").withColumn("caliper", F.lit(float(caliper)))
        .groupBy("run").applyInPandas(_nearest_free, f"treated {kind}, control {kind}, gap double")
    )


def propensity(df: DataFrame, treatment: str, features: list[str]) -> DataFrame:
    """Adds `propensity`, the fitted probability of treatment."""
    rows = vectorised(df.withColumn("_t", F.col(treatment).cast("double")), features)
    return LogisticRegression(labelCol="_t", maxIter=50).fit(rows).transform(rows).withColumn("propensity", probability()).drop("features", "_t", "rawPrediction", "probability", "prediction")


def propensity_pairs(df: DataFrame, treatment: str, features: list[str], ident: str, caliper: float = 0.2) -> DataFrame:
    """(treated, control, gap): `matched_pairs` on the propensity. Rows with a null treatment or
    feature don't count; no pairs from fewer than four rows or one kind of treatment."""
    rows = written(df.select(ident, treatment, *features).dropna(subset=[treatment, *features]), "propensity")
    n, kinds = rows.agg(F.count("*"), F.count_distinct(treatment)).first()
    scored = rows.withColumn("propensity", F.lit(0.0)).limit(0) if n < 4 or kinds < 2 else propensity(rows, treatment, features)
    side = F.col(treatment).cast("int")
    return matched_pairs(scored.filter(side == 1), scored.filter(side == 0), "propensity", ident, caliper)


def model_card(name: str, version: str, use: str, features: list[str], metrics: dict, fairness: pd.DataFrame | None = None, notes: str = "") -> str:
    """Markdown; at most 40 rows of subgroup figures."""
    lines = [f"# {name} {version}", "", use, "", "## Features", *[f"- {f}" for f in features], "", "## Metrics", *[f"- {k}: {v}" for k, v in metrics.items()]]
    if fairness is not None and len(fairness):
        head = list(fairness.columns)
        lines += ["", "## Subgroups", "| " + " | ".join(head) + " |", "|" + "-|" * len(head)]
        lines += ["| " + " | ".join(map(str, r)) + " |" for r in fairness.head(40).itertuples(index=False)]
    return "\n".join([*lines, "", "## Notes", notes or "None."]) + "\n"
