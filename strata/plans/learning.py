"""Training frames, models and their run log."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.functions import privacy
from strata.operators import ml
from strata.operators import relational as rel
from strata.operators.sliced import sliced, sum_before
from strata.plans import layers as L
from strata.plans.lake import Lake
from strata.session import written
from strata.sources import files

UTILISATION = ["encounters_90d", "inpatient_90d", "ed_90d"]


def settings() -> dict:
    """Features and parameters of the models, as shipped."""
    return yaml.safe_load(config.shipped("models.yml").read_text())


def payer_bucket(key: Column) -> Column:
    return F.ascii(key) % 3


def labs_so_far(spark: SparkSession, d) -> DataFrame:
    """(patient_key, lab_at, lab_result_key, labs_180d, mean_value_180d, code_weight) at each
    result: the trailing figures and the weight of all codes up to it."""
    weight = F.lit(0)
    for code, w in L.WEIGHTS.items():
        weight = F.when(F.col("lab_test_key").startswith(code), w).otherwise(weight)
    at = F.unix_timestamp("resulted_ts")
    labs = L.fact_lab(spark, d).filter("resulted_ts is not null and patient_key is not null").select("patient_key", "lab_result_key", at.alias("lab_at"), weight.cast("long").alias("w"))
    run = sum_before(sliced(written(labs, "labs"), "lab_at"), ["patient_key"], ["lab_at", "lab_result_key"], "w", "earlier")
    trend = L.ft_lab_trend_180d(spark, d).select("lab_result_key", "labs_180d", "mean_value_180d")
    return run.join(trend, "lab_result_key").select("patient_key", "lab_at", "lab_result_key", "labs_180d", "mean_value_180d", (F.col("earlier") + F.col("w")).alias("code_weight"))


def _with_person(stays: DataFrame, spark: SparkSession, d) -> DataFrame:
    """Demographics, utilisation before the day's last stay, and a made-up payer group."""
    use = L.ft_trailing_90d(spark, d).select("patient_key", "as_of_key", *UTILISATION)
    people = L.dim_patient(spark, d).select("patient_key", "birth_year", "sex", "age_band")
    full = stays.withColumn("as_of_key", L.date_key(F.col("admit_ts"))).join(people, "patient_key").join(use, ["patient_key", "as_of_key"], "left").drop("as_of_key")
    return full.withColumn("bucket", payer_bucket(F.col("patient_key")))


def readmission_frame(spark: SparkSession, d) -> DataFrame:
    """Index stays with the readmission label and features known at admission. Laboratory figures
    and code weights are those of the last result up to then, so nothing looks ahead."""
    stays = L.fact_readmission(spark, d).select("encounter_key", "patient_key", "admit_ts", F.col("readmission_30d_count").alias("label"))
    person = _with_person(stays, spark, d).withColumn("admit_s", F.unix_timestamp("admit_ts"))
    got = rel.as_of_join(person, labs_so_far(spark, d), "patient_key", "admit_s", "lab_at", ["lab_result_key", "labs_180d", "mean_value_180d", "code_weight"])
    return got.select(*[c for c in person.columns if c not in ("admit_ts", "admit_s")], *[F.col(f"prior_{c}").alias(c) for c in ("labs_180d", "mean_value_180d", "code_weight")])


def no_show_frame(spark: SparkSession, d) -> DataFrame:
    """Ambulatory stays with a made-up label that a fifth of them have, utilisation, and the mean
    of the patient's latest scores."""
    stays = L.fact_encounter(spark, d).filter("care_setting_key in ('outpatient', 'ambulatory')").select("encounter_key", "patient_key", "admit_ts")
    text = F.concat_ws(":", "patient_key", "encounter_key", F.lit("noshow"))
    scores = L.ft_latest_score(spark, d).groupBy("patient_key").agg((F.sum(F.col("total_score").cast("decimal(18,4)")).cast("double") / F.count("total_score")).alias("mean_score"))
    full = _with_person(stays.withColumn("label", (privacy.digest_bucket(text, 100) < 20).cast("int")), spark, d).join(scores, "patient_key", "left")
    return full.drop("admit_ts")


def _scored(frame: DataFrame, model: dict) -> DataFrame:
    """The frame with split and score: codes and model are fitted on training patients."""
    rows = written(ml.entity_split(frame, "patient_key"), "frame")
    train = rows.filter("split = 'train'")
    rows = written(ml.encoded(rows, "sex", ml.fit_codes(train, "sex"), "sex_code"), "coded")
    fitted = ml.calibrated_classifier(rows.filter("split = 'train'"), model["features"], "label", iterations=model["iterations"], isotonic_from=model["isotonic_from"])
    return fitted(rows)


def readmission_scores(spark: SparkSession, d) -> DataFrame:
    return _scored(readmission_frame(spark, d), settings()["models"]["readmission"])


def no_show_scores(spark: SparkSession, d) -> DataFrame:
    return _scored(no_show_frame(spark, d), settings()["models"]["no_show"])


def response_clusters(spark: SparkSession, d) -> DataFrame:
    """Patients by their mean score in each instrument."""
    wide = L.fact_survey(spark, d).groupBy("patient_key").pivot("instrument_key", ["MOOD-8", "MOVE-10", "SLEEP-6"]).agg(F.avg("total_score")).na.fill(0)
    return ml.clusters(written(wide, "wide"), ["MOOD-8", "MOVE-10", "SLEEP-6"], k=settings()["models"]["response_clusters"]["k"]).select("patient_key", "cluster", "mean_value")


def train_all(lake: Lake, artifacts: str) -> dict[str, dict]:
    """Fits every model on the stored features, writes a card for each and appends a row to
    ops.model_runs; returns the figures on test patients."""
    spark, store, chosen, out = lake.spark, lake.store, settings(), {}
    for name, scored in (("readmission", readmission_scores), ("no_show", no_show_scores)):
        test = written(scored(spark, lake).filter("split = 'test'"), "test")
        figures = ml.subgroup_metrics(test.withColumn("all", F.lit("all")), ["all", *chosen["slices"]], "label", "score").toPandas()  # a row a level
        overall = figures[figures["slice"] == "all"].drop(columns=["slice", "level"]).to_dict("records")
        out[name] = overall[0] if overall else {"n": 0}
        card = ml.model_card(name, "1", "Research on de-identified rows; no medical device.", chosen["models"][name]["features"], out[name], figures[figures["slice"] != "all"], "Test rows are whole patients.")
        files.write_text(spark, f"{artifacts}/{name}.md", card)
    groups = response_clusters(spark, lake).groupBy("cluster").agg(F.count("*").alias("n"), F.min("mean_value").alias("mean_value")).collect()  # k rows
    out["response_clusters"] = {"n": sum(r["n"] for r in groups), "lowest": min(groups, key=lambda r: r["mean_value"])["cluster"] if groups else None}
    exposed = L.ft_weighted_codes(spark, lake).select("patient_key", (F.col("code_weight") >= 20).cast("int").alias("treated"))
    rows = L.patient_360(spark, lake).select("patient_key", "birth_year", "lab_count", "encounter_count").join(exposed, "patient_key")
    out["propensity"] = {"pairs": ml.propensity_pairs(rows, "treated", ["birth_year", "encounter_count"], "patient_key").count()}
    at = datetime.now(UTC).isoformat()
    runs = [(n, json.dumps(chosen["models"].get(n, {}), sort_keys=True), json.dumps(m, default=float, sort_keys=True), at) for n, m in out.items()]
    store.write(spark.createDataFrame(runs, "model string, parameters string, metrics string, ts string"), "ops", "model_runs")
    return out
