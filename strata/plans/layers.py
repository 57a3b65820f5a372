"""Silver, Gold and feature frames over the clinical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.functions import privacy
from strata.functions.text import attribute_of, id_of, key_of, micros
from strata.operators import relational as rel
from strata.operators.current import latest
from strata.plans.lake import layer
from strata.plans.problems import table

AS_OF = "2025-01-01"
# fixed values: attribute weights by code, order of the survey waves
WEIGHTS = {"4548-4": 2, "2345-7": 1, "2160-0": 1, "1988-5": 1}
WAVE_ORDER = ["baseline", "day_30", "day_90", "day_180", "day_365"]
PERSON = ["sex", "race", "ethnicity"]


def pepper() -> str:
    return config.load().secret()


def sk(c: Column) -> Column:
    return privacy.hmac_hex(c, pepper())


@layer("restricted.patient_xref")
def patient_xref(spark: SparkSession, d: str) -> DataFrame:
    """Pseudonymous key of every source id."""
    ids = table(spark, d, "patient").select(id_of(F.col("patient_id")).alias("source_patient_id")).filter("source_patient_id is not null").distinct()
    return ids.select(sk(F.col("source_patient_id")).alias("patient_sk"), "source_patient_id")


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


@layer("silver.patient")
def silver_patient(spark: SparkSession, d: str) -> DataFrame:
    """One pseudonymised row per patient: the latest delivery."""
    raw = table(spark, d, "patient")
    held = latest(
        raw, id_of(F.col("patient_id")), F.struct(micros(F.col("_ingest_ts")).alias("i"), micros(F.col("valid_from")).alias("v")),
        {**{c: attribute_of(F.col(c)) for c in PERSON}, "birth_year": F.col("birth_year"), "zip": F.trim("zip3"), "dead": privacy.truthy(F.col("deceased_flag")), "_batch_id": F.col("_batch_id")},
        "patient_id",
    )
    z = F.when(F.col("zip").rlike(r"\A[0-9]{3}\z"), privacy.zip3(F.col("zip")))
    out = held.select(
        sk(F.col("patient_id")).alias("patient_sk"), *PERSON, "birth_year", privacy.age_band(F.col("birth_year")).alias("age_band"), z.alias("zip3"), F.col("dead").alias("deceased_flag"),
        F.lit(True).alias("is_current"), "_batch_id",
    )
    finger = privacy.row_fingerprint([F.col(c) for c in ("patient_sk", *PERSON, "zip3", "age_band")])
    return privacy.guard_identifiers(out.withColumn("row_hash", finger), {"patient_id", "postal_code", "birth_date", "family_name", "given_name"})


def conformed_encounter(spark: SparkSession, d: str) -> DataFrame:
    """Standing encounters, cleansed, before the referential and window checks."""
    held = latest(
        table(spark, d, "encounter"), key_of(F.col("encounter_id")), micros(F.col("_ingest_ts")),
        {
            "patient_id": id_of(F.col("patient_id")), "provider_id": id_of(F.col("provider_id")), "organization_id": id_of(F.col("organization_id")),
            "care_setting": attribute_of(F.col("care_setting")), "admit_ts": F.col("admit_ts").cast("timestamp"), "discharge_ts": F.col("discharge_ts").cast("timestamp"), "change": F.lower(F.trim("_change_type")),
        },
        "encounter_id",
    ).filter("change is null or change <> 'delete'")
    return held.select(
        F.sha2("encounter_id", 256).alias("encounter_sk"), sk(F.col("patient_id")).alias("patient_sk"), F.sha2(F.coalesce("provider_id", F.lit("")), 256).alias("provider_sk"),
        F.sha2(F.coalesce("organization_id", F.lit("")), 256).alias("organization_sk"), "care_setting", "admit_ts", "discharge_ts",
    )


def encounter_windows(stays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stays with a valid window, the others): one without a start is not valid, whether or not
    it has an end."""
    good, bad = rel.window_violations(stays, "admit_ts", "discharge_ts")
    return good.filter("admit_ts is not null"), bad.unionByName(good.filter("admit_ts is null"))


@layer("silver.encounter")
def silver_encounter(spark: SparkSession, d: str) -> DataFrame:
    known = rel.referential_keep(conformed_encounter(spark, d), silver_patient(spark, d), "patient_sk")
    return encounter_windows(known)[0]


def conformed_lab(spark: SparkSession, d: str) -> DataFrame:
    held = latest(
        table(spark, d, "lab_result"), key_of(F.col("lab_result_id")), micros(F.col("_ingest_ts")),
        {
            "patient_id": id_of(F.col("patient_id")), "encounter_id": key_of(F.col("encounter_id")), "loinc_code": id_of(F.col("loinc_code")),
            "value_num": F.col("value_num").cast("double"), "unit": F.trim("unit"), "resulted_ts": F.col("resulted_ts").cast("timestamp"),
        },
        "lab_result_id",
    )
    return held.select(
        F.sha2("lab_result_id", 256).alias("lab_result_sk"), sk(F.col("patient_id")).alias("patient_sk"), F.sha2("encounter_id", 256).alias("encounter_sk"), "loinc_code", "value_num", "unit", "resulted_ts"
    )


def lab_status(spark: SparkSession, d: str) -> DataFrame:
    """Conformed results with what becomes of them; an encounter is one that Silver holds."""
    return rel.two_parent_status(conformed_lab(spark, d), silver_patient(spark, d), "patient_sk", silver_encounter(spark, d), "encounter_sk")


@layer("silver.lab_result")
def silver_lab(spark: SparkSession, d: str) -> DataFrame:
    return lab_status(spark, d).filter("status = 'good'").drop("status")


@layer("gold.fact_encounter")
def fact_encounter(spark: SparkSession, d: str) -> DataFrame:
    s = F.unix_timestamp("discharge_ts") - F.unix_timestamp("admit_ts")
    return silver_encounter(spark, d).select(
        F.col("encounter_sk").alias("encounter_key"), F.col("patient_sk").alias("patient_key"), F.col("provider_sk").alias("provider_key"), F.col("organization_sk").alias("organization_key"),
        F.col("care_setting").alias("care_setting_key"), date_key(F.col("admit_ts")).alias("admit_date_key"), date_key(F.col("discharge_ts")).alias("discharge_date_key"),
        "admit_ts", "discharge_ts", F.coalesce(s, F.lit(0)).alias("los_s"),
    )


@layer("gold.fact_lab_result")
def fact_lab(spark: SparkSession, d: str) -> DataFrame:
    return silver_lab(spark, d).select(
        F.col("lab_result_sk").alias("lab_result_key"), F.col("patient_sk").alias("patient_key"), F.col("encounter_sk").alias("encounter_key"), F.col("loinc_code").alias("lab_test_key"),
        "value_num", "unit", "resulted_ts", date_key(F.col("resulted_ts")).alias("result_date_key"),
    )


@layer("gold.fact_readmission")
def fact_readmission(spark: SparkSession, d: str) -> DataFrame:
    stays = fact_encounter(spark, d).filter("care_setting_key = 'inpatient'")
    out = rel.next_event_within(stays, "patient_key", "admit_ts", "discharge_ts", "encounter_key", 30.0, "readmission_30d")
    return out.select("encounter_key", "patient_key", "admit_ts", "discharge_ts", "readmission_30d", F.col("readmission_30d").cast("int").alias("readmission_30d_count"))


@layer("gold.fact_survey_response")
def fact_survey(spark: SparkSession, d: str) -> DataFrame:
    """Total score per standing administration with answers."""
    adm = latest(
        table(spark, d, "survey_administration"), key_of(F.col("administration_id")), micros(F.col("_ingest_ts")),
        {"patient_id": id_of(F.col("patient_id")), "instrument": id_of(F.col("instrument_name")), "wave": attribute_of(F.col("wave")), "administered_ts": F.col("administered_ts").cast("timestamp"), "change": F.lower(F.trim("_change_type"))},
        "administration_id",
    ).filter("change is null or change <> 'delete'")
    answers = latest(
        table(spark, d, "survey_response"), key_of(F.col("response_id")), micros(F.col("_ingest_ts")), {"administration_id": key_of(F.col("administration_id")), "value_num": F.col("value_num").cast("double")}, "response_id"
    )
    score = answers.filter("administration_id is not null and value_num is not null").groupBy("administration_id").agg(F.sum(F.col("value_num").cast("decimal(18,4)")).cast("double").alias("total_score"))
    return adm.join(score, "administration_id").filter("patient_id is not null").select(
        F.sha2("administration_id", 256).alias("survey_response_key"), sk(F.col("patient_id")).alias("patient_key"), F.col("instrument").alias("instrument_key"), "wave", "administered_ts", "total_score"
    )


@layer("gold.dim_patient")
def dim_patient(spark: SparkSession, d: str) -> DataFrame:
    return silver_patient(spark, d).filter("is_current").select(F.col("patient_sk").alias("patient_key"), *PERSON, "age_band", "birth_year", "zip3", "deceased_flag")


@layer("gold.mart_patient_360")
def patient_360(spark: SparkSession, d: str) -> DataFrame:
    visits, results = fact_encounter(spark, d), fact_lab(spark, d)
    v = visits.groupBy("patient_key").agg(
        F.count("*").alias("encounter_count"), F.count_if(F.col("care_setting_key") == "inpatient").alias("inpatient_count"), F.count_if(F.col("care_setting_key") == "emergency").alias("ed_count"),
        (F.sum("los_s") / F.count("*") / 86400).alias("avg_los_days"), F.min("admit_ts").alias("first_admit"), F.max("admit_ts").alias("last_admit"),
    )
    r = results.groupBy("patient_key").agg(F.count("*").alias("lab_count"), F.count_distinct("lab_test_key").alias("distinct_tests"))
    out = dim_patient(spark, d).join(v, "patient_key", "left").join(r, "patient_key", "left")
    return out.na.fill(0, ["encounter_count", "inpatient_count", "ed_count", "lab_count", "distinct_tests"])


@layer("gold.mart_utilization")
def utilization(spark: SparkSession, d: str, k: int = 11) -> DataFrame:
    who = dim_patient(spark, d).select("patient_key", "age_band", "sex")
    cells = fact_encounter(spark, d).select("patient_key", "care_setting_key", "los_s").join(who, "patient_key").groupBy("age_band", "sex", "care_setting_key").agg(
        F.count("*").alias("n"), (F.sum("los_s") / F.count("*") / 86400).alias("avg_los_days")
    )
    return rel.suppress_small_cells(cells, "n", k, ["avg_los_days"])


@layer("gold.mart_prom_trajectory")
def trajectory(spark: SparkSession, d: str) -> DataFrame:
    out = rel.baseline_delta(fact_survey(spark, d), ["patient_key", "instrument_key"], "wave", "total_score")
    return out.withColumn("baseline_score", F.round("baseline_score", 6)).withColumn("change", F.round("change", 6))


@layer("gold.mart_clinical_survey_linkage")
def linkage(spark: SparkSession, d: str) -> DataFrame:
    return patient_360(spark, d).select("patient_key", "encounter_count", "lab_count").join(fact_survey(spark, d).select("patient_key", "instrument_key", "wave", "total_score"), "patient_key")


@layer("ml.ft_utilization_90d")
def ft_trailing_90d(spark: SparkSession, d: str) -> DataFrame:
    """Utilisation of the 90 days before each admission; one row per patient and day, the last."""
    setting = F.col("care_setting_key")
    out = rel.trailing(
        fact_encounter(spark, d), "patient_key", "admit_ts", 90 * 86_400,
        {"encounters_90d": F.lit(1), "inpatient_90d": (setting == "inpatient").cast("int"), "ed_90d": (setting == "emergency").cast("int"), "los_s_90d": F.col("los_s")},
    ).withColumn("feature_as_of", F.to_date("admit_ts"))
    names = ["encounters_90d", "inpatient_90d", "ed_90d", "los_s_90d"]
    last = out.groupBy("patient_key", "feature_as_of").agg(F.max(F.struct("admit_ts", "encounter_key", *names)).alias("m"))
    return last.select("patient_key", date_key(F.col("feature_as_of")).alias("as_of_key"), *[F.coalesce(F.col("m")[c], F.lit(0)).cast("long").alias(c) for c in names])


@layer("ml.ft_lab_trends")
def ft_lab_trend_180d(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value_num").cast("decimal(18,4)")
    out = rel.trailing(
        fact_lab(spark, d).filter("resulted_ts is not null"), "patient_key", "resulted_ts", 180 * 86_400,
        {"labs_180d": F.lit(1), "_s": (v * 10_000).cast("long"), "_n": v.isNotNull().cast("int")}, {"tests_180d": F.col("lab_test_key")}, include_now=True,
    )
    return out.select("patient_key", "lab_result_key", "labs_180d", "tests_180d", F.when(F.col("_n") > 0, F.col("_s") / 10_000.0 / F.col("_n")).alias("mean_value_180d"))


@layer("ml.ft_prom_scores")
def ft_latest_score(spark: SparkSession, d: str) -> DataFrame:
    """Latest score per patient and instrument, by time of administration, then by wave order."""
    rank = F.array_position(F.array(*[F.lit(w) for w in WAVE_ORDER]), F.col("wave"))
    last = fact_survey(spark, d).groupBy("patient_key", "instrument_key").agg(F.max(F.struct("administered_ts", rank.alias("rank"), "survey_response_key", "wave", "total_score")).alias("m"))
    return last.select("patient_key", "instrument_key", "m.wave", "m.total_score")


@layer("ml.ft_comorbidity_index")
def ft_weighted_codes(spark: SparkSession, d: str) -> DataFrame:
    weight = F.lit(0)
    for code, w in WEIGHTS.items():
        weight = F.when(F.col("lab_test_key").startswith(code), w).otherwise(weight)
    return fact_lab(spark, d).groupBy("patient_key").agg(
        F.max(date_key(F.col("resulted_ts"))).alias("as_of_key"), F.sum(weight).cast("long").alias("code_weight"), F.count_distinct("lab_test_key").alias("distinct_codes")
    )


@layer("ml.ft_medication_adherence")
def ft_density(spark: SparkSession, d: str) -> DataFrame:
    return fact_lab(spark, d).groupBy("patient_key").agg(F.max(date_key(F.col("resulted_ts"))).alias("as_of_key"), F.count("*").alias("events"), F.lit(1.0).alias("adherence"))


@layer("ml.ft_patient_demographics")
def ft_demographics(spark: SparkSession, d: str) -> DataFrame:
    return dim_patient(spark, d).select("patient_key", "sex", "race", "ethnicity", "age_band", "birth_year", "zip3", F.col("deceased_flag").cast("int").alias("deceased_flag"), F.lit(20250101).alias("as_of_key"))


