"""The pN_ queries of the core problems over the clinical tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import attribute_of, id_of, key_of, micros
from strata.operators import profile
from strata.operators.asof import as_known
from strata.operators.current import latest
from strata.operators.history import deliveries, history, load, satellite, timeline
from strata.operators.intervals import periods_and_gaps
from strata.operators.orphans import orphan_references
from strata.operators.rolling import each_day, trailing_runs
from strata.operators.spikes import implausible, readings
from strata.sources.store import Store, shared_store

ATTRIBUTES = {"slow": ["sex", "race", "ethnicity"], "fast": ["zip3", "age_band"]}
FIRST_DAY, LAST_DAY = "2023-01-01", "2024-12-31"


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    """A raw table of a folder, or of any source with a `table` of its own."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet") if isinstance(sf_dir, str) else sf_dir.table(name)


def standing_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, patient, admit, discharge): times in epoch microseconds."""
    held = latest(
        table(spark, sf_dir, "encounter"), key_of(F.col("encounter_id")), micros(F.col("_ingest_ts")),
        {"patient": id_of(F.col("patient_id")), "admit": micros(F.col("admit_ts")), "discharge": micros(F.col("discharge_ts")), "change": F.lower(F.trim("_change_type"))},
    )
    return held.filter("change is null or change <> 'delete'").drop("change", "first_at")


# --- 1: attributes as known at event time

def p1_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each standing encounter with the age band known at its admission and the latest one."""
    return as_known(
        standing_encounters(spark, sf_dir), table(spark, sf_dir, "patient"),
        event_id=F.col("id"), event_entity=F.col("patient"), event_at=F.col("admit"),
        change_entity=id_of(F.col("patient_id")), valid_from=micros(F.col("valid_from")),
        recorded_at=micros(F.col("_ingest_ts")), value=attribute_of(F.col("age_band")),
    ).select(
        F.col("event_id").alias("encounter_id"), F.col("entity").alias("patient_id"), F.floor(F.col("event_at") / 1_000_000).alias("admit_s"),
        F.col("value").alias("age_band"), F.col("latest_value").alias("latest_age_band"),
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_known(spark, sf_dir).filter("age_band is not null and age_band <> latest_age_band").select("encounter_id", "age_band")


# --- 2: implausible spikes

MEASURED = {"l": ("lab_result", "lab_result_id", "resulted_ts"), "o": ("observation", "observation_id", "observed_ts")}


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of both tables as one; a letter before ids and codes tells the tables apart."""
    parts = [
        readings(
            table(spark, sf_dir, name), row_id=F.concat(F.lit(tag), key_of(F.col(row_id))), source=F.lower(F.trim("source_system")),
            code=F.concat(F.lit(tag), F.coalesce(F.upper(F.trim("loinc_code")), F.lit(""))), entity=id_of(F.col("patient_id")), at=micros(F.col(at)), value=F.col("value_num"),
        )
        for tag, (name, row_id, at) in MEASURED.items()
    ]
    return parts[0].unionByName(parts[1])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at fault for any reason."""
    tag = F.substring("id", 1, 1)
    name = F.when(tag == "l", MEASURED["l"][0]).otherwise(MEASURED["o"][0])
    found = implausible(_readings(spark, sf_dir)).select("id").distinct()
    return found.select(name.alias("table_name"), F.expr("substring(id, 2)").alias("row_id"))


# --- 3: history of attributes

def _vault(spark: SparkSession, sf_dir: str) -> Store:
    """A store with the satellites of all patient deliveries, loaded as one batch."""
    store = shared_store(spark, "vault")
    batch = deliveries(
        table(spark, sf_dir, "patient"), entity=id_of(F.col("patient_id")), valid_from=micros(F.col("valid_from")), recorded_at=micros(F.col("_ingest_ts")),
        attributes={c: attribute_of(F.col(c)) for cols in ATTRIBUTES.values() for c in cols},
    )
    load(store, "patient", batch, ATTRIBUTES)
    return store


def _spell(df: DataFrame, *columns: str) -> DataFrame:
    s = lambda c: F.floor(F.col(c) / 1_000_000)
    return df.select(
        F.col("entity").alias("patient_id"), s("valid_from").alias("valid_from_s"), F.coalesce(s("valid_to"), F.lit(-1)).cast("long").alias("valid_to_s"), *columns
    )


def p3_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full history with its attributes."""
    return _spell(history(_vault(spark, sf_dir), "patient", ATTRIBUTES), *[c for cols in ATTRIBUTES.values() for c in cols])


def p3_satellite_slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    slow = ATTRIBUTES["slow"]
    return _spell(timeline(satellite(_vault(spark, sf_dir), "patient", "slow", slow), slow), "row_hash", *slow)


def p3_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history from satellites that were loaded half-year by half-year of arrival, the latest
    first, and one of them twice: the same as from one load."""
    store = shared_store(spark, "vault")
    rows = table(spark, sf_dir, "patient")
    for part in ("2024-07", "2024-01", "2023-07", "2024-01", ""):
        end = {"2024-07": "9", "2024-01": "2024-07", "2023-07": "2024-01", "": "2023-07"}[part]
        arrived = F.coalesce(F.date_format("_ingest_ts", "yyyy-MM"), F.lit(""))
        batch = deliveries(
            rows.filter((arrived >= part) & (arrived < end)), entity=id_of(F.col("patient_id")), valid_from=micros(F.col("valid_from")), recorded_at=micros(F.col("_ingest_ts")),
            attributes={c: attribute_of(F.col(c)) for cols in ATTRIBUTES.values() for c in cols},
        )
        load(store, "patient", batch, ATTRIBUTES)
    return _spell(history(store, "patient", ATTRIBUTES))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spell(history(_vault(spark, sf_dir), "patient", ATTRIBUTES))


# --- 4: intervals

def p4_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods and gaps, with the number of encounters in each."""
    got = periods_and_gaps(standing_encounters(spark, sf_dir), entity=F.col("patient"), start=F.col("admit"), end=F.col("discharge"))
    s = lambda c: F.floor(F.col(c) / 1_000_000)
    return got.select(F.col("entity").alias("patient_id"), "kind", s("start").alias("start_s"), s("end").alias("end_s"), F.col("intervals").alias("encounters"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_periods(spark, sf_dir).filter("kind = 'gap' or encounters >= 2").drop("encounters")


# --- 5: rolling totals

def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda c: F.to_date(F.timestamp_micros(c))
    admitted = standing_encounters(spark, sf_dir).select("patient", day("admit").alias("day")).groupBy("patient", "day").agg(F.count("*").alias("n"))
    lab = table(spark, sf_dir, "lab_result").select(
        id_of(F.col("patient_id")).alias("patient"), day(micros(F.col("resulted_ts"))).alias("day"), key_of(F.col("lab_result_id")).alias("id")
    )
    resulted = lab.filter("patient is not null and day is not null").groupBy("patient", "day").agg(F.count_distinct("id").alias("n"))
    zero = F.lit(0).cast("long")
    return admitted.select("patient", "day", F.col("n").alias("admissions"), zero.alias("results")).unionByName(
        resulted.select("patient", "day", zero.alias("admissions"), F.col("n").alias("results"))
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trailing_runs(
        _activity(spark, sf_dir), entity="patient", day="day", measures=["admissions", "results"], periods=[7, 30],
        first_day=FIRST_DAY, last_day=LAST_DAY,
    )


def _day_key() -> F.Column:
    return F.date_format("day", "yyyyMMdd").cast("long").alias("day_key")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = lambda p: F.col(f"admissions_{p}") + F.col(f"results_{p}")
    quiet = _runs(spark, sf_dir).filter(
        (F.col("admissions") + F.col("results") == 0) & (total(7) >= 5) & (total(7) * 30 >= total(30) * 14)
    )
    return each_day(quiet).select(F.col("entity").alias("patient_id"), _day_key())


def p5_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and daily means for every patient with activity and every calendar day."""
    days = each_day(_runs(spark, sf_dir))
    measures = [f"{m}_{p}" for m in ("admissions", "results") for p in (7, 30)]
    return days.select(
        F.col("entity").alias("patient_id"), _day_key(), "admissions", "results", *measures,
        *[(F.col(m) / int(m.rsplit("_", 1)[1])).alias(f"{m}_mean") for m in measures],
    )


# --- 6: column profile

# fixed values: the documented domains
RACES = ["white", "black", "asian", "other", "unknown"]
UNITS = ["mg/dL", "mmol/L", "umol/L", "g/dL", "g/L", "mg/L", "10*3/uL", "%"]
STATUSES = ["complete", "partial", "missed"]
RATIO = {"lab_result": 1.5, "observation": 1.2}


def _domains() -> dict:
    """Per table.column the condition that valid values meet."""
    v = F.col("value")
    return {
        "patient.race": v.isin(RACES), "patient.zip3": v.rlike(r"\A[0-9]{3}\z"), "lab_result.unit": v.isin(UNITS), "survey_administration.completion_status": v.isin(STATUSES),
    }


def _profiled(spark: SparkSession, sf_dir: str, columns: dict[str, list[str]]) -> DataFrame:
    """Profiles of all the tables' columns at once: their counts are one frame, in which a number
    stands for a table's column."""
    names = [f"{t}.{c}" for t, own in columns.items() for c in own]
    number = {n: i for i, n in enumerate(names)}
    counts = [profile.value_counts(table(spark, sf_dir, t), "_batch_id", own, [number[f"{t}.{c}"] for c in own]) for t, own in columns.items()]
    domains = {number[n]: ok for n, ok in _domains().items() if n in number}
    both = F.split(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("column_name") + 1), "[.]")
    return profile.shares(reduce(DataFrame.unionByName, counts), domains).withColumns({"table_name": both[0], "column_name": both[1]}).withColumnRenamed("load", "batch_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"patient": ["race", "zip3"], "lab_result": ["unit", "value_num"], "observation": ["value_num"], "survey_administration": ["completion_status"]}
    counted = F.col("batch_id").rlike(r"\Aload-20(23|24)(0[1-9]|1[0-2])\z")
    profiled = _profiled(spark, sf_dir, columns).filter(counted & (F.col("rows") >= 100))
    tests = {
        "nulls": F.abs(F.col("nulls") / F.col("rows") - F.col("whole_nulls") / F.col("whole_rows")) > 0.10,
        "domain": F.col("breaches") > 0.05 * (F.col("rows") - F.col("nulls")),
        "shift": (F.col("column_name") == "completion_status") & (F.col("variation") > 0.25),
    }
    found = F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))
    by_share = profiled.select("table_name", "column_name", "batch_id", F.explode(found).alias("finding"))

    names = ["_batch_id", "value_num", "loinc_code", "source_system"]
    values = reduce(DataFrame.unionByName, [table(spark, sf_dir, t).select(*names, F.lit(t).alias("table_name")) for t in RATIO])
    most = F.when(F.col("table_name") == "lab_result", RATIO["lab_result"]).otherwise(RATIO["observation"])
    ratio = F.col("load_median") / F.col("whole_median")
    shifted = profile.load_medians(values, "_batch_id", "value_num", ["table_name", "loinc_code", "source_system"]).withColumnRenamed("load", "batch_id").filter(
        counted & (F.col("n") >= 25) & (F.col("whole_median") != 0) & ~ratio.between(1 / most, most)
    )
    large = values.groupBy("table_name", F.col("_batch_id").alias("batch_id")).agg(F.count("*").alias("rows")).filter("rows >= 100")
    by_median = shifted.select("table_name", "batch_id").distinct().join(large, ["table_name", "batch_id"]).select(
        "table_name", F.lit("value_num").alias("column_name"), "batch_id", F.lit("shift").alias("finding")
    )
    return by_share.unionByName(by_median)


#: Columns of the large tables in whose profile the loads themselves are not a column.
PROFILED = {
    "patient": ["patient_id", "sex", "race", "ethnicity", "birth_year", "age_band", "zip3", "deceased_flag", "valid_from", "valid_to", "is_current", "row_hash", "_ingest_ts"],
    "encounter": ["encounter_id", "patient_id", "provider_id", "organization_id", "care_setting", "admit_ts", "discharge_ts", "encounter_class", "source_system", "_change_type", "_ingest_ts"],
    "lab_result": ["lab_result_id", "patient_id", "encounter_id", "loinc_code", "display", "value_num", "unit", "resulted_ts", "source_system", "_ingest_ts"],
    "observation": ["observation_id", "patient_id", "encounter_id", "loinc_code", "display", "value_num", "unit", "observed_ts", "source_system", "_ingest_ts"],
    "survey_administration": ["administration_id", "patient_id", "instrument_id", "instrument_name", "wave", "administered_ts", "completion_status", "straight_lining_flag", "out_of_window_flag", "irb_protocol_id", "source_system", "_change_type", "_ingest_ts"],
    "survey_response": ["response_id", "administration_id", "patient_id", "instrument_id", "item_id", "value_num", "source_system", "_ingest_ts"],
}


def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the large tables: each load's figures against the whole table's. They are
    rounded a hair above, since sums that end in a half come out on either side of it."""
    near = lambda c, digits: F.round(F.col(c) + 10.0 ** -(digits + 4), digits).alias(c)
    return _profiled(spark, sf_dir, PROFILED).select(
        "table_name", "column_name", "batch_id", "rows", "nulls", "distinct_values", "breaches", "min_value", "max_value", "min_number", "max_number",
        near("variation", 6), near("psi", 6), near("chi_square", 3),
    )


# --- 7: orphan references

def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = micros(F.col("_ingest_ts"))
    parts = []
    for child, own, parent, ref in (
        ("encounter", "encounter_id", "patient", "patient_id"),
        ("lab_result", "lab_result_id", "encounter", "encounter_id"),
        ("survey_response", "response_id", "survey_administration", "administration_id"),
    ):
        records = latest(table(spark, sf_dir, child), key_of(F.col(own)), seen, {"ref": key_of(F.col(ref))}, "row_id").withColumnRenamed("first_at", "seen")
        up = table(spark, sf_dir, parent)
        change = F.lower(F.trim("_change_type")) if "_change_type" in up.columns else F.lit(None).cast("string")
        parents = latest(up, key_of(F.col(ref)), seen, {"change": change}, "key").select(
            "key", F.col("first_at").alias("came"), F.expr("change is null or change <> 'delete'").alias("stands")
        )
        parts.append(orphan_references(records, parents).withColumn("table_name", F.lit(child)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "row_id", "status", F.date_format(F.timestamp_micros("seen"), "yyyyMM").cast("long").alias("period"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir)


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month and status."""
    return _orphans(spark, sf_dir).groupBy("table_name", "period", "status").agg(F.count("*").alias("records"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_known, p2_found, p3_found, p3_history, p3_satellite_slow, p3_batches, p4_found, p4_periods, p5_found, p5_rolling, p6_found, p6_profile, p7_found, p7_report)
}
