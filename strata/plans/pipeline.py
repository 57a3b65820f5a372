"""The whole chain into a store: Silver, quality gate, Gold, features, cohorts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.operators import cohort as ch
from strata.operators import contracts, rules
from strata.operators import relational as rel
from strata.plans import layers as L
from strata.plans.lake import Lake
from strata.sources import landing
from strata.sources.store import Store
from strata.streaming import ingest

SILVER = (L.silver_patient, L.silver_encounter, L.silver_lab)
GOLD = (L.dim_patient, L.fact_encounter, L.fact_lab, L.fact_readmission, L.fact_survey, L.patient_360, L.utilization, L.trajectory, L.linkage)
FEATURES = (L.ft_demographics, L.ft_trailing_90d, L.ft_lab_trend_180d, L.ft_latest_score, L.ft_weighted_codes, L.ft_density)


def rulesets() -> dict[str, list[rules.Rule]]:
    """The rules that come with the package, by Silver table."""
    return rules.listed(config.shipped("rules"))


def _publish(lake: Lake, frames: Iterable, contract: bool = False) -> dict[str, int]:
    """Each table written once, from the tables below it as they are stored."""
    out = {}
    for f in frames:
        schema, name = f.at.split(".")
        df = f.build(lake.spark, lake)
        if contract:
            contracts.require(df, contracts.load(config.shipped(f"contracts/{schema}_{name}.yml")), types=True)
        out[name] = lake.store.write(df, schema, name, mode="overwrite")
    return out


def build_silver(lake: Lake, batch_id: str) -> dict[str, int]:
    """Crosswalk and Silver tables from Bronze, held to their contracts, and what they reject with
    reason and payload."""
    spark, store = lake.spark, lake.store
    out = {**_publish(lake, [L.patient_xref]), **_publish(lake, SILVER, contract=True)}
    conformed, patients = L.conformed_encounter(spark, lake), L.silver_patient(spark, lake)
    rejected = {
        ("encounter", "orphan_patient"): rel.referential_orphans(conformed, patients, "patient_sk"),
        ("encounter", "window"): L.encounter_windows(conformed)[1],
        ("lab_result", "orphan_parent"): L.lab_status(spark, lake).filter("status <> 'good'").drop("status"),
    }
    for (entity, reason), bad in rejected.items():
        out[f"{entity}_{reason}"] = store.write(rel.quarantined(bad, entity=entity, reason=reason, batch_id=batch_id), "quarantine", f"{entity}_{reason}")
    return out


def validate_silver(lake: Lake, ruled: Mapping[str, list[rules.Rule]] | None = None, *, enforce: bool = True, alert=None) -> dict[str, rules.Report]:
    """Measures every table by the given rules or those shipped, keeps all results, and only then
    blocks."""
    store = lake.store
    reports = {t: rules.validate(store.read("silver", t), r, f"silver.{t}") for t, r in (rulesets() if ruled is None else ruled).items()}
    for r in reports.values():
        store.write(rules.report_frame(store.spark, r), "ops", "dq_results")
    if enforce:
        for r in reports.values():
            rules.gate(r, alert)
    return reports


def build_gold(lake: Lake, ruled: Mapping[str, list[rules.Rule]] | None = None, *, enforce: bool = True, alert=None) -> dict[str, int]:
    """Gold from the stored Silver, once it has passed the gate; without `enforce` also if it has
    not, which the run log then tells with the failures of error rules by table."""
    reports = validate_silver(lake, ruled, enforce=enforce, alert=alert)
    if over := {r.table: sum(x.failed for x in r.blocking) for r in reports.values() if not r.passed}:
        log_run(lake.store, "gate", over, status="passed over")
    return _publish(lake, GOLD)


def build_features(lake: Lake) -> dict[str, int]:
    return _publish(lake, FEATURES)


def run(lake: Lake, landing_folder: str, batch_id: str, *, enforce: bool = True) -> dict[str, int]:
    """Landing files to Bronze, Silver, gate, Gold and features; each step logged. Without
    `enforce` the gate measures and keeps its results, but blocks nothing."""
    out: dict[str, int] = {}
    for step, build in {
        "bronze": lambda: landing.ingest_directory(lake.store, landing_folder, batch_id), "silver": lambda: build_silver(lake, batch_id),
        "gold": lambda: build_gold(lake, enforce=enforce), "features": lambda: build_features(lake),
    }.items():
        got = build()
        log_run(lake.store, step, got)
        out |= {f"{step}.{t}": n for t, n in got.items()}
    return out


def land(spark: SparkSession, folder: str, into: str, tables: Iterable[str] = ("patient", "encounter", "lab_result", "observation", "survey_administration", "survey_response")) -> None:
    """Tables of a folder as landing files: CSV with header, texts as they are."""
    for t in tables:
        df = spark.read.parquet(f"{folder}/{t}.parquet")
        side = "survey" if t.startswith("survey_") else "clinical"
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""'}
        df.write.mode("overwrite").options(**options).csv(f"{into}/{side}/{t}.csv")


def stream(lake: Lake, landing_folder: str, checkpoint: str, batch_id: str, required: Mapping[str, str], builds: Mapping[str, Iterable] | None = None) -> None:
    """Every entity's new files to Bronze, each by a stream with a checkpoint of its own, and after
    each of its batches the tables in `builds` from what Bronze then holds. A second run takes only
    what is new. `required`: per entity the column without which a row is dropped."""
    for entity, column in required.items():
        after = list((builds or {}).get(entity, ()))
        sink = ingest.entity_sink(lake.store, entity, batch_id, column, (lambda after=after: _publish(lake, after)) if after else None)
        ingest.run_available(ingest.new_files(lake.spark, f"{landing_folder}/{entity}*.csv"), sink, f"{checkpoint}/{entity}")


def cohort_criteria(store: Store, versions: Mapping[str, int] | None = None) -> dict[str, Callable]:
    """Criteria over Gold tables, at pinned versions if given."""
    read = lambda t: store.read("gold", t, (versions or {}).get(t))
    return {
        "has_lab_loinc": lambda v: read("fact_lab_result").filter(F.col("lab_test_key") == v),
        "has_survey_instrument": lambda v: read("fact_survey_response").filter(F.col("instrument_key") == v),
        "min_inpatient_encounters": lambda v: ch.having(read("fact_encounter").filter("care_setting_key = 'inpatient'"), "patient_key", int(v)),
        "deceased": lambda _: read("dim_patient").filter("deceased_flag"),
    }


def build_cohort(store: Store, cohort: ch.Cohort, manifest: str | Path) -> ch.Manifest:
    """Writes the members with their provenance, registers the cohort and keeps a manifest with
    the versions of its inputs."""
    inputs = {t: store.version("gold", t) for t in ("fact_lab_result", "fact_survey_response", "fact_encounter", "dim_patient")}
    members = ch.compile_cohort(cohort, "patient_key", cohort_criteria(store, inputs))
    store.write(ch.with_provenance(members, cohort), "gold", f"cohort_{cohort.name}", mode="overwrite")
    got = ch.mergeable_checksum(store.read("gold", f"cohort_{cohort.name}").select("patient_key")).first()
    m = ch.Manifest("cohort", cohort.name, cohort.digest, inputs, got["rows"], got["checksum"])
    m.save(manifest)
    row = (cohort.name, cohort.version, cohort.digest, m.rows, m.checksum, m.made_at)
    store.write(store.spark.createDataFrame([row], "name string, version int, definition_hash string, rows long, checksum string, made_at string"), "ops", "cohort_registry")
    return m


def reproduce_cohort(store: Store, cohort: ch.Cohort, manifest: str | Path) -> int:
    """Builds the cohort again from the pinned input versions; see `cohort.reproduce`."""
    return ch.reproduce(manifest, cohort, lambda inputs: ch.compile_cohort(cohort, "patient_key", cohort_criteria(store, inputs)))


def log_run(store: Store, step: str, rows: Mapping[str, int], status: str = "ok") -> None:
    at = datetime.now(UTC).isoformat()
    store.write(store.spark.createDataFrame([(step, t, int(n), status, at) for t, n in rows.items()], "step string, table_name string, rows long, status string, ts string"), "ops", "pipeline_run_log")


def extract(df: DataFrame, path: str, most: int = 100) -> None:
    """The first rows as CSV, for a look."""
    df.limit(most).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
