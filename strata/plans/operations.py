"""Queries that run sources, sinks, contracts, registries, gates and the generator end to end, with
their SQL twins."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.functions import privacy
from strata.operators import cohort as ch
from strata.operators import contracts, ml, rules, scanner
from strata.operators import governance as gov
from strata.operators import relational as rel
from strata.plans import layers as L
from strata.plans import pipeline
from strata.plans.lake import Lake
from strata.plans.problems import table
from strata.plans.reference_sql import _ALL, _COHORT_LAB, _P, _PVL, _lab_rules, _pat_rules
from strata.plans.reference_sql import _enc_rules as _stay_rules
from strata.sources import files, landing, synth
from strata.sources.store import shared_store
from strata.streaming import ingest

PEOPLE = 200  # generated in the synth queries


def store_modes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a table after each way of writing it, and what changed since its first version."""
    store, orders = shared_store(spark, "modes"), table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    steps = [("absent", int(store.exists("gold", "orders")), store.version("gold", "orders"))]
    for step, df, mode in (("append", orders, "append"), ("again", orders.filter("o_orderstatus = 'F'"), "append"), ("ignore", orders, "ignore"), ("overwrite", orders.filter("o_orderstatus = 'O'"), "overwrite")):
        store.write(df, "gold", "orders", mode=mode, partition_by=["o_orderstatus"])
        steps.append((step, store.read("gold", "orders").count(), store.version("gold", "orders")))
    steps.append(("pinned", store.read("gold", "orders", 0).count(), 0))
    gone = store.changes("gold", "orders", 0).groupBy("_change").agg(F.count("*").alias("n")).collect()
    steps += [(f"changed_{r['_change']}", r["n"], 2) for r in gone]
    return spark.createDataFrame(steps, "step string, n long, version int")


def landing_replay(spark: SparkSession, d: str) -> DataFrame:
    """Rows that each entity's landing file adds to Bronze, and adds when it comes again."""
    store = shared_store(spark, "bronze")
    pipeline.land(spark, d, f"{store.root}/in")
    first, again = (landing.ingest_directory(store, f"{store.root}/in", b) for b in ("b1", "b2"))
    systems = {e: store.read("bronze", f"{e}_raw").select("_source_system").first()[0] for e, n in first.items() if n}
    rows = [(e, n, again[e], systems.get(e)) for e, n in first.items()]
    return spark.createDataFrame(rows, "entity string, added long, added_again long, source_system string")


def file_scan(spark: SparkSession, d: str) -> DataFrame:
    """Customers as lines of text files in folders by nation, scanned for phone-shaped values;
    one nation's folder is left out and another's files are allowed."""
    store = shared_store(spark, "scan")
    c = table(spark, d, "customer")
    line = F.concat(F.lit("call +1 (555) "), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("-"), F.lpad((F.col("c_custkey") % 10_000).cast("string"), 4, "0"))
    c.select("c_nationkey", F.when(F.col("c_custkey") % 2 == 0, line).otherwise(F.col("c_name")).alias("value")).write.partitionBy("c_nationkey").text(f"{store.root}/texts")
    found = scanner.scan_files(spark, [f"{store.root}/texts"], ["c_nationkey=1/"], ["c_nationkey=2"])
    return found.groupBy("pattern").agg(F.count("*").alias("lines"))


def contract_check(spark: SparkSession, d: str) -> DataFrame:
    """Breaches of the Silver contracts, and of the patient's by rows that don't keep it."""
    frames = {"patient": L.silver_patient(spark, d), "encounter": L.silver_encounter(spark, d), "lab_result": L.silver_lab(spark, d)}
    frames["broken"] = frames["patient"].withColumn("age_band", F.when(F.col("sex") != "female", F.col("age_band"))).unionByName(frames["patient"])
    out = None
    for name, df in frames.items():
        c = contracts.load(config.shipped(f"contracts/silver_{'patient' if name == 'broken' else name}.yml"))
        got = contracts.violations(contracts.require(df, c, types=True), c).groupBy().agg(F.sum("failed").alias("failed"), F.count("*").alias("checks")).select(F.lit(name).alias("table_name"), "failed", "checks")
        out = got if out is None else out.unionByName(got)
    return out


def free_text_nulled(spark: SparkSession, d: str) -> DataFrame:
    """Documents without their text, past the guard against direct identifiers."""
    docs = privacy.guard_identifiers(privacy.without_free_text(table(spark, d, "documents").select("source", "text", "n_chars"), ["text"]), {"patient_id", "family_name"})
    return docs.groupBy("source").agg(F.count("*").alias("n"), F.count("text").alias("texts"), F.sum("n_chars").alias("n_chars"))


def dq_results(spark: SparkSession, d: str) -> DataFrame:
    """What the gate keeps of the shipped rules over Silver as stored."""
    lake = Lake(shared_store(spark, "lake"))
    for f in pipeline.SILVER:
        lake.store.write(f(spark, d), *f.at.split("."))
    pipeline.validate_silver(lake, enforce=False)
    return lake.store.read("ops", "dq_results").select("table_name", "rule_id", "severity", "rows_failed", "rows_scanned", "status")


def cohort_reproduced(spark: SparkSession, d: str) -> DataFrame:
    """A cohort from stored Gold, registered with a manifest and built again from the versions
    that it names: 0 says that it came out the same."""
    lake = Lake(shared_store(spark, "lake"))
    for f in (L.dim_patient, L.fact_encounter, L.fact_lab, L.fact_survey):
        lake.store.write(f(spark, d), *f.at.split("."))
    c = ch.parse({"name": "lab", "inclusion": [{"type": "has_lab_loinc", "value": "4548-4"}], "irb": "p1"})
    path = f"{lake.store.root}/lab.json"
    pipeline.build_cohort(lake.store, c, path)
    # a later load must not matter
    lake.store.write(lake.store.read("gold", "fact_lab_result").limit(0), "gold", "fact_lab_result", mode="overwrite")
    same = pipeline.reproduce_cohort(lake.store, c, path)
    drifted = pipeline.reproduce_cohort(lake.store, ch.parse({"name": "lab", "inclusion": [{"type": "has_lab_loinc", "value": "718-7"}]}), path)
    registry = lake.store.read("ops", "cohort_registry").select("name", "version", "rows")
    held = lake.store.read("gold", "cohort_lab").groupBy("cohort_name", "cohort_version").agg(F.count("*").alias("members"))
    return registry.join(held, F.col("name") == F.col("cohort_name")).select("name", "version", "rows", "members", F.lit(same).alias("same"), F.lit(drifted).alias("drifted"))


def table_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Tables against the hours they may be old at a fixed time."""
    store = shared_store(spark, "fresh")
    for t in ("patient", "encounter"):
        store.write(table(spark, d, t).select(F.col("_ingest_ts").cast("timestamp").alias("_ingest_ts")), "bronze", t)
    got = gov.freshness(spark, store, {"bronze.patient": 24 * 3650, "bronze.encounter": 1, "bronze.lab": 8}, datetime(2030, 1, 1))
    return spark.createDataFrame([(t, there, fresh) for t, there, _, _, fresh in got], "table_name string, there boolean, fresh boolean")


def break_glass(spark: SparkSession, d: str) -> DataFrame:
    """Requests for re-identification of some patients: logged ones are let through, others not."""
    store = shared_store(spark, "ops")
    row = gov.request_access("officer", "PAT-1", "adverse event under investigation", "lead")
    log = spark.createDataFrame([row], "request_id string, at string, principal string, subject string, justification string, officer string")
    store.write(log, "ops", "reid_request_log")
    out = []
    for name, call in {"known": lambda: gov.require_request(store.read("ops", "reid_request_log"), row[0]), "unknown": lambda: gov.require_request(store.read("ops", "reid_request_log"), "x' or '1'='1"), "short": lambda: gov.request_access("officer", "PAT-1", "why not   ", "lead")}.items():
        try:
            call()
            out.append((name, True))
        except (PermissionError, ValueError):
            out.append((name, False))
    return spark.createDataFrame(out, "request string, allowed boolean")


def numeric_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of a model's columns with nulls as zero, taken apart again."""
    rows = L.patient_360(spark, d).select("patient_key", "avg_los_days", "birth_year", "lab_count")
    v = vector_to_array("features")
    return ml.vectorised(rows, ["avg_los_days", "birth_year", "lab_count"]).select("patient_key", v[0].alias("a"), v[1].alias("b"), v[2].alias("c"))


def stream_expect_fail(spark: SparkSession, d: str) -> DataFrame:
    """A stream whose expectation holds comes through, one whose doesn't stops."""
    store, schema = shared_store(spark, "stream"), table(spark, d, "events").schema
    source = lambda: spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    ingest.run_available(ingest.expect_or_fail(source(), "no id", F.col("event_id").isNotNull()), lambda df, _: store.write(df.select("event_id"), "bronze", "kept"), f"{store.root}/cp1")
    try:
        ingest.run_available(ingest.expect_or_fail(source(), "no user", F.col("user_id") < 0), lambda df, _: store.write(df.select("event_id"), "bronze", "lost"), f"{store.root}/cp2")
        stopped = False
    except Exception as e:
        stopped = "no user" in str(e)
    return store.read("bronze", "kept").agg(F.count("*").alias("kept")).select("kept", F.lit(stopped).alias("stopped"), F.lit(store.exists("bronze", "lost")).alias("lost_any"))


def extract_rows(spark: SparkSession, d: str) -> DataFrame:
    """An extract of a hundred rows at most as CSV, read again."""
    store = shared_store(spark, "extract")
    pipeline.extract(L.dim_patient(spark, d), f"{store.root}/csv", 100)
    return spark.read.csv(f"{store.root}/csv", header=True).agg(F.count("*").alias("n"), F.count("patient_key").alias("keys"))


def artifact_files(spark: SparkSession, d: str) -> DataFrame:
    """Names of the artifacts written, and how many characters they have is more than none."""
    store = shared_store(spark, "artifacts")
    gov.write_artifacts(spark, f"{store.root}/out", [("a.b", "c.d", "f")])
    card = ml.model_card("m", "1", "use", ["x"], {"n": 1})
    files.write_text(spark, f"{store.root}/out/m.md", card)
    return spark.createDataFrame([(n, bool(files.read_text(spark, f"{store.root}/out/{n}"))) for n in files.names(spark, f"{store.root}/out")], "name string, filled boolean")


def business_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of the encounters that are no technical ones, after the guard for those."""
    tagged = rel.with_technical_columns(table(spark, d, "encounter"), source_system="x", batch_id="b", version="1")
    return spark.createDataFrame([(c,) for c in rel.business_columns(rel.require_columns(tagged, rel.TECHNICAL))], "name string")


def rule_listing(spark: SparkSession, d: str) -> DataFrame:
    """Rules of all shipped rulesets."""
    return spark.createDataFrame([(t, r.id, r.type, r.severity) for t, own in rules.listed(config.shipped("rules")).items() for r in own], "table_name string, rule_id string, type string, severity string")


def synth_patients(spark: SparkSession, d: str) -> DataFrame:
    """Generated people: every value is a hash of seed, name and number."""
    return synth.patients(spark, PEOPLE).select("patient_id", "sex", "race", "birth_year", "deceased_flag")


def synth_totals(spark: SparkSession, d: str) -> DataFrame:
    """Of generated surveys, whether totals, bands, windows and consent agree with the answers."""
    people = synth.patients(spark, PEOPLE)
    consent = synth.consents(people)
    asked = synth.administrations(people, consent)
    answers = synth.responses(asked)
    scores = synth.scores(asked, answers)
    own = answers.groupBy("administration_id").agg(F.sum("value_num").alias("s"), F.count("*").alias("n"))
    declined = asked.join(consent.filter("consent_status <> 'granted'"), "patient_id", "left_semi")
    wrong = scores.join(own, "administration_id").agg(F.count_if(F.col("total_score") != F.col("s")).alias("wrong_totals"))
    phq = scores.filter("instrument_name = 'PHQ-9'").agg(F.count_if((F.col("severity_band") == "severe") != (F.col("total_score") >= 20)).alias("wrong_bands"))
    parts = [wrong.select(F.lit("totals").alias("what"), F.col("wrong_totals").alias("wrong")), phq.select(F.lit("bands").alias("what"), F.col("wrong_bands").alias("wrong")), declined.agg(F.count("*").alias("wrong")).select(F.lit("consent").alias("what"), "wrong")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def synth_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Generated results whose encounter doesn't exist are those that the generator marked."""
    visits = synth.encounters(synth.patients(spark, PEOPLE))
    labs = synth.with_orphans(synth.labs(visits, synth.LABS), "lab_result_id", "encounter_id", 0.05)
    lost = rel.referential_orphans(labs, visits, "encounter_id")
    return lost.agg((F.count("*") > 0).alias("any_lost"), F.count_if(~F.col("encounter_id").startswith("ORPHAN-")).alias("unmarked"))


QUERIES = {
    f.__name__: f
    for f in (
        store_modes, landing_replay, file_scan, contract_check, free_text_nulled, dq_results, cohort_reproduced, table_freshness, break_glass, numeric_matrix, stream_expect_fail, extract_rows, artifact_files,
        business_columns, rule_listing, synth_patients, synth_totals, synth_orphans,
    )
}


def _uniform(tag: str, n: str = "i") -> str:
    return f"(('0x' || substr(sha256('42|{tag}|' || {n}), 1, 12))::bigint / 16::double ** 12)"


def _pick(tag: str, options: list[str]) -> str:
    return f"list_extract([{', '.join(f'{chr(39)}{o}{chr(39)}' for o in options)}], floor({_uniform(tag)} * {len(options)})::int + 1)"


_LANDED = ("patient", "encounter", "lab_result", "observation", "survey_administration", "survey_response")
_RESULTS = " union all ".join(
    f"select 'silver.{t}' table_name, r.rule_id, rows_failed, rows_scanned from ({sql}) r" for t, sql in (("patient", _pat_rules("silver_patient")), ("encounter", _stay_rules("silver_encounter")), ("lab_result", _lab_rules("silver_lab")))
)
_RULES = [
    ("patient", "key_present", "not_null", "error", 1.0), ("patient", "one_current_row", "unique", "error", 1.0), ("patient", "known_sex", "allowed_values", "warn", 0.9), ("patient", "birth_year_of_a_living_memory", "between", "error", 1.0),
    ("patient", "three_digit_area", "regex", "warn", 0.99), ("encounter", "key_present", "not_null", "error", 1.0), ("encounter", "patient_present", "not_null", "error", 1.0), ("encounter", "one_row_a_stay", "unique", "error", 1.0),
    ("encounter", "ends_after_it_starts", "expression", "error", 1.0), ("encounter", "not_yet_to_come", "expression", "warn", 0.99), ("encounter", "known_setting", "allowed_values", "warn", 0.8), ("lab_result", "key_present", "not_null", "error", 1.0),
    ("lab_result", "patient_present", "not_null", "error", 1.0), ("lab_result", "test_named", "not_null", "warn", 0.95), ("lab_result", "one_row_a_result", "unique", "error", 1.0), ("lab_result", "value_in_bounds", "between", "warn", 0.98),
]
_RULE_VALUES = "(values " + ", ".join(f"('{t}', '{i}', '{k}', '{s}', {x})" for t, i, k, s, x in _RULES) + ") v(t, i, k, s, x)"

SQL = {
    "store_modes": """with o as (select count(*) n, count(*) filter (o_orderstatus = 'F') f, count(*) filter (o_orderstatus = 'O') o from orders)
      select 'absent' step, 0::bigint n, -1 "version" union all select 'append', n, 0 from o union all select 'again', n + f, 1 from o union all select 'ignore', n + f, 1 from o union all select 'overwrite', o, 2 from o
      union all select 'pinned', n, 0 from o union all select 'changed_delete', n - o, 2 from o""",
    "landing_replay": "select e entity, coalesce(n, 0)::bigint added, 0::bigint added_again, case when n is not null then case when e like 'survey_%' then 'survey_sim' else 'synthea_sim' end end source_system from (values "
    + ", ".join(f"('{e}')" for e in landing.ENTITIES) + ") t(e) left join (" + " union all ".join(f"select '{t}' e, count(*) n from (select distinct * from {t})" for t in _LANDED) + ") using (e)",
    "file_scan": "select 'phone' pattern, count(*) \"lines\" from customer where c_custkey % 2 = 0 and c_nationkey not in (1, 2) having count(*) > 0",
    "contract_check": _PVL + """select 'patient' table_name, 0::bigint failed, 6::bigint checks union all select 'encounter', 0, 5 union all select 'lab_result', 0, 3
      union all select 'broken', count(*) filter (sex = 'female' or sex is null) + count(*), 6 from silver_patient""",
    "free_text_nulled": "select source, count(*) n, 0::bigint texts, sum(n_chars)::bigint n_chars from documents group by 1",
    "dq_results": _ALL + f"select table_name, rule_id, s severity, rows_failed, rows_scanned, case when rows_scanned = 0 or (rows_scanned - rows_failed) / rows_scanned >= x then 'pass' else 'fail' end status from ({_RESULTS}) m join {_RULE_VALUES} on 'silver.' || t = table_name and i = rule_id",
    "cohort_reproduced": _PVL + f"select 'lab' \"name\", 1 \"version\", count(*) \"rows\", count(*) members, 0 same, 3 drifted from ({_COHORT_LAB})",
    "table_freshness": """select 'bronze.patient' table_name, true there, epoch(timestamp '2030-01-01' - max(_ingest_ts)) / 3600 <= 87600 fresh from patient
      union all select 'bronze.encounter', true, epoch(timestamp '2030-01-01' - max(_ingest_ts)) / 3600 <= 1 from encounter union all select 'bronze.lab', false, false""",
    "break_glass": "select * from (values ('known', true), ('unknown', false), ('short', false)) t(request, allowed)",
    "numeric_matrix": _ALL + "select patient_key, coalesce(avg_los_days, 0) a, coalesce(birth_year, 0)::double b, lab_count::double c from mart_360",
    "stream_expect_fail": "select count(*) kept, true stopped, false lost_any from events",
    "extract_rows": _P + "select least(count(*), 100) n, least(count(*), 100) \"keys\" from dim_patient",
    "artifact_files": "select *, true filled from (values ('cost.sql'), ('grants.sql'), ('lineage.md'), ('linkage.sql'), ('m.md'), ('readmission.sql'), ('scores.sql'), ('utilization.sql')) t(name)",
    "business_columns": "select unnest(['encounter_id', 'patient_id', 'provider_id', 'organization_id', 'care_setting', 'admit_ts', 'discharge_ts', 'encounter_class', 'source_system']) \"name\"",
    "rule_listing": f"select t table_name, i rule_id, k \"type\", s severity from {_RULE_VALUES}",
    "synth_patients": f"""select 'SYN-PAT-' || lpad(i::varchar, 6, '0') patient_id, {_pick('sex', synth.SEXES)} sex, {_pick('race', synth.RACES)} race, (1930 + floor({_uniform('by')} * 80))::int birth_year, {_uniform('dead')} < 0.03 deceased_flag
      from (select unnest(range(1, {PEOPLE + 1})) i)""",
    "synth_totals": "select what, 0::bigint wrong from (values ('totals'), ('bands'), ('consent')) t(what)",
    "synth_orphans": "select true any_lost, 0::bigint unmarked",
}
