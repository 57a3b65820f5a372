"""The layered queries in plain SQL."""

from __future__ import annotations

from strata.functions.privacy import SEP, SMALL_ZIP3, hmac_blocks
from strata.functions.text import NULL_TOKENS
from strata.operators.scanner import PATTERNS
from strata.plans.layers import WEIGHTS, pepper
from strata.plans.problems_sql import _attr, _id, _key

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
PEPPER = pepper()
_INNER, _OUTER = (b.hex() for b in hmac_blocks(PEPPER))


def _hmac(c: str) -> str:
    return f"(case when {c} <> '' then sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({c})))) end)"


def _s(c: str) -> str:
    return f"floor(epoch({c}))::bigint"


def _dk(c: str) -> str:
    return f"(year({c}) * 10000 + month({c}) * 100 + day({c}))::int"


def _bucket(text: str, n: int) -> str:
    return f"(('0x' || substr(sha256({text}), 1, 8))::bigint % {n})"


def _days(key: str) -> str:
    return f"({_bucket(f'{chr(39)}{PEPPER}|shift|{chr(39)} || {key}', 731)} - 365)::int"


_ZIPS = ", ".join(f"'{z}'" for z in SMALL_ZIP3)
_AGE = "case when birth_year is null or 2024 - birth_year < 0 then 'unknown' when 2024 - birth_year > 89 then '90+' when 2024 - birth_year < 10 then '00s' else ((2024 - birth_year) // 10 * 10)::int::varchar || 's' end"
_BOOL = "coalesce(lower(trim({c}::varchar)) in ('true', '1'), false)"

PEOPLE = f"""
who as (
  select * from (select {_id('patient_id')} pid, {_attr('sex')} sex, {_attr('race')} race, {_attr('ethnicity')} ethnicity, birth_year, trim(zip3) zip, {_BOOL.format(c='deceased_flag')} deceased_flag, _batch_id,
    row_number() over (partition by {_id('patient_id')} order by _ingest_ts desc, valid_from desc, {_attr('sex')} desc nulls last, {_attr('race')} desc nulls last, {_attr('ethnicity')} desc nulls last, birth_year desc nulls last, trim(zip3) desc nulls last) rn from patient)
  where rn = 1 and pid is not null),
silver_patient as (
  select *, sha256(concat_ws('|', patient_sk, sex, race, ethnicity, zip3, age_band)) row_hash from (
    select {_hmac('pid')} patient_sk, sex, race, ethnicity, birth_year, {_AGE} age_band, case when regexp_full_match(zip, '[0-9]{{3}}') and zip not in ({_ZIPS}) then zip end zip3, deceased_flag, true is_current, _batch_id from who)),
dim_patient as (select patient_sk patient_key, sex, race, ethnicity, age_band, birth_year, zip3, deceased_flag from silver_patient)"""

VISITS = f"""
conformed_encounter as (
  select sha256(eid) encounter_sk, {_hmac('pid')} patient_sk, sha256(coalesce(provider, '')) provider_sk, sha256(coalesce(org, '')) organization_sk, care_setting, admit_ts, discharge_ts from (
    select {_key('encounter_id')} eid, {_id('patient_id')} pid, {_id('provider_id')} provider, {_id('organization_id')} org, {_attr('care_setting')} care_setting, admit_ts, discharge_ts, _change_type,
      row_number() over (partition by {_key('encounter_id')} order by _ingest_ts desc) rn from encounter)
  where rn = 1 and eid is not null and _change_type is distinct from 'delete'),
silver_encounter as (select * from conformed_encounter where patient_sk in (select patient_sk from silver_patient) and admit_ts is not null and (discharge_ts is null or discharge_ts >= admit_ts)),
fact_encounter as (
  select encounter_sk encounter_key, patient_sk patient_key, provider_sk provider_key, organization_sk organization_key, care_setting care_setting_key, {_dk('admit_ts')} admit_date_key, {_dk('discharge_ts')} discharge_date_key,
    admit_ts, discharge_ts, coalesce({_s('discharge_ts')} - {_s('admit_ts')}, 0) los_s from silver_encounter),
fact_readmission as (
  select encounter_key, patient_key, admit_ts, discharge_ts, coalesce({_s('nxt')} - {_s('coalesce(discharge_ts, admit_ts)')} <= 2592000, false) readmission_30d from (
    select *, lead(admit_ts) over (partition by patient_key order by admit_ts, encounter_key) nxt from fact_encounter where care_setting_key = 'inpatient'))"""

LABS = f"""
conformed_lab as (
  select sha256(lid) lab_result_sk, {_hmac('pid')} patient_sk, case when eid is not null then sha256(eid) end encounter_sk, loinc_code, value_num, unit, resulted_ts from (
    select {_key('lab_result_id')} lid, {_id('patient_id')} pid, {_key('encounter_id')} eid, {_id('loinc_code')} loinc_code, value_num, trim(unit) unit, resulted_ts,
      row_number() over (partition by {_key('lab_result_id')} order by _ingest_ts desc) rn from lab_result)
  where rn = 1 and lid is not null),
lab_status as (
  select *, case when patient_sk is null or patient_sk not in (select patient_sk from silver_patient) then 'no_first'
    when encounter_sk is not null and encounter_sk not in (select encounter_sk from silver_encounter) then 'no_second' else 'good' end status from conformed_lab),
silver_lab as (select lab_result_sk, patient_sk, encounter_sk, loinc_code, value_num, unit, resulted_ts from lab_status where status = 'good'),
fact_lab as (
  select lab_result_sk lab_result_key, patient_sk patient_key, encounter_sk encounter_key, loinc_code lab_test_key, value_num, unit, resulted_ts, {_dk('resulted_ts')} result_date_key from silver_lab)"""

SURVEYS = f"""
adm as (
  select * from (select {_key('administration_id')} aid, {_id('patient_id')} pid, {_id('instrument_name')} instrument, {_attr('wave')} wave, administered_ts, _change_type,
    row_number() over (partition by {_key('administration_id')} order by _ingest_ts desc) rn from survey_administration)
  where rn = 1 and aid is not null and pid is not null and _change_type is distinct from 'delete'),
ans as (
  select * from (select {_key('response_id')} rid, {_key('administration_id')} aid, value_num, row_number() over (partition by {_key('response_id')} order by _ingest_ts desc) rn from survey_response) where rn = 1 and rid is not null),
score as (select aid, sum(value_num::decimal(18, 4))::double total_score from ans where aid is not null and value_num is not null group by 1),
fact_survey as (select sha256(aid) survey_response_key, {_hmac('pid')} patient_key, instrument instrument_key, wave, administered_ts, total_score from adm join score using (aid)),
trajectory as (
  select *, round(total_score - base, 6) change, abs(total_score - base) >= 5 changed_markedly, round(base, 6) baseline_score from (
    select *, avg(case when wave = 'baseline' then total_score end) over (partition by patient_key, instrument_key) base, count(*) over (partition by patient_key, instrument_key) stages from fact_survey))"""

MARTS = """
v360 as (select patient_key, count(*) encounter_count, count(*) filter (care_setting_key = 'inpatient') inpatient_count, count(*) filter (care_setting_key = 'emergency') ed_count,
  (sum(los_s) / count(*) / 86400)::double avg_los_days, min(admit_ts) first_admit, max(admit_ts) last_admit from fact_encounter group by 1),
l360 as (select patient_key, count(*) lab_count, count(distinct lab_test_key) distinct_tests from fact_lab group by 1),
mart_360 as (
  select p.*, coalesce(encounter_count, 0) encounter_count, coalesce(inpatient_count, 0) inpatient_count, coalesce(ed_count, 0) ed_count, avg_los_days, first_admit, last_admit, coalesce(lab_count, 0) lab_count, coalesce(distinct_tests, 0) distinct_tests
  from dim_patient p left join v360 using (patient_key) left join l360 using (patient_key)),
utilization as (
  select age_band, sex, care_setting_key, case when n >= 11 then n end n, case when n >= 11 then m end avg_los_days from (
    select age_band, sex, care_setting_key, count(*) n, (sum(los_s) / count(*) / 86400)::double m from fact_encounter join dim_patient using (patient_key) group by 1, 2, 3))"""

_P, _PV, _PVL = f"with {PEOPLE} ", f"with {PEOPLE}, {VISITS} ", f"with {PEOPLE}, {VISITS}, {LABS} "
_S = f"with {SURVEYS} "
_ALL = f"with {PEOPLE}, {VISITS}, {LABS}, {SURVEYS}, {MARTS} "


def _hash(*columns: str) -> str:
    return f"sha256(concat_ws('{SEP}', {', '.join(f'coalesce({c}::varchar, {chr(39)}{chr(39)})' for c in columns)}))"


def _norm(c: str) -> str:
    return f"case when upper(trim({c})) in ({_TOKENS}) then null else {c} end {c}"


def _re2(p: str) -> str:
    """The pattern without look-around, with a neighbour that is no digit instead."""
    for a, b in ((r"(?<!\d)", r"(?:^|\D)"), (r"(?!\d)", r"(?:\D|$)")):
        p = p.replace(a, b)
    return p.replace("'", "''")


_SSN = r"(?:^|\D)(?:00[1-9]|0[1-9]\d|[1-5]\d\d|6[0-57-9]\d|66[0-57-9]|[78]\d\d)-(?:0[1-9]|[1-9]\d)-(?:000[1-9]|00[1-9]\d|0[1-9]\d\d|[1-9]\d{3})(?:\D|$)"
_LINES = "lines as (select doc_id, unnest(l) line, unnest(range(1, len(l) + 1)) line_no from (select doc_id, regexp_split_to_array(text, '\\r\\n|\\n|\\r') l from documents where text is not null))"
_HITS = " union all ".join(
    f"select doc_id, line_no, '{n}' pattern, substr(line, 1, 120) snippet from lines where regexp_matches(line, '{_SSN if n == 'ssn' else _re2(p)}')" for n, p in PATTERNS.items()
)
_SCAN = f"with {_LINES}, hits as ({_HITS}) "

_W90 = "(partition by patient_key order by floor(epoch(admit_ts))::bigint range between 7776000 preceding and 1 preceding)"
_W180 = "(partition by patient_key order by floor(epoch(resulted_ts))::bigint range between 15552000 preceding and current row)"
_BACK = f"""back as (
  select patient_key, {_dk('admit_ts')} as_of_key, encounters_90d, coalesce(inpatient_90d, 0)::bigint inpatient_90d, coalesce(ed_90d, 0)::bigint ed_90d from (
    select *, row_number() over (partition by patient_key, admit_ts::date order by admit_ts desc, encounter_key desc) rn from (
      select patient_key, encounter_key, admit_ts, count(*) over w encounters_90d, sum((care_setting_key = 'inpatient')::int) over w inpatient_90d, sum((care_setting_key = 'emergency')::int) over w ed_90d
      from fact_encounter window w as {_W90})) where rn = 1)"""
_PERSONS = "persons as (select patient_key, birth_year, sex, age_band, ascii(patient_key) % 3 bucket from dim_patient)"
_WEIGHT = "case " + " ".join(f"when lab_test_key like '{k}%' then {w}" for k, w in WEIGHTS.items()) + " else 0 end"
_LABEL = f"{_bucket('''o_custkey::varchar || ':' || o_orderkey::varchar || ':noshow' ''', 100)} < 20"
_SCORED = f"scored as (select o_orderkey, o_orderstatus, o_orderpriority, ({_LABEL})::int y, {_bucket('''('s' || o_orderkey::varchar)''', 64)} / 64.0::double p from orders)"
_COHORT_LAB = "select distinct patient_key from fact_lab where lab_test_key = '4548-4' and patient_key is not null"
_MOOD = "select patient_key from fact_survey where instrument_key = 'MOOD-8'"
_BANK = "select c_custkey, c_acctbal s, c_mktsegment from customer"


def _values(rows: list[tuple]) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "(values " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows) + ")"


def _rule(i: str, failed: str, scanned: str = "count(*)", source: str = "conformed_encounter") -> str:
    return f"select '{i}' rule_id, ({failed})::bigint rows_failed, ({scanned})::bigint rows_scanned from {source}"


def _enc_rules(source: str) -> str:
    return " union all ".join([
        _rule("key_present", "count(*) filter (encounter_sk is null)", source=source), _rule("patient_present", "count(*) filter (patient_sk is null)", source=source),
        _rule("one_row_a_stay", "count(*) - count(distinct encounter_sk)", source=source), _rule("ends_after_it_starts", "count(*) filter (not (discharge_ts is null or discharge_ts >= admit_ts))", source=source),
        _rule("not_yet_to_come", "count(*) filter (not (admit_ts is null or admit_ts <= now()::timestamp))", source=source),
        _rule("known_setting", "count(*) filter (care_setting not in ('inpatient', 'outpatient', 'emergency', 'ambulatory'))", "count(care_setting)", source),
    ])


def _lab_rules(source: str) -> str:
    return " union all ".join([
        _rule("key_present", "count(*) filter (lab_result_sk is null)", source=source), _rule("patient_present", "count(*) filter (patient_sk is null)", source=source),
        _rule("test_named", "count(*) filter (loinc_code is null)", source=source), _rule("one_row_a_result", "count(*) - count(distinct lab_result_sk)", source=source),
        _rule("value_in_bounds", "count(*) filter (value_num < -1 or value_num > 10000)", "count(value_num)", source),
    ])


def _pat_rules(source: str) -> str:
    return " union all ".join([
        _rule("key_present", "count(*) filter (patient_sk is null)", source=source), _rule("one_current_row", "count(*) filter (is_current) - count(distinct case when is_current then patient_sk end)", "count(*) filter (is_current)", source),
        _rule("known_sex", "count(*) filter (sex not in ('female', 'male', 'other', 'unknown'))", "count(sex)", source), _rule("birth_year_of_a_living_memory", "count(*) filter (birth_year < 1900 or birth_year > 2024)", "count(birth_year)", source),
        _rule("three_digit_area", "count(*) filter (not regexp_matches(zip3, '^[0-9]{3}$'))", "count(zip3)", source),
    ])


# what each table of the layers reads, stated by hand
_READS = {
    "restricted.patient_xref patient_xref": "bronze.patient_raw", "silver.patient silver_patient": "bronze.patient_raw", "silver.encounter silver_encounter": "bronze.encounter_raw silver.patient",
    "silver.lab_result silver_lab": "bronze.lab_result_raw silver.patient silver.encounter", "gold.dim_patient dim_patient": "silver.patient", "gold.fact_encounter fact_encounter": "silver.encounter",
    "gold.fact_lab_result fact_lab": "silver.lab_result", "gold.fact_readmission fact_readmission": "gold.fact_encounter", "gold.fact_survey_response fact_survey": "bronze.survey_administration_raw bronze.survey_response_raw",
    "gold.mart_patient_360 patient_360": "gold.fact_encounter gold.fact_lab_result gold.dim_patient", "gold.mart_utilization utilization": "gold.dim_patient gold.fact_encounter",
    "gold.mart_prom_trajectory trajectory": "gold.fact_survey_response", "gold.mart_clinical_survey_linkage linkage": "gold.mart_patient_360 gold.fact_survey_response",
    "ml.ft_patient_demographics ft_demographics": "gold.dim_patient", "ml.ft_utilization_90d ft_trailing_90d": "gold.fact_encounter", "ml.ft_lab_trends ft_lab_trend_180d": "gold.fact_lab_result",
    "ml.ft_prom_scores ft_latest_score": "gold.fact_survey_response", "ml.ft_comorbidity_index ft_weighted_codes": "gold.fact_lab_result", "ml.ft_medication_adherence ft_density": "gold.fact_lab_result",
}
_GRANTED = [
    ("engineers", "*.bronze.*", "ALL_PRIVILEGES", "ingest"), ("engineers", "*.silver.*", "ALL_PRIVILEGES", "conform"), ("engineers", "*.gold.*", "ALL_PRIVILEGES", "publish"),
    ("engineers", "*.ops.*", "ALL_PRIVILEGES", "run the pipeline"), ("stewards", "*.silver.*", "SELECT", "review quality"), ("stewards", "*.ops.dq_results", "SELECT", "own the scorecard"),
    ("researchers", "*.gold.*", "SELECT", "de-identified research"), ("modellers", "*.ml.*", "ALL_PRIVILEGES", "features and models"), ("analysts", "*.gold.mart_utilization", "SELECT", "suppressed aggregates"),
    ("auditors", "*.ops.*", "SELECT", "audit"), ("officers", "*.restricted.patient_xref", "SELECT", "justified re-identification"),
]
_STATEMENTS = [
    *[f"GRANT {p.replace('_', ' ')} ON {'SCHEMA main.' + a.split('.')[1] if a.endswith('.*') else 'TABLE main' + a[1:]} TO `{g}`;" for g, a, p, _ in _GRANTED],
    "CREATE OR REPLACE FUNCTION main.ops.birth_year_for_stewards(x INT) RETURNS INT RETURN CASE WHEN is_account_group_member('engineers') OR is_account_group_member('stewards') THEN x END;",
    "ALTER TABLE main.silver.patient ALTER COLUMN birth_year SET MASK main.ops.birth_year_for_stewards;",
    "CREATE OR REPLACE FUNCTION main.ops.area_for_researchers(x STRING) RETURNS STRING RETURN CASE WHEN is_account_group_member('engineers') OR is_account_group_member('researchers') THEN x END;",
    "ALTER TABLE main.gold.dim_patient ALTER COLUMN zip3 SET MASK main.ops.area_for_researchers;",
    "CREATE OR REPLACE FUNCTION main.ops.own_cohorts(x STRING) RETURNS BOOLEAN RETURN EXISTS (SELECT 1 FROM main.ops.cohort_access a WHERE is_account_group_member(a.principal_group) AND a.active AND a.name = x);",
    "ALTER TABLE main.gold.cohort_registry SET ROW FILTER main.ops.own_cohorts ON (name);",
]
_EDGES = [(source, *target.split()) for target, sources in _READS.items() for source in sources.split()]
_PERSON = ("sex", "race", "ethnicity", "zip3", "age_band")

_CHAIN_360 = _ALL + f"select patient_key, sex, race, ethnicity, age_band, birth_year, zip3, deceased_flag, encounter_count, inpatient_count, ed_count, avg_los_days, {_s('first_admit')} first_admit_s, {_s('last_admit')} last_admit_s, lab_count, distinct_tests from mart_360"

SQL = {
    "null_token_norm": f"select sex, race, ethnicity, zip3, age_band, count(*) n from (select {', '.join(_norm(c) for c in _PERSON)} from patient) group by all",
    "trim_lower": "select lower(trim(completion_status)) completion_status, lower(trim(wave)) wave, count(*) n from survey_administration group by 1, 2",
    "parse_timestamps": f"select distinct lab_result_id, {_s('resulted_ts')} at_s from lab_result",
    "record_hash": f"select c_custkey, {_hash('c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment')} hash from customer",
    "record_hash_nulltoken": f"select distinct administration_id, sha256(concat_ws('{SEP}', {', '.join(f'coalesce(nullif({c}, {chr(39)}{chr(39)}), {chr(39)}<NULL>{chr(39)})' for c in ('administration_id', 'completion_status', 'wave'))})) hash from survey_administration",
    "row_fingerprint": "select distinct patient_id, sha256(concat_ws('|', patient_id, sex, race, ethnicity, zip3, age_band)) hash from patient",
    "hmac_surrogate": f"select c_custkey, {_hmac('c_name')} key from customer",
    "patient_xref": f"select {_hmac('i')} patient_sk, i source_patient_id from (select distinct {_id('patient_id')} i from patient) where i is not null",
    "day_shift": f"select o_orderkey, {_days('o_custkey::varchar')} as days, {_dk(f'(o_orderdate::date + {_days(chr(111) + "_custkey::varchar")})')} shifted_key from orders",
    "zip3_mask": f"select case when z in ({_ZIPS}) then null else z end zip3, count(*) n from (select substr(trim(zip3), 1, 3) z from patient) group by 1",
    "age_band": f"select birth_year, {_AGE} band, count(*) n from patient group by 1, 2",
    "boolean_norm": f"select deceased_flag::varchar raw, {_BOOL.format(c='deceased_flag')} flag, count(*) n from patient group by 1, 2",
    "masked_dim": _P + "select age_band, null::varchar zip3, null::int birth_year, count(*) n from dim_patient group by 1",
    "dedupe_latest": f"select l_orderkey, l_linenumber, {_s('l_shipdate')} l_shipdate_s, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc) rn from lineitem) where rn = 1",
    "distinct_hash": f"select distinct {_hash('encounter_id', 'patient_id', 'provider_id', 'care_setting', '_change_type')} _record_hash from encounter",
    "anti_seen": f"with h as (select _batch_id, {_hash('encounter_id', 'patient_id', 'care_setting', '_change_type')} _record_hash from encounter) select distinct _batch_id, _record_hash from h where _batch_id >= 'load-202401' and _record_hash not in (select _record_hash from h where _batch_id < 'load-202401')",
    "referential_keep": _PV + "select care_setting, count(*) n from conformed_encounter where patient_sk in (select patient_sk from silver_patient) group by 1",
    "referential_orphans": _PV + "select encounter_sk, patient_sk, care_setting from conformed_encounter where patient_sk is null or patient_sk not in (select patient_sk from silver_patient)",
    "two_parent_split": _PVL + "select status, loinc_code, count(*) n from lab_status group by 1, 2",
    "window_violations": _PV + f"select encounter_sk, {_s('admit_ts')} admit_ts_s, {_s('discharge_ts')} discharge_ts_s from conformed_encounter where not coalesce(discharge_ts is null or discharge_ts >= admit_ts, false)",
    "silver_patient": _P + "select patient_sk, sex, race, ethnicity, birth_year, age_band, zip3, deceased_flag, is_current, _batch_id, row_hash from silver_patient",
    "silver_encounter": _PV + f"select encounter_sk, patient_sk, provider_sk, organization_sk, care_setting, {_s('admit_ts')} admit_ts_s, {_s('discharge_ts')} discharge_ts_s from silver_encounter",
    "stream_silver_encounter": _PV + f"select encounter_sk, patient_sk, provider_sk, organization_sk, care_setting, {_s('admit_ts')} admit_ts_s, {_s('discharge_ts')} discharge_ts_s from silver_encounter",
    "silver_lab": _PVL + f"select lab_result_sk, patient_sk, encounter_sk, loinc_code, value_num, unit, {_s('resulted_ts')} resulted_ts_s from silver_lab",
    "dim_date": "select (year(d) * 10000 + month(d) * 100 + day(d))::int date_key, year(d)::int \"year\", month(d)::int \"month\", day(d)::int day_of_month, weekofyear(d)::int iso_week, dayname(d) day_name, month(d) >= 10 or month(d) <= 3 is_flu_season from (select unnest(generate_series(date '2020-01-01', date '2026-12-31', interval 1 day))::date d)",
    "dim_care_setting": "select * from (values ('inpatient', 'Inpatient', true), ('outpatient', 'Outpatient', false), ('emergency', 'Emergency', true), ('ambulatory', 'Ambulatory', false)) t(care_setting_key, name, is_acute)",
    "dim_lab_test": _PVL + "select loinc_code lab_test_key, min(unit) unit, count(*) results from silver_lab group by 1",
    "dim_patient": _P + "select * from dim_patient",
    "fact_encounter": _PV + f"select encounter_key, patient_key, provider_key, organization_key, care_setting_key, admit_date_key, discharge_date_key, {_s('admit_ts')} admit_ts_s, {_s('discharge_ts')} discharge_ts_s, los_s from fact_encounter",
    "fact_lab": _PVL + f"select lab_result_key, patient_key, encounter_key, lab_test_key, value_num, unit, {_s('resulted_ts')} resulted_ts_s, result_date_key from fact_lab",
    "fact_readmission": _PV + f"select encounter_key, patient_key, {_s('admit_ts')} admit_ts_s, {_s('discharge_ts')} discharge_ts_s, readmission_30d, readmission_30d::int readmission_30d_count from fact_readmission",
    "fact_survey": _S + f"select survey_response_key, patient_key, instrument_key, wave, {_s('administered_ts')} administered_ts_s, total_score from fact_survey",
    "mart_patient_360": _CHAIN_360,
    "mart_strata_suppressed": _ALL + "select * from utilization",
    "mart_trajectory": _S + f"select survey_response_key, patient_key, instrument_key, wave, {_s('administered_ts')} administered_ts_s, total_score, baseline_score, change, changed_markedly, stages from trajectory",
    "mart_linkage": _ALL + "select patient_key, encounter_count, lab_count, instrument_key, wave, total_score from mart_360 join fact_survey using (patient_key)",
    "ft_demographics": _P + "select patient_key, sex, race, ethnicity, age_band, birth_year, zip3, deceased_flag::int deceased_flag, 20250101 as_of_key from dim_patient",
    "ft_trailing90": _PV + f""", back as (
      select patient_key, encounter_key, admit_ts, count(*) over w encounters_90d, sum((care_setting_key = 'inpatient')::int) over w inpatient_90d, sum((care_setting_key = 'emergency')::int) over w ed_90d, sum(los_s) over w los_s_90d
      from fact_encounter window w as {_W90}),
      last as (select *, row_number() over (partition by patient_key, admit_ts::date order by admit_ts desc, encounter_key desc) rn from back)
      select patient_key, {_dk('admit_ts')} as_of_key, coalesce(encounters_90d, 0)::bigint encounters_90d, coalesce(inpatient_90d, 0)::bigint inpatient_90d, coalesce(ed_90d, 0)::bigint ed_90d, coalesce(los_s_90d, 0)::bigint los_s_90d from last where rn = 1""",
    "ft_trailing180_distinct": _PVL + f"""select patient_key, lab_result_key, count(*) over w labs_180d, count(distinct lab_test_key) over w tests_180d, (sum(value_num::decimal(18, 4)) over w)::double / count(value_num) over w mean_value_180d
      from fact_lab where resulted_ts is not null window w as {_W180}""",
    "ft_latest_score": _S + """select patient_key, instrument_key, wave, total_score from (
      select *, row_number() over (partition by patient_key, instrument_key order by administered_ts desc nulls last, list_position(['baseline', 'day_30', 'day_90', 'day_180', 'day_365'], wave) desc nulls last, survey_response_key desc) rn from fact_survey) where rn = 1""",
    "ft_weighted_codes": _PVL + f"select patient_key, max({_dk('resulted_ts')}) as_of_key, sum({_WEIGHT})::bigint code_weight, count(distinct lab_test_key) distinct_codes from fact_lab group by 1",
    "ft_density": _PVL + f"select patient_key, max({_dk('resulted_ts')}) as_of_key, count(*) events, 1.0::double adherence from fact_lab group by 1",
    "metric_readmission_30d": _PV + "select count(*) denominator, sum(readmission_30d::int)::bigint numerator, sum(readmission_30d::int)::double / nullif(count(*), 0) rate from fact_readmission",
    "metric_avg_los": _PV + "select (sum(los_s) / count(*) / 86400)::double avg_los_days, count(*) encounters from fact_encounter where care_setting_key = 'inpatient'",
    "metric_ed_utilization": _ALL + "select avg(ed_count) mean_ed_encounters, sum(ed_count)::bigint total_ed_encounters, count(*) patients from mart_360",
    "metric_response_rate": _S + "select count(distinct patient_key) patients_with_scores, count(*) scored_responses from fact_survey",
    "metric_mean_change": _S + "select instrument_key, sum(change::decimal(18, 4))::double / count(*) mean_change, count(*) filter (changed_markedly) marked, count(*) rows_n from trajectory where wave <> 'baseline' and change is not null group by 1",
    "dash_utilization": _ALL + "select age_band, sex, care_setting_key, n encounter_count, avg_los_days from utilization order by 1, 2, 3",
    "dash_readmission": _PV + "select age_band, count(*) index_stays, count(*) filter (readmission_30d) readmissions_30d, round(count(*) filter (readmission_30d) / count(*), 4)::double readmission_rate from fact_readmission join dim_patient using (patient_key) group by 1 having count(*) >= 11 order by 1",
    "dash_scores": _S + "select instrument_key, wave, count(*) n_responses, sum(total_score::decimal(18, 4))::double / count(*) mean_score, sum(change::decimal(18, 4))::double / count(change) mean_change from trajectory group by 1, 2 having count(*) >= 11 order by 1, 2",
    "dash_linkage": _ALL + "select count(distinct patient_key) patients_with_linkage, count(*) linkage_rows from mart_360 join fact_survey using (patient_key)",
    "dq_encounter": _PV + _enc_rules("conformed_encounter"),
    "dq_lab": _PVL + _lab_rules("conformed_lab"),
    "dq_patient": _P + _pat_rules("silver_patient"),
    "dq_scorecard": _PV + f""", m as ({_enc_rules('silver_encounter')}) select 'silver.encounter' table_name, rule_id,
      case when (rows_scanned - rows_failed) / rows_scanned >= case rule_id when 'known_setting' then 0.8 when 'not_yet_to_come' then 0.99 else 1.0 end then 'pass' else 'fail' end status,
      round((rows_scanned - rows_failed) / rows_scanned, 6)::double pass_rate, rows_failed from m""",
    "chain_patient_360": _CHAIN_360,
    "chain_run_log": _ALL + " union all ".join(f"select '{at}' \"at\", count(*) \"rows\" from {t}" for at, t in {
        "silver.patient": "silver_patient", "silver.encounter": "silver_encounter", "silver.lab_result": "silver_lab", "gold.dim_patient": "dim_patient", "gold.fact_encounter": "fact_encounter", "gold.fact_lab_result": "fact_lab",
        "gold.fact_readmission": "fact_readmission", "gold.fact_survey_response": "fact_survey", "gold.mart_patient_360": "mart_360", "gold.mart_utilization": "utilization", "gold.mart_prom_trajectory": "trajectory",
        "gold.mart_clinical_survey_linkage": "(select * from mart_360 join fact_survey using (patient_key))",
    }.items()),
    "cohort_lab": _PVL + _COHORT_LAB,
    "cohort_min_events": _PV + "select patient_key from fact_encounter where care_setting_key = 'inpatient' group by 1 having count(*) >= 2",
    "cohort_intersection": f"with {PEOPLE}, {VISITS}, {LABS}, {SURVEYS} {_COHORT_LAB} and patient_key in ({_MOOD})",
    "cohort_exclusion": f"with {PEOPLE}, {VISITS}, {LABS}, {SURVEYS} {_COHORT_LAB} and patient_key in ({_MOOD}) and patient_key not in (select patient_key from dim_patient where deceased_flag)",
    "frame_checksum": f"""with h as (select h, count(*) n from (select {_hash('o_custkey', 'o_orderkey', 'o_orderpriority', 'o_orderstatus')} h from orders) group by 1),
      flat as (select sha256(string_agg(h, '|' order by h)) checksum from (select h, unnest(range(n)) from h)),
      grouped as (select substr(h, 1, 3) p, sha256(string_agg(h || '*' || n, '|' order by h)) d from h group by 1)
      select case when (select sum(n) from h) <= 100000 then (select checksum from flat) else (select sha256(string_agg(p || d, '|' order by p)) from grouped) end checksum""",
    "pattern_scan_lines": _SCAN + "select doc_id, line_no::int line_no, pattern, snippet from hits",
    "pattern_scan_summary": _SCAN + "select pattern, count(*) \"lines\", count(distinct doc_id) documents from hits group by 1",
    "readmission_frame": _PVL + f""", {_BACK}, {_PERSONS},
      labs as (select patient_key, lab_result_key, {_s('resulted_ts')} t, count(*) over w labs_180d, (sum(value_num::decimal(18, 4)) over w)::double / count(value_num) over w mean_value_180d,
        sum({_WEIGHT}) over (partition by patient_key order by {_s('resulted_ts')}, lab_result_key rows unbounded preceding) code_weight from fact_lab where resulted_ts is not null and patient_key is not null window w as {_W180}),
      stays as (select encounter_key, patient_key, {_s('admit_ts')} t, {_dk('admit_ts')} as_of_key, readmission_30d::int "label" from fact_readmission),
      prior as (select encounter_key, arg_max((labs_180d, mean_value_180d, code_weight), (labs.t, lab_result_key)) x from stays join labs on labs.patient_key = stays.patient_key and labs.t <= stays.t group by 1)
      select encounter_key, patient_key, "label", birth_year, sex, age_band, encounters_90d, inpatient_90d, ed_90d, bucket, x[1]::bigint labs_180d, x[2]::double mean_value_180d, x[3]::bigint code_weight
      from stays join persons using (patient_key) left join back using (patient_key, as_of_key) left join prior using (encounter_key)""",
    "no_show_frame": f"with {PEOPLE}, {VISITS}, {SURVEYS}, {_BACK}, {_PERSONS}" + f""",
      scores as (select patient_key, sum(total_score::decimal(18, 4))::double / count(total_score) mean_score from (
        select *, row_number() over (partition by patient_key, instrument_key order by administered_ts desc nulls last, list_position(['baseline', 'day_30', 'day_90', 'day_180', 'day_365'], wave) desc nulls last, survey_response_key desc) rn from fact_survey)
        where rn = 1 group by 1),
      stays as (select encounter_key, patient_key, {_dk('admit_ts')} as_of_key, ({_bucket("patient_key || ':' || encounter_key || ':noshow'", 100)} < 20)::int "label" from fact_encounter where care_setting_key in ('outpatient', 'ambulatory'))
      select encounter_key, patient_key, "label", birth_year, sex, age_band, encounters_90d, inpatient_90d, ed_90d, bucket, mean_score
      from stays join persons using (patient_key) left join back using (patient_key, as_of_key) left join scores using (patient_key)""",
    "noshow_label": f"select o_orderkey, {_LABEL} label from orders",
    "payer_bucket": "select c_custkey, ascii(c_mktsegment) % 3 bucket from customer",
    "entity_split": f"select o_orderkey, case when {_bucket('''('42|' || o_custkey::varchar)''', 10000)} < 2500 then 'test' else 'train' end split from orders",
    "temporal_holdout": f"""with o as (select {_s('o_orderdate')} t, row_number() over (order by o_orderdate) r from orders), c as (select max(t) cut from o where r <= floor((select count(*) from o) * 0.75))
      select case when t <= cut then 'train' else 'test' end split, min(t) first_s, max(t) last_s, count(*) n from o, c group by 1""",
    "quarantine_payload": _PV + """select encounter_sk, 'orphan_patient' _quarantine_reason, '{' || concat_ws(',', '"encounter_sk":"' || encounter_sk || '"', '"care_setting":"' || care_setting || '"') || '}' _raw_payload_json
      from conformed_encounter where patient_sk is null or patient_sk not in (select patient_sk from silver_patient)""",
    "frame_checksum_mergeable": f"""with h as (select {_hash('c_custkey', 'c_mktsegment', 'c_name')} h from customer)
      select count(*) "rows", sha256(concat_ws('|', {', '.join(f"sum(('0x' || substr(h, {1 + 16 * i}, 15))::bigint)::varchar" for i in range(4))})) checksum from h""",
    "category_codes": "with codes as (select c_mktsegment, row_number() over (order by c_mktsegment) - 1 code from (select distinct c_mktsegment from customer where c_mktsegment <> 'MACHINERY')) select c_custkey, coalesce(code, -1)::int code from customer left join codes using (c_mktsegment)",
    "subgroup_metrics": f"""with {_SCORED}, long as (select 'o_orderstatus' slice, o_orderstatus level, y, p from scored union all select 'o_orderpriority', o_orderpriority, y, p from scored),
      ranked as (select *, rank() over (partition by slice, level order by p) + (count(*) over (partition by slice, level, p) - 1) / 2.0 r from long)
      select slice, level, count(*) n, round(avg(y), 6) positive_rate, round(avg(((p >= 0.5)::int = y)::int), 6) accuracy, round(avg((p - y) * (p - y)), 6) brier,
        round(case when sum(y) > 0 and sum(y) < count(*) then (sum(case when y = 1 then r end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) end, 6)::double auc from ranked group by 1, 2""",
    "nearest_pairs": f"""with recursive t as (select c_custkey, s, row_number() over (order by c_custkey) i from ({_BANK}) where c_mktsegment = 'BUILDING' and s is not null),
      c as (select c_custkey, s from ({_BANK}) where c_mktsegment = 'MACHINERY' and s is not null),
      m(i, treated, control, used) as (
        select 0::bigint, null::bigint, null::bigint, []::bigint[]
        union all
        select t.i, t.c_custkey, x.best.id, case when x.best is null then m.used else list_append(m.used, x.best.id) end from m join t on t.i = m.i + 1
          join (select t2.i, m2.used, min({{'gap': abs(c.s - t2.s), 's': c.s, 'id': c.c_custkey}}) filter (abs(c.s - t2.s) <= 5.0 and not list_contains(m2.used, c.c_custkey)) best
            from m m2 join t t2 on t2.i = m2.i + 1 cross join c group by 1, 2) x on x.i = t.i)
      select treated, control from m where control is not null""",
    "researcher_frame": _ALL + f", members as ({_COHORT_LAB}) select patient_key, encounter_count, lab_count, instrument_key, wave, change from members left join mart_360 using (patient_key) left join trajectory using (patient_key)",
    "monthly_json_rollup": "select (year(ts) * 100 + month(ts))::int month_key, (props->>'$.k')::int k, count(*) n from events group by 1, 2",
    "event_sequence": "select event_id, lag(event_id) over w \"before\", lead(event_id) over w \"after\" from events window w as (partition by user_id order by ts, event_id)",
    "key_sets": "select 'both' part, count(*) n from (select user_id from events intersect select o_custkey from orders) union all select 'events_only', count(*) from (select user_id from events except select o_custkey from orders) union all select 'either', count(*) from (select user_id from events union select o_custkey from orders)",
    "pivot_scores": _S + "select patient_key, " + ", ".join(f"coalesce(sum(total_score::decimal(18, 2)) filter (instrument_key = '{i}')::double, 0) {n}" for i, n in (("MOOD-8", "mood"), ("MOVE-10", "move"), ("SLEEP-6", "sleep"))) + " from fact_survey group by 1",
    "lineage_edges": f"select * from {_values(_EDGES)} t(source, target, transform)",
    "lineage_closure": f"""with recursive e as (select distinct source, target from {_values(_EDGES)} t(source, target, transform)),
      c as (select source, target, 1 steps from e union select c.source, e.target, steps + 1 from c join e on e.source = c.target) select source, target, min(steps)::bigint steps from c group by 1, 2""",
    "grants_sql": f"select * from {_values([(x,) for x in _STATEMENTS])} t(statement)",
    "access_review": f"select *, 'pending' status from {_values(_GRANTED)} t(principal, asset, privilege, why)",
    "access_audit": f"select {_dk('ts')} day_key, 'u' || user_id % 7 principal, upper(event_type) action, 'main.gold.t' || event_id % 3 asset, 'deidentified' class, count(*) accesses from events group by 1, 2, 3, 4",
    "monthly_cost": "select (year(ts) * 100 + month(ts))::int usage_month, case when event_type <> 'view' then event_type else 'untagged' end pipeline, 'u' || user_id % 5 \"owner\", sum(value::decimal(18, 4))::double units, (sum(value::decimal(18, 4)) * 0.55)::double \"cost\" from events group by 1, 2, 3",
    "tags": f"select * from {_values([(s, t, v) for s, c in (('bronze', 'identified'), ('gold', 'deidentified'), ('restricted', 'identified'), ('silver', 'deidentified')) for t, v in (('class', c), ('owner', 'stewards'), ('retention', '7y'))])} t(schema_name, tag, value)",
    "row_filtered": _PVL + "select lab_test_key, count(*) n from fact_lab where lab_test_key in ('4548-4', '2345-7') group by 1",
    "stream_expect_drop": "select event_type, count(*) n from events where value > 0 group by 1",
    "stream_ingest_idempotent": "select event_type, count(*) n from events group by 1",
    "as_of_join": f"""with o as (select o_custkey, o_orderkey, {_s('o_orderdate')} t from orders)
      select event_id, max(o.t) prior_order_s, max_by(o_orderkey, (o.t, o_orderkey)) prior_o_orderkey from events e left join o on o.o_custkey = e.user_id and o.t <= {_s('e.ts')} group by 1""",
    "tumbling_window": f"select {_s('date_trunc({q}hour{q}, ts)'.format(q=chr(39)))} hour_s, event_type, count(*) n from events group by 1, 2",
    "session_window": """with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hours then 0 else 1 end new from events),
      s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) k from g) select user_id, floor(epoch(min(ts)))::bigint start_s, count(*) n from s group by user_id, k""",
    "rollup_cube": "select o_orderstatus, o_orderpriority, count(*) n from orders group by rollup (o_orderstatus, o_orderpriority)",
    "pricing_summary": "select l_returnflag, l_linestatus, sum(l_quantity::decimal(18, 2))::double sum_qty, sum(l_extendedprice::decimal(18, 2))::double sum_base_price, count(*) count_order from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2",
    "nation_revenue": "select n_name, sum(l_extendedprice::decimal(18, 2) * (1 - l_discount::decimal(18, 2)))::double revenue, count(*) \"lines\" from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1",
    "top_orders": "select o_custkey, o_orderkey, rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) rank from orders) where rank <= 3",
}
