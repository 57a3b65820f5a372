"""The pN_ queries in plain SQL, for comparison on the same tables."""

from __future__ import annotations

from strata.functions.text import NULL_TOKENS
from strata.plans.problems import FIRST_DAY, LAST_DAY, PROFILED

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def _id(c: str) -> str:
    return f"(case when upper(trim({c})) in ({_TOKENS}) then null else upper(trim({c})) end)"


def _attr(c: str) -> str:
    return f"(case when upper(trim({c})) in ({_TOKENS}) then null else lower(trim({c})) end)"


def _key(c: str) -> str:
    return f"nullif(upper(trim({c})), '')"


def _s(c: str) -> str:
    return f"floor(epoch({c}))::bigint"


STANDING = f"""
standing as (
  select encounter_id, patient, admit_ts, discharge_ts from (
    select upper(trim(encounter_id)) encounter_id, {_id('patient_id')} patient, admit_ts, discharge_ts, _change_type,
           row_number() over (partition by upper(trim(encounter_id)) order by _ingest_ts desc) rn
    from encounter)
  where rn = 1 and _change_type is distinct from 'delete')"""

_BANDS = f"bands as (select {_id('patient_id')} patient, {_attr('age_band')} band, valid_from, _ingest_ts from patient where {_attr('age_band')} is not null)"
_P1 = f"""with {STANDING}, {_BANDS},
lasts as (select patient, arg_max(band, (valid_from, _ingest_ts)) band from bands group by 1),
known as (select s.encounter_id, arg_max(b.band, (b.valid_from, b._ingest_ts)) band from standing s
  join bands b on b.patient = s.patient and b.valid_from <= s.admit_ts and b._ingest_ts <= s.admit_ts group by 1)"""

_WON = f"""with won as (
  select * from (
    select {_id('patient_id')} patient_id, valid_from, {', '.join(f"{_attr(c)} {c}" for c in ('sex', 'race', 'ethnicity', 'zip3', 'age_band'))},
           row_number() over (partition by {_id('patient_id')}, valid_from order by _ingest_ts desc) rn
    from patient)
  where rn = 1 and patient_id is not null and valid_from is not null),
filled as (
  select patient_id, valid_from, row_number() over w n, {', '.join(f"last_value({c} ignore nulls) over w {c}" for c in ('sex', 'race', 'ethnicity', 'zip3', 'age_band'))}
  from won window w as (partition by patient_id order by valid_from rows between unbounded preceding and current row)),
marked as (select *, lag((sex, race, ethnicity, zip3, age_band)) over w was, lag((sex, race, ethnicity)) over w was_slow from filled window w as (partition by patient_id order by valid_from)),
history as (
  select patient_id, valid_from, sex, race, ethnicity, zip3, age_band, lead(valid_from) over (partition by patient_id order by valid_from) valid_to
  from marked where n = 1 or (sex, race, ethnicity, zip3, age_band) is distinct from was)"""

_DAYS = f"""with {STANDING}, acts as (
  select patient, admit_ts::date as day, count(*) a, 0 r from standing where patient is not null and admit_ts is not null group by 1, 2
  union all
  select {_id('patient_id')}, resulted_ts::date, 0, count(distinct upper(trim(lab_result_id))) from lab_result
  where {_id('patient_id')} is not null and resulted_ts is not null group by 1, 2),
daily as (select patient, day, sum(a) a, sum(r) r from acts where day between date '{FIRST_DAY}' and date '{LAST_DAY}' group by 1, 2),
panel as (
  select p.patient, d.day, coalesce(a, 0) a, coalesce(r, 0) r
  from (select distinct patient from daily) p cross join (select unnest(generate_series(date '{FIRST_DAY}', date '{LAST_DAY}', interval 1 day))::date as day) d
  left join daily x on x.patient = p.patient and x.day = d.day),
rolled as (
  select patient, day, a, r, sum(a) over w7 a7, sum(a) over w30 a30, sum(r) over w7 r7, sum(r) over w30 r30 from panel
  window w7 as (partition by patient order by day rows between 6 preceding and current row),
         w30 as (partition by patient order by day rows between 29 preceding and current row))"""


def _p2_table(name: str, row_id: str, at: str) -> str:
    return f"""
r_{name} as (
  select distinct upper(trim({row_id})) id, lower(trim(source_system)) s, upper(trim(loinc_code)) l, {_id('patient_id')} p, {at} tm, value_num v
  from {name} where value_num is not null and not isnan(value_num)),
m_{name} as (select s, l, median(v) m from r_{name} group by 1, 2),
e_{name} as (select x.id, x.s, x.l, abs(ln(v / m)) d from r_{name} x join m_{name} y on x.s = y.s and x.l = y.l where v > 0),
h_{name} as (
  select *, lag(d) over w below, percent_rank() over w pr, lag(d) over c below_c, percent_rank() over c pr_c, count(*) over (partition by s, l) n
  from e_{name} window w as (partition by s, l order by d), c as (partition by l order by d)),
b_{name} as (
  select s, l, case when any_value(n) >= 100 then min(d) filter (pr > 0.96 and d >= 1.5 * below) else any_value(shared) end border from h_{name}
  join (select l, min(d) filter (pr_c > 0.96 and d >= 1.5 * below_c) shared from h_{name} group by 1) using (l) group by 1, 2),
k_{name} as (
  select *, row_number() over (partition by p, l, s order by tm, id) - row_number() over (partition by p, l, s, v order by tm, id) run
  from r_{name} where p is not null and tm is not null),
f_{name} as (
  select id from r_{name} where v <= 0
  union select e.id from e_{name} e join b_{name} b on e.s = b.s and e.l = b.l where e.d >= b.border
  union select id from (select id, count(*) over (partition by p, l, s, v, run) n from k_{name}) where n >= 6)"""


_P2 = "with " + ",".join(
    _p2_table(*t) for t in (("lab_result", "lab_result_id", "resulted_ts"), ("observation", "observation_id", "observed_ts"))
) + " select 'lab_result' table_name, id row_id from f_lab_result union all select 'observation', id from f_observation"

_P4 = f"""with {STANDING},
ok as (select patient, {_s('admit_ts')} s, {_s('discharge_ts')} e from standing where patient is not null and admit_ts is not null and discharge_ts >= admit_ts),
flagged as (select *, case when s > max(e) over (partition by patient order by s, e rows between unbounded preceding and 1 preceding) then 1 else 0 end new from ok),
numbered as (select *, sum(new) over (partition by patient order by s, e rows between unbounded preceding and current row) g from flagged),
periods as (select patient, g, min(s) s, max(e) e, count(*) n from numbered group by 1, 2),
gaps as (select patient, e as s, lead(s) over (partition by patient order by s) e from periods)"""


def _p6_load(name: str) -> str:
    return f"(select *, count(*) over (partition by _batch_id) load_rows from {name})"


def _p6_nulls(name: str, c: str) -> str:
    return f"""select '{name}' table_name, '{c}' column_name, _batch_id batch_id, 'nulls' finding from {name} group by _batch_id
  having count(*) >= 100 and abs(count(*) filter ({c} is null) / count(*) - (select count(*) filter ({c} is null) / count(*) from {name})) > 0.10"""


def _p6_domain(name: str, c: str, ok: str) -> str:
    return f"""select '{name}', '{c}', _batch_id, 'domain' from {name} group by _batch_id
  having count(*) >= 100 and count(*) filter (not ({ok})) > 0.05 * count({c})"""


def _p6_shift(name: str, most: float) -> str:
    return f"""select distinct '{name}', 'value_num', x._batch_id, 'shift' from (
    select _batch_id, loinc_code, source_system, median(value_num) m, count(value_num) n, any_value(load_rows) load_rows from {_p6_load(name)} group by 1, 2, 3) x
  join (select loinc_code, source_system, median(value_num) m from {name} group by 1, 2) y on x.loinc_code = y.loinc_code and x.source_system = y.source_system
  where n >= 25 and load_rows >= 100 and y.m <> 0 and (x.m / y.m > {most} or x.m / y.m < 1.0 / {most})"""


_P6 = "select * from (" + " union all ".join([
    *[_p6_nulls(t, c) for t, c in (("patient", "race"), ("patient", "zip3"), ("lab_result", "unit"), ("lab_result", "value_num"), ("observation", "value_num"), ("survey_administration", "completion_status"))],
    _p6_domain("patient", "race", "race in ('white', 'black', 'asian', 'other', 'unknown')"),
    _p6_domain("patient", "zip3", "regexp_full_match(zip3, '[0-9]{3}')"),
    _p6_domain("lab_result", "unit", "unit in ('mg/dL', 'mmol/L', 'umol/L', 'g/dL', 'g/L', 'mg/L', '10*3/uL', '%')"),
    _p6_domain("survey_administration", "completion_status", "completion_status in ('complete', 'partial', 'missed')"),
    _p6_shift("lab_result", 1.5), _p6_shift("observation", 1.2),
    """select 'survey_administration', 'completion_status', b, 'shift' from (
      select l.b, l.held, l.load_rows, sum(abs(coalesce(n, 0) / l.held - w.share)) / 2 d
      from (select _batch_id b, count(completion_status) held, count(*) load_rows from survey_administration group by 1) l
      cross join (select completion_status v, count(*) / (select count(completion_status) from survey_administration) share from survey_administration where completion_status is not null group by 1) w
      left join (select _batch_id b, completion_status v, count(*) n from survey_administration group by 1, 2) x on x.b = l.b and x.v = w.v
      group by 1, 2, 3) where held > 0 and load_rows >= 100 and d > 0.25""",
]) + ") where batch_id between 'load-202301' and 'load-202412'"


_NUMBERS = {"birth_year", "value_num"}
_VALID = {
    "patient.race": "v in ('white', 'black', 'asian', 'other', 'unknown')", "patient.zip3": "regexp_full_match(v, '[0-9]{3}')",
    "lab_result.unit": "v in ('mg/dL', 'mmol/L', 'umol/L', 'g/dL', 'g/L', 'mg/L', '10*3/uL', '%')", "survey_administration.completion_status": "v in ('complete', 'partial', 'missed')",
}
# every load of a column against every value of the column, straight from the definitions
_P6_PROFILE = "with long as (" + " union all ".join(
    f"select '{t}' t, '{c}' c, _batch_id b, {c}::varchar v, {f'{c}::double' if c in _NUMBERS else 'null::double'} x from {t}" for t, own in PROFILED.items() for c in own
) + """),
loads as (
  select t, c, b, count(*) "rows", count(*) filter (v is null) nulls, count(v) held, count(distinct v) distinct_values, min(case when x is null then v end) min_value, max(case when x is null then v end) max_value,
    min(x) min_number, max(x) max_number, count(*) filter (""" + " or ".join(f"(t || '.' || c = '{n}' and not ({ok}))" for n, ok in _VALID.items()) + """) breaches from long group by 1, 2, 3),
counted as (select t, c, b, v, count(*) n from long where v is not null group by 1, 2, 3, 4),
vals as (select t, c, v, sum(n) n, sum(sum(n)) over (partition by t, c) held from counted group by 1, 2, 3),
grid as (select l.t, l.c, l.b, l.held, coalesce(x.n, 0) / l.held p, (v.n / v.held)::double q from loads l join vals v on v.t = l.t and v.c = l.c left join counted x on x.t = l.t and x.c = l.c and x.b = l.b and x.v = v.v where l.held > 0),
away as (select t, c, b, sum(abs(p - q)) / 2 variation, sum((p - q) * ln(greatest(p, 1e-6) / greatest(q, 1e-6))) psi, sum((p - q) * (p - q) / q * held) chi_square from grid group by 1, 2, 3)
select t table_name, c column_name, b batch_id, "rows", nulls, distinct_values, breaches, min_value, max_value, min_number, max_number, round(variation + 1e-10, 6) variation, round(psi + 1e-10, 6) psi, round(chi_square + 1e-7, 3) chi_square
from loads left join away using (t, c, b)"""


def _p7_part(child: str, own: str, parent: str, ref: str, deletable: bool) -> str:
    stands = "arg_max(_change_type, _ingest_ts) is distinct from 'delete'" if deletable else "true"
    return f"""select '{child}' table_name, c.id row_id,
    case when p.id is null then 'missing' when not p.stands then 'deleted' else 'late' end status, (year(c.first) * 100 + month(c.first))::bigint period
  from (select {_key(own)} id, min(_ingest_ts) "first", arg_max({_key(ref)}, _ingest_ts) ref from {child} group by 1) c
  left join (select {_key(ref)} id, min(_ingest_ts) "first", {stands} stands from {parent} where {_key(ref)} is not null group by 1) p on p.id = c.ref
  where c.ref is not null and c.id is not null and (p.id is null or not p.stands or p.first > c.first)"""


_P7 = " union all ".join([
    _p7_part("encounter", "encounter_id", "patient", "patient_id", False),
    _p7_part("lab_result", "lab_result_id", "encounter", "encounter_id", True),
    _p7_part("survey_response", "response_id", "survey_administration", "administration_id", True),
])


_MEANS = ", ".join(f"({x}{p} / {p})::double {m}_{p}_mean" for m, x in (("admissions", "a"), ("results", "r")) for p in (7, 30))

SQL = {
    "p1_found": _P1 + " select k.encounter_id, k.band age_band from known k join standing s using (encounter_id) join lasts l on l.patient = s.patient where k.band <> l.band",
    "p1_known": _P1 + f" select s.encounter_id, s.patient patient_id, {_s('s.admit_ts')} admit_s, k.band age_band, case when s.admit_ts is not null then l.band end latest_age_band from standing s left join known k using (encounter_id) left join lasts l on l.patient = s.patient",
    "p2_found": _P2,
    "p3_found": _WON + f" select patient_id, {_s('valid_from')} valid_from_s, coalesce({_s('valid_to')}, -1) valid_to_s from history",
    "p3_batches": _WON + f" select patient_id, {_s('valid_from')} valid_from_s, coalesce({_s('valid_to')}, -1) valid_to_s from history",
    "p3_history": _WON + f" select patient_id, {_s('valid_from')} valid_from_s, coalesce({_s('valid_to')}, -1) valid_to_s, sex, race, ethnicity, zip3, age_band from history",
    "p3_satellite_slow": _WON + f""" select patient_id, {_s('valid_from')} valid_from_s, coalesce(lead({_s('valid_from')}) over (partition by patient_id order by valid_from), -1) valid_to_s,
      sha256(concat_ws('␟', coalesce('=' || sex, '~'), coalesce('=' || race, '~'), coalesce('=' || ethnicity, '~'))) row_hash, sex, race, ethnicity
      from marked where n = 1 or (sex, race, ethnicity) is distinct from was_slow""",
    "p4_found": _P4 + " select patient patient_id, 'period' kind, s start_s, e end_s from periods where n >= 2 union all select patient, 'gap', s, e from gaps where e is not null",
    "p4_periods": _P4 + " select patient patient_id, 'period' kind, s start_s, e end_s, n encounters from periods union all select patient, 'gap', s, e, 0 from gaps where e is not null",
    "p5_found": _DAYS + " select patient patient_id, (year(day) * 10000 + month(day) * 100 + dayofmonth(day))::bigint day_key from rolled where a + r = 0 and a7 + r7 >= 5 and 30 * (a7 + r7) >= 14 * (a30 + r30)",
    "p5_rolling": _DAYS + f" select patient patient_id, (year(day) * 10000 + month(day) * 100 + dayofmonth(day))::bigint day_key, a::bigint admissions, r::bigint results, a7::bigint admissions_7, a30::bigint admissions_30, r7::bigint results_7, r30::bigint results_30, {_MEANS} from rolled",
    "p6_found": _P6,
    "p6_profile": _P6_PROFILE,
    "p7_found": _P7,
    "p7_report": f"select table_name, period, status, count(*) records from ({_P7}) group by 1, 2, 3",
}
