"""Seeded synthetic rows: every value is a hash of seed, entity and row number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: domains of the generated columns
CARE_SETTINGS = ["inpatient", "outpatient", "emergency", "ambulatory"]
RACES = ["white", "black", "asian", "other", "unknown"]
ETHNICITIES = ["hispanic", "nonhispanic", "unknown"]
SEXES = ["female", "male", "other", "unknown"]
ZIPS = ["10001", "60601", "77001", "30301", "94102", "98101", "02108", "85001"]
WAVES = {"baseline": 0, "day_30": 30, "day_90": 90, "day_180": 180, "day_365": 365}


def uniform(seed: int, *parts: Column | str) -> Column:
    """A number in [0, 1): the first twelve hex digits of SHA-256 over seed and parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def pick(seed: int, options: list[str], *parts: Column | str) -> Column:
    index = F.floor(uniform(seed, *parts) * len(options)).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), index + 1)


def synth_id(prefix: str, n: Column) -> Column:
    return F.format_string(f"SYN-{prefix}-%06d", n)


def patients(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    pid = synth_id("PAT", F.col("id"))
    return spark.range(1, n + 1).select(
        pid.alias("patient_id"), pick(seed, SEXES, "sex", F.col("id")).alias("sex"), pick(seed, RACES, "race", F.col("id")).alias("race"),
        pick(seed, ETHNICITIES, "eth", F.col("id")).alias("ethnicity"), (1930 + F.floor(uniform(seed, "by", F.col("id")) * 80)).cast("int").alias("birth_year"),
        pick(seed, ZIPS, "zip", F.col("id")).alias("postal_code"), (uniform(seed, "dead", F.col("id")) < 0.03).alias("deceased_flag"),
    )


def encounters(people: DataFrame, seed: int = 42, fewest: int = 1, most: int = 8) -> DataFrame:
    n = (fewest + F.floor(uniform(seed, "n", F.col("patient_id")) * (most - fewest + 1))).cast("int")
    visits = people.select("patient_id", F.explode(F.sequence(F.lit(1), n)).alias("v"))
    u = lambda tag: uniform(seed, tag, F.col("patient_id"), F.col("v"))
    admit = F.timestamp_seconds(F.lit(1_640_995_200) + F.floor(u("at") * 912 * 86_400))
    setting = pick(seed, CARE_SETTINGS, "set", F.col("patient_id"), F.col("v"))
    hours = F.when(setting == "inpatient", 24 + u("los") * 216).otherwise(0.5 + u("los") * 8)
    return visits.select(
        F.concat_ws("-", F.regexp_replace("patient_id", "PAT", "ENC"), "v").alias("encounter_id"), "patient_id", setting.alias("care_setting"), admit.alias("admit_ts"),
        F.timestamp_seconds(F.unix_timestamp(admit) + F.floor(hours * 3600)).alias("discharge_ts"),
    )


def labs(visits: DataFrame, codes: dict[str, tuple[float, float]], seed: int = 42) -> DataFrame:
    table = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(m).alias("mid"), F.lit(s).alias("spread")) for c, (m, s) in codes.items()])
    each = visits.select("encounter_id", "patient_id", "admit_ts", F.explode(table).alias("x")).filter(uniform(seed, "has", F.col("encounter_id"), F.col("x.code")) < 0.5)
    return each.select(
        F.concat_ws("-", "encounter_id", "x.code").alias("lab_result_id"), "patient_id", "encounter_id", F.col("x.code").alias("loinc_code"),
        F.round(F.col("x.mid") + (uniform(seed, "val", F.col("encounter_id"), F.col("x.code")) - 0.5) * 2 * F.col("x.spread"), 2).alias("value_num"), F.col("admit_ts").alias("resulted_ts"),
    )


def with_orphans(rows: DataFrame, key: str, column: str, share: float = 0.01, seed: int = 42) -> DataFrame:
    """The rows, and a seeded share of them again under a reference that does not exist."""
    lost = rows.filter(uniform(seed, "orphan", F.col(key)) < share).withColumn(column, F.concat(F.lit("ORPHAN-"), F.col(column)))
    return rows.unionByName(lost)


def observations(visits: DataFrame, vitals: dict[str, tuple[str, str, float, float]], seed: int = 42) -> DataFrame:
    """Readings of most visits; vitals: code to display, unit, least and greatest value."""
    table = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(t).alias("display"), F.lit(u).alias("unit"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")) for c, (t, u, lo, hi) in vitals.items()])
    each = visits.select("encounter_id", "patient_id", "admit_ts", F.explode(table).alias("x")).filter(uniform(seed, "seen", F.col("encounter_id"), F.col("x.code")) < 0.85)
    value = F.col("x.lo") + uniform(seed, "reading", F.col("encounter_id"), F.col("x.code")) * (F.col("x.hi") - F.col("x.lo"))
    return each.select(
        F.concat_ws("-", F.lit("OBS"), "encounter_id", "x.code").alias("observation_id"), "patient_id", "encounter_id", F.col("x.code").alias("loinc_code"), "x.display", F.round(value, 1).alias("value_num"), "x.unit",
        F.col("admit_ts").alias("observed_ts"),
    )


@dataclass(frozen=True)
class Instrument:
    """Items of a questionnaire (how many, least and greatest answer), the upper ends of its bands
    by label, ascending, and how many answers may be missing for a score."""

    items: int
    lo: int
    hi: int
    bands: tuple[tuple[str, int], ...] = ()
    spare: int = 0


# fixed values: public questionnaires and the bands of their total scores
INSTRUMENTS = {
    "PHQ-9": Instrument(9, 0, 3, (("none-minimal", 4), ("mild", 9), ("moderate", 14), ("moderately-severe", 19), ("severe", 27)), 1),
    "GAD-7": Instrument(7, 0, 3, (("minimal", 4), ("mild", 9), ("moderate", 14), ("severe", 21)), 1),
    "PROMIS-29": Instrument(28, 1, 5),
    "EQ-5D-5L": Instrument(5, 1, 5),
    "SF-36": Instrument(36, 1, 5),
}


def administrations(people: DataFrame, consent: DataFrame, instruments: dict[str, Instrument] = INSTRUMENTS, seed: int = 42) -> DataFrame:
    """One row per patient, wave and instrument that was answered. Patients whose consent was
    declined have none; the others drop out after a wave of their own, leave out waves after the
    first now and then, and come up to twenty days early or late, flagged beyond fourteen. Some
    stop within the questionnaire, some give the same answer throughout."""
    able = people.select("patient_id").join(consent.filter("consent_status <> 'granted'").select("patient_id"), "patient_id", "left_anti")
    waves = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("wave"), F.lit(d).alias("day")) for i, (w, d) in enumerate(WAVES.items())])
    u = lambda tag, *by: uniform(seed, tag, F.col("patient_id"), *[F.col(c) for c in by])
    came = able.select("patient_id", F.explode(waves).alias("x")).select("patient_id", "x.*").filter(
        (F.col("i") <= F.floor(u("dropout") * (len(WAVES) + 1))) & ((F.col("i") == 0) | (u("skip", "wave") >= 0.08))
    )
    shift = F.when(u("off", "wave") < 0.05, F.floor(u("by", "wave") * 40) - 20).otherwise(F.lit(0)).cast("int")
    kinds = F.array(*[F.struct(F.lit(n).alias("instrument_name"), F.lit(k.items).alias("items")) for n, k in instruments.items()])
    each = came.withColumn("shift", shift).select("*", F.explode(kinds).alias("k")).select("*", "k.*")
    part = F.when(u("part", "wave", "instrument_name") < 0.12, F.greatest(F.lit(1), F.floor(F.col("items") * (0.4 + u("rest", "wave", "instrument_name") * 0.5)))).otherwise(F.col("items")).cast("int")
    return each.withColumn("answered", part).select(
        F.concat_ws("-", F.lit("ADM"), "patient_id", "wave", "instrument_name").alias("administration_id"), "patient_id", F.concat(F.lit("INSTR-"), F.regexp_replace("instrument_name", "-", "")).alias("instrument_id"), "instrument_name", "wave",
        F.timestamp_seconds(F.lit(1_673_740_800) + (F.col("day") + F.col("shift")) * 86_400).alias("administered_ts"), F.when(F.col("answered") == F.col("items"), "complete").otherwise("partial").alias("completion_status"),
        (u("line", "wave", "instrument_name") < 0.04).alias("straight_lining_flag"), (F.abs("shift") > 14).alias("out_of_window_flag"), "answered",
    )


def _of(instruments: dict[str, Instrument], what: str) -> Column:
    pairs = [x for n, k in instruments.items() for x in (F.lit(n), F.lit(getattr(k, what)))]
    return F.create_map(*pairs)[F.col("instrument_name")]


def responses(administered: DataFrame, instruments: dict[str, Instrument] = INSTRUMENTS, seed: int = 42) -> DataFrame:
    """The answers: items from the first on, as many as were answered."""
    each = administered.select("*", F.explode(F.sequence(F.lit(1), F.col("answered"))).alias("q"))
    lo, hi = _of(instruments, "lo"), _of(instruments, "hi")
    drawn = lo + F.floor(uniform(seed, "answer", F.col("administration_id"), F.col("q")) * (hi - lo + 1))
    return each.select(
        F.concat_ws("-", "administration_id", "q").alias("response_id"), "administration_id", "patient_id", "instrument_id", "instrument_name", F.concat(F.regexp_replace("instrument_name", "-", ""), F.lit("_Q"), "q").alias("item_id"),
        F.when(F.col("straight_lining_flag"), lo).otherwise(drawn).cast("int").alias("value_num"),
    )


def scores(administered: DataFrame, answers: DataFrame, instruments: dict[str, Instrument] = INSTRUMENTS) -> DataFrame:
    """Total and band of every administration with enough answers."""
    total = answers.groupBy("administration_id").agg(F.sum("value_num").cast("double").alias("total_score"), F.count("value_num").alias("given"))
    enough = administered.join(total, "administration_id").filter(F.col("given") + _of(instruments, "spare") >= _of(instruments, "items"))
    band = F.lit("n/a")
    for name, kind in instruments.items():
        if kind.bands:
            band = F.when(F.col("instrument_name") == name, severity(F.col("total_score"), dict(kind.bands))).otherwise(band)
    return enough.select(F.concat(F.lit("SCR-"), "administration_id").alias("score_id"), "administration_id", "patient_id", "instrument_id", "instrument_name", "wave", "total_score", band.alias("severity_band"))


def severity(score: Column, cuts: dict[str, float]) -> Column:
    """The first band whose upper end is not below the score; cuts: label to upper end, ascending."""
    out = F.lit("unknown")
    for label, upper in reversed(list(cuts.items())):
        out = F.when(score <= upper, F.lit(label)).otherwise(out)
    return F.when(score.isNotNull(), out)


def organizations(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    return spark.range(1, n + 1).select(synth_id("ORG", F.col("id")).alias("organization_id"), F.concat(F.lit("Clinic "), F.col("id")).alias("name"), F.substring(pick(seed, ZIPS, "orgzip", F.col("id")), 1, 3).alias("zip3"))


def providers(spark: SparkSession, n: int, orgs: int, specialties: list[str], seed: int = 42) -> DataFrame:
    org = (1 + F.floor(uniform(seed, "porg", F.col("id")) * orgs)).cast("long")
    return spark.range(1, n + 1).select(synth_id("PRV", F.col("id")).alias("provider_id"), synth_id("ORG", org).alias("organization_id"), pick(seed, specialties, "spec", F.col("id")).alias("specialty"))


def coded_events(visits: DataFrame, prefix: str, codes: dict[str, str], share: float, seed: int = 42) -> DataFrame:
    """Conditions, medications, procedures, immunisations or claims: each visit has each code with
    probability `share`. codes: code to display."""
    table = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(t).alias("display")) for c, t in codes.items()])
    each = visits.select("encounter_id", "patient_id", "admit_ts", F.explode(table).alias("x"))
    return each.filter(uniform(seed, prefix, F.col("encounter_id"), F.col("x.code")) < share).select(
        F.concat_ws("-", F.lit(prefix), "encounter_id", "x.code").alias("event_id"), "patient_id", "encounter_id", "x.code", "x.display", F.col("admit_ts").alias("event_ts")
    )


def consents(people: DataFrame, share: float = 0.9, seed: int = 42) -> DataFrame:
    return people.select(F.regexp_replace("patient_id", "PAT", "CNS").alias("consent_id"), "patient_id", F.when(uniform(seed, "consent", F.col("patient_id")) < share, "granted").otherwise("declined").alias("consent_status"))


def survey_items(spark: SparkSession, instruments: dict[str, Instrument] = INSTRUMENTS) -> DataFrame:
    rows = [(f"INSTR-{n.replace('-', '')}", n, f"{n.replace('-', '')}_Q{q}", k.lo, k.hi) for n, k in instruments.items() for q in range(1, k.items + 1)]
    return spark.createDataFrame(rows, "instrument_id string, instrument_name string, item_id string, min_value int, max_value int")


def survey_instruments(spark: SparkSession, instruments: dict[str, Instrument] = INSTRUMENTS) -> DataFrame:
    rows = [(f"INSTR-{n.replace('-', '')}", n, k.items) for n, k in instruments.items()]
    return spark.createDataFrame(rows, "instrument_id string, name string, item_count int")


# fixed values: codes of generated events by entity, and the share of visits that have each
EVENTS = {
    "condition": ({"E11.9": "Type 2 diabetes", "I10": "Hypertension", "J45.909": "Asthma", "F32.9": "Depressive episode"}, 0.25),
    "medication": ({"860975": "Metformin", "314076": "Lisinopril", "745679": "Albuterol"}, 0.2),
    "procedure": ({"93000": "Electrocardiogram", "71046": "Chest radiograph"}, 0.15),
    "immunization": ({"140": "Influenza", "208": "Coronavirus"}, 0.1),
    "payer_claim": ({"claim": "Claim"}, 0.9),
}
VITALS = {"8310-5": ("Body temperature", "Cel", 36.0, 38.5), "8867-4": ("Heart rate", "/min", 50.0, 110.0), "8480-6": ("Systolic pressure", "mm[Hg]", 95.0, 165.0), "9279-1": ("Respiratory rate", "/min", 10.0, 24.0)}
LABS = {"4548-4": (6.0, 1.5), "2345-7": (100.0, 30.0), "2160-0": (1.0, 0.4), "718-7": (14.0, 2.0)}


def everything(spark: SparkSession, n: int, seed: int = 42, orphans: float = 0.01) -> dict[str, DataFrame]:
    """All landing entities for n patients."""
    people = patients(spark, n, seed)
    visits, consent = encounters(people, seed), consents(people, seed=seed)
    asked = administrations(people, consent, seed=seed)
    answers = responses(asked, seed=seed)
    out = {
        "patient": people, "encounter": visits, "consent": consent, "observation": observations(visits, VITALS, seed), "lab_result": with_orphans(labs(visits, LABS, seed), "lab_result_id", "encounter_id", orphans, seed),
        "organization": organizations(spark, max(1, n // 50), seed), "provider": providers(spark, max(1, n // 10), max(1, n // 50), ["medicine", "surgery", "psychiatry"], seed),
        "survey_instrument": survey_instruments(spark), "survey_item": survey_items(spark), "survey_administration": asked.drop("answered"), "survey_response": answers, "survey_score": scores(asked, answers),
    }
    return out | {e: coded_events(visits, e[:3].upper(), codes, share, seed) for e, (codes, share) in EVENTS.items()}


def write_landing(frames: dict[str, DataFrame], folder: str, sample_rows: int | None = None) -> None:
    """A folder of CSV files with header per entity, written where the rows lie; with `sample_rows`
    only so many of each, as an example of the format."""
    for name, df in frames.items():
        rows = df if sample_rows is None else df.limit(sample_rows).coalesce(1)
        rows.write.mode("overwrite").options(header=True, escape='"', emptyValue='""').csv(f"{folder}/{'survey' if name.startswith('survey_') else 'clinical'}/{name}.csv")
