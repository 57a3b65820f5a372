"""The whole chain into a store, contracts and settings."""

import pytest
from pyspark.sql import functions as F

from strata import config
from strata.operators import cohort as ch
from strata.operators import contracts, rules
from strata.plans import layers, pipeline
from strata.plans.lake import Lake
from strata.sources import landing, synth
from strata.sources.store import Store


def landed(spark, sf, tmp_path):
    """The driver's tables as landing files, ingested to Bronze."""
    pipeline.land(spark, sf, str(tmp_path / "in"))
    lake = Lake(Store(spark, str(tmp_path / "lake")))
    landing.ingest_directory(lake.store, str(tmp_path / "in"), "b1")
    return lake


def test_stay_without_times_is_quarantined(spark, sf, tmp_path, monkeypatch):
    lost = layers.silver_encounter(spark, sf).selectExpr("min(encounter_sk)").first()[0]
    times = {c: F.when(F.col("encounter_sk") != lost, F.col(c)) for c in ("admit_ts", "discharge_ts")}
    held = layers.conformed_encounter(spark, sf).withColumns(times)
    lake = landed(spark, sf, tmp_path)
    store = lake.store
    monkeypatch.setattr(layers, "conformed_encounter", lambda *_: held)
    pipeline.build_silver(lake, "b1")
    found = lambda schema, table: store.read(schema, table).filter(F.col("encounter_sk") == lost).count()
    assert (found("silver", "encounter"), found("quarantine", "encounter_window")) == (0, 1)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_chain(spark, sf, tmp_path):
    lake = landed(spark, sf, tmp_path)
    store = lake.store
    assert sum(landing.ingest_directory(store, str(tmp_path / "in"), "b2").values()) == 0
    silver = pipeline.build_silver(lake, "b1")
    assert silver["patient"] == silver["patient_xref"] > 0 and silver["encounter"] > 0 and "lab_result_orphan_parent" in silver
    shipped = pipeline.rulesets()
    assert {t: len(r) for t, r in shipped.items()} == {"patient": 5, "encounter": 6, "lab_result": 5}
    with pytest.raises(rules.PromotionBlocked):
        pipeline.build_gold(lake, {"encounter": [*shipped["encounter"], rules.parse({"id": "rows", "type": "row_count_min", "min_rows": 10**9})]})
    assert store.read("ops", "dq_results").count() == 7 and not store.exists("gold", "fact_encounter")
    gold = pipeline.build_gold(lake)
    assert gold["fact_encounter"] == silver["encounter"] and gold["dim_patient"] == silver["patient"]
    assert store.read("ops", "dq_results").count() == 7 + 16
    assert pipeline.build_features(lake).keys() == {f.at.split(".")[1] for f in pipeline.FEATURES}
    # what went through landing, Bronze and Silver is what the plans give straight from the tables
    for f in (*pipeline.SILVER, *pipeline.GOLD, *pipeline.FEATURES):
        assert same(f(spark, sf), store.read(*f.at.split("."))), f.at
    c = ch.load(config.shipped("cohorts/glycated_with_mood.yml"))
    m = pipeline.build_cohort(store, c, tmp_path / "m.json")
    assert m.rows == store.read("gold", f"cohort_{c.name}").count() > 0
    pipeline.log_run(store, "gold", gold)
    # a later load of the inputs does not matter: the versions are pinned
    store.write(store.read("gold", "fact_lab_result").limit(0), "gold", "fact_lab_result", mode="overwrite")
    assert pipeline.reproduce_cohort(store, c, tmp_path / "m.json") == 0
    pipeline.extract(store.read("gold", "dim_patient"), str(tmp_path / "x"), 3)
    assert spark.read.csv(str(tmp_path / "x"), header=True).count() == 3


def test_gold_reads_the_stored_silver(spark, sf, tmp_path):
    lake = landed(spark, sf, tmp_path)
    pipeline.build_silver(lake, "b1")
    lake.store.write(lake.store.read("silver", "encounter").limit(7), "silver", "encounter", mode="overwrite")
    assert pipeline.build_gold(lake)["fact_encounter"] == 7


def test_pepper_comes_from_the_settings(spark, sf, monkeypatch):
    key = lambda: layers.silver_patient(spark, sf).selectExpr("min(patient_sk)").first()[0]
    demo = key()
    monkeypatch.setenv("STRATA_PEPPER", "other")
    config.load.cache_clear()
    assert key() != demo
    monkeypatch.setenv("STRATA_PEPPER", config.DEMO_PEPPER)
    monkeypatch.setenv("STRATA_ENVIRONMENT", "production")
    config.load.cache_clear()
    with pytest.raises(RuntimeError):
        key()
    config.load.cache_clear()


def test_contract(spark):
    c = contracts.parse({"entity": "e", "primary_key": ["k"], "columns": [{"name": "k", "type": "string", "nullable": False}, {"name": "v", "type": "double"}], "checks": [{"name": "pos", "expression": "v > 0"}]})
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, None)], "k string, v double")
    assert {r.name: r.failed for r in contracts.violations(df, c).collect()} == {"null:k": 1, "check:pos": 1, "primary_key": 1}
    assert contracts.require(df, c, types=True) is df
    with pytest.raises(ValueError):
        contracts.require(df.select("k"), c)
    with pytest.raises(TypeError):
        contracts.require(df.withColumn("v", F.lit("x")), c, types=True)


def test_settings(monkeypatch, tmp_path):
    (tmp_path / "c.yml").write_text("environment: prod\npepper: demo-pepper\nsmall_cell_k: 5\n")
    config.load.cache_clear()
    s = config.load(str(tmp_path / "c.yml"))
    assert s.small_cell_k == 5 and s.name("gold", "t") == "main.gold.t"
    with pytest.raises(RuntimeError):
        s.secret()
    monkeypatch.setenv("STRATA_PEPPER", "real")
    config.load.cache_clear()
    assert config.load(str(tmp_path / "c.yml")).secret() == "real"
    config.load.cache_clear()


def test_synthetic_landing(spark, tmp_path):
    frames = synth.everything(spark, 12, orphans=0.2)
    assert set(frames) == set(landing.ENTITIES)
    synth.write_landing(frames, str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "lake"))
    first = landing.ingest_directory(store, str(tmp_path / "in"), "b1")
    assert first["patient"] == 12 and first["condition"] > 0 and first["survey_item"] == 85 and min(first.values()) > 0
    assert sum(landing.ingest_directory(store, str(tmp_path / "in"), "b2").values()) == 0
    assert store.read("bronze", "survey_score_raw").select("_source_system").distinct().first()[0] == "survey_sim"
    synth.write_landing({"patient": frames["patient"]}, str(tmp_path / "few"), 3)
    assert landing.read_csv(spark, str(tmp_path / "few" / "clinical" / "patient.csv")).count() == 3


def test_streams_follow_new_columns(spark, tmp_path):
    """Files of one entity with other columns, in another order, and a file that comes again."""
    folder = tmp_path / "in"
    folder.mkdir()
    lake = Lake(Store(spark, str(tmp_path / "lake")))
    run = lambda: pipeline.stream(lake, str(folder), str(tmp_path / "cp"), "b1", {"consent": "consent_id"})
    (folder / "consent_1.csv").write_text("consent_id,status\n1,granted\n,lost\n2,declined\n")
    run()
    (folder / "consent_2.csv").write_text("status,consent_id,signed_on\ngranted,3,2024-01-01\n")
    (folder / "consent_3.csv").write_text("consent_id,status\n1,granted\n2,declined\n")
    (folder / "consent_4.csv").write_text("status\ngranted\n")
    (folder / "other.csv").write_text("consent_id,status\n9,granted\n")
    run()
    run()
    got = {(r.consent_id, r.status, r.signed_on) for r in lake.store.read("bronze", "consent_raw").collect()}
    assert got == {("1", "granted", None), ("2", "declined", None), ("3", "granted", "2024-01-01")}
    assert lake.store.version("bronze", "consent_raw") == 1
