"""Training frames, models, run log, governance tables and artifacts over a lake."""

import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from strata import config
from strata.operators import governance as gov
from strata.operators import rules
from strata.plans import layers, learning, pipeline
from strata.plans.lake import Lake, lineage
from strata.sources import landing
from strata.sources.store import Store


def test_train_all(spark, sf, tmp_path):
    pipeline.land(spark, sf, str(tmp_path / "in"))
    lake = Lake(Store(spark, str(tmp_path / "lake")))
    pipeline.run(lake, str(tmp_path / "in"), "b1")
    got = learning.train_all(lake, str(tmp_path / "cards"))
    assert set(got) == {"readmission", "no_show", "response_clusters", "propensity"}
    for name in ("readmission", "no_show"):
        assert got[name]["n"] > 0 and 0 <= got[name]["brier"] <= 1
        card = (tmp_path / "cards" / f"{name}.md").read_text()
        assert card.startswith(f"# {name} 1") and "age_band" in card
    runs = {r.model: json.loads(r.metrics) for r in lake.store.read("ops", "model_runs").collect()}
    assert runs["no_show"]["n"] == got["no_show"]["n"] and len(runs) == 4
    assert {r.step for r in lake.store.read("ops", "pipeline_run_log").select("step").collect()} == {"bronze", "silver", "gold", "features"}


def test_scores_hold_out_whole_patients(spark, sf):
    rows = learning.no_show_scores(spark, sf)
    assert rows.groupBy("patient_key").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    n, lo, hi, mean = rows.agg(F.count("*"), F.min("score"), F.max("score"), F.avg("score")).first()
    assert n == learning.no_show_frame(spark, sf).count() and 0 <= lo <= hi <= 1
    assert mean == pytest.approx(rows.agg(F.avg("label")).first()[0], abs=0.15)


def test_figures_do_not_look_ahead(spark, sf):
    """A result after the admission changes nothing in the stay's features."""
    frame = learning.readmission_frame(spark, sf)
    assert frame.count() == layers.fact_readmission(spark, sf).join(layers.dim_patient(spark, sf), "patient_key").count()
    seen = learning.labs_so_far(spark, sf)
    stays = layers.fact_readmission(spark, sf).select("encounter_key", "patient_key", F.unix_timestamp("admit_ts").alias("t"))
    best = {}
    for r in stays.join(seen, "patient_key").filter("lab_at <= t").collect():
        best[r.encounter_key] = max(best.get(r.encounter_key, ()), (r.lab_at, r.lab_result_key, r.code_weight))
    for r in frame.collect():
        assert r.code_weight == (best[r.encounter_key][2] if r.encounter_key in best else None)


def test_lineage_follows_the_plans(spark, sf):
    edges = lineage(spark, sf, [layers.patient_360])
    assert ("gold.fact_encounter", "gold.mart_patient_360", "patient_360") in edges and ("bronze.encounter_raw", "silver.encounter", "silver_encounter") in edges
    assert not any(t == "gold.mart_patient_360" and s.startswith("bronze") for s, t, _ in edges)


def test_artifacts_and_dashboards(spark, tmp_path):
    names = gov.write_artifacts(spark, str(tmp_path), [("a.b", "c.d", "f")])
    assert names == ["cost.sql", "grants.sql", "lineage.md", "linkage.sql", "readmission.sql", "scores.sql", "utilization.sql"]
    assert '"a.b" -->|f| "c.d"' in (tmp_path / "lineage.md").read_text() and "{rate}" not in (tmp_path / "cost.sql").read_text()
    (tmp_path / "linkage.sql").unlink()
    with pytest.raises(FileNotFoundError, match="linkage"):
        gov.dashboards(tmp_path)


def test_access_tables(spark):
    matrix = gov.access_matrix()
    review = gov.access_review(spark, matrix)
    assert review.count() == len(matrix["grants"]) == review.select("review_id").distinct().count() and review.filter("status <> 'pending'").isEmpty()
    seen = spark.createDataFrame([("2024-01-01 10:00:00", "g", "SELECT", "main.bronze.t"), ("2024-01-01 11:00:00", "g", "SELECT", "main.bronze.t"), (None, "g", "SELECT", "main.other.t")], "at string, principal string, action string, asset string").withColumn("at", F.to_timestamp("at"))
    got = {(str(r.audit_date), r["class"]): r.accesses for r in gov.audit_daily(seen, matrix).collect()}
    assert got == {("2024-01-01", "identified"): 2, ("None", "sensitive"): 1}
    assert gov.audit_daily(seen.limit(0), matrix).count() == 0
    script = gov.access_script(matrix, "main")
    assert any("zip3" in s for s in script) and any("x STRING) RETURNS STRING" in s for s in script) and any("ROW FILTER" in s for s in script)


def test_webhook(spark):
    sent = []

    class Reply:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

    def send(request, timeout):
        sent.append((request.full_url, json.loads(json.loads(request.data)["text"]), timeout))
        return Reply()

    def fail(request, timeout):
        raise urllib.error.URLError("down")

    bad = rules.validate(spark.range(3), [rules.parse({"id": "few", "type": "row_count_min", "min_rows": 5})], "t")
    assert rules.webhook("https://example.org/x", send)(bad) and sent[0][2] == 5 and [r["rule"] for r in sent[0][1]["failed"]] == ["few"]
    assert not rules.webhook("http://example.org/x", send)(bad) and not rules.webhook("https://example.org/x", fail)(bad) and len(sent) == 1
    with pytest.raises(rules.PromotionBlocked):
        rules.gate(bad, rules.webhook("https://example.org/x", fail))


def test_shipped_files_load():
    from strata.operators import cohort, contracts

    assert {c.parent.name for c in config.shipped("").glob("*/*.yml")} == {"cohorts", "contracts", "rules"}
    assert all(cohort.load(p).inclusion for p in config.shipped("cohorts").glob("*.yml"))
    assert all(contracts.load(p).struct_type().fields for p in config.shipped("contracts").glob("*.yml"))
