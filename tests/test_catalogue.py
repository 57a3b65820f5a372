"""Every query with an SQL twin gives the twin's rows on the smallest tables."""

import glob
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from strata.operators import rules
from strata.plans import catalogue, pipeline, reference

SLOW = {"p5_rolling"}


def duck(folder):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool | str):
        return v
    return float(f"{float(v):.9g}")


def compare(got, sql, sf):
    """Asserts that a frame has the rows of an SQL text over the tables."""
    cols = sorted(got.columns)
    ours = sorted(repr(tuple(plain(v) for v in r)) for r in got.select(*cols).collect())
    cursor = duck(sf).execute(sql)
    names = [x[0] for x in cursor.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert ours == sorted(repr(tuple(plain(r[i]) for i in order)) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.SQL) - SLOW))
def test_same_as_sql(spark, sf, name):
    compare(catalogue.QUERIES[name](spark, sf), catalogue.SQL[name], sf)


def test_what_has_no_twin():
    """Fitted models alone; they are tested below."""
    assert set(catalogue.QUERIES) - set(catalogue.SQL) == {"gbt_scores", "no_show_scores", "kmeans_assign", "propensity_scores", "propensity_match", "lowest_cluster"}


def test_models(spark, sf):
    run = lambda name: catalogue.QUERIES[name](spark, sf)
    for scores, frame in (("gbt_scores", "readmission_frame"), ("no_show_scores", "no_show_frame")):
        got = run(scores).collect()
        assert len(got) == len({r.encounter_key for r in got}) == run(frame).count() and all(0 <= r.score <= 1 for r in got)
    people = run("fact_survey").select("patient_key").distinct().count()
    clusters = run("kmeans_assign").collect()
    assert len(clusters) == people and {r.cluster for r in clusters} <= {0, 1, 2} and len({(r.cluster, round(r.mean_value, 6)) for r in clusters}) == len({r.cluster for r in clusters})
    tops = run("lowest_cluster").collect()
    assert sum(r.n for r in tops) == people and [r.is_lowest for r in tops].count(True) == 1
    scored = run("propensity_scores").collect()
    assert len(scored) == run("dim_patient").count() and all(0 < r.propensity < 1 for r in scored)
    pairs = run("propensity_match").collect()
    assert pairs and all(r.gap <= 0.2 for r in pairs) and len(pairs) == len({r.treated for r in pairs}) == len({r.control for r in pairs})
    # the nearest control is taken, not any within the caliper
    assert sum(r.gap for r in pairs) / len(pairs) < 0.1


@pytest.fixture
def yet_unborn(sf, tmp_path):
    """The tables, with a year to come as the last delivered birth year of one patient."""
    for p in glob.glob(f"{sf}/*.parquet"):
        os.symlink(p, tmp_path / os.path.basename(p))
    os.remove(tmp_path / "patient.parquet")
    last = "row_number() over (order by patient_id is null or birth_year is null, _ingest_ts desc, patient_id) = 1"
    duckdb.execute(f"copy (select * replace (case when {last} then 2027 else birth_year end as birth_year) from '{sf}/patient.parquet') to '{tmp_path}/patient.parquet' (format parquet)")
    return str(tmp_path)


def test_chained_mart_where_a_rule_fails(spark, yet_unborn):
    compare(catalogue.QUERIES["chain_patient_360"](spark, yet_unborn), catalogue.SQL["chain_patient_360"], yet_unborn)


def test_run_log_where_a_rule_fails(spark, yet_unborn, monkeypatch):
    lake = reference._chained(spark, yet_unborn)
    monkeypatch.setattr(reference, "_chained", lambda *_: lake)
    compare(catalogue.QUERIES["chain_run_log"](spark, yet_unborn), catalogue.SQL["chain_run_log"], yet_unborn)
    over = lake.store.read("ops", "pipeline_run_log").filter("status <> 'ok'").select("step", "table_name", "rows", "status")
    assert [tuple(r) for r in over.collect()] == [("gate", "silver.patient", 1, "passed over")]
    with pytest.raises(rules.PromotionBlocked):
        pipeline.build_gold(lake)
