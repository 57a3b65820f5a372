"""Cleansing, privacy, rules, sources, streaming, cohorts and governance."""

import hashlib
import hmac
import json
import logging
import random
from datetime import UTC, datetime



import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conftest import rows
from strata.functions import privacy
from strata.operators import cohort as ch
from strata.operators import governance as gov
from strata.operators import ml, rules, scanner
from strata.operators import relational as rel
from strata.sources import landing, synth
from strata.sources.store import Store
from strata.streaming import ingest as st


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("key", ["p", "x" * 100, "ü"])
@pytest.mark.parametrize("text", ["a", "patient-1", "é" * 300])
def test_hmac(spark, key, text):
    assert one(spark, privacy.hmac_hex(F.lit(text), key)) == hmac.new(key.encode(), text.encode(), hashlib.sha256).hexdigest()
    assert one(spark, privacy.hmac_hex(F.lit(""), key)) is None


def test_shift_keeps_intervals(spark):
    df = spark.createDataFrame([("k", "2024-01-01"), ("k", "2024-02-10")], "k string, d string").select(privacy.shifted_date(F.col("d"), F.col("k"), "p").alias("x"))
    a, b = (r.x for r in df.collect())
    assert (b - a).days == 40
    assert -365 <= one(spark, privacy.day_offset(F.lit("k"), "p")) <= 365


def test_ages(spark):
    years = {2025: "unknown", 2024: "00s", 2015: "00s", 1935: "80s", 1934: "90+", None: "unknown", 1990: "30s"}
    df = spark.createDataFrame([(y,) for y in years], "y int").select("y", privacy.age_band(F.col("y")).alias("b"))
    assert {r.y: r.b for r in df.collect()} == years


def test_cleansing(spark):
    df = spark.createDataFrame([("UNK", " x ", "999"), (" na ", None, "b")], "a string, b string, c string")
    assert rows(rel.normalize_null_tokens(rel.trim_strings(df))) == sorted([(None, "x", None), (None, None, "b")], key=repr)
    bad = spark.createDataFrame([("2024-01-01T10:00:00+00:00",), ("no",)], "t string")
    assert [r.t is not None for r in rel.parse_ts(bad, "t").collect()] == [True, False]


def test_windows_split_every_row(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (1, None), (None, None)], "s int, e int")
    good, bad = rel.window_violations(df, "s", "e")
    assert (good.count(), bad.count()) == (3, 2)


def test_suppression(spark):
    df = spark.createDataFrame([(10, 1.2), (11, 2.4), (12, 3.0)], "n int, m double")
    assert rows(rel.suppress_small_cells(df, "n", 11, ["m"])) == sorted([(None, None), (11, 2.4), (12, 3.0)], key=repr)


def test_latest_and_anti(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "k string, o int, v string")
    assert rows(rel.latest_by(df, ["k"], "o")) == [("a", 2, "z"), ("b", None, "w")]
    assert rel.anti_seen(df, df.filter("k = 'a'"), "k").count() == 1


def test_rules(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, 50.0), (None, "zz", None)], "k int, c string, v double")
    specs = [
        {"id": "nn", "type": "not_null", "column": "k"}, {"id": "un", "type": "unique", "columns": ["k"], "severity": "warn"}, {"id": "av", "type": "allowed_values", "column": "c", "values": ["a"], "threshold": 0.5},
        {"id": "bt", "type": "between", "column": "v", "max": 10}, {"id": "rx", "type": "regex", "column": "c", "pattern": "^z"}, {"id": "ex", "type": "expression", "expression": "v > 10"},
        {"id": "rc", "type": "row_count_min", "min_rows": 4}, {"id": "fl", "type": "not_null", "column": "c", "filter": "v > 10"},
    ]
    rule_list = [rules.parse(s) for s in specs]
    got = {r.rule.id: (r.failed, r.scanned, r.passed) for r in rules.validate(df, rule_list, "t").results}
    assert got == {"nn": (1, 3, False), "un": (1, 3, False), "av": (1, 2, True), "bt": (1, 2, False), "rx": (1, 2, False), "ex": (1, 3, False), "rc": (1, 3, False), "fl": (1, 1, False)}
    empty = rules.validate(df.limit(0), rule_list, "t")
    assert {r.rule.id for r in empty.results if not r.passed} == {"rc"}
    told = []
    with pytest.raises(rules.PromotionBlocked):
        rules.gate(rules.validate(df, rule_list, "t"), told.append)
    assert told
    with pytest.raises(ValueError):
        rules.parse({"id": "x", "type": "nope"})


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    df = spark.range(5)
    assert s.version("gold", "t") == -1 and not s.exists("gold", "t")
    assert s.write(df, "gold", "t") == 5
    assert s.write(s.read("gold", "t").filter("id > 2"), "gold", "t", mode="overwrite") == 2
    s.write(spark.range(10, 12), "gold", "t")
    assert s.read("gold", "t").count() == 4 and s.read("gold", "t", 0).count() == 5 and s.version("gold", "t") == 2
    assert {(r.id, r._change) for r in s.changes("gold", "t", 1).collect()} == {(10, "insert"), (11, "insert")}
    assert s.write(df, "gold", "t", mode="ignore") == 0 and s.register("gold") == ["gold_t"]
    with pytest.raises(FileExistsError):
        s.write(df, "gold", "t", mode="error")


def test_landing_replay(spark, tmp_path):
    (tmp_path / "clinical").mkdir()
    (tmp_path / "clinical" / "patient.csv").write_text("patient_id,sex\n1,male\n2,female\n2,female\n")
    s = Store(spark, str(tmp_path / "lake"))
    assert landing.ingest_directory(s, str(tmp_path), "b1", ["patient", "encounter"]) == {"patient": 2, "encounter": 0}
    assert landing.ingest_file(s, "patient", str(tmp_path / "clinical" / "patient.csv"), "b2") == 0
    got = s.read("bronze", "patient_raw")
    assert got.columns == ["patient_id", "sex", *rel.TECHNICAL] and got.filter("_record_hash is null").isEmpty()
    with pytest.raises(KeyError):
        landing.bronze_rows(landing.read_csv(spark, str(tmp_path / "clinical" / "patient.csv")), "nope", "b", None)


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,v\n1,x\n2,y\n,z\n")
    schema = StructType([StructField("id", StringType()), StructField("v", StringType())])
    s = Store(spark, str(tmp_path / "lake"))
    stream = st.expect_or_drop(st.csv_stream(spark, str(src), schema), "has_id", F.col("id").isNotNull())
    run = lambda: st.run_available(stream, st.append_new(s, "bronze", "t", "id"), str(tmp_path / "cp"))
    run()
    (src / "b.csv").write_text("id,v\n2,y\n3,w\n")
    run()
    run()
    assert {r.id for r in s.read("bronze", "t").collect()} == {"1", "2", "3"}
    failing = st.expect_or_fail(st.csv_stream(spark, str(src), schema), "id missing", F.col("id").isNotNull())
    with pytest.raises(Exception, match="id missing"):
        st.run_available(failing, lambda df, _: df.write.format("noop").mode("overwrite").save(), str(tmp_path / "cp2"))


def test_watermarked_counts(spark, tmp_path):
    spark.createDataFrame([("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "a"), ("2024-01-01 01:00:00", "b")], "t string, k string").select(F.to_timestamp("t").alias("t"), "k").write.parquet(str(tmp_path / "in"))
    stream = st.windowed_counts(spark.readStream.schema("t timestamp, k string").parquet(str(tmp_path / "in")), "t", "10 minutes", "5 minutes", ["k"])
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.k, r.n) for r in spark.table("counts").collect()} == {("a", 2), ("b", 1)}


def test_cohort_reproduces(spark, tmp_path):
    base = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 2)], "k string, v int")
    crit = {"has": lambda v: base.filter(F.col("v") == v), "many": lambda v: ch.having(base, "k", v), "gone": lambda _: base.filter("k = 'b'")}
    c = ch.parse({"name": "x", "inclusion": [{"type": "has", "value": 1}], "exclusion": [{"type": "gone"}]})
    build = lambda _=None: ch.compile_cohort(c, "k", crit)
    assert rows(build()) == [("a",)]
    got = ch.mergeable_checksum(build()).first()
    path = tmp_path / "m.json"
    assert ch.reproduce(path, c, build) == 1
    ch.Manifest("cohort", "x", c.digest, {}, got["rows"], got["checksum"]).save(path)
    assert ch.reproduce(path, c, build) == 0
    assert ch.reproduce(path, ch.parse({"name": "y", "inclusion": [{"type": "has"}]}), build) == 3
    assert ch.reproduce(path, c, lambda _: base.select("k")) == 4
    assert ch.reproduce(path, c, lambda _: base.filter("k = 'b'").select("k")) == 5
    assert ch.mergeable_checksum(base).first() == ch.mergeable_checksum(base.orderBy(F.rand())).first()
    with pytest.raises(ValueError):
        ch.compile_cohort(ch.parse({"name": "z", "inclusion": []}), "k", crit)
    assert "cohort_name" in ch.with_provenance(build(), c, run="r1").columns


def test_scanner(spark, tmp_path):
    text = "a@b.org twice c@d.com\r\nSSN 123-45-6789\nnot 000-12-3456\nMRN: ABC12345 and DOB: 2001-02-03\n12345-6789 (555) 123-4567"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    got = {(r.id, r.line_no, r.pattern) for r in scanner.scan_lines(df, F.col("text"), ["id"]).collect()}
    assert got == {(1, 1, "email"), (1, 2, "ssn"), (1, 4, "mrn"), (1, 4, "dob_full"), (1, 5, "zip4"), (1, 5, "phone")}
    (tmp_path / "x.txt").write_text("mail a@b.org")
    (tmp_path / "y.png").write_bytes(b"mail a@b.org \0\1")
    (tmp_path / "z.png").write_bytes(b"mail a@b.org \xff\xfe")
    for hidden in (".cache", "made"):
        (tmp_path / hidden).mkdir()
        (tmp_path / hidden / "v.txt").write_text("mail a@b.org")
    (tmp_path / "ok.txt").write_text("mail a@b.org")
    found = scanner.scan_files(spark, [str(tmp_path)], ["ok.txt"], ["made"])
    assert found.count() == 1 == scanner.exit_code(found) and scanner.exit_code(found.limit(0)) == 0


def test_scanner_needs_nothing_that_a_match_lacks(spark):
    """The cheap test before each pattern lets every match through."""
    import re

    rng = random.Random(5)
    seeds = ["123-45-6789", "npi: 1234567890", "NPI#1234567890", "mrn-ab12cd34", "MRN AB12CD34", "a.b@c.de", "+1 (555) 123-4567", "555.123.4567", "12345-6789", "DOB: 2001-02-03", "date of birth = 1/2/2003", "date_of-birth:11/12/2003"]
    lines = ["".join(rng.choice([rng.choice(seeds), rng.choice("ab -./:12@#")]) for _ in range(6)) for _ in range(800)]
    got = {(r.id, r.pattern) for r in scanner.scan_lines(spark.createDataFrame(list(enumerate(lines)), "id int, text string"), F.col("text"), ["id"]).collect()}
    want = {(i, n) for i, t in enumerate(lines) for n, p in scanner.PATTERNS.items() if re.search(p, t, re.ASCII)}
    assert got == want and {n for _, n in want} == set(scanner.PATTERNS)


def test_cuts_are_released(spark):
    import os

    from strata import session

    session.release()
    cut = session.written(spark.range(5), "some")
    path = cut.inputFiles()[0].removeprefix("file://")
    assert cut.count() == 5 and os.path.exists(path)
    assert session.release() == 1 and not os.path.exists(path)


def test_generator_is_seeded(spark):
    p = synth.patients(spark, 30)
    e = synth.encounters(p)
    assert rows(e) == rows(synth.encounters(synth.patients(spark, 30)))
    assert rows(p) != rows(synth.patients(spark, 30, seed=1))
    assert e.filter("discharge_ts < admit_ts").isEmpty() and e.join(p, "patient_id", "left_anti").isEmpty()
    labs = synth.with_orphans(synth.labs(e, {"718-7": (14.0, 2.0)}), "lab_result_id", "encounter_id", 0.2)
    assert 0 < labs.filter("encounter_id like 'ORPHAN-%'").count() < labs.count() / 2
    consent = synth.consents(p, 0.7)
    asked = synth.administrations(p, consent)
    answers = synth.responses(asked)
    scored = synth.scores(asked, answers)
    declined = {r.patient_id for r in consent.filter("consent_status <> 'granted'").collect()}
    assert declined and not declined & {r.patient_id for r in asked.collect()}
    assert {r.completion_status for r in asked.collect()} == {"complete", "partial"}
    held = {}
    for r in answers.collect():
        k = synth.INSTRUMENTS[r.instrument_name]
        assert k.lo <= r.value_num <= k.hi
        held.setdefault(r.administration_id, []).append(r.value_num)
    want = {r.administration_id: float(sum(held[r.administration_id])) for r in asked.collect() if len(held[r.administration_id]) >= synth.INSTRUMENTS[r.instrument_name].items - synth.INSTRUMENTS[r.instrument_name].spare}
    assert {r.administration_id: r.total_score for r in scored.collect()} == want
    for r in scored.filter("instrument_name = 'PHQ-9'").collect():
        assert r.severity_band == ("none-minimal" if r.total_score <= 4 else "mild" if r.total_score <= 9 else "moderate" if r.total_score <= 14 else "moderately-severe" if r.total_score <= 19 else "severe")
    assert {r.severity_band for r in scored.filter("instrument_name = 'SF-36'").collect()} <= {"n/a"}
    waves = {}
    for r in asked.select("patient_id", "wave").distinct().collect():
        waves.setdefault(r.patient_id, set()).add(r.wave)
    assert all("baseline" in w for w in waves.values()) and any(len(w) < 5 for w in waves.values())
    seen = synth.observations(e, synth.VITALS)
    assert 0 < seen.count() < 4 * e.count() and seen.filter("loinc_code = '8310-5' and value_num not between 36 and 38.5").isEmpty()
    assert one(spark, synth.severity(F.lit(12.0), {"low": 4, "mid": 14, "high": 27})) == "mid"


def test_splits_and_metrics(spark):
    df = spark.range(2000).select((F.col("id") % 97).alias("k"), F.col("id").alias("t"), (F.col("id") % 2).cast("int").alias("y"), ((F.col("id") * 37 % 100) / 100).alias("p"), F.when(F.col("id") % 3 == 0, "a").alias("s"))
    split = ml.entity_split(df, "k")
    assert split.groupBy("k").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    t = ml.temporal_split(df, "t").groupBy("split").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    sides = {r.split: (r.lo, r.hi) for r in t.collect()}
    assert sides["train"][1] < sides["test"][0]
    got = {r.level: r for r in ml.subgroup_metrics(df, ["s"], "y", "p").collect()}
    local = [(r.y, r.p) for r in df.filter("s is null").collect()]
    pos, neg = [p for y, p in local if y], [p for y, p in local if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert got[None].auc == pytest.approx(auc) and got[None].n == len(local)
    one_class = ml.subgroup_metrics(df.filter("y = 1"), ["s"], "y", "p").first()
    assert one_class.auc is None


def test_repeated_delivery_goes_through_the_sink(spark, sf, monkeypatch):
    from strata.plans import reference

    total = lambda: reference.stream_ingest_idempotent(spark, sf).agg(F.sum("n")).first()[0]
    events = spark.read.parquet(f"{sf}/events.parquet").count()
    assert total() == events
    # a sink that appends whatever comes must show
    monkeypatch.setattr(reference, "append_new", lambda store, schema, table: lambda batch, _: store.write(batch, schema, table))
    assert total() == 2 * events


def test_matching(spark):
    import random

    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.random(), i % 2) for i in range(400)], "id long, s double, t int")
    t, c = df.filter("t = 1"), df.filter("t = 0")
    got = ml.matched_pairs(t, c, "s", "id", 0.05).collect()
    assert got and all(r.gap <= 0.05 for r in got) and len({r.control for r in got}) == len(got) == len({r.treated for r in got})


def test_matching_is_nearest_free(spark):
    import random

    rng = random.Random(2)
    score = lambda i: rng.choice([rng.uniform(0, 40), rng.uniform(100, 110), float(rng.randrange(30)), float(rng.randrange(30))])
    data = [(i, score(i), i % 3 == 0) for i in range(300)] + [(900, 4.99 - 1000, True), (901, 5.01 - 1000, False), (902, None, True), (903, float("nan"), False)]
    df = spark.createDataFrame(data, "id long, s double, t boolean")
    for caliper in (0.0, 0.3, 5.0):
        free = {i: s for i, s, t in data if not t and s is not None and s == s}
        want = set()
        for i, s, t in data:
            if t and s is not None and free:
                gap, _, near = min((abs(s - x), x, k) for k, x in free.items())
                if gap <= caliper:
                    want.add((i, near))
                    del free[near]
        got = ml.matched_pairs(df.filter("t"), df.filter("not t"), "s", "id", caliper).collect()
        assert {(r.treated, r.control) for r in got} == want and len(got) == len(want)
    assert (900, 901) in want
    assert ml.matched_pairs(df.filter("t"), df.limit(0), "s", "id", 5.0).count() == 0


def test_classifier(spark):
    df = spark.range(600).select("id", (F.col("id") % 10).cast("double").alias("a"), F.rand(1).alias("b")).withColumn("y", (F.col("a") + F.col("b") > 5).cast("int"))
    got = ml.calibrated_classifier(df, ["a", "b"], "y")(df)
    assert got.filter("score < 0 or score > 1").isEmpty()
    assert ml.subgroup_metrics(got.withColumn("s", F.lit("x")), ["s"], "y", "score").first().auc > 0.9
    assert "## Features" in ml.model_card("m", "1", "demo", ["a"], {"auc": 1})


def test_closure_reaches_the_end(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(53)], "source string, target string")
    # few sources, so that the many steps stay cheap
    got = {r.target: r.steps for r in gov.closure(edges).filter("source = 'n0'").collect()}
    assert got == {f"n{i}": i for i in range(1, 54)}


def test_calibration_and_iterations(spark, monkeypatch):
    from pyspark.ml import classification

    asked = []
    real = classification.GBTClassifier

    def trees(**k):
        asked.append(k["maxIter"])
        return real(**k | {"maxIter": 3})

    monkeypatch.setattr(ml, "GBTClassifier", trees)
    df = spark.range(600).select((F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")).withColumn("y", (F.col("a") + F.col("b") > 8).cast("int"))
    isotonic = ml.calibrated_classifier(df, ["a", "b"], "y")(df)
    logistic = ml.calibrated_classifier(df, ["a", "b"], "y", isotonic_from=None)(df)
    assert asked == [50, 50] and isotonic.columns == logistic.columns == ["a", "b", "y", "score"]
    # steps reach 0 and 1, which a logistic curve does not
    assert isotonic.agg(F.min("score"), F.max("score")).first() == (0.0, 1.0)
    assert logistic.filter("score <= 0 or score >= 1").isEmpty()


def test_propensity_pairs(spark):
    df = spark.range(200).select("id", (F.col("id") % 3 == 0).cast("int").alias("t"), F.when(F.col("id") != 9, F.col("id") % 11).alias("x"))
    got = ml.propensity_pairs(df, "t", ["x"], "id").collect()
    assert len(got) == len({r.treated for r in got}) == len({r.control for r in got}) == 66  # all but the one without x
    assert ml.propensity_pairs(df.filter("t = 1"), "t", ["x"], "id").count() == ml.propensity_pairs(df.limit(3), "t", ["x"], "id").count() == 0


def test_governance(spark):
    with pytest.raises(ValueError):
        gov.parse_grants([{"group": "account users", "asset": "*.a.*", "privilege": "SELECT"}])
    with pytest.raises(ValueError):
        gov.parse_grants([{"group": "x@y.org", "asset": "*.a.*", "privilege": "SELECT"}])
    script = gov.grants_script(gov.parse_grants([{"group": "g", "asset": "*.a.*", "privilege": "USE_SCHEMA"}]), "c")
    assert script == ["GRANT USE SCHEMA ON SCHEMA c.a TO `g`;"] and gov.grants_diff([], script) == (script, [])
    edges = spark.createDataFrame([("a", "b", "t"), ("b", "c", "t"), ("a", "c", "t"), ("c", "a", "t")], "source string, target string, transform string")
    assert {(r.source, r.target): r.steps for r in gov.closure(edges).collect()}[("a", "c")] == 1
    with pytest.raises(ValueError):
        gov.request_access("p", "s", " short ", "o")
    log = spark.createDataFrame([("r1",)], "request_id string")
    gov.require_request(log, "r1")
    with pytest.raises(PermissionError):
        gov.require_request(log, "r' or 1=1 --")
    line = gov.JsonFormatter().format(logging.makeLogRecord({"msg": "hi", "level": "extra", "n": 1}))
    assert json.loads(line)["x_level"] == "extra"


def test_freshness(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.write(spark.createDataFrame([(datetime(2024, 1, 1, 0, 0),)], "_ingest_ts timestamp"), "silver", "t")
    got = gov.freshness(spark, s, {"silver.t": 8, "silver.u": 8}, datetime(2024, 1, 1, 4, tzinfo=UTC).replace(tzinfo=None))
    assert [(g[0], g[1], g[4]) for g in got] == [("silver.t", True, True), ("silver.u", False, False)]


def test_as_of_join(spark):
    a = spark.createDataFrame([("k", 5, 1), ("k", 1, 2), ("z", 5, 3)], "k string, t long, id int")
    b = spark.createDataFrame([("k", 5, "x"), ("k", 2, "y"), ("k", 9, "w")], "k string, u long, v string")
    assert {(r.id, r.prior_v) for r in rel.as_of_join(a, b, "k", "t", "u", ["v"]).collect()} == {(1, "x"), (2, None), (3, None)}
    rng = random.Random(3)
    key = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}"
    when = lambda: None if rng.random() < 0.05 else rng.randrange(60)
    left, right = [(key(), when(), i) for i in range(300)], [(key(), when(), f"v{i:03}") for i in range(200)]
    got = {r.id: (r.prior_u, r.prior_v) for r in rel.as_of_join(spark.createDataFrame(left, "k string, t long, id int"), spark.createDataFrame(right, "k string, u long, v string"), "k", "t", "u", ["v"]).collect()}
    for k, t, i in left:
        assert got[i] == max(((u, v) for kk, u, v in right if None not in (k, t, u) and kk == k and u <= t), default=(None, None))
    assert rel.as_of_join(a.limit(0), b, "k", "t", "u", ["v"]).count() == 0 and rel.as_of_join(a, b.limit(0), "k", "t", "u", ["v"]).filter("prior_v is not null").isEmpty()


def test_checksum_in_groups(spark):
    import hashlib
    from itertools import groupby

    digest = lambda parts: hashlib.sha256("|".join(sorted(parts)).encode()).hexdigest()
    df = spark.range(500).select((F.col("id") % 450).alias("a"), F.lit("x").alias("b"))
    hashes = [hashlib.sha256(f"{i % 450}␟x".encode()).hexdigest() for i in range(500)]
    assert ch.checksum(df).first()[0] == digest(hashes) == ch.checksum(df.orderBy(F.rand())).first()[0]
    for rows, digits in ((100, 3), (0.0001, 6)):
        level = {p: digest(f"{h}*{hashes.count(h)}" for h in own) for p, own in ((p, list(own)) for p, own in groupby(sorted(set(hashes)), lambda h: h[:digits]))}
        while digits := digits - 3:
            level = {p: digest(x + level[x] for x in own) for p, own in ((p, list(own)) for p, own in groupby(sorted(level), lambda h: h[:digits]))}
        assert ch.checksum(df.orderBy(F.rand()), rows).first()[0] == digest(p + d for p, d in level.items())
    assert ch.checksum(df.limit(0)).first()[0] == hashlib.sha256(b"").hexdigest()


def test_baseline_of_null_keys(spark):
    df = spark.createDataFrame([("p", None, "baseline", 1.0), ("p", None, "day_30", 7.0), (None, "i", "day_30", 2.0)], "k string, i string, wave string, v double")
    got = {(r.k, r.i, r.wave): (r.change, r.changed_markedly, r.stages) for r in rel.baseline_delta(df, ["k", "i"], "wave", "v").collect()}
    assert got == {("p", None, "baseline"): (0.0, False, 2), ("p", None, "day_30"): (6.0, True, 2), (None, "i", "day_30"): (None, None, 1)}


def test_labs_meet_validated_encounters(spark, sf):
    """A result's encounter is one that Silver holds, not any that was delivered."""
    from strata.plans import layers as L

    labs, stays = L.silver_lab(spark, sf).filter("encounter_sk is not null"), L.silver_encounter(spark, sf).select("encounter_sk")
    assert labs.count() > 0 and labs.join(stays, "encounter_sk", "left_anti").isEmpty()
    assert not L.lab_status(spark, sf).filter("status = 'no_second'").isEmpty()


def test_trailing_and_next_against_brute_force(spark):
    import random

    rng = random.Random(2)
    data = [(i, "hot" if rng.random() < 0.6 else "b", rng.randrange(0, 4000) if rng.random() > 0.02 else None) for i in range(300)]
    df = spark.createDataFrame(data, "id long, k string, s long").select("id", "k", F.timestamp_seconds("s").alias("at"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("c"))
    figures = lambda **kw: {r.id: (r.n, r.total, r.kinds) for r in rel.trailing(df, "k", "at", 500, {"n": F.lit(1), "total": F.col("v")}, {"kinds": F.col("c")}, **kw).collect()}
    got, now = figures(), figures(include_now=True)
    for i, k, s in data:
        for found, upto in ((got, 1), (now, 0)):
            own = [j for j, kk, x in data if s is not None and kk == k and x is not None and s - 500 <= x <= s - upto]
            assert found[i] == (len(own), sum(j % 7 for j in own), len({j % 11 for j in own if j % 5 > 0}))
    assert len(got) == len(data)
    assert rel.trailing(df.limit(0), "k", "at", 500, {"n": F.lit(1)}).count() == 0
    again = {r.id: r.again for r in rel.next_event_within(df.withColumn("end", F.lit(None).cast("timestamp")), "k", "at", "end", "id", 10 / 86_400).collect()}
    for k in ("hot", "b"):
        own = sorted((s, i) for i, kk, s in data if kk == k and s is not None)
        for n, (s, i) in enumerate(own):
            assert again[i] == (n + 1 < len(own) and own[n + 1][0] - s <= 10)
