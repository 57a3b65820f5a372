"""Operators of the core problems on small inputs, against brute force."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.asof import as_known
from strata.operators.history import changes, deliveries, history, load, satellite, timeline, united, with_end
from strata.operators.intervals import periods_and_gaps
from strata.operators.orphans import orphan_references
from strata.operators.profile import load_medians, shares, value_counts
from strata.operators.rolling import each_day, trailing_runs
from strata.operators.spikes import implausible, readings, spike_borders, stuck_runs
from strata.sources.store import Store

C = F.col


# --- as known

def known(events, changes):
    return as_known(events, changes, event_id=C("id"), event_entity=C("k"), event_at=C("t"), change_entity=C("k"), valid_from=C("vf"), recorded_at=C("rec"), value=C("value"), slices=5, buckets=3)


EVENT, CHANGE = "id string, k string, t long, s string, ready string", "k string, vf long, rec long, value string, s string, m string"


def test_as_known_random(spark):
    rng = random.Random(3)
    k = lambda: "hot" if rng.random() < 0.4 else f"p{rng.randrange(6)}"
    events = [(f"e{i}", k(), rng.randrange(60), "x", "y") for i in range(300)]
    changes = [(k(), rng.randrange(60), rng.randrange(60), rng.choice(["a", "b", "c", None]), "x", "y") for _ in range(200)]
    got = {r.event_id: (r.value, r.latest_value) for r in known(spark.createDataFrame(events, EVENT), spark.createDataFrame(changes, CHANGE)).collect()}
    for i, key, t, *_ in events:
        own = [(vf, rec, v) for kk, vf, rec, v, *_ in changes if kk == key and v is not None]
        best = max([x for x in own if x[0] <= t and x[1] <= t], default=(0, 0, None))
        assert got[i] == (best[2], max(own, default=(0, 0, None))[2])


def test_as_known_odd(spark):
    events = spark.createDataFrame([("a", None, 5, "", ""), ("b", "k", None, "", ""), (None, "k", 5, "", ""), ("d", "none", 5, "", ""), ("d", "none", 5, "", "")], EVENT)
    changes = spark.createDataFrame([("k", 1, 1, "v", "", ""), (None, 1, 1, "v", "", ""), ("k", None, 1, "w", "", ""), ("k", 9, 9, "late", "", "")], CHANGE)
    assert [(r.event_id, r.value) for r in sorted(known(events, changes).collect(), key=repr)] and rows(known(events, changes).select("event_id", "value", "latest_value")) == sorted(
        [("a", None, None), ("b", None, None), (None, "v", "late"), ("d", None, None), ("d", None, None)], key=repr
    )
    assert rows(known(events.limit(0), changes)) == []
    assert {r.value for r in known(events, changes.limit(0)).collect()} == {None}


# --- history

GROUPS = {"slow": ["a"], "fast": ["b"]}
DELIVERY = "k string, vf long, rec long, a string, b string"


def delivered(df):
    return deliveries(df, entity=C("k"), valid_from=C("vf"), recorded_at=C("rec"), attributes={"a": C("a"), "b": C("b")})


def history_of(spark, where, *batches):
    """The history from one load per batch, and the store."""
    store = Store(spark, str(where))
    for df in batches:
        load(store, "p", delivered(df), GROUPS, slices=4)
    return history(store, "p", GROUPS, slices=4), store


def history_by_force(data):
    want = []
    for key in {d[0] for d in data}:
        won = {}
        for k, vf, rec, a, b in data:
            if k == key:
                new = (rec, (a is not None, a or ""), (b is not None, b or ""))
                if vf not in won or new > won[vf]:
                    won[vf] = new
        state, spans = None, []
        for vf in sorted(won):
            a, b = (x[1] if x[0] else None for x in won[vf][1:])
            new = (a or (state or (None, None))[0], b or (state or (None, None))[1])
            if state is None or new != state:
                spans.append([key, vf, *new])
            state = new
        want += [(*s, e[1] if e else None) for s, e in zip(spans, [*spans[1:], None], strict=True)]
    return sorted(want, key=repr)


def test_history_random(spark, tmp_path):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.5 else f"p{rng.randrange(4)}", rng.randrange(40), rng.randrange(5), rng.choice([None, "x", "y"]), rng.choice([None, "1", "2"])) for _ in range(200)]
    got, store = history_of(spark, tmp_path, spark.createDataFrame(data, DELIVERY))
    assert rows(got.select("entity", "valid_from", "a", "b", "valid_to")) == history_by_force(data)
    slow = timeline(satellite(store, "p", "slow", ["a"]), ["a"]).filter("entity = 'hot'").orderBy("valid_from").collect()
    assert all(x.a != y.a for x, y in zip(slow, slow[1:], strict=False))
    assert [x.valid_to for x in slow[:-1]] == [y.valid_from for y in slow[1:]]


@pytest.mark.parametrize("seed", [1, 2])
def test_satellites_are_insert_only(spark, tmp_path, seed):
    """Batches in any order of validity and arrival, some twice: the view is that of one load,
    stored rows never change, and what was loaded before adds nothing."""
    rng = random.Random(seed)
    data = [(rng.choice(["hot", "hot", "p0", "p1"]), rng.randrange(25), rng.randrange(6), rng.choice([None, "x", "y"]), rng.choice([None, "1", "2", "3"])) for _ in range(150)]
    store, kept = Store(spark, str(tmp_path)), set()
    for i in range(3):
        batch = delivered(spark.createDataFrame(data[i * 50 : i * 50 + 50], DELIVERY))
        load(store, "p", batch, GROUPS, slices=3)
        assert set(load(store, "p", batch, GROUPS, slices=3).values()) == {0}
        now = {(g, *r) for g in GROUPS for r in store.read("vault", f"p_{g}").collect()}
        assert kept <= now
        kept = now
        assert rows(history(store, "p", GROUPS).select("entity", "valid_from", "a", "b", "valid_to")) == history_by_force(data[: i * 50 + 50])
    assert set(load(store, "p", delivered(spark.createDataFrame(data, DELIVERY)), GROUPS).values()) == {0}


def test_late_delivery_restores_what_was_dropped(spark, tmp_path):
    at = lambda *d: spark.createDataFrame([("k", *d)], DELIVERY)
    got, store = history_of(spark, tmp_path, at(1, 1, "x", "1"), at(5, 2, "x", "1"))
    assert store.read("vault", "p_slow").count() == 1 and store.read("vault", "p_track").count() == 2
    assert rows(got.select("valid_from", "a", "valid_to")) == [(1, "x", None)]
    got, store = history_of(spark, tmp_path, at(3, 3, "y", "1"))
    assert rows(got.select("valid_from", "a", "valid_to")) == sorted([(1, "x", 3), (3, "y", 5), (5, "x", None)], key=repr)
    assert store.read("vault", "p_slow").count() == 3 and store.read("vault", "p_fast").count() == 1


def test_history_odd(spark, tmp_path):
    schema = "k string, vf long, rec long, a string, b string, entity string, _slice int, row_hash string"
    df = spark.createDataFrame([(None, 1, 1, "x", "1", "", 0, ""), ("k", None, 1, "x", "1", "", 0, ""), ("k", 1, None, None, None, "", 0, ""), ("k", 2, None, "é" * 5000, None, "", 0, ""), ("k", 2, None, "é" * 5000, None, "", 0, "")], schema)
    assert [(r.entity, r.valid_from, r.valid_to) for r in history_of(spark, tmp_path / "a", df)[0].orderBy("valid_from").collect()] == [("k", 1, 2), ("k", 2, None)]
    assert rows(history_of(spark, tmp_path / "b", df.limit(0), df.limit(0))[0]) == []


def test_history_comes_from_the_satellites(spark):
    slow = spark.createDataFrame([("k", 1, "h", "x"), ("k", 4, "i", None)], "entity string, valid_from long, row_hash string, a string")
    fast = spark.createDataFrame([("k", 1, "h", "1"), ("k", 3, "i", "2"), ("k", 4, "j", "3"), ("k", 9, "l", "1")], "entity string, valid_from long, row_hash string, b string")
    got = with_end(changes(united({"slow": slow, "fast": fast}, GROUPS), ["a", "b"])).select("valid_from", "a", "b", "valid_to")
    assert rows(got) == sorted([(1, "x", "1", 3), (3, "x", "2", 4), (4, "x", "3", 9), (9, "x", "1", None)], key=repr)


# --- intervals

def test_intervals_random(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.5 else f"p{rng.randrange(5)}", s := rng.randrange(600), s + rng.choice([0, 0, 3, 10, -1])) for _ in range(200)]
    data += [(None, 1, 2), ("p1", None, 2), ("p1", 5, None), data[0]]
    got = periods_and_gaps(spark.createDataFrame(data, "entity string, s long, e long"), entity=C("entity"), start=C("s"), end=C("e"), slices=6)
    want = []
    for key in {d[0] for d in data if d[0]}:
        own, spans = sorted((s, e) for k, s, e in data if k == key and s is not None and e is not None and e >= s), []
        for s, e in own:
            if spans and s <= spans[-1][1]:
                spans[-1][1], spans[-1][2] = max(spans[-1][1], e), spans[-1][2] + 1
            else:
                spans.append([s, e, 1])
        want += [(key, "period", *x) for x in spans] + [(key, "gap", a[1], b[0], 0) for a, b in zip(spans, spans[1:], strict=False)]
    assert rows(got) == sorted(want, key=repr)


def test_intervals_empty(spark):
    df = spark.createDataFrame([], "entity string, s long, e long")
    assert rows(periods_and_gaps(df, entity=C("entity"), start=C("s"), end=C("e"))) == []


# --- rolling

def test_rolling_random(spark):
    rng = random.Random(6)
    first, last = date(2024, 1, 1), date(2024, 3, 15)
    data = [(f"p{rng.randrange(3)}", first + timedelta(days=rng.randrange(-5, 80)), rng.choice([1, 2, None])) for _ in range(120)]
    df = spark.createDataFrame([*data, (None, first, 1), ("p0", None, 1)], "entity string, day date, n int")
    runs = trailing_runs(df, entity="entity", day="day", measures=["n"], periods=[7, 30], first_day=str(first), last_day=str(last))
    got = {(r.entity, r.day): (r.n, r.n_7, r.n_30) for r in each_day(runs).collect()}
    held = {}
    for k, d, n in data:
        if first <= d <= last:
            held[k, d] = held.get((k, d), 0) + (n or 0)
    for k in {k for k, _ in held}:
        for x in range((last - first).days + 1):
            d = first + timedelta(days=x)
            back = lambda p, k=k, d=d: sum(held.get((k, d - timedelta(days=i)), 0) for i in range(p))
            assert got[k, d] == (held.get((k, d), 0), back(7), back(30))
    assert rows(trailing_runs(df.limit(0), entity="entity", day="day", measures=["n"], periods=[7], first_day=str(first), last_day=str(last))) == []


# --- spikes

def reading(df):
    return readings(df, row_id=C("id"), source=C("src"), code=C("code"), entity=C("who"), at=C("at"), value=C("v"))


SCHEMA = "id string, src string, code string, who string, at long, v double, d double, e double, median string"


def test_spikes_and_stuck(spark):
    rng = random.Random(7)
    data, n = [], 0
    for code, mid in (("a", 100.0), ("b", 0.5)):
        for _ in range(1500):
            n += 1
            data.append((f"r{n}", "s", code, f"p{rng.randrange(40)}", n * 1_000_000, mid * 2.718281828 ** max(-0.6, min(0.6, rng.gauss(0, 0.2))) + n * 1e-9))
    spikes = {"x1": ("a", 100 * 2.8), "x2": ("b", 0.5 / 2.8), "x3": ("a", 9e6)}
    data += [(i, "s", c, "p1", 10**12 + j, v) for j, (i, (c, v)) in enumerate(spikes.items())]
    data += [("z1", "s", "a", "p2", 1, 0.0), ("z2", "s", "a", None, None, -5.0)]
    stuck = [(f"k{i}", "s", "b", "p3", 2 * 10**12 + i, 0.5) for i in range(6)]
    short = [(f"q{i}", "s", "b", "p4", 2 * 10**12 + i, 0.5) for i in range(5)]
    odd = [(None, "s", "a", "p", 1, 5.0), ("n1", None, None, None, None, 4.0), ("n2", "s", "a", "p", 1, None), ("n3", "s", "a", "p", 1, float("nan"))]
    all_ = [(*x, None, None, None) for x in data + stuck + short + odd + stuck[:3]]
    got = implausible(reading(spark.createDataFrame(all_, SCHEMA)))
    by = {}
    for r in got.collect():
        by.setdefault(r.reason, set()).add(r.id)
    assert by == {"impossible": {"z1", "z2"}, "spike": set(spikes), "stuck": {f"k{i}" for i in range(6)}}


def test_stuck_against_brute_force(spark):
    rng = random.Random(8)
    data = [(f"r{i:04}", "s", "c", "hot" if rng.random() < 0.7 else "cold", rng.randrange(300), float(rng.choice([1, 1, 1, 2])), None, None, None) for i in range(600)]
    got = {r.id for r in stuck_runs(reading(spark.createDataFrame(data, SCHEMA)), least=4, slices=5).collect()}
    want = set()
    for who in ("hot", "cold"):
        own, run = sorted((at, i, v) for i, _, _, w, at, v, *_ in data if w == who), []
        for x in [*own, (0, "", None)]:
            if run and x[2] != run[-1][2]:
                want |= {r[1] for r in run} if len(run) >= 4 else set()
                run = []
            run.append(x)
    assert got == want


def test_spikes_small_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(implausible(reading(empty))) == []
    same = spark.createDataFrame([(f"r{i}", "s", "c", "p", i, 5.0, None, None, None) for i in range(3)], SCHEMA)
    assert rows(implausible(reading(same))) == []
    assert [r.border for r in spike_borders(reading(same)).collect()] == [float("inf")]


# --- profile

def test_profile(spark):
    data = [("l1", "x", 1.0), ("l1", "x", 2.0), ("l1", None, None), ("l2", "y", 4.0), ("l2", "x", None), (None, "z", 3.0)]
    df = spark.createDataFrame(data, "load string, value string, n double")
    got = {(r.column_name, r.load): r for r in shares(value_counts(df, "load", ["value", "n"]), {"value": F.col("value").isin("x", "y")}).collect()}
    a = got["value", "l1"]
    assert (a.rows, a.nulls, a.distinct_values, a.breaches, a.whole_rows, a.whole_nulls) == (3, 1, 1, 0, 6, 1)
    assert a.variation == pytest.approx((abs(1 - 3 / 5) + 1 / 5 + 1 / 5) / 2)
    assert got["value", None].breaches == 1 and (got["n", "l2"].min_number, got["n", "l2"].max_number) == (4.0, 4.0)
    assert rows(shares(value_counts(df.limit(0), "load", ["value"]))) == []
    m = {(r.value, r.load): (r.n, r.load_median, r.whole_median) for r in load_medians(df, "load", "n", ["value"]).collect()}
    assert m["x", "l1"] == (2, 1.5, 1.5)


def test_psi_counts_absent_values(spark):
    rng = random.Random(4)
    data = [(load, rng.choice(held)) for load, held in (("l1", "ab"), ("l2", "abcd"), ("l3", "d"), (None, "ac")) for _ in range(50)] + [("l1", None)]
    figures = {r.load: r for r in shares(value_counts(spark.createDataFrame(data, "load string, value string"), "load", ["value"])).collect()}
    whole = [v for _, v in data if v is not None]
    for load in ("l1", "l2", "l3", None):
        own = [v for x, v in data if x == load and v is not None]
        share = [(own.count(v) / len(own), whole.count(v) / len(whole)) for v in "abcd"]
        assert figures[load].psi == pytest.approx(sum((p - q) * math.log(max(p, 1e-6) / max(q, 1e-6)) for p, q in share))
        assert figures[load].chi_square == pytest.approx(sum((p - q) ** 2 / q * len(own) for p, q in share))
        assert figures[load].variation == pytest.approx(sum(abs(p - q) for p, q in share) / 2)


# --- orphans

def test_orphans_random(spark):
    rng = random.Random(9)
    parents = [(f"k{i}" + "x" * (80 if i == 7 else 0), rng.randrange(50), rng.random() < 0.8) for i in range(60)]
    table = {k: (c, s) for k, c, s in parents}
    names = [*table, "gone", "z" * 100, "ä"]
    records = [(f"r{i}", "gone" if rng.random() < 0.3 else rng.choice(names), rng.choice([rng.randrange(50)])) for i in range(500)] + [("n", None, 3), ("m", "k1", None)]
    got = orphan_references(spark.createDataFrame(records, "row_id string, ref string, seen long"), spark.createDataFrame([*parents, (None, 1, True)], "key string, came long, stands boolean"))
    want = []
    for i, ref, seen in records:
        if ref is None:
            continue
        if ref not in table:
            want.append((i, ref, "missing", seen))
        elif not table[ref][1]:
            want.append((i, ref, "deleted", seen))
        elif seen is None or table[ref][0] > seen:
            want.append((i, ref, "late", seen))
    assert rows(got) == sorted(want, key=repr)


def test_orphans_empty(spark):
    p = spark.createDataFrame([("a", 1, True)], "key string, came long, stands boolean")
    r = spark.createDataFrame([("r", "a", 1), ("s", "b", 1)], "row_id string, ref string, seen long")
    assert rows(orphan_references(r.limit(0), p)) == []
    assert {x[2] for x in rows(orphan_references(r, p.limit(0)))} == {"missing"}


# --- the fitted tail decides which readings are spikes

@pytest.mark.parametrize("share", [0.5, 0.8])
def test_spikes_come_from_the_fitted_tail(spark, monkeypatch, share):
    import numpy as np

    from strata.operators import spikes
    from strata.plans import problems

    large = "/root/testdata/sf0.1"
    want = {tuple(r) for r in problems.p2_found(spark, large).collect()}
    quantile = lambda edges, n, risk: float(edges[np.searchsorted(np.cumsum(n), share * n.sum())])
    monkeypatch.setattr(spikes, "_tail", quantile)
    other = {tuple(r) for r in problems.p2_found(spark, large).collect()}
    assert len(other ^ want) > len(want)


def test_few_readings_share_the_tail_of_their_code(spark):
    rng = random.Random(11)
    v = lambda: 50.0 * 2.718281828 ** max(-0.6, min(0.6, rng.gauss(0, 0.2)))
    data = [(f"r{i}", "many", "a", None, i, v()) for i in range(900)] + [(f"f{i}", "few", "a", None, i, v()) for i in range(7)]
    data += [("x", "few", "a", None, 8, 50.0 * 2.718281828**1.3), ("y", "lone", "b", None, 1, 7.0)]
    got = implausible(reading(spark.createDataFrame([(*x, None, None, None) for x in data], SCHEMA)))
    assert rows(got) == [("x", "spike")]
