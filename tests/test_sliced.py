import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import sliced


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(1)
    data = [(("hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}"), rng.randrange(40), i, rng.choice([None, f"v{rng.randrange(3)}"])) for i in range(400)]
    return data, spark.createDataFrame(data, "k string, t long, id long, v string")


def test_row_number_and_previous(spark, frame):
    data, df = frame
    s = sliced.sliced(df, "t", slices=7)
    got = {r.id: r.n for r in sliced.row_number(s, ["k"], ["t", "id"], "n").collect()}
    before = {r.id: r.prev_id for r in sliced.previous(s, ["k"], ["t", "id"], ["id"]).collect()}
    for key in {d[0] for d in data}:
        own = sorted((t, i) for k, t, i, _ in data if k == key)
        for n, (_, i) in enumerate(own, 1):
            assert got[i] == n
            assert before[i] == (own[n - 2][1] if n > 1 else None)


def test_filled_forward_and_following(spark, frame):
    data, _ = frame
    one = {(k, t): v for k, t, _, v in data}
    df = spark.createDataFrame([(k, t, v) for (k, t), v in one.items()], "k string, t long, v string")
    s = sliced.sliced(df, "t", slices=7)
    filled = {(r.k, r.t): (r.v, r.was_v, r._first) for r in sliced.filled_forward(s, ["k"], "t", ["v"]).collect()}
    nxt = {(r.k, r.t): r.n for r in sliced.following(s, ["k"], "t", "n").collect()}
    for key in {k for k, _ in one}:
        last, own = None, sorted(t for k, t in one if k == key)
        for n, t in enumerate(own):
            was, last = last, one[key, t] if one[key, t] is not None else last
            assert filled[key, t] == (last, was, n == 0)
            assert nxt[key, t] == (own[n + 1] if n + 1 < len(own) else None)


@pytest.mark.parametrize("per_slice", [2_000_000, 3])
def test_slices_follow_the_rows(spark, frame, monkeypatch, per_slice):
    monkeypatch.setattr(sliced, "SLICE_ROWS", per_slice)
    data, df = frame
    s = sliced.sliced(df, "t", slices=7)
    assert (s.select(F.max("_slice")).first()[0] > 7) == (per_slice == 3)
    assert s.groupBy("t").agg(F.count_distinct("_slice").alias("n")).filter("n > 1").isEmpty()
    order = [r._slice for r in s.orderBy("t").collect()]
    assert order == sorted(order)
    total = {r.id: r.total for r in sliced.sum_before(s, ["k"], ["t", "id"], "id", "total").collect()}
    near = {r.id: (r.prev_id, r.next_id) for r in sliced.neighbour(sliced.previous(s, ["k"], ["t", "id"], ["id"]), ["k"], ["t", "id"], ["id"], "next_", ahead=True).collect()}
    for key in {d[0] for d in data}:
        own = [i for _, i in sorted((t, i) for k, t, i, _ in data if k == key)]
        for n, i in enumerate(own):
            assert total[i] == sum(own[:n])
            assert near[i] == (own[n - 1] if n else None, own[n + 1] if n + 1 < len(own) else None)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_weighted_quantile(spark, q):
    import numpy as np

    rng = random.Random(2)
    data = [(g, rng.choice([-3.5, 0.0, 1.25, rng.uniform(-100, 1e4)]), rng.randrange(1, 4)) for g in "ab" for _ in range(rng.randrange(50, 90))]
    df = spark.createDataFrame([*data, ("c", 7.0, 1)], "g string, v double, w long")
    got = {r.g: r.m for r in sliced.weighted_quantile(df, ["g"], "v", "w", q, "m").collect()}
    for g in "ab":
        want = np.quantile(np.repeat([v for k, v, _ in data if k == g], [w for k, _, w in data if k == g]), q)
        assert got[g] == pytest.approx(want, abs=1e-9)
    assert got["c"] == 7.0


def test_empty(spark):
    df = spark.createDataFrame([], "k string, t long, v string")
    s = sliced.sliced(df, "t")
    assert rows(sliced.row_number(s, ["k"], ["t"], "n")) == []
    assert rows(sliced.filled_forward(s, ["k"], "t", ["v"])) == []
    assert sliced.bounded(df).count() == 0
    assert rows(sliced.weighted_quantile(df.select("k", F.lit(1.0).alias("v"), F.lit(1).alias("w")), ["k"], "v", "w", 0.5, "m")) == []
