import itertools
import random

import numpy as np
import pytest

from strata.llm import mixing, packing, spans, tokens


def by_force(texts, need):
    pairs, cover = set(), {}
    seen = {}
    for d, t in texts:
        for i in range(len(t) - need + 1):
            seen.setdefault(t[i : i + need], {}).setdefault(d, []).append(i)
    for where in seen.values():
        for a, b in itertools.combinations(sorted(where), 2):
            pairs.add((a, b))
        if len(where) > 1:
            for d, at in where.items():
                cover.setdefault(d, set()).update(x for i in at for x in range(i, i + need))
    return pairs, {d: len(c) for d, c in cover.items()}


def corpus(seed, need):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("ab cé漢🙂") for _ in range(n))
    common, phrase = [word(rng.randrange(need - 5, 3 * need)) for _ in range(6)], word(need - need // 4)
    texts = []
    for i in range(120):
        parts = [word(rng.randrange(0, 2 * need))]
        for _ in range(rng.randrange(3)):
            c = rng.choice(common)
            a = rng.randrange(len(c) // 2)
            parts += [c[a:], word(rng.randrange(1, need))]
        if rng.random() < 0.7:
            parts += [phrase, word(3)]  # common, but shorter than needed
        texts.append((i, "".join(parts)))
    texts += [(200, texts[0][1]), (201, texts[0][1]), (202, "-" * (3 * need)), (203, "x" + "-" * (2 * need)), (204, ""), (205, "short")]
    return texts


@pytest.mark.parametrize(("seed", "direct", "common"), [(1, 32, 8), (2, 2, 8), (3, 2, 10**9), (4, 8, 2)])
def test_spans_against_brute_force(spark, monkeypatch, seed, direct, common):
    monkeypatch.setattr(spans, "COMMON", common)
    need = 24
    texts = corpus(seed, need)
    schema = "doc_id long, text string, key string, pos int, doc int"
    data = [(d, t, "k", 1, 2) for d, t in texts] + [(900, None, None, None, None), (None, texts[0][1], "", 0, 0), (*texts[3], "again", 0, 0)]
    got = spans.shared_spans(spark.createDataFrame(data, schema), need=need, cover=True, direct=direct)
    pairs = {tuple(r) for r in spans.expand(spans.linked(got), got["members"]).collect()}
    want, cover = by_force(texts, need)
    assert pairs == want
    share = {r.doc_id: r.shared_chars for r in spans.shared_share(spark.createDataFrame(data, schema), need=need, direct=direct).collect()}
    assert share == {d: cover.get(d, 0) for d, _ in texts}


def test_spans_long_and_empty(spark, monkeypatch):
    rng = random.Random(5)
    part = "".join(rng.choice("abcdefgh") for _ in range(400))
    long = lambda n: "".join(rng.choices("ijklmnop", k=n))
    n = spans._CHUNK
    df = spark.createDataFrame([(1, long(n - 150) + part + long(n)), (2, long(50) + part + long(7))], "doc_id long, text string")
    got = spans.shared_spans(df)
    assert [tuple(r) for r in spans.linked(got).collect()] == [(1, 2)]
    none = spans.shared_spans(df.limit(0), cover=True)
    assert spans.linked(none).count() == none["members"].count() == none["spans"].count() == 0


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(1)
    for _ in range(60):
        cap = int(rng.integers(10, 200))
        sizes = rng.integers(1, cap, size=int(rng.integers(1, 60)))
        bins = packing.best_fit_decreasing(sizes, cap)
        fill = np.bincount(bins, weights=sizes)
        assert fill.max() <= cap and len(bins) == len(sizes)
        v, c = np.unique(sizes, return_counts=True)
        assert packing.lower_bound(v, c, cap) <= bins.max() + 1
    assert packing.lower_bound(np.array([51]), np.array([10]), 100) == 10
    assert packing.lower_bound(np.array([34]), np.array([9]), 100) == 5


def test_lower_bound_tries_large_thresholds():
    # beside 600 small sizes, 4,900 leaves too little for 3,300, two of which fill a container
    v = np.array([*range(1, 601), 3300, 4900])
    c = np.array([1] * 600 + [1000, 1000])
    assert packing.lower_bound(v, c, 8192) == 1500


def bound_by_force(x, n, capacity):
    """All three families, one parameter and one item at a time."""
    best = -(-sum(a * b for a, b in zip(x, n, strict=True)) // capacity)
    for t in x:
        if 2 * t <= capacity:
            best = max(best, -(-sum(b * (capacity if a > capacity - t else 0 if a < t else a) for a, b in zip(x, n, strict=True)) // capacity))
            slots = capacity // t
            each = (b * (2 * (slots - (capacity - a) // t) if 2 * a > capacity else slots if 2 * a == capacity else 2 * (a // t)) for a, b in zip(x, n, strict=True))
            best = max(best, -(-sum(each) // (2 * slots)))
    for m in range(2, capacity + 1):
        each = (b * (a * (m - 1) if a * m % capacity == 0 else a * m // capacity * capacity) for a, b in zip(x, n, strict=True))
        best = max(best, -(-sum(each) // (capacity * (m - 1))))
    return best


def test_lower_bound_is_the_best_of_all_parameters():
    rng = np.random.default_rng(2)
    for _ in range(200):
        cap = int(rng.integers(2, 120))
        x = np.unique(rng.integers(1, cap + 1, size=int(rng.integers(1, 30))))
        n = rng.integers(1, 40, size=len(x))
        assert packing.lower_bound(x, n, cap) == bound_by_force(x.tolist(), n.tolist(), cap)


def test_lower_bound_of_many_sizes():
    # two of 5,000 sizes above a third of the capacity fit together at most, whatever else there is
    v = np.concatenate([np.arange(1, 5001), [43_700, 43_701]])
    c = np.concatenate([np.ones(5000, np.int64), [30_000, 30_000]])
    assert packing.lower_bound(v, c, 131_072) == 30_000
    bins = packing.best_fit_decreasing(np.repeat(v, c), 131_072)
    assert bins.max() + 1 == 30_000


def test_pack_reports_what_is_not_certified(spark):
    # 60 + 60 leaves 40 in each container of 100 that nothing fills: the bound knows
    df = spark.createDataFrame([(i, 60) for i in range(50)] + [(100 + i, 51) for i in range(30)], "doc long, tokens long")
    caps = spark.createDataFrame([("s", 100)], "kind string, capacity long")
    got = packing.pack(df, caps, part_items=10)
    assert got.filter("not certified").isEmpty()
    r = packing.packing_report(got).first()
    assert (r.containers, r.certified_containers, r.least_containers) == (80, 80, 80)
    # best fit takes 40 + 40 first and needs three containers where two would do
    hard = spark.createDataFrame([(i, t) for i, t in enumerate([40, 40, 30, 30, 30, 30])], "doc long, tokens long")
    r = packing.packing_report(packing.pack(hard, caps)).first()
    assert (r.containers, r.certified_containers, r.least_containers) == (3, 0, 2)


def test_pack(spark):
    rng = random.Random(3)
    counts = [(i, rng.choice([0, 1, 5, 7, 30, 99, 100, 101, 250])) for i in range(600)] + [(None, 5), (7, 5), (7, 5)]
    caps = spark.createDataFrame([("s", 100), ("l", 200), ("l", 200), (None, 5), ("bad", 0)], "kind string, capacity long")
    df = spark.createDataFrame(counts, "doc long, tokens long")
    got = packing.pack(df, caps, part_items=100)
    rows = got.collect()
    for kind, cap in (("s", 100), ("l", 200)):
        own = [r for r in rows if r.container_kind == kind]
        fill = {}
        for r in own:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.tokens
        assert max(fill.values()) <= cap
        assert sum(r.tokens for r in own) == sum(t for _, t in counts)
        per = {}
        for r in own:
            per.setdefault(r.doc_id, []).append(r)
        whole = {}
        for d, t in counts:
            whole.setdefault(d, []).append(t)
        for d, ts in whole.items():
            assert len(per[d]) == sum(max(1, -(-t // cap)) for t in ts)
    report = {r.container_kind: r for r in packing.packing_report(got).collect()}
    assert set(report) == {"s", "l"} and all(r.least_containers <= r.containers <= 1.1 * r.least_containers for r in report.values())
    assert packing.pack(df.limit(0), caps).count() == 0
    assert packing.pack(df, caps.limit(0)).count() == 0


def test_flow():
    f = mixing.Flow(4)
    a = f.add(0, 2, 5)
    f.add(0, 3, 5)
    f.add(2, 3, 9)
    f.add(3, 1, 4)
    assert f.send(0, 1) == 4 and f.reached(0)[1] < 0
    f.add(2, 1, 3)
    assert f.send(0, 1) == 3 and f.room[a ^ 1] <= 5


def uses_by_force(patterns, targets, quota):
    """Least cost of meeting the quotas token by token, by trying all amounts; None if impossible."""
    cells = [(p, s) for p in patterns for s in p]

    def go(i, need, given):
        if i == len(cells):
            if any(need.values()):
                return None
            return sum(sum(min(patterns[p], max(0, n - k * patterns[p])) * k for k in range(9)) for p, n in given.items())
        p, s = cells[i]
        room = min(need[s], patterns[p] * targets[s][1], patterns[p] * max(targets[x][1] for x in p) - given[p])
        costs = [go(i + 1, need | {s: need[s] - n}, given | {p: given[p] + n}) for n in range(room + 1)]
        return min((c for c in costs if c is not None), default=None)

    return go(0, quota, dict.fromkeys(patterns, 0))


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_the_greatest_and_the_cheapest(seed):
    rng = random.Random(seed)
    names = ["a", "b", "c"]
    targets = {n: (rng.choice([0.2, 0.3, 0.5]), rng.randrange(1, 4)) for n in names}
    sets = [("a",), ("b",), ("c",), ("a", "b"), ("b", "c")]
    patterns = {p: rng.randrange(1, 4) for p in rng.sample(sets, 3)}
    plan = mixing.plan_mixture(patterns, targets)
    by = {s: sum(n for (_, t), n in plan.items() if t == s) for s in names}
    live = {s for p in patterns for s in p}
    scale = sum(targets[s][0] for s in live)
    quota = lambda t: {s: int(t * targets[s][0] / scale + 1e-9) for s in live}
    cost = uses_by_force(patterns, targets, {s: by[s] for s in live})
    used = {p: sum(n for (q, _), n in plan.items() if q == p) for p in patterns}
    assert cost == sum(sum(min(patterns[p], max(0, n - k * patterns[p])) * k for k in range(9)) for p, n in used.items())
    total, step = sum(by.values()), 1
    more = [t for t in range(total + 1, total + 12 * step) if sum(quota(t).values()) > total and all(quota(t)[s] >= by[s] for s in live)]
    assert not any(uses_by_force(patterns, targets, quota(t)) is not None for t in more if min(quota(t)[s] - t * targets[s][0] / scale for s in live) > -1e-6)


def test_plan_reaches_weights():
    targets = {"a": (0.5, 1), "b": (0.3, 4), "c": (0.2, 2), "none": (0.1, 1)}
    plan = mixing.plan_mixture({("a",): 1000, ("b",): 50, ("a", "b"): 40, ("c",): 500}, targets)
    by = {s: sum(n for (_, t), n in plan.items() if t == s) for s in "abc"}
    total = sum(by.values())
    assert {s: round(n / total, 2) for s, n in by.items()} == {"a": 0.5, "b": 0.3, "c": 0.2}
    assert by["b"] == pytest.approx(360, abs=2)  # both its sets, four times over
    assert plan.get((("a", "b"), "a"), 0) == 0
    assert mixing.plan_mixture({}, targets) == {}
    # sets that differ only in a source of no weight add up
    dead = {"a": (0.5, 1), "b": (0.5, 1), "x": (0.0, 1)}
    assert mixing.plan_mixture({("a",): 30, ("a", "x"): 70, ("b",): 100}, dead) == {(("a",), "a"): 100, (("b",), "b"): 100}


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "A ", "b", "x", None]), i, i, 10, rng.randrange(0, 50)) for i in range(2000)]
    docs += [(5000 + i, "b", i, i, 10, docs[i][5]) for i in range(200)]  # also in b
    df = spark.createDataFrame(docs, "doc long, source string, h1 long, h2 long, chars int, tokens long")
    t = spark.createDataFrame([("a", 0.4, 1), ("B", 0.6, 3), ("gone", 0.1, 2), (None, 0.1, 1)], "source string, weight double, repeats int")
    got = mixing.mixture(df, t)
    rows = got.collect()
    uses = {}
    for r in rows:
        assert 0 < r.uses <= {"a": 1, "b": 3}[r.source] and r.tokens > 0
        uses[r.doc_id] = uses.get(r.doc_id, 0) + r.uses
    assert max(uses.values()) <= 3
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mixture(df, t).collect()))
    share = {r.source: r.share for r in mixing.mixture_report(got, t.filter("source is not null")).collect()}
    assert share["a"] == pytest.approx(0.4, abs=0.01) and share["b"] == pytest.approx(0.6, abs=0.01) and share["gone"] == 0
    part = mixing.mixture(df, t, total=5000)
    assert sum(r.uses * r.tokens for r in part.collect()) == pytest.approx(5000, abs=150)
    assert mixing.mixture(df.limit(0), t).count() == mixing.mixture(df, t.limit(0)).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "<|endoftext|> " * 2000)], "id long, text string")
    got = {r.id: r.tokens for r in tokens.with_token_counts(df).collect()}
    encode = tokens.tokenizer(tokens.VOCABULARY).encode_ordinary
    assert got == {1: 2, 2: 0, 3: 0, 4: len(encode("<|endoftext|> " * 2000))}


@pytest.mark.parametrize("name", ["p8_holds", "p9_holds", "p10_found", "p10_share"])
def test_same_as_sql(spark, sf, name):
    from test_catalogue import compare

    from strata.llm import queries

    compare(queries.QUERIES[name](spark, sf), queries.SQL[name], sf)


def test_reports(spark, sf):
    from strata.llm import queries

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = {r.container_kind: r for r in queries.p8_report(spark, sf).collect()}
    kinds = {r.container_kind for r in spark.read.parquet(f"{sf}/pack_capacity.parquet").collect()}
    assert set(packed) == kinds and len({r.tokens for r in packed.values()}) == 1
    assert all(r.least_containers <= r.containers and 0.9 < r.used_share <= 1 for r in packed.values())
    assert queries.p8_pack(spark, sf).select("doc_id").distinct().count() == docs.count()
    shares = {r.source: r for r in queries.p9_shares(spark, sf).collect()}
    assert sum(r.share for r in shares.values()) == pytest.approx(1) and all(r.most_uses <= r.max_repeats for r in shares.values())
