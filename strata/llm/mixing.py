"""Mixing overlapping sources to target weights."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.sliced import bounded
from strata.session import written


class Flow:
    """Maximum flow that can be carried on after arcs grew wider: shortest paths in phases
    (Dinic). Nodes are numbers; an arc and its reverse are neighbours."""

    def __init__(self, nodes: int) -> None:
        self.to: list[int] = []
        self.room: list[int] = []
        self.at: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, room: int) -> int:
        for u, v, r in ((a, b, room), (b, a, 0)):
            self.at[u].append(len(self.to))
            self.to.append(v)
            self.room.append(r)
        return len(self.to) - 2

    def reached(self, a: int) -> list[int]:
        """Steps from a to each node along arcs with room; -1 where there is no way."""
        far = [-1] * len(self.at)
        far[a], queue = 0, [a]
        for u in queue:
            for i in self.at[u]:
                if self.room[i] and far[self.to[i]] < 0:
                    far[self.to[i]] = far[u] + 1
                    queue.append(self.to[i])
        return far

    def send(self, a: int, b: int) -> int:
        """As much more as possible from a to b; the amount. What leaves a by an arc never
        becomes less."""
        total = 0
        while (far := self.reached(a))[b] >= 0:
            tried = [0] * len(self.at)
            path: list[int] = []
            u = a
            while True:
                if u == b:
                    amount = min(self.room[i] for i in path)
                    for i in path:
                        self.room[i] -= amount
                        self.room[i ^ 1] += amount
                    total += amount
                    first = next(n for n, i in enumerate(path) if not self.room[i])
                    u, path = self.to[path[first] ^ 1], path[:first]
                elif tried[u] < len(self.at[u]):
                    i = self.at[u][tried[u]]
                    if self.room[i] and far[self.to[i]] == far[u] + 1:
                        path.append(i)
                        u = self.to[i]
                    else:
                        tried[u] += 1
                elif path:
                    far[u] = -1
                    u = self.to[path.pop() ^ 1]
                else:
                    break
        return total


def _network(patterns: dict[tuple, int], targets: dict[str, tuple[float, int]], quota: dict[str, int], laps: int | None = None) -> tuple[Flow, dict, dict, dict]:
    """Tokens flow from node 0 by sets of sources to sources to node 1. A set gives its tokens
    `laps` times (default: as often as the most patient of its sources allows), and each source
    takes them as often as it allows."""
    source = {s: 2 + i for i, s in enumerate(quota)}
    node = {p: 2 + len(quota) + i for i, p in enumerate(patterns)}
    flow = Flow(2 + len(quota) + len(patterns))
    inflow = {p: flow.add(0, node[p], t * (max(targets[s][1] for s in p) if laps is None else laps)) for p, t in patterns.items()}
    sent = {(p, s): flow.add(node[p], source[s], t * targets[s][1]) for p, t in patterns.items() for s in p}
    ends = {s: flow.add(source[s], 1, q) for s, q in quota.items()}
    return flow, inflow, sent, ends


def _routed(patterns: dict[tuple, int], targets: dict[str, tuple[float, int]], quota: dict[str, int]) -> dict[tuple, int]:
    """Tokens of each set sent to each source: the flow that meets the quotas at least cost, where
    the k-th use of a token costs k - 1, whatever set it is of. Since the costs are convex and the
    same for all sets, it is found lap by lap: all that can flow with one use each, then with
    two, and so on; what a set gave in earlier laps stays given."""
    flow, inflow, sent, _ = _network(patterns, targets, quota, 0)
    most = {p: max(targets[s][1] for s in p) for p in patterns}
    for lap in range(1, max(most.values(), default=0) + 1):
        for p, i in inflow.items():
            flow.room[i] += patterns[p] if lap <= most[p] else 0
        flow.send(0, 1)
    return {k: flow.room[i ^ 1] for k, i in sent.items() if flow.room[i ^ 1] > 0}


def plan_mixture(patterns: dict[tuple, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[tuple, int]:
    """{(sources, source): tokens}. Weights of sources without any tokens are left out and the
    others scaled up to 1. `total` is met if the sources allow it; by default, and beyond what
    they allow, it is the greatest total at which every source reaches its weight."""
    given = {p: t for p, t in patterns.items() if p and t > 0}
    live = sorted({s for p in given for s in p if targets[s][0] > 0 and targets[s][1] > 0})
    merged: dict[tuple, int] = {}
    for p, t in given.items():
        if q := tuple(s for s in p if s in set(live)):
            merged[q] = merged.get(q, 0) + t  # sets that differ in dead sources alone
    if not live:
        return {}
    scale = sum(Fraction(targets[s][0]) for s in live)
    weight = {s: Fraction(targets[s][0]) / scale for s in live}
    quota = lambda t: {s: int(t * w) for s, w in weight.items()}
    most = sum(t * max(targets[s][1] for s in p) for p, t in merged.items())
    best = Fraction(most if total is None else min(total, most))
    while True:
        # a total is too much if some sources together need more than the sets they stand in can
        # give; the least cut names them, and they allow just that much
        flow, inflow, sent, ends = _network(merged, targets, quota(best))
        if flow.send(0, 1) == sum(quota(best).values()):
            break
        far = flow.reached(0)
        scarce = [s for s, i in ends.items() if far[flow.to[i ^ 1]] < 0]
        width = lambda i: flow.room[i] + flow.room[i ^ 1]  # noqa: E731, B023
        can = sum(width(i) for i in inflow.values() if far[flow.to[i]] < 0) + sum(width(i) for i in sent.values() if far[flow.to[i ^ 1]] >= 0 > far[flow.to[i]])
        best = Fraction(can) / sum(weight[s] for s in scarce)
    return _routed(merged, targets, quota(best))


def mixture(counted: DataFrame, targets: DataFrame, *, total: int | None = None, seed: int = 42, most_patterns: int = 100_000) -> DataFrame:
    """(doc_id, source, uses, tokens): how often each document is used, and for which source.

    counted: (doc, source, h1, h2, chars, tokens), a row per document; equal texts (h1, h2,
    chars) are one document that belongs to all sources it stands in, represented by its least
    id. targets: (source, weight, repeats). Sources compare trimmed and ignoring case.

    Documents are added up by the set of target sources they stand in, at most 2^sources rows,
    which are all the driver sees (an error beyond `most_patterns`, for which routing on the driver
    takes about a minute). Min-cost flow routes each set's tokens to source quotas: a
    document is used at most `repeats` times for a source, and over all sources no more often
    than the greatest `repeats` among its own. Within a set, documents lie end to end in a seeded
    random order, lap after lap; each source gets a stretch of that line, and a document is used
    by whose stretch its middle lies in. Shares are therefore met up to half a document per set
    and source. Positions come from cumulative sums per hash slice, so a source with much of all
    rows is spread over tasks.

    Null sources, weights or repeats, and sources without a target, count as no source; documents
    without tokens are not used; empty tables give no rows."""
    same = lambda c: F.lower(F.trim(c))
    rows = targets.select(same(F.col("source")).alias("s"), "weight", "repeats").filter("s is not null and weight > 0 and repeats > 0").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10000 target sources")
    aim = {r["s"]: (float(r["weight"]), int(r["repeats"])) for r in rows}
    known = F.when(same(F.col("source")).isin(list(aim)), same(F.col("source"))) if aim else F.lit(None).cast("string")
    texts = written(
        counted.withColumn("source", known).groupBy("h1", "h2", "chars").agg(F.min("doc").alias("doc"), F.max("tokens").alias("tokens"), F.array_sort(F.collect_set("source")).alias("sources"))
        .filter((F.size("sources") > 0) & (F.col("tokens") > 0)),
        "texts",
    )
    sums = texts.groupBy("sources").agg(F.sum("tokens").alias("t")).limit(most_patterns + 1).collect()
    if len(sums) > most_patterns:
        raise ValueError("too many sets of sources")
    tokens = {tuple(r["sources"]): int(r["t"]) for r in sums}
    sent = plan_mixture(tokens, aim, total)
    spark = counted.sparkSession
    plan = []
    for p, t in tokens.items():
        at = 0
        for s in p:
            if n := sent.get((tuple(x for x in p if aim[x][0] > 0), s), 0):
                plan.append((list(p), s, at, at + n, t))
                at += n
    plan_df = bounded(spark.createDataFrame(plan, "sources array<string>, source string, lo long, hi long, lap long"))
    order = F.xxhash64(F.lit(seed), "h1", "h2", "chars")
    placed = texts.withColumn("r", order).withColumn("slice", F.shiftrightunsigned("r", 56))
    per = placed.groupBy("sources", "slice").agg(F.sum("tokens").alias("n"))
    early = Window.partitionBy("sources").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("sources", "slice", F.coalesce(F.sum("n").over(early), F.lit(0)).alias("before"))
    w = Window.partitionBy("sources", "slice").orderBy("r", "doc").rowsBetween(Window.unboundedPreceding, 0)
    line = placed.withColumn("upto", F.sum("tokens").over(w)).join(before, ["sources", "slice"])
    middle = F.col("before") + F.col("upto") - F.col("tokens") / 2
    laps = lambda end: F.ceil((F.col(end) - F.col("middle")) / F.col("lap"))
    return (
        line.select("sources", "doc", "tokens", middle.alias("middle")).join(plan_df, "sources")
        .select(F.col("doc").alias("doc_id"), "source", F.greatest(laps("hi") - laps("lo"), F.lit(0)).cast("long").alias("uses"), "tokens")
        .filter("uses > 0")
    )


def mixture_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: its weight, the tokens drawn for it and the share really reached."""
    got = mixed.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("uses") * F.col("tokens")).alias("tokens"), F.max("uses").alias("most_uses"))
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # over one row a source
    rows = targets.select(F.lower(F.trim("source")).alias("source"), "weight", "repeats")
    none = lambda c: F.coalesce(c, F.lit(0))
    joined = rows.join(got.withColumn("all_tokens", total), "source", "left")
    return joined.select(
        "source", F.col("weight").alias("target_weight"), F.col("repeats").alias("max_repeats"), none("documents").alias("documents"), none("tokens").alias("tokens"),
        none("most_uses").alias("most_uses"), F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("share"),
    )
