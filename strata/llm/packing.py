"""Filling containers of fixed capacity with documents, with a certified bound."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import written

#: Items packed by one task at a time.
PART_ITEMS = 20_000


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Least number of containers that any packing needs, by dual feasible functions: maps of
    sizes under which no full container can exceed the capacity, so that the mapped total over
    the capacity bounds every packing. The best of three families over all their parameters; the
    first and third come from cumulative counts by size, in about capacity times its logarithm."""
    keep = sizes > 0
    x, n = sizes[keep].astype(np.int64), counts[keep].astype(np.int64)
    if not len(x):
        return int(counts.sum() > 0)
    of = np.zeros(capacity + 2, dtype=np.int64)  # how many items have each size
    np.add.at(of, x, n)
    held = np.arange(capacity + 2, dtype=np.int64)
    upto, space = np.cumsum(of), np.cumsum(of * held)
    total = int(space[-1])
    best = -(-total // capacity)
    t = np.unique(x[2 * x <= capacity])
    if len(t):
        # sizes above capacity - t fill a container; sizes below t vanish
        mapped = (upto[-1] - upto[capacity - t]) * capacity + space[capacity - t] - space[t - 1]
        best = max(best, int((-(-mapped // capacity)).max()))
        # whole multiples of t; sizes above half the capacity by what they leave
        small, left = np.where(2 * held < capacity, of, 0), np.where(2 * held > capacity, of, 0)[capacity::-1]
        at_least = np.cumsum(small[::-1])[::-1]
        left_at_least = np.cumsum(left[::-1])[::-1]
        large, half = int(left.sum()), int(of[capacity // 2]) if capacity % 2 == 0 else 0
        for step in t.tolist():
            slots = capacity // step
            sum_small, sum_left = int(at_least[step::step].sum()), int(left_at_least[step::step].sum())
            best = max(best, -(-(2 * (slots * large - sum_left) + half * slots + 2 * sum_small) // (2 * slots)))
    # multiples of capacity / m, rounded down unless exact, over m - 1. The bound is at most
    # m / (m - 1) times the plain one, so no greater m can help once that is not above the best
    for m in range(2, capacity + 1):
        if -(-total * m // ((m - 1) * capacity)) <= best:
            break
        scaled = x * m
        mapped = np.where(scaled % capacity == 0, x * (m - 1), scaled // capacity * capacity)
        best = max(best, -(-int((mapped * n).sum()) // (capacity * (m - 1))))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item: largest first, into the fullest container that takes it.
    Rooms are kept as a bit set, so finding it is one shift."""
    bins = np.empty(len(sizes), dtype=np.int64)
    rooms: dict[int, list[int]] = {}
    mask = used = 0
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            stack = rooms[room]
            b = stack.pop()
            if not stack:
                mask ^= 1 << room
        else:
            room, b, used = capacity, used, used + 1
        bins[i] = b
        left = room - s
        stack = rooms.setdefault(left, [])
        if not stack:
            mask |= 1 << left
        stack.append(b)
    return bins


def _reopened(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[np.ndarray, bool]:
    """(whether each item is exchanged, whether the partition is certified): a partition that
    needs more containers than its bound hands on the items of its emptiest ones, taken until
    their free space is twice the surplus."""
    total = int(bins.max()) + 1
    fill = np.bincount(bins, weights=sizes, minlength=total)
    values, counts = np.unique(sizes, return_counts=True)
    surplus = total - lower_bound(values, counts, capacity)
    opened = np.zeros(total, dtype=bool)
    if surplus > 0:
        order = np.argsort(fill, kind="stable")
        free = np.cumsum(capacity - fill[order])
        opened[order[: max(2, int(np.searchsorted(free, 2.0 * surplus * capacity)) + 1)]] = True
    return opened[bins], surplus <= 0


def _pack_part(round_no: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity = int(pdf["capacity"].iloc[0])
        pdf = pdf.sort_values(["tokens", "doc", "piece", "row"], ascending=False, kind="stable")
        sizes = pdf["tokens"].to_numpy(np.int64)
        bins = best_fit_decreasing(sizes, capacity)
        opened, certified = _reopened(sizes, bins, capacity)
        part = int(pdf["part"].iloc[0])
        out = pdf[["kind", "capacity", "doc", "piece", "first", "tokens", "row"]].copy()
        out["bin"] = [f"{round_no}-{part}-{b}" for b in bins]
        out["open"] = opened & (not last)
        out["certified"] = certified
        return out

    return run


def pieces(counts: DataFrame, capacities: DataFrame) -> DataFrame:
    """(kind, capacity, doc, piece, first, tokens): a document no longer than the capacity is one
    piece; a longer one is cut into full pieces and one rest."""
    kinds = [(r["kind"], r["capacity"]) for r in capacities.distinct().limit(1001).collect()]
    if len(kinds) > 1000:
        raise ValueError("more than 1000 kinds of containers")
    kinds = sorted({(k, c) for k, c in kinds if k is not None and c is not None and c > 0})
    if not kinds:
        return counts.limit(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (("kind", "string"), ("capacity", "long"))], "doc", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("first"), "tokens")
    each = counts.select("doc", "tokens", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("long").alias("capacity")) for k, c in kinds])).alias("k"))
    last = F.greatest(F.ceil(F.col("tokens") / F.col("k.capacity")) - 1, F.lit(0))
    cut = each.select("k.kind", "k.capacity", "doc", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    first = F.col("piece") * F.col("capacity")
    return cut.select("kind", "capacity", "doc", "piece", first.alias("first"), F.least(F.col("capacity"), F.col("tokens") - first).alias("tokens"))


def pack(counts: DataFrame, capacities: DataFrame, *, part_items: int = PART_ITEMS) -> DataFrame:
    """(container_kind, capacity_tokens, container_id, doc_id, piece_no, first_token, tokens,
    certified): every document in containers of each kind. counts: (doc, tokens); capacities:
    (kind, capacity).

    Full pieces of long documents fill a container each. All other pieces are spread by hash over
    partitions of about `part_items` and packed by best-fit decreasing. A partition whose number
    of containers equals its lower bound (`lower_bound`) is certified and done. The others hand
    the documents of their emptiest containers on: these are pooled over partitions of the same
    size and packed again, until nothing is handed on, one partition holds all of it, or a round
    leaves as much as it got. `certified` tells whether a container's partition met its bound in
    its last round. Rounds are written to the shared folder; only what is handed on is read again.

    Documents without tokens take no space but get a container. Kinds with a null name or without
    a positive capacity are ignored; repeated rows are items of their own; an empty table gives
    no rows."""
    # written: the token counts, cuts and row numbers must not be worked out anew in each round
    items = written(pieces(counts, capacities).withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = items.filter("tokens = capacity").select(
        "kind", "capacity", F.concat(F.lit("full-"), F.col("row")).alias("bin"), "doc", "piece", "first", "tokens", F.lit(True).alias("certified")
    )
    todo, done, r, before = items.filter("tokens < capacity"), [full], 0, None
    schema = "kind string, capacity long, doc long, piece long, first long, tokens long, row long, bin string, open boolean, certified boolean"
    while True:
        most = todo.groupBy("kind").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        parts = max(1, -(-most // part_items))
        r += 1
        last = parts == 1 or (before is not None and most >= before)
        spread = F.pmod(F.xxhash64("row", F.lit(r)), F.lit(parts)).cast("long")
        got = written(todo.withColumn("part", spread).groupBy("kind", "part").applyInPandas(_pack_part(r, last), schema), f"round{r}")
        done.append(got.filter("not open").select("kind", "capacity", "bin", "doc", "piece", "first", "tokens", "certified"))
        if last:
            break
        todo, before = got.filter("open").drop("bin", "open", "certified"), most
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(
        F.col("kind").alias("container_kind"), F.col("capacity").alias("capacity_tokens"), F.concat("kind", F.lit("-"), "bin").alias("container_id"),
        F.col("doc").alias("doc_id"), F.col("piece").alias("piece_no"), F.col("first").alias("first_token"), "tokens", "certified",
    )


def packing_report(packed: DataFrame) -> DataFrame:
    """Per kind: containers, how many of them come from a partition that met its bound, the lower
    bound over all documents (the packing is the best there is if it equals the containers), and
    the share of space used. The bound is worked out from the number of pieces of each size: at
    most `capacity` rows a kind."""
    each = packed.groupBy("container_kind", "container_id").agg(F.sum("tokens").alias("tokens"), F.min("certified").alias("certified"))
    bins = each.groupBy("container_kind").agg(F.count("*").alias("containers"), F.count_if("certified").alias("certified_containers"), F.sum("tokens").alias("tokens"))
    sizes = packed.groupBy("container_kind", "capacity_tokens", "tokens").agg(F.count("*").alias("n"))

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        c = int(pdf["capacity_tokens"].iloc[0])
        return pd.DataFrame({"container_kind": [pdf["container_kind"].iloc[0]], "capacity_tokens": [c], "least_containers": [lower_bound(pdf["tokens"].to_numpy(), pdf["n"].to_numpy(), c)]})

    bounds = sizes.groupBy("container_kind").applyInPandas(bound, "container_kind string, capacity_tokens long, least_containers long")
    return bins.join(bounds, "container_kind").withColumn("used_share", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
