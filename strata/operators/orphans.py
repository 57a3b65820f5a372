"""References to records that do not exist, were deleted or came later."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SHORT = 64  # bytes: keys up to here lie in fixed-width arrays


def _bytes(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = col.cast(pa.binary()).to_pylist()
    if raw and max(map(len, raw)) <= _SHORT:
        return np.array(raw, dtype=f"S{_SHORT}")
    out = np.empty(len(raw), dtype=object)
    out[:] = raw
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    if not parts:
        return np.empty(0, dtype=f"S{_SHORT}")
    return np.concatenate(parts if len({p.dtype for p in parts}) == 1 else [p.astype(object) for p in parts])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range: its parents come first, sorted, and become arrays; each batch of referenced
    keys is then looked up by binary search."""
    keys: list[np.ndarray] = []
    first: list[np.ndarray] = []
    alive: list[np.ndarray] = []
    table = None
    for b in batches:
        parent = b.column("kind").to_numpy(zero_copy_only=False) == 0
        if parent.any():
            p = b.filter(pa.array(parent))
            keys.append(_bytes(p.column("k")))
            first.append(p.column("at").fill_null(-(2**62)).to_numpy(zero_copy_only=False))
            alive.append(p.column("alive").to_numpy(zero_copy_only=False).astype(bool))
        if parent.all():
            continue
        if table is None:
            table = _joined(keys), np.concatenate(first) if first else np.empty(0, np.int64), np.concatenate(alive) if alive else np.empty(0, bool)
        r = b.filter(pa.array(~parent))
        asked, early = _bytes(r.column("k")), r.column("at").fill_null(-(2**62)).to_numpy(zero_copy_only=False)
        have, at, lives = table
        if asked.dtype != have.dtype:
            asked, have = asked.astype(object), have.astype(object)
        n = len(have)
        pos = np.searchsorted(have, asked)
        hit = pos < n
        hit[hit] = have[pos[hit]] == asked[hit]
        safe = np.where(hit, pos, 0)
        dead = hit & ~lives[safe] if n else hit
        late = hit & ~dead & (at[safe] > early) if n else hit
        bad = ~hit | dead | late
        status = np.where(~hit, "missing", np.where(dead, "deleted", "late"))
        came = at[safe] if n else np.zeros(len(asked), np.int64)
        yield pa.RecordBatch.from_arrays(
            [r.column("k").filter(pa.array(bad)), pa.array(status[bad], pa.string()), pa.array(came[bad], pa.int64())],
            names=["ref", "status", "came"],
        )


def orphan_references(records: DataFrame, parents: DataFrame) -> DataFrame:
    """(row_id, ref, status, seen): the records whose reference is `missing` among the parents,
    `deleted` (the parent doesn't stand) or `late` (the parent came after the record).

    records: (row_id, ref, seen bigint), one row per record; a null `ref` is no reference.
    parents: (key, came bigint, stands boolean), one row per key; null keys are ignored.

    Only the distinct referenced keys, each with its earliest record, meet the parents: both sides
    then have one row per key, so range partitions of the key are even, whatever share of the
    records one key has. Each range keeps its parents as sorted arrays and answers batches of
    keys by binary search. The keys found at fault go back to their records by a join, whose hot
    keys adaptive execution splits. A null `seen` counts as earlier than any time."""
    asked = records.filter("ref is not null").groupBy("ref").agg(F.min(F.coalesce("seen", F.lit(-(2**62)))).alias("at"))
    both = parents.filter("key is not null").select(
        F.col("key").alias("k"), F.col("came").alias("at"), F.coalesce("stands", F.lit(True)).alias("alive"), F.lit(0).alias("kind")
    ).unionByName(asked.select(F.col("ref").alias("k"), "at", F.lit(True).alias("alive"), F.lit(1).alias("kind")))
    faulty = (
        both.repartitionByRange("k").sortWithinPartitions("kind", "k")
        .mapInArrow(_probe, "ref string, status string, came long")
    )
    return (
        records.join(faulty, "ref")
        .filter((F.col("status") != "late") | (F.col("came") > F.coalesce("seen", F.lit(-(2**62)))))
        .select("row_id", "ref", "status", "seen")
    )
