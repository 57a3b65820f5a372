"""Attributes as known at event time (two time axes: valid from, recorded at)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.sliced import SLICES, boundaries, slice_of

_NEVER = -(2**62)


def _probe(events: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """Binary search of each event among its entity's versions, sorted by the time from which
    they are usable, with the running best version at each of them."""
    out = pd.DataFrame({"event_id": events["id"], "entity": events["k"], "event_at": events["t"]})
    n = len(changes)
    if n == 0 or len(events) == 0:
        for c in ("value", "latest_value"):
            out[c] = pd.Series([None] * len(out), dtype=object)
        for c in ("valid_from", "recorded_at"):
            out[c] = pd.array([pd.NA] * len(out), dtype="Int64")
        return out[["event_id", "entity", "event_at", "value", "valid_from", "recorded_at", "latest_value"]]
    codes, _ = pd.factorize(np.concatenate([changes["k"].to_numpy(object), events["k"].to_numpy(object)]))
    # a bucket may hold several slices of an entity: each is searched on its own
    slot = np.concatenate([changes["s"].to_numpy(np.int64), events["s"].to_numpy(np.int64)])
    codes = codes.astype(np.int64) * (slot.max() + 1) + slot
    ck, ek = codes[:n], codes[n:]
    ready, vf, rec = (changes[c].to_numpy(np.int64) for c in ("ready", "vf", "rec"))
    value = changes["value"].to_numpy(object)
    usable = np.array([v is not None for v in value])
    # version order: valid_from, recorded_at, value
    vcode = np.unique(np.where(usable, value, "").astype(str), return_inverse=True)[1]
    rank = np.empty(n, np.int64)
    rank[np.lexsort((vcode, rec, vf, usable))] = np.arange(n)
    times = np.unique(ready)
    width = len(times) + 1
    at = ck * width + np.searchsorted(times, ready, side="right")
    order = np.argsort(at, kind="stable")
    best = np.maximum.accumulate(ck[order] * n + rank[order])  # starts anew at each entity
    where = np.searchsorted(at[order], ek * width + np.searchsorted(times, events["t"].to_numpy(np.int64), side="right"), side="right") - 1
    row = np.empty(n, np.int64)
    row[rank] = np.arange(n)
    hit = where >= 0
    hit[hit] &= ck[order][where[hit]] == ek[hit]
    pick = np.where(hit, row[best[np.maximum(where, 0)] % n], 0)
    hit &= usable[pick]
    out["value"] = np.where(hit, value[pick], None)
    out["valid_from"] = pd.array(vf[pick], dtype="Int64")
    out["recorded_at"] = pd.array(rec[pick], dtype="Int64")
    out.loc[~hit, ["valid_from", "recorded_at"]] = pd.NA
    last = dict(zip(ck, changes["last"].to_numpy(object), strict=True)) if changes["last"].isna().all() else {
        k: v for k, v in zip(ck, changes["last"].to_numpy(object), strict=True) if v is not None
    }
    out["latest_value"] = np.array([last.get(k) for k in ek], dtype=object)
    return out[["event_id", "entity", "event_at", "value", "valid_from", "recorded_at", "latest_value"]]


def as_known(
    events: DataFrame, changes: DataFrame, *, event_id: Column, event_entity: Column, event_at: Column,
    change_entity: Column, valid_from: Column, recorded_at: Column, value: Column,
    slices: int = SLICES, buckets: int | None = None,
) -> DataFrame:
    """Each event with the attribute value valid at its time and already recorded then.

    Times are given in epoch microseconds (bigint). Among an entity's changes with a non-null
    `value`, `valid_from` <= t and `recorded_at` <= t, the one with the greatest (`valid_from`,
    `recorded_at`, `value`) counts; `latest_value` is that of the greatest of all. A change is
    usable from max(valid_from, recorded_at) on, so the answer is a running maximum over changes
    sorted by that time, and one binary search per event finds it.

    Events and changes are co-grouped by hash buckets of (entity, time slice), many entities to a
    group; a slice's group gets one row with the state at the slice's start. An entity with much
    of all rows is thus spread over all slices. `buckets` (default: four times the session's
    shuffle partitions) sets the size of a group.

    Defined for odd input: events with a null entity or time, or without a usable change, come
    out with nulls; changes with a null entity, value or time are ignored; repeated rows give
    repeated results; columns not named here don't matter.
    """
    spark = events.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ev = events.select(event_id.alias("id"), event_entity.alias("k"), event_at.alias("t"))
    able = F.col("k").isNotNull() & F.col("t").isNotNull()
    ch = (
        changes.select(change_entity.alias("k"), valid_from.alias("vf"), recorded_at.alias("rec"), value.alias("value"))
        .filter("k is not null and vf is not null and rec is not null and value is not null")
        .withColumn("ready", F.greatest("vf", "rec"))
    )
    cuts = boundaries(ev, "t", slices)
    best = F.struct("vf", "rec", "value")
    ev_s = ev.filter(able).withColumn("s", slice_of(F.col("t"), cuts))
    ch_s = ch.withColumn("s", slice_of(F.col("ready"), cuts))
    per_slice = ch_s.groupBy("k", "s").agg(F.max(best).alias("m"))
    asked = ev_s.groupBy("k", "s").agg(F.lit(True).alias("asked"))
    whole = Window.partitionBy("k")
    early = whole.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    start = (
        per_slice.join(asked, ["k", "s"], "full")
        .select(
            "k", "s", "asked", F.max("m").over(early).alias("m"), F.max("m").over(whole).alias("l"),
        )
        .filter("asked and l is not null")
        .select(
            "k", "s", F.lit(_NEVER).cast("long").alias("ready"), F.coalesce("m.vf", F.lit(_NEVER)).alias("vf"),
            F.coalesce("m.rec", F.lit(_NEVER)).alias("rec"), F.col("m.value").alias("value"), F.col("l.value").alias("last"),
        )
    )
    versions = ch_s.select("k", "s", "ready", "vf", "rec", "value", F.lit(None).cast("string").alias("last")).unionByName(start)
    bucket = F.pmod(F.xxhash64("k", "s"), F.lit(buckets))
    kind = dict(ev.dtypes)["id"]
    schema = f"event_id {kind}, entity string, event_at long, value string, valid_from long, recorded_at long, latest_value string"
    found = (
        ev_s.withColumn("b", bucket).groupBy("b").cogroup(versions.withColumn("b", bucket).groupBy("b"))
        .applyInPandas(lambda e, c: _probe(e, c), schema)
    )
    null = lambda t: F.lit(None).cast(t)
    unable = ev.filter(~able).select(
        F.col("id").alias("event_id"), F.col("k").alias("entity"), F.col("t").alias("event_at"), null("string").alias("value"),
        null("long").alias("valid_from"), null("long").alias("recorded_at"), null("string").alias("latest_value"),
    )
    return found.unionByName(unable)
