"""Cleansing, deduplication, referential splits, windows and suppression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.privacy import record_hash
from strata.functions.text import is_missing
from strata.operators import sliced
from strata.session import written

# fixed values: technical columns of Bronze
TECHNICAL = ["_ingest_ts", "_source_system", "_source_file", "_file_modification_time", "_batch_id", "_record_hash", "_rescued_data", "_ingest_pipeline_version"]


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def _each(df: DataFrame, columns: Sequence[str] | None, f) -> DataFrame:
    chosen = set(business_columns(df) if columns is None else columns)
    return df.select(*[f(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trimmed text of the columns (default: all business columns, cast to text)."""
    return _each(df, columns, lambda c: F.trim(c.cast("string")))


def normalize_null_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null where the trimmed upper-case text is a token for "missing"; else the value as it is."""
    return _each(df, columns, lambda c: F.when(~is_missing(c.cast("string")), c))


def canonical_lower(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, [c for c in columns if c in df.columns], F.lower)


def parse_ts(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Timestamp of a text, null where it is none."""
    return df.withColumn(out or column, F.try_to_timestamp(F.col(column).cast("string")))


def with_technical_columns(df: DataFrame, *, source_system: str, batch_id: str, version: str, source_file: Column | None = None, modified: Column | None = None) -> DataFrame:
    """The eight technical columns behind the business columns."""
    own = [F.col(c) for c in business_columns(df)]
    values = [
        F.current_timestamp(), F.lit(source_system), source_file if source_file is not None else F.lit(None).cast("string"),
        modified if modified is not None else F.lit(None).cast("timestamp"), F.lit(batch_id), record_hash(own), F.lit(None).cast("string"), F.lit(version),
    ]
    return df.select(*own, *[v.alias(n) for n, v in zip(TECHNICAL, values, strict=True)])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    return df


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key the row with the greatest `order` (nulls last); ties go to the greatest row. A
    partial aggregate, so that many versions of a key cost no shuffle."""
    rest = [c for c in df.columns if c not in keys and c != order]
    return df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_m")).select(*[F.col(c) if c in keys else F.col("_m")[c].alias(c) for c in df.columns])


def anti_seen(new: DataFrame, seen: DataFrame | None, key: str = "_record_hash") -> DataFrame:
    """Rows whose key has not been seen."""
    return new if seen is None else new.join(seen.select(key), key, "left_anti")


def referential_keep(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_semi")


def referential_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows without a parent; a null key is one."""
    return child.join(parent.select(key), key, "left_anti")


def two_parent_status(child: DataFrame, first: DataFrame, first_key: str, second: DataFrame, second_key: str) -> DataFrame:
    """`child` with `status`: no_first, no_second (given, but absent) or good, in one pass of two
    left joins instead of four semi and anti joins."""
    a = first.select(first_key).distinct().withColumn("_a", F.lit(True))
    b = second.select(second_key).distinct().withColumn("_b", F.lit(True))
    joined = child.join(a, first_key, "left").join(b, second_key, "left")
    status = F.when(F.col("_a").isNull(), "no_first").when(F.col(second_key).isNotNull() & F.col("_b").isNull(), "no_second").otherwise("good")
    return joined.withColumn("status", status).drop("_a", "_b")


def window_violations(df: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a valid window, the others). An open end is valid; an end without a start is
    not. Every row lands on one side."""
    ok = F.coalesce(F.col(end).isNull() | (F.col(end) >= F.col(start)), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def quarantined(bad: DataFrame, *, entity: str, reason: str, batch_id: str) -> DataFrame:
    """Rejected rows with what, why and when, and their business columns as JSON."""
    return bad.select(
        "*", F.current_timestamp().alias("_quarantine_ts"), F.lit(reason).alias("_quarantine_reason"), F.lit(batch_id).alias("_quarantine_batch_id"),
        F.lit(entity).alias("_quarantine_entity"), F.to_json(F.struct(*business_columns(bad))).alias("_raw_payload_json"),
    )


def suppress_small_cells(df: DataFrame, count: str = "n", k: int = 11, mask: Sequence[str] = ()) -> DataFrame:
    """Counts below k, and the masked measures beside them, become null; dimensions stay."""
    small = F.col(count) < k
    return df.select(*[F.when(~small, F.col(c)).alias(c) if c == count or c in mask else F.col(c) for c in df.columns])


def next_event_within(df: DataFrame, entity: str, start: str, end: str, key: str, days: float = 30.0, out: str = "again") -> DataFrame:
    """Adds `out`: the entity's next event begins at most `days` after this one ended (or began,
    if it has no end). Order: start, then key. Rows without an entity or a start have no next
    event. The next start is looked up per time slice, so a hot entity is spread over tasks."""
    marked = df.withColumn("_at", F.unix_timestamp(start))
    usable = F.col(entity).isNotNull() & F.col("_at").isNotNull()
    led = sliced.following(sliced.sliced(marked.filter(usable), "_at"), [entity], "_at", "_then", ties=[key])
    gap = F.col("_then") - F.unix_timestamp(F.coalesce(F.col(end), F.col(start)))
    return led.select(*df.columns, F.coalesce(gap <= days * 86_400, F.lit(False)).alias(out)).unionByName(
        marked.filter(~usable).select(*df.columns, F.lit(False).alias(out))
    )


def trailing(
    df: DataFrame, entity: str, at: str, seconds_back: int, sums: dict[str, Column], distinct: dict[str, Column] | None = None, *, include_now: bool = False,
) -> DataFrame:
    """Adds sums, and counts of distinct non-null values, over the entity's rows of the last
    `seconds_back` seconds; rows of the same second count only with `include_now`. `at` is a
    timestamp; a null summand counts as 0.

    Each row adds its summands at its time and takes them back `seconds_back` later, so the sum
    over the frame is a running sum of such steps, which is found per time slice: a hot entity is
    spread over tasks. A value is there from an occurrence until `seconds_back` after the last
    that follows within that time, so distinct values are counted by steps, too. Rows without an
    entity or a time have no rows before them: their figures are 0."""
    distinct = distinct or {}
    names = [*sums, *distinct]
    cols = df.columns
    src = df.select(F.struct(*cols).alias("_row"), F.col(entity).alias("_e"), F.unix_timestamp(at).alias("_t"), *[c.alias(f"_v_{n}") for n, c in (sums | distinct).items()])
    usable = F.col("_e").isNotNull() & F.col("_t").isNotNull()
    base = written(src.filter(usable), "trailing")
    cuts = sliced.boundaries(base, "_t")
    cut = lambda rows: rows.withColumn("_slice", sliced.slice_of(F.col("_t"), cuts).cast("int"))
    after, own, leaving = F.lit(2), F.lit(1), F.lit(2)
    arriving = F.lit(0) if include_now else after
    zero = {n: F.coalesce(F.col(f"_v_{n}"), F.lit(0)) for n in sums}

    def step(t: Column, phase: Column, row: Column, values: dict[str, Column]) -> Column:
        return F.struct(t.alias("_t"), phase.alias("_phase"), row.alias("_row"), *[values[n].alias(f"_d_{n}") for n in names])

    none = {n: c * 0 for n, c in zero.items()} | {n: F.lit(0).cast("long") for n in distinct}
    nothing = F.lit(None).cast(base.schema["_row"].dataType)
    steps = [
        step(F.col("_t"), own, F.col("_row"), none), step(F.col("_t"), arriving, nothing, none | zero), step(F.col("_t") + seconds_back, leaving, nothing, none | {n: -c for n, c in zero.items()}),
    ]
    points = base.select("_e", F.explode(F.array(*steps)).alias("x")).select("_e", "x.*")
    for n in distinct:
        kept = base.filter(F.col(f"_v_{n}").isNotNull()).select("_e", F.col(f"_v_{n}").alias("_v"), "_t").distinct()
        keys = ["_e", "_v"]
        near = sliced.neighbour(sliced.previous(cut(kept), keys, ["_t"], ["_t"]), keys, ["_t"], ["_t"], "next_", ahead=True)
        one = lambda t, phase, sign, n=n: F.struct(t.alias("_t"), phase.alias("_phase"), F.lit(sign).cast("long").alias(f"_d_{n}"))
        begins = F.when(F.col("prev__t").isNull() | (F.col("_t") - F.col("prev__t") > seconds_back), one(F.col("_t"), arriving, 1))
        ends = F.when(F.col("next__t").isNull() | (F.col("next__t") - F.col("_t") > seconds_back), one(F.col("_t") + seconds_back, leaving, -1))
        points = points.unionByName(near.select("_e", F.explode(F.array_compact(F.array(begins, ends))).alias("x")).select("_e", "x.*"), allowMissingColumns=True)
    points = points.select("_e", "_t", "_phase", "_row", *[F.coalesce(f"_d_{n}", F.lit(0)).alias(f"_d_{n}") for n in names])
    run = sliced.sums_before(cut(points), ["_e"], ["_t", "_phase"], {n: f"_d_{n}" for n in names}).filter("_phase = 1").select("_row", *names)
    rest = src.filter(~usable).select("_row", *[F.lit(0).cast(run.schema[n].dataType).alias(n) for n in names])
    return run.unionByName(rest).select(*[F.col("_row")[c].alias(c) for c in cols], *names)


def baseline_delta(df: DataFrame, keys: Sequence[str], stage: str, score: str, baseline: str = "baseline", threshold: float = 5.0) -> DataFrame:
    """Adds the keys' mean score at the baseline stage, the change from it, whether the change is
    at least `threshold` in either direction, and the number of rows. The figures of the keys are
    aggregated on the map side and joined back, so that a hot key is split between tasks; null
    keys are keys too."""
    own = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.avg(F.when(F.col(stage) == baseline, F.col(score))).alias("baseline_score"), F.count("*").alias("stages"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    change = F.col(score) - F.col("baseline_score")
    return df.join(own, same).select(*df.columns, "baseline_score", change.alias("change"), (F.abs(change) >= threshold).alias("changed_markedly"), "stages")


def as_of_join(left: DataFrame, right: DataFrame, entity: str, left_at: str, right_at: str, columns: Sequence[str]) -> DataFrame:
    """Each left row with the entity's latest right row at or before it (of equally late ones the
    greatest), under prior_<column>: both sides in one stream sorted by time, the last right row
    carried forward within and across time slices, so a hot entity is spread over tasks.

    Left rows with a null entity or time have no prior row; such right rows don't count."""
    known = lambda df, at: df.filter(F.col(entity).isNotNull() & F.col(at).isNotNull())
    lcols, rcols = left.columns, [right_at, *columns]
    b = known(right, right_at).select(F.col(entity).alias("_e"), F.col(right_at).alias("_t"), F.lit(0).alias("_side"), F.struct(*rcols).alias("_r"))
    a = left.select(F.col(entity).alias("_e"), F.col(left_at).alias("_t"), F.lit(1).alias("_side"), F.struct(*lcols).alias("_l"), F.lit(None).cast(b.schema["_r"].dataType).alias("_r"))
    usable = F.col("_e").isNotNull() & F.col("_t").isNotNull()
    both = a.filter(usable).unionByName(b.withColumn("_l", F.lit(None).cast(a.schema["_l"].dataType)))
    got = sliced.filled_forward(sliced.sliced(both, "_t"), ["_e"], "_t", ["_r"], ties=["_side", "_r"]).filter("_side = 1").select("_l", "_r")
    return got.unionByName(a.filter(~usable).select("_l", "_r")).select("_l.*", *[F.col("_r")[c].alias(f"prior_{c}") for c in rcols])


def flagged_split(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(good, F.lit(False))
    return df.filter(ok), df.filter(~ok)
