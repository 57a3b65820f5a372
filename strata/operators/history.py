"""History of changing entity attributes: insert-only satellites and lead-based end dates.

Attributes are split by change rate into groups. Each group has a satellite, a table that rows are
only ever appended to: a delivery adds a row where the hash of its stated attributes differs from
the hash in force before it. A narrow tracking table keeps the hashes of every delivery that
counts, also of those that added nothing. It is what makes loads independent of their order: when a
late delivery lands between two equal ones, the later of them, dropped before, is restored.

    load(store, "patient", deliveries(...), groups)      # once per batch
    history(store, "patient", groups)                     # view over all satellites

Tables of a store's schema "vault": <name>_<group> and <name>_track.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.sliced import SLICES, filled_forward, following, previous, sliced
from strata.session import written
from strata.sources.store import Store

VAULT = "vault"
_KEY = ["entity", "valid_from"]


def _digest(columns: list[str]) -> Column:
    """Hash of the attributes with nulls kept apart from texts and positions kept apart."""
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("~")) for c in columns]
    return F.sha2(F.concat_ws("␟", *parts), 256)


def _mark(columns: list[str]) -> Column:
    """The first 128 bits of the hash, as satellites store and compare it."""
    return F.unhex(F.substring(_digest(columns), 1, 32))


def deliveries(df: DataFrame, *, entity: Column, valid_from: Column, recorded_at: Column, attributes: dict[str, Column]) -> DataFrame:
    """(entity, valid_from, rec, attributes): per entity and `valid_from` the delivery with the
    greatest `recorded_at` (ties: the greatest attribute values). Times are epoch microseconds, a
    null attribute is not stated.

    Deliveries with a null entity or `valid_from` are ignored; a null `recorded_at` is older than
    any; an empty table gives no rows."""
    src = df.select(entity.alias("entity"), valid_from.alias("valid_from"), recorded_at.alias("rec"), *[c.alias(n) for n, c in attributes.items()])
    won = src.filter("entity is not null and valid_from is not null").groupBy(*_KEY).agg(F.max(F.struct("rec", *attributes)).alias("m"))
    return won.select(*_KEY, "m.*")


def _tracked(store: Store, name: str, groups: dict[str, list[str]], touched: DataFrame) -> DataFrame:
    """The deliveries of the touched entities that count so far, with their attributes looked up
    by hash in the satellites: every tracked hash stands in its entity's satellite."""
    rows = store.read(VAULT, f"{name}_track").join(touched, "entity", "left_semi")
    rows = rows.groupBy(*_KEY).agg(F.max(F.struct("rec", "seq", *[f"{g}_hash" for g in groups])).alias("m")).select(*_KEY, "m.*")
    for g, cols in groups.items():
        known = store.read(VAULT, f"{name}_{g}").select("entity", F.col("row_hash").alias(f"{g}_hash"), *cols).distinct()
        rows = rows.join(known, ["entity", f"{g}_hash"])
    return rows


def load(store: Store, name: str, batch: DataFrame, groups: dict[str, list[str]], *, slices: int = SLICES) -> dict[str, int]:
    """Appends a batch of `deliveries` to the satellites and the tracking table; returns the rows
    added to each. Batches may come in any order and more than once: the views show the same as
    after one load of everything, and a batch that was loaded before adds nothing.

    Only entities of the batch are looked at. Predecessors are found per time slice, so a hot
    entity is spread over tasks."""
    names = [c for cols in groups.values() for c in cols]
    hashes = {g: f"{g}_hash" for g in groups}
    new = batch.select(*_KEY, "rec", *names)
    seq = store.version(VAULT, f"{name}_track") + 1  # number of this load
    if seq == 0:
        won = new.withColumns({h: _mark(groups[g]) for g, h in hashes.items()})
        won = won.select("*", *[F.lit(None).cast("binary").alias(f"had_{g}") for g in groups], F.lit(None).cast("string").alias("had"))
    else:
        old = _tracked(store, name, groups, new.select("entity").distinct())
        mark = F.concat_ws("|", F.coalesce(F.col("rec").cast("string"), F.lit("~")), *[F.hex(h) for h in hashes.values()])
        both = old.select(*_KEY, "rec", *names, mark.alias("had")).unionByName(new.withColumn("had", F.lit(None).cast("string")))
        won = both.groupBy(*_KEY).agg(F.max(F.struct("rec", *names)).alias("m"), F.max("had").alias("had")).select(*_KEY, "m.*", "had")
        won = won.withColumns({h: _mark(groups[g]) for g, h in hashes.items()})
        for g in groups:
            held = satellite(store, name, g, groups[g]).select(*_KEY, F.col("row_hash").alias(f"had_{g}"))
            won = won.join(held.join(new.select("entity").distinct(), "entity", "left_semi"), _KEY, "left")
    cut = sliced(won, "valid_from", slices=slices)
    before = previous(cut, ["entity"], ["valid_from"], list(hashes.values()))
    now = F.concat_ws("|", F.coalesce(F.col("rec").cast("string"), F.lit("~")), *[F.hex(h) for h in hashes.values()])
    adds = {g: F.when(F.col(f"had_{g}").isNotNull(), F.col(f"had_{g}") != F.col(h)).otherwise(~F.col(h).eqNullSafe(F.col(f"prev_{h}"))).alias(f"adds_{g}") for g, h in hashes.items()}
    marked = written(before.select(*_KEY, "rec", *names, *hashes.values(), *adds.values(), (~F.col("had").eqNullSafe(now)).alias("tracks")), "load")
    out = {}
    for g, cols in groups.items():
        rows = marked.filter(f"adds_{g}").select(*_KEY, "rec", F.lit(seq).alias("seq"), F.col(hashes[g]).alias("row_hash"), *cols)
        out[g] = store.write(rows, VAULT, f"{name}_{g}") if seq == 0 or not rows.isEmpty() else 0
    tracked = marked.filter("tracks").select(*_KEY, "rec", F.lit(seq).alias("seq"), *hashes.values())
    out["track"] = store.write(tracked, VAULT, f"{name}_track") if seq == 0 or not tracked.isEmpty() else 0
    return out


def satellite(store: Store, name: str, group: str, columns: list[str]) -> DataFrame:
    """(entity, valid_from, row_hash, columns): the rows of a satellite that hold, i.e. the latest
    that was appended per entity and `valid_from`. One load appends one such row at most, so after
    a single load there is nothing to choose from."""
    rows = store.read(VAULT, f"{name}_{group}")
    if store.version(VAULT, f"{name}_{group}") == 0:
        return rows.select(*_KEY, "row_hash", *columns)
    return rows.groupBy(*_KEY).agg(F.max(F.struct("rec", "seq", "row_hash", *columns)).alias("m")).select(*_KEY, "m.row_hash", *[f"m.{c}" for c in columns])


def changes(rows: DataFrame, columns: list[str], *, slices: int = SLICES) -> DataFrame:
    """Of rows per (entity, valid_from), those where an attribute in force changes, with what is
    in force: an attribute that is not stated leaves the last stated value. The entity's first row
    is a change. `_slice` stays for `with_end`."""
    full = filled_forward(sliced(rows, "valid_from", slices=slices), ["entity"], "valid_from", columns)
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"was_{c}")) for c in columns], F.col("_first"))
    return full.filter(differs).select(*_KEY, "_slice", *columns)


def with_end(rows: DataFrame) -> DataFrame:
    """The view with `valid_to`, the start of the entity's next row (null in the last)."""
    return following(rows, ["entity"], "valid_from", "valid_to").drop("_slice")


def timeline(rows: DataFrame, columns: list[str], *, slices: int = SLICES) -> DataFrame:
    """The lead view of one satellite: its changes with their ends and the hash of what is in
    force."""
    return with_end(changes(rows, columns, slices=slices).withColumn("row_hash", _digest(columns)))


def united(satellites: dict[str, DataFrame], groups: dict[str, list[str]]) -> DataFrame:
    """The union of the satellites' rows per (entity, valid_from), each with what every satellite
    states there."""
    parts = [rows.select(*_KEY, *groups[g]) for g, rows in satellites.items()]
    points = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return points.groupBy(*_KEY).agg(*[F.max(c).alias(c) for cols in groups.values() for c in cols])  # one row a satellite


def history(store: Store, name: str, groups: dict[str, list[str]], *, slices: int = SLICES) -> DataFrame:
    """(entity, valid_from, attributes, valid_to): one row per period of unchanged attributes over
    all satellites, with the end computed by lead."""
    points = united({g: satellite(store, name, g, cols) for g, cols in groups.items()}, groups)
    return with_end(changes(points, [c for cols in groups.values() for c in cols], slices=slices))
