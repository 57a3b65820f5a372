"""Declarative cohorts compiled to semi and anti joins, checksummed and reproducible."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.privacy import SEP
from strata.session import written
from strata.sources import files


@dataclass(frozen=True)
class Criterion:
    type: str
    value: str | int | None = None


@dataclass(frozen=True)
class Cohort:
    name: str
    version: int
    inclusion: tuple[Criterion, ...]
    exclusion: tuple[Criterion, ...] = ()
    meta: dict[str, Any] = field(default_factory=dict)

    @property
    def digest(self) -> str:
        """Hash of the definition as canonical JSON."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def parse(spec: dict[str, Any]) -> Cohort:
    pick = lambda k: tuple(Criterion(c["type"], c.get("value")) for c in spec.get(k) or ())
    return Cohort(spec["name"], int(spec.get("version", 1)), pick("inclusion"), pick("exclusion"), {k: v for k, v in spec.items() if k not in ("name", "version", "inclusion", "exclusion")})


def load(path: str | Path) -> Cohort:
    import yaml

    return parse(yaml.safe_load(Path(path).read_text()))


def having(df: DataFrame, key: str, least: int) -> DataFrame:
    """Keys with at least `least` rows."""
    return df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(key)


def compile_cohort(cohort: Cohort, key: str, criteria: dict[str, Callable[[Any], DataFrame]]) -> DataFrame:
    """Members: keys in every inclusion set and in no exclusion set. `criteria` maps a type to a
    function from the criterion's value to a frame with the key."""
    if not cohort.inclusion:
        raise ValueError("a cohort needs an inclusion criterion")
    frame = lambda c: criteria[c.type](c.value).select(key)
    for c in (*cohort.inclusion, *cohort.exclusion):
        if c.type not in criteria:
            raise ValueError(f"unknown criterion {c.type!r}")
    members = frame(cohort.inclusion[0]).filter(F.col(key).isNotNull()).distinct()
    for c in cohort.inclusion[1:]:
        members = members.join(frame(c), key, "left_semi")
    for c in cohort.exclusion:
        members = members.join(frame(c), key, "left_anti")
    return members


def with_provenance(members: DataFrame, cohort: Cohort, **more: Any) -> DataFrame:
    facts = {"cohort_name": cohort.name, "cohort_version": cohort.version, "definition_hash": cohort.digest, "built_at": datetime.now(UTC).isoformat(), **cohort.meta, **more}
    return members.select("*", *[F.lit(v if isinstance(v, str | int | float | bool) else json.dumps(v, default=str)).alias(k) for k, v in facts.items() if k not in members.columns])


def row_hashes(df: DataFrame, out: str = "h") -> DataFrame:
    """One hash per row over its columns in order of name; doubles should be cast to decimals
    beforehand, since their text differs between engines."""
    return df.select(F.sha2(F.concat_ws(SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]), 256).alias(out))


def checksum(df: DataFrame, group_rows: int = 100_000) -> DataFrame:
    """(checksum): the same in any row order. Up to `group_rows` rows it is the SHA-256 over the
    sorted row hashes joined by a pipe. With more rows the distinct hashes, each with its count,
    are digested in groups of a common prefix, as long as it takes to keep a group at about
    `group_rows`, and the groups' digests by three digits less at a time, up to one. No task gets
    more than a group."""
    hashes = written(row_hashes(df).groupBy("h").agg(F.count("*").alias("n")), "hashes")
    n, distinct = hashes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    digest = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "|"), 256)
    if n <= group_rows:
        return hashes.select(F.explode(F.array_repeat("h", F.col("n").cast("int"))).alias("h")).agg(digest("h").alias("checksum"))
    digits = 3
    while distinct > group_rows * 16**digits:
        digits += 3
    level = hashes.groupBy(F.substring("h", 1, digits).alias("p")).agg(digest(F.concat_ws("*", "h", "n")).alias("d"))
    while digits := digits - 3:
        level = level.groupBy(F.substring("p", 1, digits).alias("p")).agg(digest(F.concat("p", "d")).alias("d"))
    return level.agg(digest(F.concat("p", "d")).alias("checksum"))


def mergeable_checksum(df: DataFrame) -> DataFrame:
    """(rows, checksum): sums of the row hashes' four 64-bit quarters, one partial sum a task. Row
    order doesn't matter and nothing is gathered, whatever the size."""
    quarters = [F.conv(F.substring("h", 1 + 16 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = [F.coalesce(F.sum(q), F.lit(0)).cast("string").alias(f"q{i}") for i, q in enumerate(quarters)]
    return row_hashes(df).agg(F.count("*").alias("rows"), *sums).select("rows", F.sha2(F.concat_ws("|", "q0", "q1", "q2", "q3"), 256).alias("checksum"))


@dataclass
class Manifest:
    """What is needed to build a frame again and to tell whether it came out the same."""

    kind: str
    name: str
    definition_hash: str
    inputs: dict[str, int]
    rows: int
    checksum: str
    made_at: str = field(default_factory=lambda: datetime.now(UTC).isoformat())

    def save(self, path: str | Path) -> None:
        files.write_text(SparkSession.active(), str(path), json.dumps(asdict(self), indent=1, sort_keys=True))

    @classmethod
    def load(cls, path: str | Path) -> Manifest | None:
        """The manifest on any file system; None if there is none."""
        text = files.read_text(SparkSession.active(), str(path))
        return cls(**json.loads(text)) if text is not None else None


def reproduce(path: str | Path, cohort: Cohort, rebuild: Callable[[dict[str, int]], DataFrame]) -> int:
    """0 same; 1 no manifest; 2 other kind; 3 definition changed; 4 row count; 5 checksum;
    6 two rebuilds differ. `rebuild` gets the pinned input versions."""
    m = Manifest.load(path)
    if m is None:
        return 1
    if m.kind != "cohort":
        return 2
    if m.definition_hash != cohort.digest:
        return 3
    first, second = (mergeable_checksum(rebuild(m.inputs)).first() for _ in range(2))
    if first["rows"] != m.rows:
        return 4
    if first["checksum"] != m.checksum:
        return 5
    return 0 if first == second else 6
