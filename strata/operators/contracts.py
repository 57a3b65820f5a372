"""Versioned schema contracts and their enforcement."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: type names of contracts
TYPES = {"string": T.StringType(), "integer": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


@dataclass(frozen=True)
class Contract:
    entity: str
    columns: tuple[tuple[str, str, bool], ...]  # name, type, nullable
    primary_key: tuple[str, ...] = ()
    checks: tuple[tuple[str, str], ...] = ()  # name, SQL condition

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(n, TYPES[t], null) for n, t, null in self.columns])


def parse(spec: dict[str, Any]) -> Contract:
    return Contract(
        spec["entity"], tuple((c["name"], c["type"], bool(c.get("nullable", True))) for c in spec["columns"]), tuple(spec.get("primary_key", ())),
        tuple((c["name"], c["expression"]) for c in spec.get("checks", ())),
    )


def load(path: str | Path) -> Contract:
    import yaml

    return parse(yaml.safe_load(Path(path).read_text()))


def require(df: DataFrame, contract: Contract, *, types: bool = False) -> DataFrame:
    """`df`, or an error for missing columns and, with `types`, for other types. Plan time only."""
    missing = [n for n, _, _ in contract.columns if n not in df.columns]
    if missing:
        raise ValueError(f"{contract.entity}: missing columns {missing}")
    if types:
        wrong = [n for n, t, _ in contract.columns if df.schema[n].dataType != TYPES[t]]
        if wrong:
            raise TypeError(f"{contract.entity}: wrong types {wrong}")
    return df


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(name, failed): nulls where none may be, repeated primary keys and failed checks, in one
    aggregate."""
    counts = [F.count_if(F.col(n).isNull()).alias(f"null:{n}") for n, _, null in contract.columns if not null]
    counts += [F.count_if(~F.expr(e)).alias(f"check:{n}") for n, e in contract.checks]
    if contract.primary_key:
        counts.append((F.count("*") - F.count_distinct(F.struct(*contract.primary_key))).alias("primary_key"))
    row = df.agg(*counts) if counts else df.limit(0).agg(F.lit(0).alias("none"))
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("failed")) for c in row.columns])).alias("x")).select("x.*")
