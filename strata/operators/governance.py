"""Access matrix, grants, masks, tags, lineage and logs."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, datetime
from itertools import count
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.sources import files

# fixed values: groups that hold everyone
EVERYONE = {"account users", "users", "all users"}


@dataclass(frozen=True)
class Grant:
    group: str
    asset: str
    privilege: str


def parse_grants(rows: Iterable[dict]) -> list[Grant]:
    """Grants of the matrix; only groups may hold one."""
    grants = [Grant(r["group"], r["asset"], r["privilege"]) for r in rows]
    for g in grants:
        if g.group.strip().lower() in EVERYONE or "@" in g.group:
            raise ValueError(f"grant to {g.group!r}: only named groups may hold grants")
    return grants


def grant_sql(g: Grant, catalog: str) -> str:
    schema, table = g.asset.split(".")[1:3]
    on = f"SCHEMA {catalog}.{schema}" if table == "*" else f"TABLE {catalog}.{schema}.{table}"
    return f"GRANT {g.privilege.replace('_', ' ')} ON {on} TO `{g.group}`;"


def grants_script(grants: list[Grant], catalog: str) -> list[str]:
    return sorted({grant_sql(g, catalog) for g in grants})


def grants_diff(old: list[str], new: list[str]) -> tuple[list[str], list[str]]:
    """(added, removed) statements."""
    return sorted(set(new) - set(old)), sorted(set(old) - set(new))


def mask(column: str, groups_allowed: list[str], current: str = "current_group") -> Column:
    """The column for readers in an allowed group, else null."""
    return F.when(F.lit(current).isin(groups_allowed) if groups_allowed else F.lit(False), F.col(column))


def row_filter(df: DataFrame, access: DataFrame, key: str, group: str) -> DataFrame:
    """Rows whose key the group may see by an active entry in `access` (group, key, active)."""
    allowed = access.filter((F.col("principal_group") == group) & F.col("active")).select(key)
    return df.join(allowed, key, "left_semi")


def tag_rows(defaults: dict[str, str], by_schema: dict[str, dict[str, str]]) -> list[tuple[str, str, str]]:
    return [(s, k, v) for s, own in sorted(by_schema.items()) for k, v in sorted((defaults | own).items())]


def closure(edges: DataFrame) -> DataFrame:
    """(source, target, steps): everything each source leads to, by the shortest way. The frontier
    joins the edges until nothing new comes; it is written at each step, so plans stay short."""
    from strata.session import written

    edge = edges.select("source", "target").distinct()
    reached = frontier = written(edge.withColumn("steps", F.lit(1)), "closure")
    for step in count(2):  # ends, since pairs that are reached don't come again
        grown = frontier.select("source", F.col("target").alias("via")).join(edge.select(F.col("source").alias("via"), "target"), "via").select("source", "target").distinct()
        frontier = written(grown.join(reached, ["source", "target"], "left_anti").withColumn("steps", F.lit(step)), "closure")
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached


def mermaid(edges: list[tuple[str, str, str]]) -> str:
    return "\n".join(["graph LR", *[f'  "{a}" -->|{t}| "{b}"' for a, b, t in edges]])


def request_access(principal: str, subject: str, justification: str, officer: str) -> tuple:
    """A log row for a break-glass request; the justification needs 20 characters at least."""
    if len(justification.strip()) < 20:
        raise ValueError("justification needs at least 20 characters")
    return uuid.uuid4().hex, datetime.now(UTC).isoformat(), principal, subject, justification.strip(), officer


def require_request(log: DataFrame, request_id: str) -> None:
    if log.filter(F.col("request_id") == F.lit(request_id)).isEmpty():
        raise PermissionError("no such request")


def freshness(spark: SparkSession, store, sla: dict[str, float], now: datetime, column: str = "_ingest_ts") -> list[tuple]:
    """(table, exists, newest, hours, fresh) against the hours allowed per schema.table."""
    out = []
    for name, hours in sla.items():
        schema, table = name.split(".")
        if not store.exists(schema, table):
            out.append((name, False, None, None, False))
            continue
        newest = store.read(schema, table).agg(F.max(column)).first()[0]
        age = (now - newest).total_seconds() / 3600 if newest else None
        out.append((name, True, newest, age, age is not None and age <= hours))
    return out


class JsonFormatter(logging.Formatter):
    """One JSON object a line; extra fields that clash with reserved ones get a prefix."""

    reserved = frozenset(vars(logging.makeLogRecord({}))) | {"message", "asctime"}

    def format(self, record: logging.LogRecord) -> str:
        base = {"ts": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        extra = {(f"x_{k}" if k in base else k): v for k, v in vars(record).items() if k not in self.reserved}
        return json.dumps(base | extra, default=str)


def access_matrix(path: str | Path | None = None) -> dict:
    """Grants, masks, row filters and tags from YAML, by default as shipped."""
    got = load_yaml(path or config.shipped("access.yml"))
    parse_grants(got["grants"])
    return got


def access_script(matrix: dict, catalog: str) -> list[str]:
    """Statements for a catalog that takes them: grants, then a function and its binding for each
    mask and row filter. The function has the type of the column it masks."""
    member = lambda groups: " OR ".join(f"is_account_group_member('{g}')" for g in groups)
    out = grants_script(parse_grants(matrix["grants"]), catalog)
    for m in matrix.get("masks", ()):
        out.append(f"CREATE OR REPLACE FUNCTION {catalog}.ops.{m['name']}(x {m['type']}) RETURNS {m['type']} RETURN CASE WHEN {member(m['groups'])} THEN x END;")
        out.append(f"ALTER TABLE {catalog}.{m['table']} ALTER COLUMN {m['column']} SET MASK {catalog}.ops.{m['name']};")
    for f in matrix.get("row_filters", ()):
        entry = f"SELECT 1 FROM {catalog}.{f['access']} a WHERE is_account_group_member(a.principal_group) AND a.active AND a.{f['key']} = x"
        out.append(f"CREATE OR REPLACE FUNCTION {catalog}.ops.{f['name']}(x STRING) RETURNS BOOLEAN RETURN EXISTS ({entry});")
        out.append(f"ALTER TABLE {catalog}.{f['table']} SET ROW FILTER {catalog}.ops.{f['name']} ON ({f['key']});")
    return out


def access_review(spark: SparkSession, matrix: dict, due: str = "next quarter") -> DataFrame:
    """One row per grant, to be confirmed by its reviewer."""
    at = datetime.now(UTC).isoformat()
    rows = [(uuid.uuid4().hex, g["group"], g["asset"], g["privilege"], g.get("why", ""), "pending", None, at, due) for g in matrix["grants"]]
    return spark.createDataFrame(rows, "review_id string, principal string, asset string, privilege string, why string, status string, reviewer string, created_at string, due string")


def audit_daily(accesses: DataFrame, matrix: dict, keep_years: int = 6) -> DataFrame:
    """(audit_date, principal, action, asset, class, accesses, keep_years): accesses (at,
    principal, action, asset) added up per day, with the class that the tags give the asset's
    schema. Rows with a null time keep a null day."""
    tags = matrix["tags"]
    classes = {s: own.get("class", tags["defaults"].get("class")) for s, own in tags["by_schema"].items()}
    schema, kind = F.split("asset", "[.]")[1], F.lit(tags["defaults"].get("class"))
    for s, c in classes.items():
        kind = F.when(schema == s, c).otherwise(kind)
    rows = accesses.select(F.to_date("at").alias("audit_date"), "principal", "action", "asset", kind.alias("class"))
    return rows.groupBy("audit_date", "principal", "action", "asset", "class").agg(F.count("*").alias("accesses")).withColumn("keep_years", F.lit(keep_years))


#: Dashboards that come with the package.
DASHBOARDS = ("utilization", "readmission", "scores", "linkage", "cost")


def dashboards(folder: str | Path | None = None, unit_cost: float = 0.55) -> dict[str, str]:
    """SQL of every dashboard by name, over views <schema>_<table>; an error if one is missing."""
    root = Path(folder) if folder else config.shipped("dashboards")
    missing = [n for n in DASHBOARDS if not (root / f"{n}.sql").exists()]
    if missing:
        raise FileNotFoundError(f"missing dashboards: {missing}")
    return {n: (root / f"{n}.sql").read_text().replace("{rate}", str(unit_cost)) for n in DASHBOARDS}


def write_artifacts(spark: SparkSession, folder: str, edges: list[tuple[str, str, str]], catalog: str = "main") -> list[str]:
    """The lineage document, the access script and the dashboards' SQL as files; their names."""
    texts = {"lineage.md": f"```mermaid\n{mermaid(edges)}\n```\n", "grants.sql": "\n".join(access_script(access_matrix(), catalog)) + "\n"}
    texts |= {f"{n}.sql": sql for n, sql in dashboards().items()}
    for name, text in texts.items():
        files.write_text(spark, f"{folder}/{name}", text)
    return sorted(texts)


def load_yaml(path: str | Path) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text())
