"""A versioned Parquet table store: <root>/<schema>/<table>/v=N-... and a log entry per version."""

from __future__ import annotations

import atexit
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_folder
from strata.sources import files

#: Logical schemas of the layers.
SCHEMAS = ["landing", "bronze", "silver", "gold", "quarantine", "checkpoints", "artifacts", "restricted", "ops", "ml", "sandbox"]


class Store:
    """Writes go to a new version directory and become visible when the version's log entry is
    created, so that a table may be overwritten while it is read and failed writes leave no trace.
    An entry is never replaced: of two writers of the same version one fails. An append writes only
    the new rows: a version lists the directories that make it up.

    The root may lie on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"

    def version(self, schema: str, table: str) -> int:
        """Number of the latest version; -1 if the table is missing."""
        entries = files.names(self.spark, f"{self.path(schema, table)}/_log")
        return int(entries[-1].split(".")[0]) if entries else -1

    def exists(self, schema: str, table: str) -> bool:
        return self.version(schema, table) >= 0

    def _parts(self, schema: str, table: str, version: int) -> list[str]:
        text = files.read_text(self.spark, f"{self.path(schema, table)}/_log/{version:012d}.json") if version >= 0 else None
        if text is None:
            raise FileNotFoundError(f"{schema}.{table}")
        return json.loads(text)

    def _read_parts(self, schema: str, table: str, parts: list[str]) -> DataFrame:
        paths = [f"{self.path(schema, table)}/{p}" for p in parts]
        if len(paths) > 1 and any("=" in n for n in files.names(self.spark, paths[0])):  # partitions of several roots must be read apart
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self.spark.read.parquet(p) for p in paths])
        return self.spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)

    def read(self, schema: str, table: str, version: int | None = None) -> DataFrame:
        return self._read_parts(schema, table, self._parts(schema, table, self.version(schema, table) if version is None else version))

    def write(self, df: DataFrame, schema: str, table: str, *, mode: str = "append", partition_by: list[str] | None = None) -> int:
        """Rows written. Modes: append, overwrite, error, ignore."""
        last = self.version(schema, table)
        if last >= 0 and mode == "error":
            raise FileExistsError(f"{schema}.{table}")
        if last >= 0 and mode == "ignore":
            return 0
        part = f"v={last + 1}-{uuid.uuid4().hex[:8]}"
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path(schema, table)}/{part}")
        held = self._parts(schema, table, last) if last >= 0 and mode == "append" else []
        files.write_text(self.spark, f"{self.path(schema, table)}/_log/{last + 1:012d}.json", json.dumps([*held, part]), overwrite=False)
        return self.spark.read.parquet(f"{self.path(schema, table)}/{part}").count()  # from the files' footers

    def changes(self, schema: str, table: str, since: int) -> DataFrame:
        """Rows of the latest version that version `since` lacks, and the other way round, with
        `_change` insert or delete. Directories that both versions list are not read, so after
        appends only the new rows are."""
        last = self.version(schema, table)
        new, old = self._parts(schema, table, last), self._parts(schema, table, since)
        came, gone = [p for p in new if p not in old], [p for p in old if p not in new]
        empty = self.read(schema, table, last).limit(0)
        rows = lambda parts: self._read_parts(schema, table, parts) if parts else empty
        tell = lambda df, what: df.withColumn("_change", F.lit(what))
        if not gone:
            return tell(rows(came), "insert")
        return tell(rows(came).exceptAll(rows(gone)), "insert").unionByName(tell(rows(gone).exceptAll(rows(came)), "delete"))

    def register(self, *schemas: str) -> list[str]:
        """Temporary views schema_table for every table of the schemas."""
        found = []
        for s in schemas:
            for t in files.names(self.spark, f"{self.root}/{s}"):
                if self.exists(s, t):
                    self.read(s, t).createOrReplaceTempView(f"{s}_{t}")
                    found.append(f"{s}_{t}")
        return found


def shared_store(spark: SparkSession, label: str) -> Store:
    """A store in the session's shared folder that is removed when the driver ends."""
    store = Store(spark, f"{shared_folder(spark)}/strata-{label}-{uuid.uuid4().hex}")
    atexit.register(files.remove, spark, store.root)
    return store
