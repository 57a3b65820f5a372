"""Landing files into append-only Bronze tables, idempotent by record hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.relational import TECHNICAL, anti_seen, require_columns, with_technical_columns
from strata.sources import files
from strata.sources.store import Store

# fixed values: entities of a landing folder
ENTITIES = [
    "patient", "encounter", "condition", "observation", "lab_result", "medication", "procedure", "immunization", "provider", "organization",
    "payer_claim", "consent", "survey_instrument", "survey_item", "survey_administration", "survey_response", "survey_score",
]
VERSION = "1"


def source_system(entity: str) -> str:
    return "survey_sim" if entity.startswith("survey_") else "synthea_sim"


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files of one header; every column text; broken lines kept as far as they go."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE", escape='"')


def bronze_rows(df: DataFrame, entity: str, batch_id: str, seen: DataFrame | None) -> DataFrame:
    """Technical columns, one row per record hash, and only hashes not seen before. A column that
    the feed names with an underscore is landed as feed_<name>, since technical columns have such
    names."""
    if entity not in ENTITIES:
        raise KeyError(entity)
    feed = {c: f"feed{c}" for c in df.columns if c.startswith("_")}
    tagged = with_technical_columns(
        df.select(*[F.col(c).alias(feed.get(c, c)) for c in df.columns], "_metadata.file_path", "_metadata.file_modification_time").withColumnsRenamed({"file_path": "_path", "file_modification_time": "_modified"}),
        source_system=source_system(entity), batch_id=batch_id, version=VERSION, source_file=F.col("_path"), modified=F.col("_modified"),
    )
    return anti_seen(require_columns(tagged.dropDuplicates(["_record_hash"]), TECHNICAL), seen)


def ingest_file(store: Store, entity: str, path: str, batch_id: str) -> int:
    """Rows appended; 0 when the file was ingested before."""
    table = f"{entity}_raw"
    seen = store.read("bronze", table).select("_record_hash") if store.exists("bronze", table) else None
    new = bronze_rows(read_csv(store.spark, path), entity, batch_id, seen)
    return 0 if new.isEmpty() else store.write(new, "bronze", table)


def ingest_directory(store: Store, root: str, batch_id: str, entities: list[str] | None = None) -> dict[str, int]:
    """Looks for <entity>.csv in clinical/, survey/ and the root, in that order; missing: 0."""
    out = {}
    for e in entities or ENTITIES:
        found = next((f"{root}/{d}/{e}.csv" for d in ("clinical", "survey", ".") if f"{e}.csv" in files.names(store.spark, f"{root}/{d}")), None)
        out[e] = ingest_file(store, e, found, batch_id) if found else 0
    return out
