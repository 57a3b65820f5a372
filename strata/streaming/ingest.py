"""Incremental file ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources import files, landing

RESCUED = "_rescued_data"


def csv_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """New CSV files of a folder as they appear; lines that don't fit go to `_rescued_data`."""
    full = StructType([*schema.fields, StructField(RESCUED, StringType())])
    return (
        spark.readStream.schema(full).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUED).csv(folder)
        .withColumns({"_source_file": F.col("_metadata.file_path"), "_ingest_ts": F.current_timestamp()})
    )


def new_files(spark: SparkSession, folder: str, glob: str = "*.csv", most_files: int = 1000) -> DataFrame:
    """(path) of the files of a folder as they appear, also in its sub-folders; `folder` may hold
    wildcards, and contents are not read. At most `most_files` make a batch; the others come with the next ones."""
    kinds = "path string, modificationTime timestamp, length long, content binary"
    source = spark.readStream.format("binaryFile").schema(kinds).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return source.option("maxFilesPerTrigger", most_files).load(folder).select("path")


def entity_sink(store, entity: str, batch_id: str, required: str | None = None, then: Callable[[], object] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch sink of `new_files` that lands an entity's CSV files in Bronze, by column name:
    files of one header are read together, and a column that appears later is null in the rows
    before. Rows without the `required` column's value are dropped; rows that are there already
    add nothing, so a batch may be delivered twice. `then` is called once new rows are in."""

    def sink(batch: DataFrame, _: int) -> None:
        spark, table = store.spark, f"{entity}_raw"
        by_header: dict[str, list[str]] = {}
        for r in batch.distinct().collect():  # bounded by the source's files a batch
            by_header.setdefault(files.first_line(spark, r["path"]), []).append(r["path"])
        grown = 0
        for paths in by_header.values():
            seen = store.read("bronze", table).select("_record_hash") if store.exists("bronze", table) else None
            rows = landing.bronze_rows(landing.read_csv(spark, paths), entity, batch_id, seen)
            if required:
                rows = rows.filter(F.col(required).isNotNull()) if required in rows.columns else rows.limit(0)
            if not rows.isEmpty():
                grown += store.write(rows, "bronze", table)
        if grown and then:
            then()

    return sink


def expect_or_drop(df: DataFrame, name: str, ok: Column) -> DataFrame:
    """Keeps rows for which `ok` holds; how many failed is observed under `name`."""
    return df.observe(name, F.count_if(~F.coalesce(ok, F.lit(False))).alias("dropped")).filter(ok)


def expect_or_fail(df: DataFrame, message: str, ok: Column) -> DataFrame:
    """Stops the query at the first row for which `ok` does not hold."""
    checked = F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return df.filter(checked)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Processes all files there are, batch by batch, and stops. Progress is kept in `checkpoint`,
    so that a restart goes on where it ended."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_new(store, schema: str, table: str, key: str = "_record_hash") -> Callable[[DataFrame, int], None]:
    """A batch sink that appends rows whose key is new: a batch that is delivered twice changes
    nothing."""

    def sink(batch: DataFrame, _: int) -> None:
        rows = batch.dropDuplicates([key])
        if store.exists(schema, table):
            rows = rows.join(store.read(schema, table).select(key), key, "left_anti")
        if not rows.isEmpty():
            store.write(rows, schema, table)

    return sink


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, keys: list[str]) -> DataFrame:
    """Rows per window of event time and keys; rows later than `late` are dropped by the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"))
