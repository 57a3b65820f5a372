"""Session factory and the shared working folder for lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.sources import files


def get_spark(app_name: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution. Cluster settings given by the caller or by
    spark-submit win; only `master` falls back to all local cores."""
    builder = SparkSession.builder.appName(app_name)
    if master or SparkSession.getActiveSession() is None:
        builder = builder.master(master or "local[*]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: `spark.checkpoint.dir` of the session. A local one is
    made only where none is named and the master is local, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="strata-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_made: list[tuple[SparkSession, str]] = []


def release() -> int:
    """Removes all lineage cuts made so far; how many there were. For long sessions, once the
    results that read them are saved; otherwise they go when the driver ends."""
    n = len(_made)
    while _made:
        files.remove(*_made.pop())
    return n


atexit.register(release)


def written(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut the lineage of `df`: write it once as a compressed table in the shared folder and read
    it back. Lost executors cost nothing, since no copy lives on them. The table is removed by
    `release` or when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/strata-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
