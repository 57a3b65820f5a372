"""Layers in a store as the source of plans.

A plan takes a source: a folder of Parquet tables, a `Lake` or a `Trace`. From a folder every
frame is worked out from the raw tables. From a lake a frame reads the layer below it: raw tables
come from Bronze, typed by their contracts, and frames of layers that are published are read back.
A trace works out nothing and records what reads what.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config
from strata.operators import contracts
from strata.sources.store import Store

Frame = Callable[[SparkSession, object], DataFrame]


class Trace:
    """Records (source, target, transform) edges while plans are put together over empty tables of
    a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.edges, self.into, self.made = spark, folder, [], [], {}

    def table(self, name: str) -> DataFrame:
        self._edge(f"bronze.{name}_raw")
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet").limit(0)

    def held(self, at: str, frame: Frame) -> DataFrame:
        self._edge(at)
        if at not in self.made:
            self.into.append((at, frame.__name__))
            try:
                self.made[at] = frame(self.spark, self)
            finally:
                self.into.pop()
        return self.made[at]

    def _edge(self, source: str) -> None:
        if self.into and (edge := (source, *self.into[-1])) not in self.edges:
            self.edges.append(edge)


class Lake:
    """The layers of one store."""

    def __init__(self, store: Store) -> None:
        self.store, self.spark = store, store.spark

    def table(self, name: str) -> DataFrame:
        """A Bronze table with the columns and types of its contract; what can't be read as its
        type is null. Columns that the feed names with an underscore are landed as feed_<name>."""
        raw = self.store.read("bronze", f"{name}_raw")
        contract = contracts.load(config.shipped(f"contracts/bronze_{name}.yml"))
        landed = {n: f"feed{n}" if f"feed{n}" in raw.columns else n for n, _, _ in contract.columns}
        texts = raw.select(*[F.col(landed[n]).alias(n) if landed[n] in raw.columns else F.lit(None).cast("string").alias(n) for n, _, _ in contract.columns])
        return texts.select(*[F.col(n).try_cast(contracts.TYPES[t]).alias(n) for n, t, _ in contract.columns])

    def held(self, at: str, frame: Frame) -> DataFrame:
        return self.store.read(*at.split("."))


def layer(at: str) -> Callable[[Frame], Frame]:
    """Marks a frame as the table `at` (schema.table) of the layers. `build` is the frame itself,
    which reads the tables below."""

    def mark(frame: Frame) -> Frame:
        @functools.wraps(frame)
        def held(spark: SparkSession, source, *args) -> DataFrame:
            return frame(spark, source, *args) if isinstance(source, str) else source.held(at, frame)

        held.build, held.at = frame, at
        return held

    return mark


def lineage(spark: SparkSession, folder: str, frames: list[Frame]) -> list[tuple[str, str, str]]:
    """Edges (source, target, transform) of the frames and all they read, from their own plans."""
    trace = Trace(spark, folder)
    for f in frames:
        trace.held(f.at, f.build)
    return sorted(trace.edges)
