"""Aggregates per partition of a stored table, kept beside it.

A partition is read again only when its files have changed, so the totals or digests of a table
that grows by a batch a night cost as much as that batch. Kept rows name the files they were made
from; rows of files that are gone are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reconcile import digest, table_diff
from .store import PERIOD, UNDATED, MartStore

PART = "_part"


@dataclass(frozen=True)
class Partitioned:
    """A stored table: its rows with the partition's value in ``_part``, and the files of every partition."""

    rows: DataFrame
    files: Mapping[str | None, frozenset[str]]

    def only(self, parts: Iterable[str | None]) -> DataFrame:
        """The rows of some partitions; no other is opened."""
        parts = list(parts)
        named = F.col(PART).isin([p for p in parts if p is not None])
        return self.rows.where(named | F.col(PART).isNull() if None in parts else named)


def partition_files(files: Iterable[str], column: str) -> dict[str | None, frozenset[str]]:
    """Files by the value that their path gives a partition column."""
    found: dict[str | None, set[str]] = {}
    for file in files:
        value = next(p for p in reversed(file.split("/")) if p.startswith(f"{column}=")).split("=", 1)[1]
        found.setdefault(None if value == UNDATED else value, set()).add(file)
    return {value: frozenset(names) for value, names in found.items()}


def of_mart(store: MartStore, name: str, grain: str) -> Partitioned:
    """A mart by its periods."""
    columns = store.schema(name)
    stored = T.StructType([*columns, T.StructField(PERIOD, T.StringType())])
    rows = store.spark.read.schema(stored).parquet(f"{store.root}/{name}/by={grain}")
    return Partitioned(rows.select(*columns.names, F.col(PERIOD).alias(PART)), store.partitions(name, grain))


class FeedLog:
    """Feeds as delivered, a partition per batch. A batch delivered again replaces the first as a whole."""

    BATCH = "batch"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def deliver(self, name: str, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/{self.BATCH}={batch}")

    def _rows(self, name: str, schema: T.StructType) -> DataFrame:
        stored = T.StructType([*schema, T.StructField(self.BATCH, T.IntegerType())])
        return self.spark.read.schema(stored).parquet(f"{self.root}/{name}")

    def upto(self, name: str, schema: T.StructType, batch: int) -> DataFrame:
        """Everything delivered up to and including a batch; later partitions are not opened."""
        return self._rows(name, schema).where(F.col(self.BATCH) <= batch).select(*schema.names)

    def exactly(self, name: str, schema: T.StructType, batch: int) -> DataFrame:
        return self._rows(name, schema).where(F.col(self.BATCH) == batch).select(*schema.names)

    def partitioned(self, name: str, schema: T.StructType, batch: int) -> Partitioned:
        """What has been delivered up to a batch, by batches."""
        rows = self._rows(name, schema)
        files = partition_files(rows.inputFiles(), self.BATCH)
        rows = rows.select(*schema.names, F.col(self.BATCH).cast("string").alias(PART))
        return Partitioned(rows, {p: f for p, f in files.items() if int(p) <= batch})


class Summaries:
    """Kept aggregates by name, below the folder of the tables they belong to.

    The driver sees a fingerprint per partition and refresh, no rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/_summaries"

    def _kept(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def stale(self, name: str, table: Partitioned, aggregates: Mapping[str, Column]) -> dict[str | None, str]:
        """The partitions to read again, and the fingerprints of their files."""
        return self._plan(name, table, aggregates)[1]

    def _plan(self, name, table, aggregates):
        found = table.rows.groupBy(PART).agg(F.count("*").alias("rows"), *[a.alias(n) for n, a in aggregates.items()])
        schema = T.StructType([T.StructField("of", T.StringType()), *found.schema])
        asked = "".join(f"{n}={a}" for n, a in aggregates.items())
        now = {
            hashlib.sha256("\n".join([asked, str(part), *sorted(files)]).encode()).hexdigest(): part
            for part, files in table.files.items()
        }
        known = {r[0] for r in self._kept(name, schema).select("of").distinct().collect()}
        return schema, {part: of for of, part in now.items() if of not in known}, list(now)

    def of(self, name: str, table: Partitioned, aggregates: Mapping[str, Column]) -> DataFrame:
        """A row per partition that has rows: ``_part``, ``rows`` and the aggregates."""
        schema, stale, now = self._plan(name, table, aggregates)
        if stale:
            found = table.only(stale).groupBy(PART).agg(
                F.count("*").alias("rows"), *[a.alias(n) for n, a in aggregates.items()]
            )
            names = self.spark.createDataFrame([(of, part) for part, of in stale.items()], f"of string, {PART} string")
            # a partition without rows is noted, too, or it would be read every time
            noted = names.alias("n").join(found.alias("f"), F.expr(f"n.{PART} <=> f.{PART}"), "left")
            noted = noted.select("n.of", f"n.{PART}", *[f"f.{c}" for c in schema.names[2:]])
            noted.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")
        kept = self._kept(name, schema).where(F.col("of").isin(now) & (F.col("rows") > 0))
        return kept.dropDuplicates(["of"]).drop("of")


def digests(summaries: Summaries, name: str, table: Partitioned) -> DataFrame:
    """``_part``, ``rows`` and ``digest`` of every partition's rows."""
    return summaries.of(name, table, {"digest": digest([c for c in table.rows.columns if c != PART])})


def stored_diff(left: Partitioned, left_digests: DataFrame, right: Partitioned, right_digests: DataFrame) -> DataFrame:
    """Rows that do not occur equally often in two stored tables with the same partitioning.

    Only partitions whose digests differ are opened. Their list is collected: no more than the
    calendar has. Equal digests of unequal rows are as unlikely as equal 128-bit hashes.
    """
    marked = left_digests.withColumn("side", F.lit(1)).unionByName(right_digests.withColumn("side", F.lit(-1)))
    unequal = marked.groupBy(PART, "rows", "digest").agg(F.sum("side").alias("n")).where("n <> 0")
    parts = [r[0] for r in unequal.select(PART).distinct().collect()]
    return table_diff(left.only(parts).drop(PART), right.only(parts).drop(PART))
