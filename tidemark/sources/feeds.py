"""Raw feeds: reading, typed staging, batch filters and freshness."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One staged column: where it comes from, its name and type, and an optional text rule."""

    source: str
    name: str
    type: str
    rule: Callable[[Column], Column] | None = None

    def staged(self, source_type: T.DataType) -> Column:
        value = F.col(self.source)
        if isinstance(source_type, T.StringType) and self.type != "string":
            value = F.nullif(value, F.lit(""))
        if self.rule is not None:
            value = self.rule(value)
        return value.cast(self.type).alias(self.name)


@dataclass(frozen=True)
class FeedSpec:
    """A raw feed: its fields in file order and, if batched, the column naming the batch."""

    name: str
    fields: tuple[Field, ...]
    batch: str | None = None

    @property
    def raw_schema(self) -> T.StructType:
        """All text: types are pinned by staging, never guessed from the file."""
        names = [f.source for f in self.fields] + ([self.batch] if self.batch else [])
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def read_delimited(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """A headed CSV feed. An empty field is missing; blanks inside a field are data."""
    return (
        spark.read.schema(spec.raw_schema)
        .option("header", True)
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def stage(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """One row out per row in: rename and cast, nothing else. A bad value raises."""
    return raw.select([f.staged(raw.schema[f.source].dataType) for f in spec.fields])


def batch_upto(feed: DataFrame, column: str, batch: int) -> DataFrame:
    """Append-only log: everything delivered up to and including this batch."""
    return feed.where(F.col(column).cast("int") <= F.lit(batch)).drop(column)


def batch_exact(feed: DataFrame, column: str, batch: int) -> DataFrame:
    """Full dump: this batch's picture and no other."""
    return feed.where(F.col(column).cast("int") == F.lit(batch)).drop(column)


def staged_upto(raw: DataFrame, spec: FeedSpec, batch: int) -> DataFrame:
    return stage(batch_upto(raw, spec.batch, batch), spec)


def staged_exact(raw: DataFrame, spec: FeedSpec, batch: int) -> DataFrame:
    return stage(batch_exact(raw, spec.batch, batch), spec)


@dataclass(frozen=True)
class SourceSpec:
    """A table built elsewhere: what says when it was loaded, and how old it may get."""

    name: str
    loaded_at: str
    warn_after_hours: int
    error_after_hours: int


class Sources:
    """Logical names for external tables; they are read and checked, never written."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._locations: dict[str, str] = {}
        self.specs: dict[str, SourceSpec] = {}

    def declare(self, spec: SourceSpec, location: str) -> None:
        """``location`` is a folder of Parquet files or the name of a catalog table."""
        self.specs[spec.name] = spec
        self._locations[spec.name] = location

    def read(self, name: str) -> DataFrame:
        if name not in self._locations:
            raise KeyError(f"source {name!r} is not declared")
        location = self._locations[name]
        return self._spark.read.parquet(location) if "/" in location else self._spark.table(location)

    def freshness(self, name: str, as_of: datetime | str) -> DataFrame:
        return freshness(self.read(name), self.specs[name], as_of)


def freshness(feed: DataFrame, spec: SourceSpec, as_of: datetime | str) -> DataFrame:
    """One row: newest load, its age at ``as_of`` and pass / warn / error.

    The clock is an argument so that a run can be repeated. A source without rows is an error.
    """
    clock = F.lit(str(as_of)).cast("timestamp_ntz")
    newest = feed.agg(F.max(F.col(spec.loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    limit = lambda hours: F.make_dt_interval(hours=F.lit(hours))
    age = clock - F.col("max_loaded_at")
    return newest.select(
        F.lit(spec.name).alias("source"),
        "max_loaded_at",
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > limit(spec.error_after_hours), "error")
        .when(age > limit(spec.warn_after_hours), "warn")
        .otherwise("pass")
        .alias("status"),
    )
