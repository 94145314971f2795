"""Rows that arrived since the last run, by the moment they were loaded.

The mark of a feed is the newest ``loaded_at`` that a finished run has seen. Rows above it are new.
Rows at the very mark may be new as well, as a load that shares its moment with an earlier one does not
move the mark: their number and an order-free digest are kept with it, and when either has changed all
rows at the mark count as arrivals. Whoever uses them recomputes what they belong to, so that meeting
a row twice changes nothing.

Defined cases: rows without a moment arrive in every run; rows loaded with a moment below the mark
do not arrive at all, as ``loaded_at`` is promised not to run backwards; an empty feed has no mark.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import digest


@dataclass(frozen=True)
class Mark:
    """The newest moment, how many rows are at it, and their digest."""

    moment: datetime
    rows: int
    digest: str


@dataclass(frozen=True)
class Taken:
    """What a run takes from a feed, and the mark that holds once the run is done."""

    feed: str
    arrivals: DataFrame
    mark: Mark | None


class HighWater:
    """Marks by feed: a one-row Parquet folder per finished run."""

    SCHEMA = "moment timestamp_ntz, rows long, digest string, run int"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/_marks"

    def mark(self, feed: str, before_run: int) -> Mark | None:
        """The mark of the newest finished run before ``before_run``."""
        try:
            kept = self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/{feed}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        last = kept.where(F.col("run") < before_run).orderBy(F.desc("run")).first()
        return None if last is None else Mark(last["moment"], last["rows"], last["digest"])

    def take(self, feed: str, rows: DataFrame, loaded_at: str, run: int) -> Taken:
        """The arrivals of run ``run``.

        The new mark is settled before anything is built: what is loaded in the meantime lies above
        it or changes the digest, and so arrives in the next run.
        """
        moment = F.col(loaded_at).cast("timestamp_ntz")
        last = self.mark(feed, run)
        since = rows if last is None else rows.where(moment >= F.lit(last.moment))
        newest = since.agg(F.max(moment)).first()[0]
        mark = last if newest is None else self._at(rows, moment, newest)
        if last is None:
            return Taken(feed, rows, mark)
        same = mark == last or (mark.moment != last.moment and self._at(rows, moment, last.moment) == last)
        above = moment > F.lit(last.moment) if same else moment >= F.lit(last.moment)
        return Taken(feed, rows.where(above | moment.isNull()), mark)

    @staticmethod
    def _at(rows: DataFrame, moment: Column, at: datetime) -> Mark:
        found = rows.where(moment == F.lit(at)).agg(F.count("*").alias("n"), digest(rows.columns).alias("d")).first()
        return Mark(at, found["n"], found["d"])

    def finish(self, taken: Taken, run: int) -> None:
        """Keeps the mark, once what the run built from its arrivals is stored."""
        if taken.mark is None:
            return
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(taken.mark.moment).cast("timestamp_ntz").alias("moment"),
            F.lit(taken.mark.rows).cast("long").alias("rows"),
            F.lit(taken.mark.digest).alias("digest"),
        )
        row.write.mode("overwrite").parquet(f"{self.root}/{taken.feed}/run={run}")
