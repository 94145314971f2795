"""Stored tables: plain Parquet in shared storage, and a ledger of the runs that wrote them.

Incremental marts are partitioned by the period (month, by default) of their grain date. A run overwrites
the periods that its window touches, and no others, by Spark's dynamic partition overwrite; rows without
a date are a partition of their own, which every run rebuilds. Other marts are written whole, one
folder per run.

The ledger has a row when a run begins (what it found, so that a repeated run finds the same) and one
when it is done. A run that was cut off is not done: the same run, started again, writes its periods again.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How Spark names the partition of missing values.
UNDATED = "__HIVE_DEFAULT_PARTITION__"
#: The partition column, and how the first letters of a date name its period.
PERIOD = "_period"
LETTERS = {"year": 4, "month": 7, "day": 10}


class NotRebuildable(Exception):
    """Raised when a table that cannot be derived again would be dropped or overwritten."""


@dataclass(frozen=True)
class Run:
    """A ledger row: the newest grain date that a run found, and the table it leaves."""

    run: int
    newest: date | None
    grain: str | None
    columns: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))


class Ledger:
    """Runs by table: tiny Parquet folders, one per run and state."""

    BEGUN, DONE = "begun", "done"
    SCHEMA = "newest date, grain string, columns string, run int, state string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/_ledger"
        self.known: dict[str, list] = {}

    def refresh(self, name: str) -> None:
        """Looks at the folder again: what others have written since this object first looked."""
        self.known.pop(name, None)

    def _rows(self, name: str) -> list:
        if name not in self.known:
            try:
                rows = self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/{name}")
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                return []
            self.known[name] = rows.collect()
        return self.known[name]

    def runs(self, name: str, state: str = DONE, before_run: int | None = None) -> list[Run]:
        """Runs of a table in a state, in order."""
        found = [r for r in self._rows(name) if r["state"] == state and (before_run is None or r["run"] < before_run)]
        return sorted((Run(r["run"], r["newest"], r["grain"], r["columns"]) for r in found), key=lambda r: r.run)

    def found(self, name: str, run: int) -> Run | None:
        """What a run wrote down when it first began."""
        return next((r for r in self.runs(name, self.BEGUN) if r.run == run), None)

    def note(self, name: str, state: str, run: int, schema: T.StructType, newest: date | None = None, grain: str | None = None) -> None:
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(newest).cast("date").alias("newest"),
            F.lit(grain).cast("string").alias("grain"),
            F.lit(schema.json()).alias("columns"),
        )
        row.write.mode("overwrite").parquet(f"{self.root}/{name}/run={run}/state={state}")
        self.refresh(name)


class MartStore:
    """Marts by name: partitioned by periods of their grain date, or whole.

    ``period`` is the length of a partition: days for marts with many rows a day, else longer ones,
    as every partition is at least a file. One run at a time writes a mart.
    """

    def __init__(self, spark: SparkSession, root: str, period: str = "month"):
        self.spark, self.root, self.letters = spark, root.rstrip("/"), LETTERS[period]
        self.ledger = Ledger(spark, self.root)

    def _path(self, name: str, written: Run) -> str:
        return f"{self.root}/{name}/" + (f"by={written.grain}" if written.grain else f"run={written.run}")

    def _last(self, name: str, before_run: int | None = None) -> Run:
        done = self.ledger.runs(name, before_run=before_run)
        if not done:
            raise FileNotFoundError(f"no finished run of {name!r} in {self.root}")
        return done[-1]

    def exists(self, name: str, before_run: int | None = None) -> bool:
        self.ledger.refresh(name)
        return bool(self.ledger.runs(name, before_run=before_run))

    def schema(self, name: str, before_run: int | None = None) -> T.StructType:
        return self._last(name, before_run).schema

    def period(self, day: date) -> str:
        return day.isoformat()[: self.letters]

    def _touched(self, window) -> Column:
        """The periods of a window's dates, as a condition that prunes partitions."""
        inside = f"{PERIOD} is null or {PERIOD} >= '{self.period(window.since)}'"
        reopened = sorted({self.period(day) for day in window.reopened})
        return F.expr(inside + (f" or {PERIOD} in ({str(reopened)[1:-1]})" if reopened else ""))

    def read(self, name: str, before_run: int | None = None, window=None) -> DataFrame:
        """The table; one written whole as of its newest run (before ``before_run``).

        A partitioned mart is as its last run left it; with ``window`` only the periods it touches
        are opened. Columns that older periods lack are NULL.
        """
        last = self._last(name, before_run)
        schema = last.schema
        if last.grain:
            schema = T.StructType([*schema, T.StructField(PERIOD, T.StringType())])
        rows = self.spark.read.schema(schema).parquet(self._path(name, last))
        if window is not None:
            rows = rows.where(self._touched(window))
        return rows.select(*last.schema.names)

    def partitions(self, name: str, grain: str) -> dict[str | None, frozenset[str]]:
        """The files of every period, in order, from their paths; None stands for rows without a date."""
        try:
            files = self.spark.read.schema(f"{grain} date").parquet(f"{self.root}/{name}/by={grain}").inputFiles()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        found: dict[str | None, set[str]] = {}
        for file in sorted(files):  # a folder may be listed in any order
            value = re.findall(f"/{PERIOD}=([^/]+)/", file)[-1]
            found.setdefault(None if value == UNDATED else value, set()).add(file)
        return {period: frozenset(names) for period, names in found.items()}

    def newest(self, name: str, grain: str) -> date | None:
        """The newest date, from the newest period in the list of partitions that has rows."""
        for period in sorted((p for p in self.partitions(name, grain) if p is not None), reverse=True):
            rows = self.spark.read.schema(f"{grain} date").parquet(self._folder(name, grain, period))
            found = rows.agg(F.max(grain)).first()[0]
            if found is not None:
                return found
        return None

    def _folder(self, name: str, grain: str, period: str | None) -> str:
        return f"{self.root}/{name}/by={grain}/{PERIOD}={period or UNDATED}"

    def before(self, name: str, run: int, rows: DataFrame) -> DataFrame:
        """``rows`` as they were when the run first began: kept then, read when it is repeated."""
        if self.ledger.found(name, run) is not None:
            return self.spark.read.schema(rows.schema).parquet(f"{self.root}/_staged/{name}-before/run={run}")
        return self.stage(f"{name}-before", run, rows)

    def begin(self, name: str, run: int, schema: T.StructType, grain: str) -> None:
        """Notes what the run finds; the first note counts."""
        if self.ledger.found(name, run) is None:
            self.ledger.note(name, Ledger.BEGUN, run, schema, self.newest(name, grain), grain)

    def write(self, name: str, run: int, df: DataFrame, grain: str | None = None, window=None) -> None:
        """Commits run ``run``: the whole table, or the periods that ``window`` touches, from all of their rows.

        Periods without rows in ``df`` are emptied; the one without a date is always among them.
        """
        if grain is None:
            df.write.mode("overwrite").parquet(f"{self.root}/{name}/run={run}")
        else:
            self.begin(name, run, df.schema, grain)
            before = self.partitions(name, grain)
            # rebalanced by period: a file or a few for each, whatever the sizes
            named = df.withColumn(PERIOD, F.substring(F.col(grain).cast("string"), 1, self.letters))
            dealt = named.hint("rebalance", F.col(PERIOD)).write.mode("overwrite")
            dealt.option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(f"{self.root}/{name}/by={grain}")
            after = self.partitions(name, grain)
            first = self.period(window.since) if window is not None else ""
            others = {self.period(day) for day in window.reopened} if window is not None else set()
            for period, files in before.items():
                # the same files as before: nothing was written for this period
                if (period is None or period >= first or period in others) and after.get(period) == files:
                    empty = self.spark.createDataFrame([], df.schema).coalesce(1)
                    empty.write.mode("overwrite").parquet(self._folder(name, grain, period))
        self.ledger.note(name, Ledger.DONE, run, df.schema, grain=grain)

    def stage(self, name: str, run: int, df: DataFrame) -> DataFrame:
        """Writes rows a run needs more than once, so that they are computed only once."""
        folder = f"{self.root}/_staged/{name}/run={run}"
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)


class HistoryStore:
    """Version histories. Each run adds the versions it closed and a fresh set of open ones.

    Closed versions are never written again, so a run costs as much as the open set, however
    long the history grows. There is no way to drop or rebuild a history: it cannot be derived
    from its source a second time.
    """

    OPEN, CLOSED = "open", "closed"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger = Ledger(spark, self.root)

    def runs(self, name: str) -> list[int]:
        self.ledger.refresh(name)
        return [r.run for r in self.ledger.runs(name)]

    def _rows(self, name: str, schema: T.StructType) -> DataFrame:
        full = T.StructType(
            [*schema, T.StructField("run", T.IntegerType()), T.StructField("state", T.StringType())]
        )
        return self.spark.read.schema(full).parquet(f"{self.root}/{name}")

    def open_versions(self, name: str, run: int, schema: T.StructType) -> DataFrame:
        rows = self._rows(name, schema)
        return rows.where((F.col("run") == run) & (F.col("state") == self.OPEN)).select(
            *schema.names
        )

    def read(self, name: str, schema: T.StructType, upto_run: int | None = None) -> DataFrame:
        """All versions as of a run: those closed by then and those open after it."""
        done = [r for r in self.runs(name) if upto_run is None or r <= upto_run]
        if not done:
            raise FileNotFoundError(f"no finished run of history {name!r} in {self.root}")
        rows = self._rows(name, schema)
        closed = F.col("run").isin(done) & (F.col("state") == self.CLOSED)
        still_open = (F.col("run") == done[-1]) & (F.col("state") == self.OPEN)
        return rows.where(closed | still_open).select(*schema.names)

    def write(self, name: str, run: int, rows: DataFrame) -> None:
        """``rows`` carry a ``state`` column. Only the newest run may be written again."""
        done = self.runs(name)
        if done and run < done[-1]:
            raise NotRebuildable(
                f"history {name!r} already holds run {done[-1]}; run {run} cannot be redone"
            )
        rows.write.mode("overwrite").partitionBy("state").parquet(f"{self.root}/{name}/run={run}")
        self.ledger.note(name, Ledger.DONE, run, rows.schema)

    def drop(self, name: str) -> None:
        raise NotRebuildable(f"history {name!r} cannot be rebuilt from its source")
