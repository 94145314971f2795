"""Data-quality checks. A check yields failing rows; none means it passes."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import MartStore
from .joins import drop_keys

ERROR, WARN = "error", "warn"


class ChecksFailed(Exception):
    pass


class CheckCountMismatch(Exception):
    pass


@dataclass(frozen=True)
class Check:
    """One named check on a table.

    Either ``condition`` (a row fails where it is true; many such checks share one scan) or
    ``failing`` (a function from the table to its failing rows), with ``counting`` where their
    number (one row, column ``n``) is cheaper to get than the rows.
    ``severity`` is a ceiling: a warn check never blocks. Under severity error, ``error_if``
    and ``warn_if`` are the failing-row counts from which the check errors or warns.
    """

    name: str
    severity: str = ERROR
    condition: Column | None = None
    failing: Callable[[DataFrame], DataFrame] | None = None
    counting: Callable[[DataFrame], DataFrame] | None = None
    error_if: int = 1
    warn_if: int = 1

    def rows(self, table: DataFrame) -> DataFrame:
        """The failing rows themselves, for follow-up."""
        return table.where(self.condition) if self.failing is None else self.failing(table)

    def count(self, table: DataFrame) -> DataFrame:
        if self.counting is not None:
            return self.counting(table)
        return self.rows(table).agg(F.count("*").alias("n"))

    def status(self, count: Column) -> Column:
        outcome = F.when(F.lit(self.severity == ERROR) & (count >= self.error_if), "error")
        return outcome.when(count >= self.warn_if, "warn").otherwise("pass")


def not_null(column: str, severity: str = ERROR) -> Check:
    return Check(f"not_null({column})", severity, F.col(column).isNull())


def all_not_null(columns: Sequence[str], severity: str = ERROR) -> Check:
    """A row fails once, however many of the columns are missing."""
    condition = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return Check(f"all_not_null({', '.join(columns)})", severity, condition)


def not_negative(column: str, severity: str = ERROR) -> Check:
    """A missing value passes; presence is ``not_null``'s business."""
    return Check(f"not_negative({column})", severity, F.coalesce(F.col(column) < 0, F.lit(False)))


def accepted_values(column: str, values: Sequence, severity: str = ERROR) -> Check:
    """A missing value passes, as in three-valued logic."""
    condition = F.coalesce(~F.col(column).isin(list(values)), F.lit(False))
    return Check(f"accepted_values({column})", severity, condition)


def row_rule(name: str, rule: Column, severity: str = ERROR) -> Check:
    """Every row must make ``rule`` true; a rule that is NULL fails."""
    return Check(name, severity, ~F.coalesce(rule, F.lit(False)))


def unique(column: str, severity: str = ERROR) -> Check:
    """One failing row per repeated value; missing values are ignored."""
    return Check(
        f"unique({column})",
        severity,
        failing=lambda t: duplicate_keys(t.where(F.col(column).isNotNull()), [column]),
    )


def grain_unique(columns: Sequence[str], severity: str = ERROR) -> Check:
    return Check(
        f"grain_unique({', '.join(columns)})",
        severity,
        failing=lambda t: duplicate_keys(t, columns),
    )


def relationships(column: str, parent: DataFrame, to: str, severity: str = ERROR) -> Check:
    """Present child values must exist in the parent. One failing row per child row."""
    return Check(
        f"relationships({column} -> {to})",
        severity,
        failing=lambda t: orphans(t, column, parent, to),
        counting=lambda t: orphan_count(t, column, parent, to),
    )


def singular(name: str, failing: DataFrame, severity: str = ERROR) -> Check:
    """Any query whose rows are failures."""
    return Check(name, severity, failing=lambda _: failing)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys with their number of rows; a missing key part is a value like others."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, to: str) -> DataFrame:
    """Child rows whose present key has no parent row."""
    known = parent.select(F.col(to).alias(column))
    return drop_keys(child.where(F.col(column).isNotNull()), known, [column])


def orphan_count(child: DataFrame, column: str, parent: DataFrame, to: str) -> DataFrame:
    """Their number: child rows are counted per key first, so a busy key is one row."""
    known = parent.select(F.col(to).alias(column)).distinct()
    per_key = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("c"))
    missing = per_key.join(known, column, "left_anti")
    return missing.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))


def header_not_equal_lines(
    headers: DataFrame, lines: DataFrame, key: str, header_amount: str, line_amount: str
) -> DataFrame:
    """Headers that have lines and whose amount is not their sum."""
    sums = lines.dropna(subset=[key]).groupBy(key).agg(F.sum(line_amount).alias("line_sum"))
    joined = headers.join(sums, key)
    return joined.where(~F.col(header_amount).eqNullSafe(F.col("line_sum")))


def without_children(headers: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Headers that must have lines but have none."""
    return headers.join(lines.select(key).distinct(), key, "left_anti")


@dataclass
class CheckSuite:
    """The checks of one table, run together.

    All row conditions are counted in one aggregate over one scan, so hundreds of bindings cost
    as many scans as there are tables. ``expected`` guards against a check that was written
    but never bound.
    """

    table_name: str
    table: DataFrame
    checks: Sequence[Check]
    expected: int | None = None

    def __post_init__(self):
        names = [c.name for c in self.checks]
        if len(set(names)) != len(names):
            raise ValueError(f"check names repeat: {names}")
        if self.expected is not None and len(names) != self.expected:
            raise CheckCountMismatch(f"{len(names)} checks bound, {self.expected} expected")

    def results(self) -> DataFrame:
        """One row per check: table, check, severity, failing_rows, status."""
        frames = []
        scanned = [c for c in self.checks if c.failing is None]
        if scanned:
            counts = self.table.agg(
                *[F.count_if(c.condition).alias(f"c{i}") for i, c in enumerate(scanned)]
            )
            cells = [self._cell(c, F.col(f"c{i}")) for i, c in enumerate(scanned)]
            frames.append(counts.select(F.explode(F.array(*cells)).alias("r")).select("r.*"))
        for c in self.checks:
            if c.failing is not None:
                frames.append(c.count(self.table).select(self._cell(c, F.col("n")).alias("r")).select("r.*"))
        return reduce(DataFrame.unionByName, frames)

    def _cell(self, check: Check, count: Column) -> Column:
        return F.struct(
            F.lit(self.table_name).alias("table_name"),
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            count.cast("bigint").alias("failing_rows"),
            check.status(count).alias("status"),
        )

    def store_failures(self, folder: str) -> None:
        """Writes each check's failing rows below ``folder`` for follow-up."""
        for i, c in enumerate(self.checks):
            c.rows(self.table).write.mode("overwrite").parquet(f"{folder}/{self.table_name}/{i}")

    def gate(self) -> DataFrame:
        """Returns the table, or raises if an error check fails: nothing downstream is built."""
        failed = self.results().where(F.col("status") == "error").collect()  # one row per check
        if failed:
            text = "; ".join(f"{r.check_name}: {r.failing_rows}" for r in failed)
            raise ChecksFailed(f"{self.table_name}: {text}")
        return self.table


def run_suites(suites: Sequence[CheckSuite], expected: int | None = None) -> DataFrame:
    bound = sum(len(s.checks) for s in suites)
    if expected is not None and bound != expected:
        raise CheckCountMismatch(f"{bound} checks bound, {expected} expected")
    return reduce(DataFrame.unionByName, [s.results() for s in suites])


def relation_kind(
    spark: SparkSession, store: MartStore, name: str, inlined: Collection[str] = ()
) -> str:
    """``table`` if stored, ``view`` if in the catalog, ``ephemeral`` if it exists as a function only.

    ``inlined`` names those functions; any other name is ``missing``.
    """
    if store.exists(name):
        return "table"
    if spark.catalog.tableExists(name):
        return "view"
    return "ephemeral" if name in inlined else "missing"


def wrong_materializations(
    spark: SparkSession, store: MartStore, expected: Mapping[str, str], inlined: Collection[str] = ()
) -> list[str]:
    """Relations that do not exist in the way they are meant to."""
    kinds = {name: relation_kind(spark, store, name, inlined) for name in expected}
    return [f"{n}: {kinds[n]}, not {want}" for n, want in expected.items() if kinds[n] != want]
