"""Grain-safe joins: many sides are reduced to the header's key before they are joined."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that a single task may receive in a row-preserving join.
HOT_ROWS = 20_000_000
# How often a key at the limit should show up in the sample that looks for hot keys.
SAMPLE_HITS = 10_000
# Most hot keys handled apart; any further ones take the ordinary shuffle, which is exact too.
MAX_HOT_KEYS = 10_000


def zero_filled(df: DataFrame, zeros: Mapping[str, str]) -> DataFrame:
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)).cast(type_) for name, type_ in zeros.items()}
    )


def left_zero_fill(
    spine: DataFrame, measures: DataFrame, on: Sequence[str], zeros: Mapping[str, str]
) -> DataFrame:
    """``spine`` fixes the grain; a row without measures gets zeros. Both sides unique on ``on``."""
    return zero_filled(spine.join(measures, list(on), "left"), zeros)


def lookup(
    facts: DataFrame,
    names: DataFrame,
    on: str,
    column: str,
    default: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Adds ``column`` from a lookup unique on ``on``; facts without a match get ``default``.

    ``hot_rows=None`` says that the facts are already reduced to one row per ``on``.
    """
    wanted = names.select(on, column)
    if hot_rows is None:
        found = facts.join(wanted, on, "left")
    else:
        found = split_join(facts, wanted, [on], "left", hot_rows)
    return found.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def rollup(lines: DataFrame, key: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One row per key; lines without a key belong to nothing and are left out."""
    keyed = lines.dropna(subset=list(key))
    return keyed.groupBy(*key).agg(*[m.alias(name) for name, m in measures.items()])


def rollup_left(
    headers: DataFrame,
    lines: DataFrame,
    key: Sequence[str],
    measures: Mapping[str, Column],
    zeros: Mapping[str, str],
) -> DataFrame:
    """Header rows with their lines' totals: lines are reduced first, so no header repeats."""
    return left_zero_fill(headers, rollup(lines, key, measures), key, zeros)


def rollup_left_many(
    headers: DataFrame,
    key: Sequence[str],
    *sides: tuple[DataFrame, Mapping[str, Column], Mapping[str, str]],
) -> DataFrame:
    """Several many sides, each reduced on its own before any join: no fan-out between them."""
    for lines, measures, zeros in sides:
        headers = rollup_left(headers, lines, key, measures, zeros)
    return headers


@dataclass(frozen=True)
class HotKeys:
    """Keys with more facts than one task should get: the named ones, and the missing key."""

    named: DataFrame | None
    missing: bool


def sampled(df: DataFrame, hot_rows: int) -> tuple[DataFrame, float]:
    """Enough of ``df`` to tell whether a key has ``hot_rows`` rows, and the share that is.

    A key at the limit shows up about ``SAMPLE_HITS`` times, so the count that follows shuffles a
    small fraction of the keys. Limits up to ``SAMPLE_HITS`` are decided on all rows.
    """
    share = min(1.0, SAMPLE_HITS / max(hot_rows, 1))
    return (df if share == 1.0 else df.sample(share, seed=SAMPLE_HITS)), share


def hot_keys(facts: DataFrame, on: Sequence[str], hot_rows: int) -> HotKeys | None:
    """The keys with more than about ``hot_rows`` facts, or None.

    One count per key on a sample of the key columns. The answer only chooses how a join is
    carried out: its rows are the same whichever keys are listed. At most
    ``len(facts) / hot_rows`` keys can qualify.
    """
    spark: SparkSession = facts.sparkSession
    sample, share = sampled(facts.select(*on), hot_rows)
    counted = sample.groupBy(*on).count()
    heavy = (
        counted.where(F.col("count") > hot_rows * share)
        .orderBy(F.col("count").desc())
        .limit(MAX_HOT_KEYS)
        .select(*on)
    )
    rows = heavy.collect()
    named = [r for r in map(tuple, rows) if None not in r]
    if not rows:
        return None
    few = spark.createDataFrame(named, heavy.schema) if named else None
    return HotKeys(few, len(named) < len(rows))


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """``df`` marked for broadcast if it has no more than ``limit`` rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def split_join(
    facts: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Joins facts to ``side`` (one row per ``on``) without ever gathering a hot key.

    Facts of a hot key are joined where they are to the few matching ``side`` rows, which are
    at most as many as there are hot keys; the others take the ordinary join. If the missing
    key is hot, its facts, which can match nothing, skip the shuffle altogether.
    ``counted`` is a cheaper frame with the same keys as ``facts`` to find the hot ones in.
    """
    on = list(on)
    hot = hot_keys(facts if counted is None else counted, on, hot_rows)
    if hot is None:
        return facts.join(side, on, how)
    has_key = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in on])
    keyed = facts.where(has_key) if hot.missing else facts
    if hot.named is None:
        joined = keyed.join(side, on, how)
    else:
        few = F.broadcast(hot.named)
        hot_side = broadcast_if_small(side.join(few, on, "left_semi"), MAX_HOT_KEYS)
        cold = keyed.join(few, on, "left_anti").join(side, on, how)
        joined = cold.unionByName(keyed.join(few, on, "left_semi").join(hot_side, on, how))
    if hot.missing and how in ("left", "left_anti"):
        joined = joined.unionByName(facts.where(~has_key), allowMissingColumns=True)
    return joined


def attach(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Row-preserving join: facts with the columns of a ``dim`` unique on ``on``."""
    return split_join(facts, dim, on, how, hot_rows, counted)


def keep_keys(
    facts: DataFrame, wanted: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Facts whose key occurs in ``wanted``."""
    return split_join(facts, wanted.select(*on).distinct(), on, "left_semi", hot_rows)


def drop_keys(
    facts: DataFrame, unwanted: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Facts whose key does not occur in ``unwanted``; those without a key stay."""
    return split_join(facts, unwanted.select(*on).distinct(), on, "left_anti", hot_rows)


def within_key_range(
    headers: DataFrame, key: str, *logs: DataFrame
) -> list[DataFrame]:
    """The logs' rows whose key lies between the least and the greatest key of ``headers``.

    Cuts what an incremental run reads of large logs without a join: the two bounds become
    plain comparisons that reach the scan, and skip whole files where keys grow over time.
    Every row that can match is kept; a later join on the key does the exact matching.
    """
    least, greatest = headers.agg(F.min(key), F.max(key)).first()
    if least is None:
        return [log.where(F.lit(False)) for log in logs]
    inside = F.col(key).between(F.lit(least), F.lit(greatest))
    return [log.where(inside) for log in logs]
