"""Neighbour, running and as-of columns along a key's timeline, safe for very long timelines.

A window partitioned by key sorts one key's rows in one task. That is the plan used while no
key is longer than ``hot_rows`` (a count per key on a sample decides). Otherwise all rows are
range partitioned by key, moment and ties, so that each partition, a stretch, holds about as many
rows as any other, whether a key's rows lie in one minute or in ten years. Every (key, stretch) is
its own window partition, and what a stretch needs from its neighbours is carried over as one
extra edge row. The edge values come from one row per (key, stretch), so no task ever holds a
whole long timeline. Both plans give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_folder
from .joins import sampled

HOT_ROWS = 20_000_000
# Stretches are cut finer than the row count asks for, as range bounds come from a sample.
FINENESS = 4
# Rows below which a stretch need not be cut again; production limits are far above it.
LEAST_ROWS = 50_000

STRETCH, EDGE, CARRY = "_stretch", "_edge", "_carry"
BEFORE, ROW, AFTER = -1, 0, 1


def stretches_for(timelines: DataFrame, keys: Sequence[str], hot_rows: int) -> int | None:
    """None while every key fits one task, else the number of stretches to cut the rows into.

    Decided on a sample of the keys: it chooses the plan and how fine the cuts are, never the rows.
    """
    sample, share = sampled(timelines.select(*keys), hot_rows)
    longest, rows = sample.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    if longest is None or longest <= hot_rows * share:
        return None
    wanted = FINENESS * math.ceil(rows / share / hot_rows)
    few = int(timelines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(wanted, max(few, math.ceil(rows / share / LEAST_ROWS)))


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column], stretches: int) -> DataFrame:
    """``df`` with the number of each row's stretch; numbers rise with ``order`` within a key.

    Range bounds are drawn anew whenever a plan runs, so the numbered rows are written once.
    """
    spread = df.repartitionByRange(stretches, *[F.col(k) for k in keys], *order)
    numbered = spread.withColumns({STRETCH: F.spark_partition_id(), EDGE: F.lit(ROW)})
    path = fresh_folder(df.sparkSession, "stretches")
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def _with_edges(rows: DataFrame, edges: DataFrame) -> DataFrame:
    return rows.unionByName(edges, allowMissingColumns=True)


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    moment: str,
    take: Sequence[str],
    into: str,
    ties: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds struct ``into`` with the ``take`` columns of the key's next row, NULL on the last."""
    return _neighbour(df, keys, moment, take, into, ties, hot_rows, AFTER)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    moment: str,
    take: Sequence[str],
    into: str,
    ties: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds struct ``into`` with the ``take`` columns of the key's previous row."""
    return _neighbour(df, keys, moment, take, into, ties, hot_rows, BEFORE)


def _neighbour(df, keys, moment, take, into, ties, hot_rows, side):
    step = F.lead if side == AFTER else F.lag
    value = F.struct(*take)
    order = [F.col(moment), *ties]
    cuts = stretches_for(df, keys, hot_rows)
    if cuts is None:
        return df.withColumn(into, step(value).over(Window.partitionBy(*keys).orderBy(*order)))
    rows = _cut(df, keys, order, cuts).withColumn(CARRY, value)
    pick = F.min_by if side == AFTER else F.max_by
    ends = rows.groupBy(*keys, STRETCH).agg(pick(CARRY, F.struct(*order)).alias(CARRY))
    along = Window.partitionBy(*keys).orderBy(STRETCH)
    edges = ends.withColumns({CARRY: step(CARRY).over(along), EDGE: F.lit(side)}).where(
        F.col(CARRY).isNotNull()
    )
    within = Window.partitionBy(*keys, STRETCH).orderBy(EDGE, *order)
    return (
        _with_edges(rows, edges)
        .withColumn(into, step(CARRY).over(within))
        .where(F.col(EDGE) == ROW)
        .drop(STRETCH, EDGE, CARRY)
    )


def with_earlier_max(
    df: DataFrame,
    keys: Sequence[str],
    moment: str,
    value: Column,
    into: str,
    ties: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``into``: the greatest ``value`` among the key's earlier rows, NULL on the first."""
    order = [F.col(moment), *ties]
    cuts = stretches_for(df, keys, hot_rows)
    if cuts is None:
        earlier = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(into, F.max(value).over(_up_to_previous(earlier)))
    rows = _cut(df, keys, order, cuts).withColumn(CARRY, value)
    tops = rows.groupBy(*keys, STRETCH).agg(F.max(CARRY).alias(CARRY))
    along = Window.partitionBy(*keys).orderBy(STRETCH)
    edges = tops.withColumns(
        {CARRY: F.max(CARRY).over(_up_to_previous(along)), EDGE: F.lit(BEFORE)}
    ).where(F.col(CARRY).isNotNull())
    within = Window.partitionBy(*keys, STRETCH).orderBy(EDGE, *order)
    return (
        _with_edges(rows, edges)
        .withColumn(into, F.max(CARRY).over(_up_to_previous(within)))
        .where(F.col(EDGE) == ROW)
        .drop(STRETCH, EDGE, CARRY)
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    starts: str,
    take: Sequence[str],
    into: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds struct ``into``: the ``take`` columns of the key's last version not after ``at``.

    Facts and versions share one timeline per key, on which the last seen version is carried
    forward: one shuffle, no pairing of facts with versions. Every fact stays, once. As in an
    equality join, facts and versions without a key match nothing, nor do versions without a
    start; of versions with one start the one with the greatest values in ``take`` holds.
    """
    keys = list(keys)
    when, turn, fact = "_when", "_turn", "_fact"
    value = F.struct(*take)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    versions = versions.where(keyed & F.col(starts).isNotNull())
    unkeyed, facts = facts.where(~keyed), facts.where(keyed)
    timeline = versions.select(
        *keys, F.col(starts).alias(when), F.lit(0).alias(turn), value.alias(CARRY)
    ).unionByName(
        facts.select(
            *keys, F.col(at).alias(when), F.lit(1).alias(turn), F.struct(*facts.columns).alias(fact)
        ),
        allowMissingColumns=True,
    )
    order = [F.col(when), F.col(turn), F.col(CARRY)]
    cuts = stretches_for(timeline, keys, hot_rows)
    if cuts is None:
        within = Window.partitionBy(*keys).orderBy(*order)
    else:
        timeline = _cut(timeline, keys, order, cuts)
        is_version = F.when(F.col(turn) == 0, F.struct(when, CARRY))
        lasts = timeline.groupBy(*keys, STRETCH).agg(F.max_by(CARRY, is_version).alias(CARRY))
        along = Window.partitionBy(*keys).orderBy(STRETCH)
        edges = lasts.withColumns(
            {
                CARRY: F.last(CARRY, ignorenulls=True).over(_up_to_previous(along)),
                EDGE: F.lit(BEFORE),
                turn: F.lit(0),
            }
        ).where(F.col(CARRY).isNotNull())
        timeline = _with_edges(timeline, edges)
        within = Window.partitionBy(*keys, STRETCH).orderBy(EDGE, *order)
    carried = F.last(CARRY, ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = timeline.withColumn(into, carried).where(F.col(turn) == 1).select(f"{fact}.*", into)
    return found.unionByName(unkeyed, allowMissingColumns=True)


def _up_to_previous(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)
