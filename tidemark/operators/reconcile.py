"""Comparing two relations in both directions.

Both sides are stacked and aggregated by key instead of joined outright: the sums combine
map-side, so one key holding much of either side does not end up in one task, and repeated
keys are counted rather than multiplied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = "_side"


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str] = (),
    names: tuple[str, str] = ("left", "right"),
) -> DataFrame:
    """Keys on which the sides disagree, labelled: missing on a side, repeated differently, or
    with different totals. Empty when the sides agree."""
    keys, (a, b) = list(keys), names
    both = _stack(left.select(*keys, *sums), right.select(*keys, *sums))
    per_key = both.groupBy(*keys).agg(*_per_side(sums, a, b))
    unequal = [~F.col(f"{a}_{s}").eqNullSafe(F.col(f"{b}_{s}")) for s in sums]
    failure = (
        F.when(F.col(f"{b}_rows") == 0, f"missing in {b}")
        .when(F.col(f"{a}_rows") == 0, f"missing in {a}")
        .when(F.col(f"{a}_rows") != F.col(f"{b}_rows"), "row count differs")
    )
    if unequal:
        failure = failure.when(reduce(lambda x, y: x | y, unequal), "amount differs")
    return per_key.withColumn("failure", failure).where(F.col("failure").isNotNull())


def _stack(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn(SIDE, F.lit(0)).unionByName(right.withColumn(SIDE, F.lit(1)))


def _per_side(sums, a, b):
    columns = []
    for i, name in enumerate((a, b)):
        here = F.col(SIDE) == i
        columns.append(F.count_if(here).alias(f"{name}_rows"))
        columns += [F.sum(F.when(here, F.col(s))).alias(f"{name}_{s}") for s in sums]
    return columns


def tie_out(
    published: DataFrame,
    totals: Mapping[str, tuple[Column, DataFrame, Column]],
    type_: str = "decimal(28,2)",
) -> DataFrame:
    """Per named total: its value on both sides and the difference (0 when they tie).

    ``totals`` maps a name to (aggregate of ``published``, staged frame, its aggregate); an
    empty frame totals 0. ``published`` is read once for all of them, and the one-row totals
    are stacked by name, so nothing is crossed with anything.
    """
    value = lambda total: F.coalesce(total, F.lit(0)).cast(type_)
    cells = [
        F.struct(F.lit(name).alias("total"), value(total).alias("value"))
        for name, (total, _, _) in totals.items()
    ]
    one_row = published.agg(F.array(*cells).alias("cells"))
    rows = [
        one_row.select(F.explode("cells").alias("c")).select(
            "c.total", F.lit("published").alias(SIDE), "c.value"
        )
    ]
    for name, (_, frame, total) in totals.items():
        rows.append(
            frame.agg(value(total).alias("value")).select(
                F.lit(name).alias("total"), F.lit("staged").alias(SIDE), "value"
            )
        )
    pick = lambda side: F.max(F.when(F.col(SIDE) == side, F.col("value")))
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy("total")
        .agg(pick("published").alias("published"), pick("staged").alias("staged"))
        .withColumn("difference", (F.col("published") - F.col("staged")).cast(type_))
    )


def schema_differences(left: DataFrame, right: DataFrame) -> list[str]:
    a = [(f.name, f.dataType.simpleString()) for f in left.schema]
    b = [(f.name, f.dataType.simpleString()) for f in right.schema]
    return [] if a == b else [f"{x} <> {y}" for x, y in zip(a, b) if x != y] or [f"{a} <> {b}"]


def side_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row with how often it occurs on each side (NULL equals NULL).

    Types must agree as well. One aggregate over both sides answers both directions.
    """
    wrong = schema_differences(left, right)
    if wrong:
        raise TypeError("; ".join(wrong))
    return (
        _stack(left, right)
        .groupBy(*left.columns)
        .agg(
            F.count_if(F.col(SIDE) == 0).alias("left_rows"),
            F.count_if(F.col(SIDE) == 1).alias("right_rows"),
        )
    )


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides; empty when the tables are equal."""
    return side_counts(left, right).where(F.col("left_rows") != F.col("right_rows"))


def digest(columns: Sequence[str]) -> Column:
    """An aggregate that is equal for equal multisets of rows, whatever their order.

    Two 64-bit hashes of every row are added up in pieces of 32 bits, so that two billion
    rows fit a group; repeated rows count. Each column's absence is hashed beside its value.
    """
    cells = [cell for c in columns for cell in (F.col(c), F.col(c).isNull())]
    pieces = []
    for seed in (1, 2):
        row = F.xxhash64(F.lit(seed), *cells)
        halves = (row.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(row, 32))
        pieces += [F.coalesce(F.sum(half), F.lit(0)).cast("string") for half in halves]
    return F.concat_ws(":", F.count("*").cast("string"), *pieces)
