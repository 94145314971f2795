"""Pivot whose columns follow a list, with an ``other`` bucket for everything unlisted."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.scalars import any_of, not_listed, total_of

OTHER = "other"
_IDENTIFIER = re.compile(r"[a-z_][a-z0-9_]*")


def listed(values: Sequence[str] | None) -> list[str]:
    """The list as column prefixes. An empty list is valid; a missing one is not."""
    if values is None or isinstance(values, str):
        raise ValueError("the pivot needs a list of values")
    names = [v.lower() for v in values]
    for name in names:
        if not _IDENTIFIER.fullmatch(name):
            raise ValueError(f"{name!r} cannot start a column name")
    if len(set(names)) != len(names) or OTHER in names:
        raise ValueError("values must be distinct, and none may be 'other'")
    return names


def bucket(value: Column, names: Sequence[str]) -> Column:
    return F.when(not_listed(value, names), F.lit(OTHER)).otherwise(value)


def pivot_metrics(
    headers: DataFrame,
    payments: DataFrame,
    header_key: str,
    groups: Sequence[str],
    method: str,
    amount: str,
    values: Sequence[str] | None,
) -> DataFrame:
    """Per group: header count, total amount and, per listed value and ``other``, the number of
    headers with such a payment and their amount. Groups come from ``headers`` alone.

    Payments are folded to one row per header first. That makes "headers with at least one" a
    plain count (no distinct, no row expansion per listed value), keeps many-payment headers
    out of the join, and leaves one join and one final aggregate.
    """
    names = [*listed(values), OTHER]
    tag = bucket(F.col(method), names[:-1])
    per_header = (
        payments.withColumn("_tag", tag)
        .groupBy(header_key)
        .agg(
            F.sum(amount).alias("_all"),
            *[F.count_if(F.col("_tag") == n).alias(f"_n_{n}") for n in names],
            *[F.sum(F.when(F.col("_tag") == n, F.col(amount))).alias(f"_a_{n}") for n in names],
        )
    )
    measures = [
        F.count("*").alias("order_count"),
        _money(F.sum("_all")).alias("captured_amount_usd"),
    ]
    for n in names:
        measures.append(F.count_if(F.col(f"_n_{n}") > 0).alias(f"{n}_order_count"))
        measures.append(_money(F.sum(f"_a_{n}")).alias(f"{n}_amount_usd"))
    return headers.join(per_header, header_key, "left").groupBy(*groups).agg(*measures)


def _money(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("decimal(28,2)")


def pivot_contract(groups: Sequence[tuple[str, str]], values: Sequence[str] | None) -> Contract:
    columns = [*groups, ("order_count", "int"), ("captured_amount_usd", "decimal(12,2)")]
    for n in [*listed(values), OTHER]:
        columns += [(f"{n}_order_count", "int"), (f"{n}_amount_usd", "decimal(12,2)")]
    return Contract(*columns)


def long_metrics(
    payments: DataFrame, header_key: str, groups: Sequence[str], method: str, amount: str
) -> DataFrame:
    """The same measures with the method as a row instead of a column."""
    return (
        payments.groupBy(*groups, method, header_key)
        .agg(F.sum(amount).alias("_a"))
        .groupBy(*groups, method)
        .agg(F.count("*").alias("order_count"), _money(F.sum("_a")).alias("amount_usd"))
    )


def melt_metrics(wide: DataFrame, groups: Sequence[str], values: Sequence[str] | None) -> DataFrame:
    """Pivoted columns back to rows (one per group and listed value, ``other`` included)."""
    cells = [
        F.struct(
            F.lit(n).alias("bucket"),
            F.col(f"{n}_order_count").alias("order_count"),
            F.col(f"{n}_amount_usd").alias("amount_usd"),
        )
        for n in [*listed(values), OTHER]
    ]
    return wide.select(*groups, F.explode(F.array(*cells)).alias("c")).select(*groups, "c.*")


def parts_not_equal_total(wide: DataFrame, values: Sequence[str] | None) -> DataFrame:
    """Failing rows: the buckets do not add up to the total (a missing bucket also fails)."""
    parts = total_of([F.col(f"{n}_amount_usd") for n in [*listed(values), OTHER]])
    return wide.where(~parts.eqNullSafe(F.col("captured_amount_usd")))


def generated_not_populated(wide: DataFrame, values: Sequence[str] | None) -> DataFrame:
    """Failing rows: any generated cell is missing or negative."""
    cells = [
        F.col(f"{n}_{m}") for n in [*listed(values), OTHER] for m in ("order_count", "amount_usd")
    ]
    return wide.where(any_of([c.isNull() | (c < 0) for c in cells]))
