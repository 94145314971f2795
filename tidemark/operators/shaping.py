"""Latest row per key, previews and key filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The whole first row of each key in ``order`` (newest first, then whatever breaks ties:
    a task run again after a lost executor must pick the same row).

    Filtering ``row_number() = 1`` lets Spark keep one candidate per key and task before the
    shuffle (WindowGroupLimit), so a key that holds a large share of the rows stays cheap.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(first)).where(F.col(RANK) == 1).drop(RANK)


def preview(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Ordered first ``n`` rows for reading; tables themselves are never sorted."""
    return df.orderBy(*order).limit(n)


def without_keys(df: DataFrame, unwanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a mart whose key does not occur in ``unwanted``; a missing key stays."""
    return df.join(unwanted.select(*keys).distinct(), list(keys), "left_anti")


def run_labels(df: DataFrame, moment: str, label: str = "run_label") -> DataFrame:
    """Names each distinct moment R1, R2, ... in order; rows without a moment name none.

    Moments are ranked within their day, by as many tasks as there are days, and the days' counts
    are added up along the calendar. That one running sum sees a row per day that occurs.
    """
    moments = (
        df.select(moment).where(F.col(moment).isNotNull()).distinct().withColumn("_day", F.to_date(moment))
    )
    days = moments.groupBy("_day").agg(F.count("*").alias("_here")).withColumn("_one", F.lit(1))
    earlier = Window.partitionBy("_one").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = days.select("_day", F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_before"))
    ranked = moments.withColumn("_n", F.row_number().over(Window.partitionBy("_day").orderBy(moment)))
    number = (F.col("_before") + F.col("_n")).cast("string")
    return ranked.join(offsets, "_day").select(moment, F.concat(F.lit("R"), number).alias(label))
