"""Integrity of version histories; every function returns the failing rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import joins, temporal, timeline

FOREVER = "9999-12-31 23:59:59"


def not_one_open(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without exactly one open version; none at all fails too."""
    counted = history.groupBy(*keys).agg(
        F.count_if(F.col("valid_to").isNull()).alias("open_versions")
    )
    return counted.where(F.col("open_versions") != 1)


def window_overlaps(
    history: DataFrame, keys: Sequence[str], hot_rows: int = timeline.HOT_ROWS
) -> DataFrame:
    """Versions with an empty or inverted window, and versions starting inside an earlier one.

    "Inside an earlier one" is decided by the running latest end along the key's timeline, one
    sorted pass instead of comparing every version with every other.
    """
    end = F.coalesce(F.col("valid_to"), F.lit(FOREVER).cast("timestamp_ntz"))
    seen = timeline.with_earlier_max(
        history,
        keys,
        "valid_from",
        end,
        "_reach",
        ties=[F.col("valid_to").isNull(), F.col("valid_to")],
        hot_rows=hot_rows,
    )
    failure = F.when(F.col("valid_to") <= F.col("valid_from"), "empty window").when(
        F.col("valid_from") < F.col("_reach"), "overlap"
    )
    failing = seen.withColumn("failure", failure).where(F.col("failure").isNotNull())
    return failing.select(*keys, "valid_from", "valid_to", "failure")


def not_tiling(
    history: DataFrame, keys: Sequence[str], hot_rows: int = timeline.HOT_ROWS
) -> DataFrame:
    """Versions that break the tiling of their key's timeline, labelled.

    Each closed version must end where the next begins, the open one must be the last, and no
    window may be empty.
    """
    seen = timeline.with_next(
        history,
        keys,
        "valid_from",
        ["valid_from"],
        "_next",
        ties=[F.col("valid_to").isNull(), F.col("valid_to")],
        hot_rows=hot_rows,
    )
    following = F.col("_next.valid_from")
    failure = (
        F.when(F.col("valid_to") <= F.col("valid_from"), "empty window")
        .when(F.col("valid_to").isNull() & F.col("_next").isNotNull(), "open but not last")
        .when(F.col("valid_to").isNotNull() & F.col("_next").isNull(), "last but closed")
        .when(F.col("valid_to") < following, "gap")
        .when(F.col("valid_to") > following, "overlap")
    )
    failing = seen.withColumn("failure", failure).where(F.col("failure").isNotNull())
    return failing.select(*keys, "valid_from", "valid_to", "failure")


def open_not_matching_dump(
    history: DataFrame, dump: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Living open versions against the latest dump, both ways and on the tracked columns."""
    keys, tracked = list(keys), list(tracked)
    alive = history.where(F.col("valid_to").isNull() & ~F.col("is_deleted"))
    stacked = (
        alive.select(*keys, F.struct(*tracked).alias("v"), F.lit(True).alias("h"))
        .unionByName(dump.select(*keys, F.struct(*tracked).alias("v"), F.lit(False).alias("h")))
        .groupBy(*keys)
        .agg(
            F.count_if("h").alias("open_rows"),
            F.count_if(~F.col("h")).alias("dump_rows"),
            F.max(F.when(F.col("h"), F.col("v"))).alias("a"),
            F.max(F.when(~F.col("h"), F.col("v"))).alias("b"),
        )
    )
    failure = (
        F.when(F.col("open_rows") == 0, "in dump, not open")
        .when(F.col("dump_rows") == 0, "open, not in dump")
        .when(F.col("open_rows") > 1, "several open versions")
        .when(F.col("dump_rows") > 1, "several dump rows")
        .when(~F.col("a").eqNullSafe(F.col("b")), "tracked columns differ")
    )
    return (
        stacked.withColumn("failure", failure)
        .where(F.col("failure").isNotNull())
        .select(*keys, "failure")
    )


def redundant_versions(
    history: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    hot_rows: int = timeline.HOT_ROWS,
) -> DataFrame:
    """Versions that repeat the version they directly follow, neither being a termination."""
    seen = timeline.with_previous(
        history, keys, "valid_from", ["valid_to", "is_deleted", *tracked], "_prev", hot_rows=hot_rows
    )
    same = F.struct(*tracked).eqNullSafe(F.struct(*[F.col(f"_prev.{c}") for c in tracked]))
    adjacent = F.col("_prev.valid_to") == F.col("valid_from")
    living = ~F.col("is_deleted") & ~F.col("_prev.is_deleted")
    return seen.where(adjacent & same & living).select(*keys, "valid_from", *tracked)


def attribution_differs(
    attributed: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    published: str,
    attribute: str,
    hot_rows: int = timeline.HOT_ROWS,
) -> DataFrame:
    """Facts whose published attribute is not that of the latest version not after them."""
    derived = temporal.asof_latest(
        attributed, versions, keys, at, {attribute: "_derived"}, hot_rows
    )
    differs = ~F.col(published).eqNullSafe(F.col("_derived"))
    return derived.where(differs).withColumnRenamed("_derived", "derived")


def default_though_covered(
    attributed: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    published: str,
    default: str,
    attribute: str,
) -> DataFrame:
    """Facts carrying the default although a version with a real value covers them."""
    suspects = attributed.where(F.col(published) == default)
    found = temporal.point_in_time_join(suspects, history, keys, at, {attribute: "_covering"})
    return found.where(F.col("_covering").isNotNull()).withColumnRenamed("_covering", "covering")


def current_differs(
    attributed: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    published: str,
    attribute: str,
    default: str,
) -> DataFrame:
    """Facts whose published current attribute is not the current dimension's (or the default)."""
    now = current.select(*keys, F.col(attribute).alias("_now"))
    joined = joins.attach(attributed, now, keys, "left")
    expected = F.coalesce(F.col("_now"), F.lit(default))
    differs = ~F.col(published).eqNullSafe(expected)
    return joined.where(differs).withColumn("expected", expected).drop("_now")
