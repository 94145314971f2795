"""Point-in-time joins and histories derived in one pass from logs or dumps.

A version holds on the half-open window ``[valid_from, valid_to)``; NULL means still open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import joins, timeline

# Versions of one key up to which searching all of them for each fact is cheap.
FEW_VERSIONS = 64


def point_in_time_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    defaults: Mapping[str, str] | None = None,
    few_versions: int = FEW_VERSIONS,
    hot_rows: int = joins.HOT_ROWS,
) -> DataFrame:
    """Adds the attributes in effect at ``at``: ``take`` maps history columns to new names.

    Every fact stays exactly once: it meets the version that started last by then (of versions with one
    start, the one with the greatest end and values), and takes its attributes if it still holds; else it gets
    NULLs, or ``defaults``. Overlapping windows therefore repeat no fact, whatever the plan.
    ``keys`` is required: an interval alone would compare everything with everything.

    Keys with up to ``few_versions`` versions are folded to one row per key, an array that is searched
    inside the joined fact: no fan-out, and no shuffle of the facts while the folded history is small enough
    to be broadcast. Past that the last version is carried forward along the timeline, which stays linear.
    """
    if not keys:
        raise ValueError("a point-in-time join needs an equality key")
    keys = list(keys)
    versions = history.select(*keys, "valid_from", "valid_to", *take)
    most = versions.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if most <= few_versions:
        joined = _folded_join(facts, versions, keys, at, hot_rows)
    else:
        joined = timeline.as_of(
            facts, versions, keys, at, "valid_from", ["valid_to", *take], "_v", hot_rows
        )
    open_at = F.col("_v.valid_to").isNull() | (F.col(at) < F.col("_v.valid_to"))
    found = {new: F.when(open_at, F.col(f"_v.{old}")) for old, new in take.items()}
    for new, default in (defaults or {}).items():
        found[new] = F.coalesce(found[new], F.lit(default))
    return joined.select(*facts.columns, *[c.alias(new) for new, c in found.items()])


def _folded_join(facts, versions, keys, at, hot_rows):
    """Facts with ``_v``, their key's last version by then: one history row per key, none repeated."""
    payload = F.struct("valid_from", *[c for c in versions.columns if c not in (*keys, "valid_from")])
    folded = versions.where("valid_from is not null").groupBy(*keys).agg(F.collect_list(payload).alias("_versions"))
    joined = joins.attach(facts, folded, keys, "left", hot_rows)
    started = F.filter("_versions", lambda v: v["valid_from"] <= F.col(at))
    return joined.withColumn("_v", F.array_max(started)).drop("_versions")


def asof_latest(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    hot_rows: int = timeline.HOT_ROWS,
) -> DataFrame:
    """The version with the greatest ``valid_from`` not after ``at``; never reads ``valid_to``.

    An independent route to the point-in-time answer. Facts before any version get NULLs.
    """
    carried = timeline.as_of(facts, versions, keys, at, "valid_from", list(take), "_v", hot_rows)
    return carried.select(
        *facts.columns, *[F.col(f"_v.{old}").alias(new) for old, new in take.items()]
    )


def scd2_from_log(
    log: DataFrame, keys: Sequence[str], ts: str, hot_rows: int = timeline.HOT_ROWS
) -> DataFrame:
    """History straight from a complete version log: each row holds until the key's next row.

    Rows of one key and moment are ordered by their other columns, so that a task run again
    closes the same ones.
    """
    others = [c for c in log.columns if c not in (*keys, ts)]
    ties = [F.xxhash64(*others)] if others else []
    following = timeline.with_next(log, keys, ts, [ts], "_next", ties, hot_rows)
    return following.withColumns(
        {"valid_from": F.col(ts), "valid_to": F.col(f"_next.{ts}")}
    ).drop("_next", ts)


def scd2_from_dumps(
    dumps: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    batch: str,
    runs: Sequence[tuple[int, datetime]],
    hard_deletes: str = "new_record",
) -> DataFrame:
    """The history that nightly change detection would build, in one pass over all dumps.

    ``runs`` lists (batch, run moment) in order. ``dumps`` has one row per key and batch, so a
    key's timeline is no longer than the list of runs. A version starts where a key appears,
    reappears after an absence, or changes a tracked column; other columns are kept as they
    stood then. Absence closes the version and, for ``new_record``, adds a flagged one.
    """
    if hard_deletes not in ("ignore", "invalidate", "new_record"):
        raise ValueError(f"unknown hard_deletes {hard_deletes!r}")
    keys, payload = list(keys), [c for c in dumps.columns if c not in (*keys, batch)]
    moments = [r for _, r in runs] + [None]
    befores = [None] + [b for b, _ in runs]
    calendar = dumps.sparkSession.createDataFrame(
        [
            (b, befores[i], str(r), str(moments[i + 1]) if moments[i + 1] else None)
            for i, (b, r) in enumerate(runs)
        ],
        f"{batch} int, _before int, _now string, _then string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("_now", "_then")})
    # The calendar has one row per run and is built from a list: a size known beforehand.
    unlisted = F.raise_error(F.concat(F.lit("dump batch without a run: "), F.coalesce(F.col(batch).cast("string"), F.lit("missing"))))
    dated = dumps.join(F.broadcast(calendar), batch, "left").withColumn(
        "_now", F.coalesce("_now", unlisted.cast("timestamp_ntz"))
    )
    along = Window.partitionBy(*keys).orderBy(batch)
    seen = dated.withColumns(
        {
            "_prev_batch": F.lag(batch).over(along),
            "_prev": F.lag(F.struct(*tracked)).over(along),
            "_next_before": F.lead("_before").over(along),
            "_has_next": F.lead(batch).over(along).isNotNull(),
        }
    )
    same = F.struct(*tracked).eqNullSafe(F.col("_prev"))
    stayed = F.col("_prev_batch").eqNullSafe(F.col("_before"))
    if hard_deletes == "ignore":
        starts = F.col("_prev_batch").isNull() | ~same
        leaves = F.lit(False)
    else:
        starts = F.col("_prev_batch").isNull() | ~stayed | ~same
        comes_back_at_once = F.col("_has_next") & F.col("_next_before").eqNullSafe(F.col(batch))
        leaves = F.col("_then").isNotNull() & ~comes_back_at_once
    marks = F.array(
        F.when(starts, F.struct(F.col("_now").alias("valid_from"), F.lit(False).alias("gone"))),
        F.when(leaves, F.struct(F.col("_then").alias("valid_from"), F.lit(True).alias("gone"))),
    )
    events = seen.select(
        *keys, *payload, F.explode(F.filter(marks, lambda m: m.isNotNull())).alias("_m")
    ).select(*keys, *payload, "_m.*")
    if hard_deletes != "ignore":
        # A flagged version repeats the last *recorded* version, not the last dump.
        events = _carry_recorded(events, keys, payload)
    closed = events.withColumn(
        "valid_to", F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    )
    if hard_deletes == "invalidate":
        closed = closed.where(~F.col("gone"))
    flag = F.col("gone") if hard_deletes == "new_record" else F.lit(False)
    return closed.select(*keys, *payload, "valid_from", "valid_to", flag.alias("is_deleted"))


def _carry_recorded(events, keys, payload):
    recorded = F.last(F.when(~F.col("gone"), F.struct(*payload)), ignorenulls=True).over(
        Window.partitionBy(*keys)
        .orderBy("valid_from")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return events.withColumn("_r", recorded).select(*keys, "_r.*", "valid_from", "gone")
