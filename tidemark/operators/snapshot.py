"""Version history kept run by run from the current state of a relation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import HistoryStore

META = {
    "valid_from": "timestamp_ntz",
    "valid_to": "timestamp_ntz",
    "version_updated_at": "timestamp_ntz",
    "is_deleted": "boolean",
    "version_id": "string",
}
ALL = "all"


class NotOneRowPerKey(Exception):
    pass


class SuspiciousDrop(Exception):
    pass


@dataclass(frozen=True)
class SnapshotSpec:
    """What makes a new version and what an absent key means.

    ``timestamp``: the relation's ``updated_at`` advanced; windows are in source time.
    ``check``: one of ``check_columns`` changed; windows are in run time.
    ``hard_deletes`` other than ``ignore`` need a relation that is complete on every run,
    which must be stated as ``feed='full_dump'``. ``max_drop`` refuses a run in which more than
    that share of the keys vanished (a partial feed would end them all).
    """

    name: str
    keys: tuple[str, ...]
    strategy: str
    updated_at: str | None = None
    check_columns: tuple[str, ...] | str = ()
    hard_deletes: str = "ignore"
    feed: str = "state"
    max_drop: float = 1.0

    def __post_init__(self):
        if self.strategy not in ("timestamp", "check"):
            raise ValueError(f"unknown strategy {self.strategy!r}")
        if self.strategy == "timestamp" and not self.updated_at:
            raise ValueError("the timestamp strategy needs updated_at")
        if self.strategy == "check" and not self.check_columns:
            raise ValueError("the check strategy needs check_columns")
        if self.hard_deletes not in ("ignore", "invalidate", "new_record"):
            raise ValueError(f"unknown hard_deletes {self.hard_deletes!r}")
        if self.hard_deletes != "ignore" and self.feed != "full_dump":
            raise ValueError("absence means deletion only in a full dump")

    def compared(self, relation: T.StructType) -> list[str]:
        if self.check_columns == ALL:
            return [n for n in relation.names if n not in self.keys]
        return list(self.check_columns)

    def history_schema(self, relation: T.StructType) -> T.StructType:
        meta = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in META.items()))
        return T.StructType([*relation, *meta])


def version_id(keys: Sequence[str], valid_from: Column) -> Column:
    stamp = F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.concat_ws("~", *[F.col(k).cast("string") for k in keys], stamp), 256)


def assert_one_row_per_key(current: DataFrame, keys: Sequence[str]) -> None:
    """A relation with several rows for a key does not build history, it corrupts it."""
    if not current.groupBy(*keys).count().where(F.col("count") > 1).isEmpty():
        raise NotOneRowPerKey(f"several current rows share {list(keys)}")


def first_versions(current: DataFrame, spec: SnapshotSpec, run_ts: datetime | str) -> DataFrame:
    starts = _starts(spec, run_ts, F.col)
    rows = current.withColumns(
        {
            "valid_from": starts,
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "version_updated_at": starts,
            "is_deleted": F.lit(False),
        }
    )
    return rows.withColumns(
        {"version_id": version_id(spec.keys, F.col("valid_from")), "state": F.lit("open")}
    )


def merge_versions(
    open_versions: DataFrame, current: DataFrame, spec: SnapshotSpec, run_ts: datetime | str
) -> DataFrame:
    """Rows to store after a run: every open version, and those this run closed (``state``).

    Both sides have one row per key, so one full join on the key decides each key's fate and
    emits its one to two rows; closed history is not read.
    """
    relation = current.columns
    old, now = F.struct(*open_versions.columns), F.struct(*relation)
    both = open_versions.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(spec.keys)], old.alias("o")
    ).join(
        current.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(spec.keys)], now.alias("c")),
        [f"_k{i}" for i in range(len(spec.keys))],
        "full",
    )
    was, is_ = F.col("o").isNotNull(), F.col("c").isNotNull()
    if spec.strategy == "timestamp":
        # a missing moment has not advanced: the open version stays
        later = F.col(f"c.{spec.updated_at}").cast("timestamp_ntz") > F.col("o.version_updated_at")
        differs = F.coalesce(later, F.lit(False))
    else:
        names = spec.compared(current.schema)
        differs = ~F.struct(*[f"c.{n}" for n in names]).eqNullSafe(
            F.struct(*[f"o.{n}" for n in names])
        )
    changed = was & is_ & (F.col("o.is_deleted") | differs)
    gone = was & ~is_ & ~F.col("o.is_deleted") & F.lit(spec.hard_deletes != "ignore")
    clock = F.lit(str(run_ts)).cast("timestamp_ntz")
    starts = _starts(spec, run_ts, lambda n: F.col(f"c.{n}"))
    never = F.lit(None).cast("timestamp_ntz")

    def row(side, valid_from, valid_to, updated, deleted, state):
        return F.struct(
            *[F.col(f"{side}.{n}").alias(n) for n in relation],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            updated.alias("version_updated_at"),
            deleted.alias("is_deleted"),
            F.lit(state).alias("state"),
        )

    o_from, o_upd, o_del = (F.col(f"o.{n}") for n in ("valid_from", "version_updated_at", "is_deleted"))
    ended = F.when(gone, clock).otherwise(starts)
    rows = F.array(
        F.when(was & ~changed & ~gone, row("o", o_from, never, o_upd, o_del, "open")),
        F.when(changed | gone, row("o", o_from, ended, o_upd, o_del, "closed")),
        F.when(is_ & (~was | changed), row("c", starts, never, starts, F.lit(False), "open")),
        F.when(
            gone & F.lit(spec.hard_deletes == "new_record"),
            row("o", clock, never, clock, F.lit(True), "open"),
        ),
    )
    out = both.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")
    return out.withColumn("version_id", version_id(spec.keys, F.col("valid_from")))


def _starts(spec: SnapshotSpec, run_ts, column) -> Column:
    if spec.strategy == "timestamp":
        return column(spec.updated_at).cast("timestamp_ntz")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def run_snapshot(
    store: HistoryStore,
    spec: SnapshotSpec,
    current: DataFrame,
    run: int,
    run_ts: datetime | str,
) -> DataFrame:
    """One run: check the relation, merge, store, and return the history as of this run.

    A run that is already stored is not merged again, so delivering a batch twice is harmless.
    """
    schema = spec.history_schema(current.schema)
    done = store.runs(spec.name)
    if run in done:
        return store.read(spec.name, schema, run)
    assert_one_row_per_key(current, spec.keys)
    if not done:
        rows = first_versions(current, spec, run_ts)
    else:
        before = store.open_versions(spec.name, done[-1], schema)
        if spec.max_drop < 1.0:
            _refuse_mass_drop(before, current, spec)
        rows = merge_versions(before, current, spec, run_ts)
    store.write(spec.name, run, rows.select(*schema.names, "state"))
    return store.read(spec.name, schema, run)


def _refuse_mass_drop(before, current, spec):
    alive = before.where(~F.col("is_deleted")).select(*spec.keys)
    kept = alive.join(current.select(*spec.keys), list(spec.keys), "left_semi").count()
    had = alive.count()
    if had and (had - kept) / had > spec.max_drop:
        raise SuspiciousDrop(f"{had - kept} of {had} keys vanished in one run")


def history_view(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The typed interface to a history: real booleans, and ``is_current`` for living rows only."""
    return history.select(
        *columns,
        "valid_from",
        "valid_to",
        "is_deleted",
        (F.col("valid_to").isNull() & ~F.col("is_deleted")).alias("is_current"),
    )


def current_rows(history: DataFrame, condition: Column) -> DataFrame:
    """Open versions that meet a positive condition; the condition is on that version itself."""
    return history.where(F.col("valid_to").isNull() & ~F.col("is_deleted") & condition)


def hybrid_current(
    current: DataFrame, dump: DataFrame, keys: Sequence[str], overwritten: Sequence[str]
) -> DataFrame:
    """Versioned columns from the current versions, overwritten ones from today's dump."""
    versioned = current.drop(*overwritten)
    return versioned.join(dump.select(*keys, *overwritten), list(keys), "left")
