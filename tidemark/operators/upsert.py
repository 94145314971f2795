"""Incremental marts: windows derived from the target, upserts and replays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.arrivals import HighWater
from ..sources.store import MartStore, NotRebuildable
from .joins import keep_keys
from .shaping import without_keys


class SchemaChanged(Exception):
    pass


class DuplicateKeys(Exception):
    pass


@dataclass(frozen=True)
class Window:
    """The grain dates that a run recomputes: all from ``since`` on, and single earlier ones.

    Rows without a date belong to every window.
    """

    since: date
    reopened: frozenset[date] = frozenset()

    def holds(self, day: str) -> Column:
        """Whether a date, given by a column or expression in SQL, is in the window."""
        inside = f"{day} is null or {day} >= date'{self.since}'"
        listed = ", ".join(f"date'{d}'" for d in sorted(self.reopened))
        return F.expr(inside + (f" or {day} in ({listed})" if listed else ""))


def within(day: str, since: date | Window) -> Column:
    """Whether a date is in a window, which may be given by its first date alone."""
    return (since if isinstance(since, Window) else Window(since)).holds(day)


def align(new: DataFrame, target: T.StructType, on_schema_change: str) -> DataFrame:
    """``new`` in the shape the target should have after this run.

    fail: any difference raises. ignore: the target's columns only. append_new_columns: target
    columns plus new ones. sync_all_columns: exactly the new columns.
    """
    have, want = {f.name: f.dataType for f in new.schema}, {f.name: f.dataType for f in target}
    if on_schema_change == "fail":
        if have != want:
            raise SchemaChanged(f"target has {want}, run produced {have}")
        return new.select(*target.names)
    if on_schema_change not in ("ignore", "append_new_columns", "sync_all_columns"):
        raise ValueError(f"unknown on_schema_change {on_schema_change!r}")
    if on_schema_change == "sync_all_columns":
        return new
    kept = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target
    ]
    added = [n for n in new.columns if n not in want] if on_schema_change != "ignore" else []
    return new.select(*kept, *added)


def reshape_target(target: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows in the (already aligned) shape of ``new``; columns they lack are NULL."""
    return target.select(
        [
            (F.col(f.name) if f.name in target.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in new.schema
        ]
    )


def append(target: DataFrame, new: DataFrame) -> DataFrame:
    """Without a key: rows of a reopened day are simply there twice."""
    return reshape_target(target, new).unionByName(new)


def delete_insert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drops every target row whose key occurs in ``new``, then adds all of ``new``.

    ``keys`` coarser than the grain wipe whole groups of a recomputed key.
    """
    return append(without_keys(target, new, keys), new)


def merge(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates matched rows as a whole, inserts the others. ``new`` must be unique per key."""
    if not new.groupBy(*keys).count().where(F.col("count") > 1).isEmpty():
        raise DuplicateKeys(f"several new rows share {list(keys)}")
    return append(without_keys(target, new, keys), new)


def replace_window(target: DataFrame, new: DataFrame, grain: str, since: date | Window | None) -> DataFrame:
    """Target rows outside the window, then those of ``new`` in it: also removes groups that no
    longer exist. Rows without a grain date are in every window: those of the target go.
    """
    if since is None:
        return new
    inside = within(grain, since)
    return append(target.where(~inside), new.where(inside))


def touched_keys(new_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The groups that arriving rows belong to."""
    return new_rows.select(*keys).distinct()


def recompute_touched(
    target: DataFrame,
    arrivals: DataFrame,
    everything: DataFrame,
    keys: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Rebuilds only the groups touched by ``arrivals``, each from all of its rows so far.

    Groups that end up without rows leave the target.
    """
    touched = touched_keys(arrivals, keys)
    rebuilt = build(keep_keys(everything, touched, keys))
    return append(without_keys(target, touched, keys), rebuilt)


def lower_bound(newest: date | None, lookback_days: int) -> date | None:
    """First grain date to recompute, inclusive. None (an empty target) means everything.

    The anchor is the newest date in the *target*: whatever may still arrive for a date is at
    most ``lookback_days`` late, and every date after the anchor is new. Anchoring on today or
    on the source's newest date would skip dates when a run was missed.
    """
    return None if newest is None else newest - timedelta(days=lookback_days)


def is_incremental(store: MartStore, name: str, run: int, full_refresh: bool) -> bool:
    return not full_refresh and bool(store.ledger.runs(name, before_run=run))


def window_start(
    store: MartStore, name: str, grain: str, run: int, lookback_days: int, full_refresh: bool = False
) -> date | None:
    """The first grain date that run ``run`` recomputes; None if it builds everything.

    A run that is repeated finds the newest date it found when it first began.
    """
    if not is_incremental(store, name, run, full_refresh):
        return None
    begun = store.ledger.found(name, run)
    return lower_bound(begun.newest if begun else store.newest(name, grain), lookback_days)


def touched_dates(headers: DataFrame, arrivals: DataFrame, keys: Sequence[str], grain: str) -> DataFrame:
    """The dates of the headers that arriving child rows belong to, however old."""
    return headers.join(arrivals.select(*keys).distinct(), list(keys), "left_semi").select(grain).distinct()


def run_window(
    store: MartStore,
    name: str,
    grain: str,
    run: int,
    lookback_days: int = 0,
    full_refresh: bool = False,
    reopened: Callable[[date], DataFrame] | None = None,
) -> date | Window | None:
    """What run ``run`` recomputes: everything (None), all from a date on, or a ``Window``.

    ``reopened(since)`` gives the dates that late rows belong to; those before ``since`` are added.
    They are collected, as they are no more than the calendar has.
    """
    since = window_start(store, name, grain, run, lookback_days, full_refresh)
    if since is None or reopened is None:
        return since
    late = reopened(since).where(F.col(grain) < F.lit(since)).distinct().collect()
    return Window(since, frozenset(r[0] for r in late)) if late else since


def run_incremental(
    store: MartStore,
    name: str,
    build: Callable[[date | Window | None], DataFrame],
    grain: str,
    run: int,
    lookback_days: int = 0,
    full_refresh: bool = False,
    strategy: str = "replace_window",
    keys: Sequence[str] = (),
    on_schema_change: str = "fail",
    reopened: Callable[[date], DataFrame] | None = None,
    only: Callable[[], Window] | None = None,
) -> DataFrame:
    """One nightly run: derive the window, build it from full upstream, commit, read back.

    ``build(window)`` returns the mart's rows in the window and those without a date (all rows for
    None). The window is its first date, or a ``Window`` if ``reopened`` names earlier dates; ``only``
    gives it instead of the lookback.

    Only the periods that the window touches are written, rows without a date among them, so the
    mart equals a rebuild after every run. A run that is repeated finds the state it first found;
    one older than the newest can't be repeated.
    """
    store.ledger.refresh(name)
    later = [r.run for r in store.ledger.runs(name) if r.run > run]
    if later:
        raise NotRebuildable(f"{name!r} already holds run {later[-1]}; run {run} cannot be redone")
    if not is_incremental(store, name, run, full_refresh):
        store.write(name, run, build(None), grain)
        return store.read(name)
    window = only() if only else run_window(store, name, grain, run, lookback_days, full_refresh, reopened)
    asked, window = window, Window(window) if isinstance(window, date) else window
    new = align(build(asked), store.schema(name, before_run=run), on_schema_change)
    keyed = {"delete_insert": delete_insert, "merge": merge}.get(strategy)
    if keyed and grain not in keys:
        touched = None  # keys without the grain date reach rows of any date
    else:
        touched = window
    # The periods that the window touches are written again from their rows, which the run keeps
    # first. Rows without a date are all among the new ones.
    kept = store.read(name, before_run=run, window=touched).where(F.col(grain).isNotNull())
    if strategy == "replace_window" and window is not None:
        kept = kept.where(~within(grain, window))
    target = store.before(name, run, kept)
    if strategy == "replace_window":
        state = new if window is None else append(target, new)
    elif keyed:
        state = keyed(target, store.stage(name, run, new), keys)
    elif strategy == "append":
        state = append(target, new)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    store.write(name, run, state, grain, touched)
    return store.read(name)


def run_arrivals(
    store: MartStore,
    name: str,
    build: Callable[[Window | None], DataFrame],
    grain: str,
    run: int,
    marks: HighWater,
    arriving: Mapping[str, tuple[DataFrame, str]],
    dates: Callable[[Mapping[str, DataFrame]], DataFrame],
    full_refresh: bool = False,
) -> DataFrame:
    """One nightly run by load time: recomputes the grain dates of rows loaded since the last run.

    ``arriving`` maps a feed to its rows and the column that says when they were loaded;
    ``dates(arrivals)`` gives the grain dates that the arrivals of each feed belong to, old dates of
    restated headers included. There is no lookback: a row may be as late as it likes. Marks move
    once the mart is stored, so a run that was cut off takes its arrivals again.
    """
    taken = {feed: marks.take(feed, rows, loaded_at, run) for feed, (rows, loaded_at) in arriving.items()}

    def touched() -> Window:
        found = dates({feed: t.arrivals for feed, t in taken.items()}).where(F.col(grain).isNotNull())
        return Window(date.max, frozenset(r[0] for r in found.select(grain).distinct().collect()))

    state = run_incremental(store, name, build, grain, run, full_refresh=full_refresh, only=touched)
    for t in taken.values():
        marks.finish(t, run)
    return state


def replay(batches: Iterable[int], one_run: Callable[[int], DataFrame]) -> DataFrame:
    """Runs the batches in order (the first builds, the others add) and returns the last state."""
    state = None
    for batch in batches:
        state = one_run(batch)
    if state is None:
        raise ValueError("nothing to replay")
    return state
