import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import upsert
from tidemark.operators.reconcile import table_diff
from tidemark.plans import marts
from tidemark.sources.store import MartStore, NotRebuildable

DAY = dt.date(2025, 3, 1)
MART = "day date, city string, n int"


def day(n):
    return str(DAY + dt.timedelta(days=n))


@pytest.fixture
def store(spark, tmp_path):
    return MartStore(spark, str(tmp_path / "marts"))


def counts(feed):
    """A small mart: live rows per (day, city)."""

    def build(since):
        rows = feed.where(F.col("status") != "CANCELLED")
        if since is not None:
            rows = rows.where(upsert.within("day", since))
        return rows.groupBy("day", "city").agg(F.count("*").cast("int").alias("n"))

    return build


def test_bound_is_inclusive_and_empty_targets_have_none():
    assert upsert.lower_bound(dt.date(2025, 3, 9), 0) == dt.date(2025, 3, 9)
    assert upsert.lower_bound(dt.date(2025, 3, 9), 4) == dt.date(2025, 3, 5)
    assert upsert.lower_bound(None, 4) is None


def test_gate_needs_a_stored_target_and_no_full_refresh(store, rows):
    assert not upsert.is_incremental(store, "m", 1, False)
    store.write("m", 1, rows(MART, (day(0), "a", 1)), "day")
    assert upsert.is_incremental(store, "m", 2, False)
    assert not upsert.is_incremental(store, "m", 2, True)
    assert not upsert.is_incremental(store, "m", 1, False)  # nothing before its own run


def test_upserts_differ_on_a_vanished_group(rows, bag):
    target = rows(MART, (day(0), "a", 1), (day(1), "a", 2), (day(1), "b", 3))
    new = rows(MART, (day(1), "a", 9), (day(2), "a", 1))
    keyed = [(day(0), "a", 1), (day(1), "a", 9), (day(1), "b", 3), (day(2), "a", 1)]
    assert bag(upsert.delete_insert(target, new, ["day", "city"])) == keyed
    assert bag(upsert.merge(target, new, ["day", "city"])) == keyed
    without_b = [row for row in keyed if row[1] != "b"]
    assert bag(upsert.delete_insert(target, new, ["day"])) == without_b
    assert bag(upsert.replace_window(target, new, "day", DAY + dt.timedelta(days=1))) == without_b
    assert upsert.append(target, new).count() == 5


def test_merge_refuses_repeated_keys(rows):
    new = rows(MART, (day(1), "a", 9), (day(1), "a", 8))
    with pytest.raises(upsert.DuplicateKeys):
        upsert.merge(new, new, ["day", "city"])


def test_schema_change_policies(rows):
    target = rows("a int, b string", (1, "x"))
    new = rows("a int, c string", (2, "y"))
    with pytest.raises(upsert.SchemaChanged):
        upsert.align(new, target.schema, "fail")
    assert upsert.align(new, target.schema, "ignore").columns == ["a", "b"]
    assert upsert.align(new, target.schema, "append_new_columns").columns == ["a", "b", "c"]
    assert upsert.align(new, target.schema, "sync_all_columns").columns == ["a", "c"]
    grown = upsert.append(target, upsert.align(new, target.schema, "append_new_columns"))
    assert sorted(map(tuple, grown.collect())) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError):
        upsert.align(new, target.schema, "whatever")


def test_type_change_fails_as_well(rows):
    with pytest.raises(upsert.SchemaChanged):
        upsert.align(rows("a bigint", (1,)), rows("a int", (1,)).schema, "fail")


def test_all_cancelled_restatement_leaves_no_orphan(store, rows, bag):
    schema = "day date, city string, status string"
    first = rows(schema, (day(0), "a", "OK"), (day(1), "b", "OK"), (day(1), "c", "OK"))
    upsert.run_incremental(store, "m", counts(first), "day", 1)
    second = rows(schema, (day(0), "a", "OK"), (day(1), "b", "CANCELLED"), (day(1), "c", "OK"))
    state = upsert.run_incremental(store, "m", counts(second), "day", 2)
    assert bag(state) == [(day(0), "a", 1), (day(1), "c", 1)]


def test_two_loads_on_one_day_need_the_whole_sla_as_lookback(spark, rows, tmp_path):
    """The first load already holds today, so a row four days late lies four days back."""
    schema = "day date, city string, status string"
    first = [(day(d), "a", "OK") for d in range(5)]
    late = [*first, (day(0), "a", "OK")]
    for lookback, right in ((4, True), (3, False)):
        store = MartStore(spark, str(tmp_path / str(lookback)))
        upsert.run_incremental(store, "m", counts(rows(schema, *first)), "day", 1, lookback)
        build = counts(rows(schema, *late))
        state = upsert.run_incremental(store, "m", build, "day", 2, lookback)
        assert table_diff(state, build(None)).isEmpty() is right


def test_a_repeated_run_changes_nothing(store, rows, bag):
    schema = "day date, city string, status string"
    one = rows(schema, (day(0), "a", "OK"), (day(3), "a", "OK"))
    two = rows(schema, (day(0), "a", "OK"), (day(3), "a", "OK"), (day(3), "b", "OK"), (day(9), "a", "OK"))
    upsert.run_incremental(store, "m", counts(one), "day", 1, 2)
    once = bag(upsert.run_incremental(store, "m", counts(two), "day", 2, 2))
    again = bag(upsert.run_incremental(store, "m", counts(two), "day", 2, 2))
    assert once == again == bag(counts(two)(None))


def test_a_rebuild_at_the_same_batch_wins(store, rows, bag):
    schema = "day date, city string, status string"
    one = rows(schema, (day(0), "a", "OK"), (day(3), "a", "OK"))
    upsert.run_incremental(store, "m", counts(one), "day", 1)
    upsert.run_incremental(store, "m", counts(one), "day", 2)
    fixed = rows(schema, (day(0), "b", "OK"), (day(3), "a", "OK"))
    state = upsert.run_incremental(store, "m", counts(fixed), "day", 2, full_refresh=True)
    assert bag(state) == bag(counts(fixed)(None))
    late = rows(schema, (day(0), "b", "OK"), (day(3), "a", "OK"), (day(4), "a", "OK"))
    state = upsert.run_incremental(store, "m", counts(late), "day", 3)
    assert bag(state) == bag(counts(late)(None))


def test_incremental_runs_write_only_the_periods_of_their_window(spark, rows, tmp_path):
    store = MartStore(spark, str(tmp_path / "marts"), "day")
    schema = "day date, city string, status string"
    feed = rows(schema, *[(day(d), "a", "OK") for d in range(9)])
    upsert.run_incremental(store, "m", counts(feed), "day", 1)
    before = store.partitions("m", "day")
    upsert.run_incremental(store, "m", counts(feed), "day", 2, 2)
    after = store.partitions("m", "day")
    assert [d for d in before if after[d] != before[d]] == [day(6), day(7), day(8)]


@pytest.mark.parametrize("strategy", ["delete_insert", "merge", "append"])
def test_keyed_runs_also_write_only_their_window(store, rows, bag, strategy):
    schema = "day date, city string, status string"
    first = rows(schema, *[(day(d), c, "OK") for d in range(4) for c in "ab"])
    upsert.run_incremental(store, "m", counts(first), "day", 1)
    second = rows(schema, *[(day(d), "a", "OK") for d in (0, 2, 3, 3, 4)])
    settings = dict(strategy=strategy, keys=["day", "city"])
    state = upsert.run_incremental(store, "m", counts(second), "day", 2, 1, **settings)
    new = counts(second)(DAY + dt.timedelta(days=2))
    old = counts(first)(None)
    want = {
        "delete_insert": lambda: upsert.delete_insert(old, new, ["day", "city"]),
        "merge": lambda: upsert.merge(old, new, ["day", "city"]),
        "append": lambda: upsert.append(old, new),
    }[strategy]()
    assert bag(state) == bag(want)


def test_keys_without_the_grain_write_the_table_whole(store, rows, bag):
    schema = "day date, city string, status string"
    first = rows(schema, (day(0), "a", "OK"), (day(5), "b", "OK"))
    upsert.run_incremental(store, "m", counts(first), "day", 1)
    second = rows(schema, (day(5), "a", "OK"), (day(5), "b", "OK"))
    settings = dict(strategy="delete_insert", keys=["city"])
    state = upsert.run_incremental(store, "m", counts(second), "day", 2, **settings)
    assert bag(state) == [(day(5), "a", 1), (day(5), "b", 1)]


def test_unfinished_runs_do_not_count(store, rows, bag, monkeypatch):
    """A run that is cut off after its rows were written is not done, and writes them again."""
    schema = "day date, city string, status string"
    one = rows(schema, (day(0), "a", "OK"), (day(1), "a", "OK"), (day(1), "b", "OK"))
    two = rows(schema, (day(0), "a", "OK"), (day(1), "b", "OK"), (day(40), "a", "OK"))
    upsert.run_incremental(store, "m", counts(one), "day", 1)
    note = store.ledger.note

    def cut_off(name, state, *rest, **more):
        if state == "done":
            raise KeyboardInterrupt
        note(name, state, *rest, **more)

    monkeypatch.setattr(store.ledger, "note", cut_off)
    with pytest.raises(KeyboardInterrupt):
        upsert.run_incremental(store, "m", counts(two), "day", 2)
    monkeypatch.setattr(store.ledger, "note", note)
    assert [r.run for r in store.ledger.runs("m")] == [1]
    # the newest date stored is now day 40, but the run found day 1 when it began
    state = upsert.run_incremental(store, "m", counts(two), "day", 2)
    assert bag(state) == bag(counts(two)(None))


def test_whole_tables_keep_earlier_runs(store, rows, bag):
    for run in (1, 2, 3):
        store.write("m", run, rows(MART, (day(0), "a", run)))
    assert bag(store.read("m")) == [(day(0), "a", 3)]
    assert bag(store.read("m", before_run=3)) == [(day(0), "a", 2)]


def test_an_older_run_is_refused(store, rows):
    feed = rows("day date, city string, status string", (day(0), "a", "OK"))
    for run in (1, 2):
        upsert.run_incremental(store, "m", counts(feed), "day", run)
    with pytest.raises(NotRebuildable):
        upsert.run_incremental(store, "m", counts(feed), "day", 1)


@pytest.mark.parametrize("strategy", ["replace_window", "delete_insert", "merge", "append"])
def test_every_strategy_can_repeat_its_run(store, rows, bag, strategy):
    schema = "day date, city string, status string"
    first = rows(schema, *[(day(d), c, "OK") for d in range(4) for c in "ab"], (None, "a", "OK"))
    upsert.run_incremental(store, "m", counts(first), "day", 1)
    second = rows(schema, *[(day(d), "a", "OK") for d in (0, 2, 3, 3, 4)], (None, "b", "OK"))
    settings = dict(strategy=strategy, keys=["day", "city"])
    once = bag(upsert.run_incremental(store, "m", counts(second), "day", 2, 1, **settings))
    assert bag(upsert.run_incremental(store, "m", counts(second), "day", 2, 1, **settings)) == once
    assert [r for r in once if r[0] is None] == [(None, "b", 1)]


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_undated_and_vanished_rows_equal_a_rebuild(spark, rows, bag, tmp_path, period):
    """Two loads bring undated rows 1 and 2, then none; a day and a whole period vanish."""
    store = MartStore(spark, str(tmp_path / "marts"), period)
    schema = "day date, city string, status string"
    loads = [
        [(None, "a", "OK"), (day(0), "a", "OK"), (day(31), "a", "OK"), (day(400), "a", "OK")],
        [(None, "a", "OK"), (None, "b", "OK"), (day(0), "a", "OK"), (day(31), "a", "OK"), (day(401), "c", "OK")],
        [(day(0), "a", "OK"), (day(31), "a", "OK")],
        [(None, "c", "OK"), (day(0), "a", "OK"), (day(31), "b", "OK")],
    ]
    for run, data in enumerate(loads, 1):
        build = counts(rows(schema, *data))
        state = upsert.run_incremental(store, "m", build, "day", run, 1)
        assert bag(state) == bag(build(None)), run


def test_windowed_reads_open_window_periods_only(spark, tmp_path, capsys):
    store = MartStore(spark, str(tmp_path / "marts"))
    days = spark.range(1000).selectExpr("date_add(date'2015-01-01', int(id)) as day", "id as n")
    store.write("m", 1, days, "day")
    assert len(store.partitions("m", "day")) == 33
    assert store.newest("m", "day") == dt.date(2017, 9, 26)
    window = upsert.Window(dt.date(2017, 9, 3), frozenset({dt.date(2015, 4, 2)}))
    rows = store.read("m", window=window)
    assert len(rows.inputFiles()) == 33  # of the listing; the plan prunes them
    rows.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "_period" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert rows.count() == 26 + 30


def test_columns_that_older_periods_lack_are_null(store, rows, bag):
    store.write("m", 1, rows(MART, (day(0), "a", 1), (day(40), "a", 1)), "day")
    wide = rows(MART + ", more string", (day(40), "a", 2, "x"))
    state = upsert.run_incremental(store, "m", lambda _: wide, "day", 2, on_schema_change="append_new_columns")
    assert bag(state) == [(day(0), "a", 1, None), (day(40), "a", 2, "x")]


def test_reading_an_unknown_mart_fails(store):
    with pytest.raises(FileNotFoundError):
        store.read("nothing")


def test_touched_groups_are_rebuilt_from_everything(rows, bag):
    schema = "day date, city string, status string"
    before = rows(schema, (day(0), "a", "OK"), (day(0), "b", "OK"), (day(1), "a", "OK"))
    arrivals = rows(schema, (day(0), "a", "OK"), (day(5), "c", "CANCELLED"))
    everything = before.unionByName(arrivals)
    state = upsert.recompute_touched(
        counts(before)(None), arrivals, everything, ["day", "city"], lambda r: counts(r)(None)
    )
    assert table_diff(state, counts(everything)(None)).isEmpty()


deliveries = st.lists(
    st.tuples(
        st.integers(0, 12), st.integers(0, 4), st.sampled_from("ab"),
        st.sampled_from(["COMPLETED", "RETURNED", "CANCELLED"]),
    ),
    min_size=1, max_size=25,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feed=deliveries, cuts=st.lists(st.integers(0, 16), min_size=1, max_size=3))
def test_replay_equals_rebuild_for_any_load_schedule(spark, rows, tmp_path_factory, feed, cuts):
    """Deliveries zero to four days late, loads at any days: equal to a rebuild after every run."""
    schema = (
        "delivery_id string, city_code string, delivery_date date, status string, "
        "payout_base_usd decimal(10,2), loaded int"
    )
    data = [(str(i), c, day(d), s, "1.50", d + late) for i, (d, late, c, s) in enumerate(feed)]
    lines = [(str(i % 7), "0.25" if i % 2 else "-0.50") for i in range(20)]
    adjustments = rows("delivery_id string, adj_amount_usd decimal(10,2)", *lines)
    every = rows(schema, *data)
    store = MartStore(spark, str(tmp_path_factory.mktemp("marts")))
    for run, cut in enumerate(sorted(cuts), 1):
        seen = every.where(F.col("loaded") <= cut)
        build = lambda since: marts.daily_payouts(seen, adjustments, since)  # noqa: B023, E731
        state = upsert.run_incremental(store, "m", build, "delivery_date", run, 4)
        assert table_diff(state, build(None)).isEmpty()


def test_newest_date_is_that_of_the_newest_period_with_rows(store, rows):
    store.write("m", 1, rows(MART, (day(0), "a", 1), (day(5), "a", 1), (None, "a", 1)), "day")
    assert str(store.newest("m", "day")) == day(5)
    store.write("m", 2, rows(MART, (day(40), "a", 1)), "day", upsert.Window(DAY + dt.timedelta(days=35)))
    assert str(store.newest("m", "day")) == day(40)
    # the window is withdrawn: what remains ends before it
    store.write("m", 3, rows(MART), "day", upsert.Window(DAY + dt.timedelta(days=35)))
    assert str(store.newest("m", "day")) == day(5)


header = st.tuples(st.integers(0, 60), st.integers(0, 4), st.sampled_from("ab"))
child = st.tuples(st.integers(0, 9), st.integers(0, 80), st.integers(1, 9))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(headers=st.lists(header, min_size=1, max_size=10), children=st.lists(child, max_size=15))
def test_late_child_rows_reopen_their_dates(spark, rows, tmp_path_factory, headers, children):
    """Headers up to four days late, children at any time: equal to a rebuild after every load."""
    every = rows(
        "delivery_id string, city_code string, delivery_date date, status string, payout_base_usd decimal(10,2), loaded int",
        *[(str(i), c, day(d), "COMPLETED", "1.50", (d + late) // 20) for i, (d, late, c) in enumerate(headers)],
    )
    lines = rows(
        "delivery_id string, adj_amount_usd decimal(10,2), loaded int",
        *[(str(i), f"{n}.25", at // 20) for i, at, n in children], ("none", "1.00", 0),
    )
    store = MartStore(spark, str(tmp_path_factory.mktemp("marts")))
    for run in range(5):
        seen, known = every.where(F.col("loaded") <= run), lines.where(F.col("loaded") <= run)
        arrived = lines.where(F.col("loaded") == run)
        build = lambda window: marts.daily_payouts(seen, known, window)  # noqa: B023, E731
        late = lambda _: upsert.touched_dates(seen, arrived, ["delivery_id"], "delivery_date")  # noqa: B023, E731
        state = upsert.run_incremental(store, "m", build, "delivery_date", run, 4, reopened=late)
        assert table_diff(state, build(None)).isEmpty(), run
