import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import joins, snapshot, temporal, timeline
from tidemark.sources.store import HistoryStore

START = dt.datetime(2025, 1, 1)
SLOW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def at(hour):
    return str(START + dt.timedelta(hours=hour))


HISTORY = "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, tier string"
FACTS = "id int, k string, ts timestamp_ntz"


@pytest.fixture
def history(rows):
    return rows(
        HISTORY,
        ("a", at(10), at(20), "one"),
        ("a", at(20), at(30), "two"),
        ("a", at(40), None, "four"),
        ("b", at(0), None, "b"),
    )


@pytest.fixture
def facts(rows):
    hours = {1: 9, 2: 10, 3: 19, 4: 20, 5: 29, 6: 30, 7: 35, 8: 40, 9: 1000}
    return rows(
        FACTS, *[(i, "a", at(h)) for i, h in hours.items()], (10, "z", at(5)), (11, None, at(5))
    )


WANT = [
    (1, "?"), (2, "one"), (3, "one"), (4, "two"), (5, "two"), (6, "?"), (7, "?"), (8, "four"),
    (9, "four"), (10, "?"), (11, "?"),
]


@pytest.mark.parametrize("few, hot", [(64, 1000), (64, 2), (0, 1000), (0, 2)])
def test_point_in_time_on_boundaries_gaps_and_unknown_keys(history, facts, bag, few, hot):
    got = temporal.point_in_time_join(
        facts, history, ["k"], "ts", {"tier": "tier_then"}, {"tier_then": "?"}, few, hot
    )
    assert sorted(bag(got, "id", "tier_then")) == WANT


def test_point_in_time_needs_a_key(history, facts):
    with pytest.raises(ValueError):
        temporal.point_in_time_join(facts, history, [], "ts", {"tier": "t"})


def test_point_in_time_plan_has_no_nested_loop(history, facts, capsys):
    for few in (64, 0):
        temporal.point_in_time_join(facts, history, ["k"], "ts", {"tier": "t"}, None, few).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_reads_no_ends(history, facts, bag):
    got = temporal.asof_latest(facts, history.drop("valid_to"), ["k"], "ts", {"tier": "t"})
    assert dict(bag(got, "id", "t"))[7] == "two"  # the gap is invisible without the ends


@pytest.fixture(autouse=True)
def fine_cuts(monkeypatch):
    """A few rows already make several stretches."""
    monkeypatch.setattr(timeline, "LEAST_ROWS", 4)


timelines = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(0, 200)), min_size=1, max_size=40, unique=True
)


@SLOW
@given(moments=timelines, hot=st.integers(1, 5))
def test_neighbours_agree_with_brute_force(spark, rows, bag, moments, hot):
    df = rows("k string, ts timestamp_ntz, h int", *[(k, at(h), h) for k, h in moments])
    per_key = {k: sorted(h for x, h in moments if x == k) for k in "ab"}

    def beside(k, h, step):
        place = per_key[k].index(h) + step
        return per_key[k][place] if 0 <= place < len(per_key[k]) else None

    for step, fn in ((1, timeline.with_next), (-1, timeline.with_previous)):
        got = fn(df, ["k"], "ts", ["h"], "n", hot_rows=hot)
        want = [(k, h, beside(k, h, step)) for k, h in moments]
        assert sorted(bag(got, "k", "h", "n.h"), key=str) == sorted(want, key=str)
    got = timeline.with_earlier_max(df, ["k"], "ts", F.col("h") % 7, "m", hot_rows=hot)
    want = [
        (k, h, max((e % 7 for e in per_key[k] if e < h), default=None)) for k, h in moments
    ]
    assert sorted(bag(got, "k", "h", "m"), key=str) == sorted(want, key=str)


@SLOW
@given(
    versions=timelines,
    moments=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 200)), max_size=30),
    hot=st.integers(1, 6),
)
def test_point_in_time_equals_asof_equals_brute_force(spark, rows, bag, versions, moments, hot):
    log = rows("k string, ts timestamp_ntz, h int", *[(k, at(h), h) for k, h in versions])
    history = temporal.scd2_from_log(log, ["k"], "ts", hot_rows=hot)
    facts = rows(FACTS, *[(i, k, at(h)) for i, (k, h) in enumerate(moments)], (99, "c", at(0)))
    latest = lambda k, h: max((v for x, v in versions if x == k and v <= h), default=None)
    want = sorted([(i, latest(k, h)) for i, (k, h) in enumerate(moments)] + [(99, None)], key=str)
    for few in (64, 0):
        got = temporal.point_in_time_join(
            facts, history, ["k"], "ts", {"h": "v"}, few_versions=few, hot_rows=hot
        )
        assert sorted(bag(got, "id", "v"), key=str) == want
    versions_only = history.drop("valid_to")
    got = temporal.asof_latest(facts, versions_only, ["k"], "ts", {"h": "v"}, hot_rows=hot)
    assert sorted(bag(got, "id", "v"), key=str) == want


def test_moments_outside_the_sampled_range_are_kept(spark, monkeypatch):
    """A tiny sample sees part of the range only; rows before and after it still count."""
    monkeypatch.setattr(joins, "SAMPLE_HITS", 50)
    log = spark.range(4000).select(
        F.lit("a").alias("k"),
        F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, id)").alias("ts"),
        "id",
    )
    assert timeline.stretches_for(log, ["k"], 500) is not None
    got = timeline.with_next(log, ["k"], "ts", ["id"], "n", hot_rows=500)
    wrong = got.where(~F.col("n.id").eqNullSafe(F.when(F.col("id") < 3999, F.col("id") + 1)))
    assert got.count() == 4000 and wrong.isEmpty()


def test_stretches_keep_clock_order_over_a_day_change(rows):
    df = rows("k string, ts timestamp_ntz", *[("a", at(h)) for h in range(60)])
    cuts = timeline.stretches_for(df, ["k"], 4)
    found = timeline._cut(df, ["k"], [F.col("ts")], cuts).orderBy("ts").collect()
    order = [r[timeline.STRETCH] for r in found]
    assert order == sorted(order) and len(set(order)) >= 15
    assert timeline.stretches_for(df, ["k"], 60) is None


def test_a_burst_is_cut_as_fine_as_even_rows(spark):
    """98 % of a key's rows in one minute, half of these at one moment: no stretch gets them all."""
    moment = """timestamp_ntz'2025-01-01 00:00:00' + case when id % 50 = 0 then make_dt_interval(id)
        when id % 2 = 0 then make_dt_interval(5000) else make_dt_interval(5000, 0, 0, id % 60) end"""
    log = spark.range(20_000).select(F.lit("a").alias("k"), F.expr(moment).alias("ts"), "id")
    order = [F.col("ts"), F.col("id")]
    cuts = timeline.stretches_for(log, ["k"], 1000)
    sizes = timeline._cut(log, ["k"], order, cuts).groupBy(timeline.STRETCH).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2000
    both = [
        timeline.with_next(log, ["k"], "ts", ["id"], "n", [F.col("id")], limit) for limit in (1000, 10**6)
    ]
    assert both[0].exceptAll(both[1]).isEmpty() and both[0].count() == 20_000


dumps = st.lists(
    st.dictionaries(st.sampled_from("abc"), st.tuples(st.sampled_from("XY"), st.integers(0, 9)),
                    max_size=3),
    min_size=2, max_size=5,
)


@SLOW
@given(dumps=dumps, mode=st.sampled_from(["new_record", "invalidate", "ignore"]))
def test_history_from_dumps_equals_run_by_run_snapshots(
    spark, rows, bag, tmp_path_factory, dumps, mode
):
    schema = "k string, dep string, login int, b int"
    data = [(k, d, n, i) for i, dump in enumerate(dumps, 1) for k, (d, n) in dump.items()]
    every = rows(schema, *data, ("zz", "Z", 0, 1))
    runs = [(i, START + dt.timedelta(days=i)) for i in range(1, len(dumps) + 1)]
    spec = snapshot.SnapshotSpec(
        "s", ("k",), "check", check_columns=("dep",), hard_deletes=mode, feed="full_dump"
    )
    store = HistoryStore(spark, str(tmp_path_factory.mktemp("history")))
    for run, moment in runs:
        history = snapshot.run_snapshot(store, spec, every.where(F.col("b") == run).drop("b"), run, moment)
    columns = ["k", "dep", "login", "valid_from", "valid_to", "is_deleted"]
    set_based = temporal.scd2_from_dumps(every, ["k"], ["dep"], "b", runs, mode)
    assert bag(history, *columns) == bag(set_based, *columns)


@pytest.mark.parametrize("count", [1, 2, 64, 400])
def test_overlapping_windows_repeat_no_fact_on_either_plan(spark, rows, bag, count):
    """Versions that overlap, nest, end before they are reached, and start together."""
    rng = random.Random(count)
    moments = [dt.datetime(2025, 1, 1) + dt.timedelta(hours=h) for h in range(300)]
    versions = [("k", rng.choice(moments), rng.choice([None, *moments]), f"v{n}") for n in range(count)]
    versions += [("k", None, None, "never"), (None, moments[0], None, "keyless"), ("z", moments[5], moments[9], "z")]
    facts = [(n, rng.choice(["k", "k", "z", "none", None]), rng.choice([None, *moments])) for n in range(120)]

    def expected(key, at):
        started = [v for v in versions if v[0] == key is not None and at is not None and v[1] is not None and v[1] <= at]
        if not started:
            return None
        last = max(started, key=lambda v: (v[1], v[2] is not None, v[2] or at, v[3]))
        return last[3] if last[2] is None or at < last[2] else None

    plain = lambda m: None if m is None else str(m)
    history = rows("k string, valid_from timestamp_ntz, valid_to timestamp_ntz, h string", *[(k, plain(a), plain(b), h) for k, a, b, h in versions])
    asked = rows("n int, k string, ts timestamp_ntz", *[(n, k, plain(ts)) for n, k, ts in facts])
    want = sorted((n, expected(k, ts)) for n, k, ts in facts)
    for few in (0, 10_000):
        got = temporal.point_in_time_join(asked, history, ["k"], "ts", {"h": "v"}, few_versions=few)
        assert sorted((r["n"], r["v"]) for r in got.collect()) == want
