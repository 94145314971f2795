import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import upsert
from tidemark.operators.reconcile import digest, table_diff
from tidemark.plans import marts
from tidemark.sources import summaries
from tidemark.sources.arrivals import HighWater
from tidemark.sources.store import MartStore

FEED = "id string, n int, loaded_at timestamp_ntz"
T1, T2, T3 = "2025-03-01 00:00:00", "2025-03-02 00:00:00", "2025-03-03 00:00:00"


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


@pytest.fixture
def marks(spark, tmp_path):
    return HighWater(spark, str(tmp_path))


def test_first_run_takes_everything_and_an_empty_feed_has_no_mark(marks, rows):
    empty = marks.take("f", rows(FEED), "loaded_at", 1)
    assert ids(empty.arrivals) == [] and empty.mark is None
    marks.finish(empty, 1)
    assert marks.mark("f", 2) is None
    first = marks.take("f", rows(FEED, ("a", 1, T1), ("x", 1, None)), "loaded_at", 2)
    assert ids(first.arrivals) == ["a", "x"] and str(first.mark.moment) == T1


def test_rows_at_the_very_mark_arrive_when_the_load_there_has_grown_or_changed(marks, rows):
    seen = [("a", 1, T1), ("b", 1, T2)]
    marks.finish(marks.take("f", rows(FEED, *seen), "loaded_at", 1), 1)
    assert ids(marks.take("f", rows(FEED, *seen), "loaded_at", 2).arrivals) == []
    # one more at the mark, alone and beside a newer load
    assert ids(marks.take("f", rows(FEED, *seen, ("c", 1, T2)), "loaded_at", 2).arrivals) == ["b", "c"]
    assert ids(marks.take("f", rows(FEED, *seen, ("c", 1, T2), ("d", 1, T3)), "loaded_at", 2).arrivals) == ["b", "c", "d"]
    assert ids(marks.take("f", rows(FEED, *seen, ("d", 1, T3)), "loaded_at", 2).arrivals) == ["d"]
    # as many rows, another value; a repeated row
    assert ids(marks.take("f", rows(FEED, seen[0], ("b", 2, T2)), "loaded_at", 2).arrivals) == ["b"]
    assert ids(marks.take("f", rows(FEED, *seen, seen[1]), "loaded_at", 2).arrivals) == ["b", "b"]


def test_a_run_that_was_cut_off_takes_its_arrivals_again(marks, rows):
    marks.finish(marks.take("f", rows(FEED, ("a", 1, T1)), "loaded_at", 1), 1)
    grown = rows(FEED, ("a", 1, T1), ("b", 1, T2))
    assert ids(marks.take("f", grown, "loaded_at", 2).arrivals) == ["b"]  # never finished
    again = marks.take("f", grown, "loaded_at", 3)
    assert ids(again.arrivals) == ["b"]
    marks.finish(again, 3)
    assert ids(marks.take("f", grown, "loaded_at", 4).arrivals) == []
    assert ids(marks.take("f", grown, "loaded_at", 3).arrivals) == ["b"]  # the run itself, repeated


def test_rows_without_a_moment_arrive_in_every_run(marks, rows):
    feed = rows(FEED, ("a", 1, T1), ("x", 1, None))
    marks.finish(marks.take("f", feed, "loaded_at", 1), 1)
    assert ids(marks.take("f", feed, "loaded_at", 2).arrivals) == ["x"]
    # a feed without any moment keeps no mark
    nowhere = rows(FEED, ("x", 1, None))
    marks.finish(marks.take("g", nowhere, "loaded_at", 1), 1)
    assert ids(marks.take("g", nowhere, "loaded_at", 2).arrivals) == ["x"]


header = st.tuples(st.integers(0, 60), st.integers(0, 3), st.integers(0, 1), st.sampled_from("ab"))
child = st.tuples(st.integers(0, 9), st.integers(0, 3), st.integers(0, 1), st.integers(1, 9))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(headers=st.lists(header, min_size=1, max_size=10), children=st.lists(child, max_size=15))
def test_runs_by_load_time_equal_a_rebuild(spark, rows, tmp_path_factory, headers, children):
    """Headers and children of any date; half of each load shows one run after the load's moment does."""
    moment = lambda n: str(dt.datetime(2025, 3, 1 + n))
    day = lambda n: str(dt.date(2025, 1, 1) + dt.timedelta(days=n))
    every = rows(
        "delivery_id string, city_code string, delivery_date date, status string, payout_base_usd decimal(10,2), "
        "loaded_at timestamp_ntz, run int",
        *[(str(i), c, day(d), "COMPLETED", "1.50", moment(at), at + late) for i, (d, at, late, c) in enumerate(headers)],
        ("undated", "a", None, "COMPLETED", "2.00", moment(0), 1),
    )
    lines = rows(
        "delivery_id string, adj_amount_usd decimal(10,2), loaded_at timestamp_ntz, run int",
        *[(str(i), f"{n}.25", moment(at), at + late) for i, at, late, n in children], ("none", "1.00", None, 0),
    )
    root = str(tmp_path_factory.mktemp("marts"))
    store, marks = MartStore(spark, root), HighWater(spark, root)
    for run in range(5):
        seen, known = (feed.where(F.col("run") <= run).drop("run") for feed in (every, lines))
        build = lambda window: marts.daily_payouts(seen, known, window)  # noqa: B023, E731
        dates = lambda new: new["deliveries"].select("delivery_date").unionByName(
            upsert.touched_dates(seen, new["lines"], ["delivery_id"], "delivery_date")  # noqa: B023
        )
        state = upsert.run_arrivals(
            store, "m", build, "delivery_date", run, marks,
            {"deliveries": (seen, "loaded_at"), "lines": (known, "loaded_at")}, dates,
        )
        assert table_diff(state, build(None)).isEmpty(), run


# --- digests and kept totals -------------------------------------------------------------

PAIR = "a string, b string, n int"


def the_digest(frame):
    return frame.agg(digest(frame.columns).alias("d")).first()["d"]


def test_digests_tell_multisets_apart_and_ignore_order(rows):
    base = [("x", "y", 1), ("x", None, 2), ("z", "z", None)]
    same = the_digest(rows(PAIR, *base))
    assert same == the_digest(rows(PAIR, *reversed(base)).repartition(3))
    others = [
        base + base[:1], base[1:], [], [("x", "y", 1), (None, "x", 2), ("z", "z", None)],
        [("xy", "", 1), *base[1:]], [("x", "y", 2), ("x", None, 1), ("z", "z", None)], base[:2] + [("z", "z", 0)],
    ]
    found = [the_digest(rows(PAIR, *other)) for other in others]
    assert same not in found and len(set(found)) == len(found)


MART = "day date, city string, n int"


def stored(spark, folder, rows, *data):
    store = MartStore(spark, str(folder))
    store.write("m", 1, rows(MART, *data), "day")
    return store


BASE = [("2025-01-05", "a", 1), ("2025-01-05", "b", 2), ("2025-02-01", "a", 3), ("2025-03-09", "c", 4), (None, "u", 5)]


def test_only_periods_that_differ_are_opened(spark, rows, tmp_path, capsys):
    kept = summaries.Summaries(spark, str(tmp_path / "kept"))

    def difference(name, *data):
        sides = [
            summaries.of_mart(stored(spark, tmp_path / side, rows, *of), "m", "day")
            for side, of in ((f"{name}-l", BASE), (f"{name}-r", data))
        ]
        left, right = (summaries.digests(kept, f"{name}-{i}", side) for i, side in enumerate(sides))
        return summaries.stored_diff(sides[0], left, sides[1], right)

    same = difference("same", *reversed(BASE))
    assert same.isEmpty()
    changed = difference("changed", *BASE[:2], ("2025-02-01", "a", 9), *BASE[3:])
    assert sorted(r["n"] for r in changed.collect()) == [3, 9]
    changed.explain()
    plan = capsys.readouterr().out
    scans = [line.split("PartitionFilters: ")[1] for line in plan.splitlines() if "PartitionFilters" in line]
    assert scans and all("= 2025-02)" in scan and "2025-01" not in scan for scan in scans)
    assert {r["n"] for r in difference("undated", *BASE[:4], (None, "u", 6)).collect()} == {5, 6}
    assert [r["n"] for r in difference("missing", *BASE[:3], BASE[4]).collect()] == [4]
    twice = difference("twice", *BASE, BASE[3]).collect()
    assert [(r["n"], r["left_rows"], r["right_rows"]) for r in twice] == [(4, 1, 2)]


def test_totals_are_read_again_only_where_files_changed(spark, rows, tmp_path, bag):
    store = stored(spark, tmp_path, rows, *BASE)
    kept, asked = summaries.Summaries(spark, str(tmp_path)), {"total": F.sum("n")}
    mart = summaries.of_mart(store, "m", "day")
    assert set(kept.stale("t", mart, asked)) == {"2025-01", "2025-02", "2025-03", None}
    want = [("2025-01", 2, 3), ("2025-02", 1, 3), ("2025-03", 1, 4), (None, 1, 5)]
    assert bag(kept.of("t", mart, asked)) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert kept.stale("t", mart, asked) == {}
    # a run writes March, and rows without a date, again
    store.write("m", 2, rows(MART, ("2025-03-09", "c", 7)), "day", upsert.Window(dt.date(2025, 3, 1)))
    mart = summaries.of_mart(store, "m", "day")
    assert set(kept.stale("t", mart, asked)) == {"2025-03", None}
    assert bag(kept.of("t", mart, asked)) == [("2025-01", 2, 3), ("2025-02", 1, 3), ("2025-03", 1, 7)]
    assert kept.stale("t", mart, asked) == {}  # that the undated partition is empty is known as well
    # other aggregates under the same name are not taken from the kept ones
    assert len(kept.stale("t", mart, {"total": F.max("n")})) == 4


def test_feed_log_prunes_batches_and_replaces_a_batch_as_a_whole(spark, rows, tmp_path, capsys, bag):
    log, schema = summaries.FeedLog(spark, str(tmp_path)), rows(PAIR).schema
    log.deliver("f", rows(PAIR, ("a", "a", 1), ("b", "b", 2)), 1)
    log.deliver("f", rows(PAIR, ("c", "c", 3)), 2)
    log.deliver("f", rows(PAIR, ("d", "d", 4)), 10)
    assert ids_of(log.upto("f", schema, 2)) == [1, 2, 3] and ids_of(log.exactly("f", schema, 10)) == [4]
    log.upto("f", schema, 2).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(batch" in plan and "(batch" in plan
    kept, asked = summaries.Summaries(spark, str(tmp_path)), {"total": F.sum("n")}
    kept.of("t", log.partitioned("f", schema, 2), asked)
    assert set(kept.stale("t", log.partitioned("f", schema, 10), asked)) == {"10"}
    log.deliver("f", rows(PAIR, ("b", "b", 5)), 1)
    assert ids_of(log.upto("f", schema, 2)) == [3, 5]
    assert bag(kept.of("t", log.partitioned("f", schema, 2), asked)) == [("1", 1, 5), ("2", 1, 3)]


def ids_of(frame):
    return sorted(r["n"] for r in frame.collect())
