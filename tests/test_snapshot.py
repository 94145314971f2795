import pytest
from pyspark.sql import functions as F

from tidemark.operators import history_checks, snapshot
from tidemark.sources.store import HistoryStore, NotRebuildable

DUMP = "k string, name string, dep string, updated_at timestamp_ntz"
D1, D2, D3 = (f"2025-02-0{d} 00:00:00" for d in (1, 2, 3))
SHOWN = ("k", "dep", "valid_from", "valid_to", "is_deleted")


@pytest.fixture
def store(spark, tmp_path):
    return HistoryStore(spark, str(tmp_path / "history"))


def check_spec(**changes):
    settings = dict(strategy="check", check_columns=("dep",), hard_deletes="new_record", feed="full_dump")
    return snapshot.SnapshotSpec("people", ("k",), **{**settings, **changes})


STAMPED = snapshot.SnapshotSpec("people", ("k",), "timestamp", updated_at="updated_at")


def play(store, spec, rows, *dumps):
    for run, dump in enumerate(dumps, 1):
        history = snapshot.run_snapshot(store, spec, rows(DUMP, *dump), run, f"2025-02-0{run} 00:00:00")
    return history


def test_termination_and_rehire_with_equal_values(store, rows, bag):
    ann, bob = ("a", "Ann", "X", D1), ("b", "Bob", "X", D1)
    history = play(store, check_spec(), rows, [ann, bob], [ann], [ann, bob])
    assert bag(history, *SHOWN) == [
        ("a", "X", D1, None, False),
        ("b", "X", D1, D2, False),
        ("b", "X", D2, D3, True),
        ("b", "X", D3, None, False),
    ]


def test_staying_absent_adds_nothing_more(store, rows, bag):
    ann, bob = ("a", "Ann", "X", D1), ("b", "Bob", "X", D1)
    history = play(store, check_spec(), rows, [ann, bob], [ann], [ann])
    assert history.where("k = 'b'").count() == 2


def test_only_tracked_columns_make_versions(store, rows, bag):
    history = play(
        store,
        check_spec(),
        rows,
        [("a", "Ann", "X", D1), ("c", "Cy", None, D1)],
        [("a", "Anna", "X", D2), ("c", "Cy", None, D1)],  # overwritten name, bumped stamp
        [("a", "Anna", "Y", D2), ("c", "Cy", "Z", D1)],  # script change without a stamp
    )
    assert bag(history, "k", "name", *SHOWN[1:4]) == [
        ("a", "Ann", "X", D1, D3),
        ("a", "Anna", "Y", D3, None),
        ("c", "Cy", None, D1, D3),
        ("c", "Cy", "Z", D3, None),
    ]


def test_all_columns_version_every_correction(store, rows):
    spec = check_spec(check_columns=snapshot.ALL, hard_deletes="ignore")
    history = play(store, spec, rows, [("a", "Ann", "X", D1)], [("a", "Anna", "X", D1)])
    assert history.count() == 2


@pytest.mark.parametrize(
    "mode, want",
    [
        ("ignore", [("b", "X", D1, None, False)]),
        ("invalidate", [("b", "X", D1, D2, False), ("b", "X", D3, None, False)]),
    ],
)
def test_other_meanings_of_absence(store, rows, bag, mode, want):
    ann, bob = ("a", "Ann", "X", D1), ("b", "Bob", "X", D1)
    history = play(store, check_spec(hard_deletes=mode), rows, [ann, bob], [ann], [ann, bob])
    assert bag(history.where("k = 'b'"), *SHOWN) == want


def test_timestamp_windows_are_in_source_time(store, rows, bag):
    t1, t2 = "2025-01-10 08:00:00", "2025-01-31 17:30:00"
    history = play(
        store,
        STAMPED,
        rows,
        [("a", "Ann", "X", t1), ("b", "Bob", "X", t1)],
        [("a", "Ann", "Y", t2), ("b", "Bob", "Y", t1)],  # b changed without its stamp moving
    )
    assert bag(history, *SHOWN[:4]) == [
        ("a", "X", t1, t2),
        ("a", "Y", t2, None),
        ("b", "X", t1, None),
    ]


def test_rehire_in_source_time_can_invert_the_termination_and_is_caught(store, rows, bag):
    """Terminations are stamped with the run, versions with the source: the check reports it."""
    spec = check_spec(strategy="timestamp", updated_at="updated_at")
    old = "2025-01-20 00:00:00"
    ann, bob = ("a", "Ann", "X", old), ("b", "Bob", "X", old)
    history = play(store, spec, rows, [ann, bob], [ann], [ann, bob])
    assert bag(history.where("k = 'b'"), *SHOWN[1:]) == [
        ("X", old, None, False),
        ("X", old, D2, False),
        ("X", D2, old, True),
    ]
    failing = history_checks.window_overlaps(history, ["k"])
    assert "empty window" in {r.failure for r in failing.collect()}


def test_version_ids_are_unique_and_stable(store, rows):
    ann, bob = ("a", "Ann", "X", D1), ("b", "Bob", "X", D1)
    play(store, check_spec(), rows, [ann, bob], [ann], [ann, bob])
    schema = check_spec().history_schema(rows(DUMP).schema)
    ids = [[r.version_id for r in store.read("people", schema, n).collect()] for n in (2, 3)]
    assert len(set(ids[1])) == 4 and set(ids[0]) <= set(ids[1])


def test_several_rows_per_key_are_refused(store, rows):
    with pytest.raises(snapshot.NotOneRowPerKey):
        play(store, check_spec(), rows, [("a", "Ann", "X", D1), ("a", "Ann", "Y", D1)])


def test_a_repeated_run_is_not_merged_again(store, rows, bag):
    one, two = [("a", "Ann", "X", D1)], [("a", "Ann", "Y", D1)]
    before = bag(play(store, check_spec(), rows, one, two))
    again = snapshot.run_snapshot(store, check_spec(), rows(DUMP, *two), 2, "2026-01-01")
    assert bag(again) == before


def test_history_is_never_redone_or_dropped(store, rows):
    ann = ("a", "Ann", "X", D1)
    play(store, check_spec(), rows, [ann], [ann], [ann])
    with pytest.raises(NotRebuildable):
        store.write("people", 2, rows(DUMP, ann).withColumn("state", F.lit("open")))
    with pytest.raises(NotRebuildable):
        store.drop("people")


def test_history_can_be_read_as_of_a_run(store, rows, bag):
    play(store, check_spec(), rows, [("a", "Ann", "X", D1)], [("a", "Ann", "Y", D1)])
    schema = check_spec().history_schema(rows(DUMP).schema)
    assert bag(store.read("people", schema, 1), *SHOWN) == [("a", "X", D1, None, False)]


def test_closed_versions_are_written_once(store, rows, tmp_path):
    play(store, check_spec(), rows, *[[("a", "Ann", dep, D1)] for dep in "XYZ"])
    base = tmp_path / "history" / "people"
    closed = [store.spark.read.parquet(f"file:{base}/run={n}/state=closed").count() for n in (2, 3)]
    assert closed == [1, 1] and not (base / "run=1" / "state=closed").exists()


def test_partial_feed_is_refused(store, rows):
    many = [(str(i), "n", "X", D1) for i in range(10)]
    with pytest.raises(snapshot.SuspiciousDrop):
        play(store, check_spec(max_drop=0.5), rows, many, many[:2])


@pytest.mark.parametrize(
    "wrong",
    [
        dict(strategy="guess"),
        dict(check_columns=()),
        dict(strategy="timestamp"),
        dict(hard_deletes="maybe"),
        dict(feed="state"),
    ],
)
def test_contradictory_settings_are_refused(wrong):
    with pytest.raises(ValueError):
        check_spec(**wrong)


def test_history_view_and_current_rows(store, rows, bag):
    ann, bob = ("a", "Ann", "X", D1), ("b", "Bob", "X", D1)
    history = play(store, check_spec(), rows, [ann, bob], [ann])
    view = snapshot.history_view(history, ["k"])
    assert bag(view, "k", "is_deleted", "is_current") == [
        ("a", False, True),
        ("b", False, False),
        ("b", True, False),
    ]
    assert bag(snapshot.current_rows(history, F.col("dep") == "X"), "k") == [("a",)]
