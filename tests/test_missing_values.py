"""Missing keys, moments and dates, ties and repeated deliveries: the same answer on every plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, snapshot, temporal, upsert
from tidemark.sources.store import MartStore
from tidemark.streaming import nightly

FACTS = [("a", "2025-01-05"), ("a", "2024-12-31"), ("b", "2025-01-05"), (None, "2025-01-05"), ("a", None)]
VERSIONS = [
    ("a", "2025-01-01", "2025-01-03", "old"),
    ("a", "2025-01-03", None, "new"),
    ("b", None, None, "dateless"),
    (None, "2025-01-01", None, "keyless"),
]
WANT = {("a", "2025-01-05"): "new", ("a", "2024-12-31"): None, ("b", "2025-01-05"): None, (None, "2025-01-05"): None, ("a", None): None}


@pytest.fixture
def facts(rows):
    return rows("k string, ts timestamp_ntz", *FACTS)


@pytest.fixture
def versions(rows):
    return rows("k string, valid_from timestamp_ntz, valid_to timestamp_ntz, tier string", *VERSIONS)


def found(df):
    return {(r["k"], r["ts"] and str(r["ts"])[:10]): r["t"] for r in df.collect()}


@pytest.mark.parametrize("few_versions", [0, 64])
def test_point_in_time_is_the_same_on_both_plans(facts, versions, few_versions):
    got = temporal.point_in_time_join(facts, versions, ["k"], "ts", {"tier": "t"}, few_versions=few_versions)
    assert got.count() == len(FACTS) and found(got) == WANT


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_as_of_matches_no_missing_keys_or_starts(facts, versions, hot_rows):
    got = temporal.asof_latest(facts, versions, ["k"], "ts", {"tier": "t"}, hot_rows=hot_rows)
    assert got.count() == len(FACTS) and found(got) == WANT


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_tied_versions_do_not_depend_on_order(facts, rows, hot_rows):
    tied = [("a", "2025-01-01", "x"), ("a", "2025-01-01", "y"), ("a", "2025-01-01", "w")]
    for order in (tied, tied[::-1]):
        versions = rows("k string, valid_from timestamp_ntz, tier string", *order)
        got = temporal.asof_latest(facts, versions, ["k"], "ts", {"tier": "t"}, hot_rows=hot_rows)
        assert found(got)["a", "2025-01-05"] == "y"


def test_a_dump_batch_without_a_run_is_refused(rows):
    dumps = rows("k string, v string, batch int", ("a", "1", 1), ("a", "2", 2))
    history = temporal.scd2_from_dumps(dumps, ["k"], ["v"], "batch", [(1, dt.datetime(2025, 1, 1))])
    with pytest.raises(Exception, match="dump batch without a run: 2"):
        history.collect()


def test_rows_without_a_date_belong_to_every_window(rows, bag):
    """They are rebuilt with it: those of the target go, those of the new rows come."""
    first = rows("day date, n int", ("2025-01-01", 1), ("2025-01-02", 2), (None, 3))
    later = rows("day date, n int", ("2025-01-02", 5), (None, 4))
    replaced = upsert.replace_window(first, later, "day", dt.date(2025, 1, 2))
    assert sorted(bag(replaced), key=str) == sorted([("2025-01-01", 1), ("2025-01-02", 5), (None, 4)], key=str)


def test_a_load_delivered_again_counts_once(spark, rows, bag, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    load = rows("day date, k string", ("2025-01-01", "a"), ("2025-01-01", "b"))
    build = lambda seen, since: seen.groupBy("day").agg(F.count("*").cast("int").alias("n"))
    for _ in range(2):
        nightly.deliver(load, landing, 1)
        state = nightly.stream_mart(spark, landing, load.schema, root, "m", build, "day", 4)
        assert bag(state) == [("2025-01-01", 2)]


def test_a_misspelt_relation_is_not_ephemeral(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    assert checks.relation_kind(spark, store, "billable_usge", ["billable_usage"]) == "missing"
    assert checks.wrong_materializations(spark, store, {"billable_usage": "ephemeral"}, ["billable_usage"]) == []


def test_a_missing_update_time_keeps_the_open_version(rows):
    schema = "id int, v string, at timestamp_ntz"
    spec = snapshot.SnapshotSpec(name="s", keys=("id",), strategy="timestamp", updated_at="at", hard_deletes="ignore")
    opened = snapshot.first_versions(rows(schema, (1, "x", "2025-01-01")), spec, dt.datetime(2025, 1, 2))
    after = snapshot.merge_versions(opened.drop("state"), rows(schema, (1, "y", None)), spec, dt.datetime(2025, 1, 3))
    assert [(r["v"], r["state"]) for r in after.collect()] == [("x", "open")]
