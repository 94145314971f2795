import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.reconcile import table_diff
from tidemark.streaming import nightly

SCHEMA = "day date, city string"


def build(seen, since):
    kept = seen if since is None else seen.where(F.col("day") >= F.lit(since))
    return kept.groupBy("day", "city").agg(F.count("*").alias("n"))


def test_each_delivery_brings_the_mart_up_to_date(spark, rows, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    nights = [
        [("2025-01-01", "a"), ("2025-01-02", "a")],
        [("2025-01-01", "a"), ("2025-01-03", "b")],
        [("2025-01-02", "b"), ("2025-01-04", "a")],
    ]
    everything = []
    for load, night in enumerate(nights, 1):
        nightly.deliver(rows(SCHEMA, *night), landing, load)
        schema = rows(SCHEMA, *night).schema
        state = nightly.stream_mart(spark, landing, schema, root, "m", build, "day", 4)
        everything += night
        assert table_diff(state, build(rows(SCHEMA, *everything), None)).isEmpty()


def test_nothing_new_means_no_new_run(spark, rows, tmp_path, bag):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    nightly.deliver(rows(SCHEMA, ("2025-01-01", "a")), landing, 1)
    args = (spark, landing, rows(SCHEMA, ("2025-01-01", "a")).schema, root, "m", build, "day", 4)
    assert bag(nightly.stream_mart(*args)) == bag(nightly.stream_mart(*args))
    assert len(list((tmp_path / "root" / "marts" / "m").iterdir())) == 1


def test_a_repeated_micro_batch_overwrites_its_first_attempt(spark, rows, tmp_path, bag):
    """As after a driver loss between the mart's commit and the stream's."""
    landing, root = str(tmp_path / "landing"), tmp_path / "root"
    schema = rows(SCHEMA, ("2025-01-01", "a")).schema
    for load, night in enumerate((("2025-01-01", "a"), ("2025-01-02", "b")), 1):
        nightly.deliver(rows(SCHEMA, night), landing, load)
        once = bag(nightly.stream_mart(spark, landing, schema, str(root), "m", build, "day", 4))
    for mark in (root / "progress" / "commits").glob("*1*"):
        mark.unlink()
    again = bag(nightly.stream_mart(spark, landing, schema, str(root), "m", build, "day", 4))
    assert once == again == sorted(again)
    assert dt.date.fromisoformat(again[0][0]) == dt.date(2025, 1, 1)


def test_a_load_in_two_micro_batches_is_kept_whole(spark, rows, tmp_path):
    """Its second half also holds days before the window that its first half opened."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    parts = [
        (1, [("2025-01-01", "a")]),
        (2, [("2025-01-02", "a"), ("2025-01-20", "b")]),
        (2, [("2025-01-02", "b"), ("2025-01-03", "a"), ("2025-01-20", "b")]),
    ]
    everything = []
    for load, part in parts:
        rows(SCHEMA, *part).write.mode("append").parquet(f"{landing}/load={load}")
        everything += part
        state = nightly.stream_mart(spark, landing, rows(SCHEMA, *part).schema, root, "m", build, "day", 4)
        assert table_diff(state, build(rows(SCHEMA, *everything), None)).isEmpty()
