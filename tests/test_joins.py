import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, shaping


def test_latest_row_is_kept_whole(rows, bag):
    log = rows(
        "k string, ts timestamp_ntz, v int",
        ("a", "2025-01-01 00:00:00", 1),
        ("a", "2025-01-03 00:00:00", None),
        ("a", "2025-01-02 00:00:00", 2),
        (None, "2025-01-02 00:00:00", 3),
    )
    latest = shaping.latest_per_key(log, ["k"], [F.desc("ts")])
    assert bag(latest) == [(None, "2025-01-02 00:00:00", 3), ("a", "2025-01-03 00:00:00", None)]


def test_preview_is_ordered_and_limited(rows):
    df = rows("v int", (3,), (1,), (2,))
    assert [r.v for r in shaping.preview(df, [F.desc("v")], 2).collect()] == [3, 2]


def test_run_labels_number_distinct_moments(rows, bag):
    df = rows("t timestamp_ntz", *[(f"2025-01-0{d} 00:00:00",) for d in (2, 1, 2, 3)])
    assert bag(shaping.run_labels(df, "t"), "run_label", "t") == [
        ("R1", "2025-01-01 00:00:00"),
        ("R2", "2025-01-02 00:00:00"),
        ("R3", "2025-01-03 00:00:00"),
    ]


def test_rollup_left_does_not_repeat_headers_and_fills_zeros(rows, bag):
    headers = rows("h int, cost int", (1, 10), (2, 20))
    lines = rows("h int, q int", (1, 5), (1, 7), (None, 100), (9, 100))
    result = joins.rollup_left(
        headers, lines, ["h"], {"n": F.count("*"), "q": F.sum("q")}, {"n": "int", "q": "int"}
    )
    assert bag(result) == [(1, 10, 2, 12), (2, 20, 0, 0)]


def test_two_many_sides_do_not_multiply_each_other(rows, bag):
    headers = rows("h int", (1,), (2,))
    many = rows("h int, v int", (1, 1), (1, 1), (1, 1))
    other = rows("h int, v int", (1, 10), (1, 10), (2, 10))
    result = joins.rollup_left_many(
        headers,
        ["h"],
        (many, {"a": F.sum("v")}, {"a": "int"}),
        (other, {"b": F.sum("v")}, {"b": "int"}),
    )
    assert bag(result, "h", "a", "b") == [(1, 3, 20), (2, 0, 10)]


@pytest.mark.parametrize("hot_rows", [None, 0, 1000])
def test_lookup_default_covers_unmapped_and_missing_codes(rows, bag, hot_rows):
    facts = rows("code string, n int", ("FR", 1), ("XX", 2), (None, 3))
    names = rows("code string, region string", ("FR", "EMEA"), ("JP", "APAC"))
    found = joins.lookup(facts, names, "code", "region", "Unmapped", hot_rows)
    assert bag(found, "n", "region") == [(1, "EMEA"), (2, "Unmapped"), (3, "Unmapped")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 2, 3, 5, 1000])
def test_split_join_equals_the_plain_join(rows, bag, how, hot_rows):
    keys = [1] * 6 + [2] * 4 + [3] * 2 + [4, 5, None, None, None]
    facts = rows("k int, f int", *[(k, i) for i, k in enumerate(keys)])
    dim = rows("k int, d string", (1, "a"), (3, "c"), (5, "e"), (7, "g"))
    want = facts.join(dim, "k", how)
    got = joins.split_join(facts, dim, ["k"], how, hot_rows)
    assert bag(got, *want.columns) == bag(want)


def test_only_small_frames_are_marked_for_broadcast(rows, capsys):
    df = rows("k int", (1,), (2,), (3,))
    joins.broadcast_if_small(df, 3).explain(True)
    assert "broadcast" in capsys.readouterr().out.lower()
    assert joins.broadcast_if_small(df, 2) is df


def test_hot_keys_are_those_above_the_limit(rows, bag):
    facts = rows("k int", *[(k,) for k in [1] * 5 + [2] * 3 + [3] + [None] * 9])
    few = joins.hot_keys(facts, ["k"], 2)
    assert bag(few.named) == [(1,), (2,)] and few.missing
    only_missing = joins.hot_keys(facts, ["k"], 5)
    assert only_missing.named is None and only_missing.missing
    assert joins.hot_keys(facts, ["k"], 9) is None


def test_large_limits_are_judged_on_a_sample(spark, bag):
    facts = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    sample, share = joins.sampled(facts, 40_000)
    assert share == 0.25 and 70_000 < sample.count() < 80_000
    few = joins.hot_keys(facts, ["k"], 40_000)
    assert bag(few.named) == [(-1,)] and not few.missing
    assert joins.hot_keys(facts, ["k"], 200_000) is None
    dim = spark.createDataFrame([(-1, "hot"), (1, "cold")], "k bigint, d string")
    joined = joins.attach(facts, dim, ["k"], "left", hot_rows=40_000)
    assert bag(joined.groupBy("d").count()) == [(None, 199_999), ("cold", 1), ("hot", 100_000)]


def test_keep_and_drop_keys(rows, bag):
    facts = rows("k int, v int", (1, 1), (2, 2), (None, 3))
    some = rows("k int", (2,), (2,))
    assert bag(joins.keep_keys(facts, some, ["k"])) == [(2, 2)]
    assert bag(joins.drop_keys(facts, some, ["k"]), "v") == [(1,), (3,)]


def test_key_range_keeps_every_possible_match(rows, bag):
    headers = rows("k string", ("b",), ("d",))
    a, b = joins.within_key_range(
        headers,
        "k",
        rows("k string", ("a",), ("b",), ("c",), ("e",)),
        rows("k string", ("d",), (None,)),
    )
    assert bag(a) == [("b",), ("c",)] and bag(b) == [("d",)]
    (none,) = joins.within_key_range(headers.where(F.lit(False)), "k", a)
    assert none.count() == 0
