import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, history_checks, pivot, reconcile

T = "k string, v int, s string"


def counts(table, *bound, **options):
    suite = checks.CheckSuite("t", table, bound, **options)
    return {r.check_name: (r.failing_rows, r.status) for r in suite.results().collect()}


@pytest.fixture
def table(rows):
    return rows(T, ("a", 1, "x"), ("a", -2, None), (None, None, "y"), (None, 5, "x"), ("b", 0, "z"))


def test_missing_values_only_fail_presence_checks(table, rows):
    parent = rows("p string", ("a",))
    got = counts(
        table,
        checks.unique("k"),
        checks.not_null("k"),
        checks.accepted_values("s", ["x", "y"]),
        checks.relationships("k", parent, "p"),
        checks.not_negative("v"),
        checks.all_not_null(["k", "v", "s"]),
        checks.grain_unique(["k"]),
    )
    assert {n.split("(")[0]: c for n, (c, _) in got.items()} == {
        "unique": 1,
        "not_null": 2,
        "accepted_values": 1,
        "relationships": 1,
        "not_negative": 1,
        "all_not_null": 3,
        "grain_unique": 2,
    }


def test_row_rules_fail_when_unknown(table):
    assert counts(table, checks.row_rule("positive", F.col("v") >= 0))["positive"][0] == 2


def test_severity_is_a_ceiling(table):
    got = counts(table, checks.not_null("k", checks.WARN), checks.not_null("v"))
    assert got["not_null(k)"] == (2, "warn") and got["not_null(v)"] == (1, "error")


@pytest.mark.parametrize("error_if, warn_if, status", [(3, 1, "warn"), (2, 1, "error"), (9, 9, "pass")])
def test_thresholds_on_the_failing_count(table, error_if, warn_if, status):
    check = checks.Check("c", condition=F.col("k").isNull(), error_if=error_if, warn_if=warn_if)
    assert counts(table, check)["c"][1] == status


def test_a_failing_error_check_blocks_and_a_warning_does_not(table):
    with pytest.raises(checks.ChecksFailed, match="not_null"):
        checks.CheckSuite("t", table, [checks.not_null("k")]).gate()
    passed = checks.CheckSuite("t", table, [checks.not_null("k", checks.WARN)]).gate()
    assert passed is table


def test_unbound_checks_are_noticed(table):
    with pytest.raises(checks.CheckCountMismatch):
        checks.CheckSuite("t", table, [checks.not_null("k")], expected=2)
    with pytest.raises(checks.CheckCountMismatch):
        checks.run_suites([checks.CheckSuite("t", table, [checks.not_null("k")])], expected=2)
    with pytest.raises(ValueError):
        checks.CheckSuite("t", table, [checks.not_null("k"), checks.not_null("k")])


def test_row_checks_of_a_table_share_one_scan(table, tmp_path, spark, capsys):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    bound = [checks.not_null(c) for c in T.replace(",", "").split()[::2]]
    bound += [checks.accepted_values("s", ["x"]), checks.not_negative("v")]
    checks.CheckSuite("t", stored, bound).results().explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_failing_rows_can_be_kept(table, spark, tmp_path):
    checks.CheckSuite("t", table, [checks.not_null("k"), checks.unique("k")]).store_failures(
        str(tmp_path)
    )
    assert spark.read.parquet(str(tmp_path / "t" / "0")).count() == 2
    assert spark.read.parquet(str(tmp_path / "t" / "1")).count() == 1


def test_header_and_line_checks(rows, bag):
    headers = rows("h int, amount decimal(10,2)", (1, "3.00"), (2, "9.00"), (3, "1.00"))
    lines = rows("h int, a decimal(10,2)", (1, "1.00"), (1, "2.00"), (2, "1.00"), (None, "5.00"))
    unequal = checks.header_not_equal_lines(headers, lines, "h", "amount", "a")
    assert bag(unequal, "h") == [(2,)]
    assert bag(checks.without_children(headers, lines, "h"), "h") == [(3,)]
    assert bag(checks.orphans(lines, "h", headers.where("h = 1"), "h"), "h") == [(2,)]


def test_reconcile_names_every_kind_of_disagreement(rows, bag):
    schema = "k string, a decimal(10,2)"
    left = rows(schema, ("same", "1.00"), ("gone", "1.00"), ("twice", "1.00"), ("off", "1.00"), (None, None))
    right = rows(
        schema, ("same", "1.00"), ("twice", "0.50"), ("twice", "0.50"), ("off", "2.00"), ("new", "1.00"),
        (None, None),
    )
    failing = reconcile.reconcile(left, right, ["k"], ["a"], ("staged", "published"))
    assert dict(bag(failing, "k", "failure")) == {
        "gone": "missing in published",
        "new": "missing in staged",
        "twice": "row count differs",
        "off": "amount differs",
    }


def test_tie_out_of_empty_input_is_zero(rows, bag):
    some = rows("v int", (2,), (3,))
    none = some.where(F.lit(False))
    result = reconcile.tie_out(some, {"v": (F.sum("v"), none, F.sum("v"))})
    assert bag(result) == [("v", "5.00", "0.00", "5.00")]


def test_table_diff_counts_rows_and_compares_types(rows, bag):
    a = rows("k string, v int", ("x", 1), ("x", 1), (None, None))
    b = rows("k string, v int", ("x", 1), (None, None), ("y", 2))
    assert bag(reconcile.table_diff(a, b)) == [("x", 1, 2, 1), ("y", 2, 0, 1)]
    assert reconcile.table_diff(a, a).isEmpty()
    with pytest.raises(TypeError):
        reconcile.table_diff(a, a.withColumn("v", F.col("v").cast("bigint")))


# --- histories: each check is green on sound history and red on the fault it is for -----------

H = "k string, dep string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_deleted boolean"
T1, T2, T3 = (f"2025-01-0{d} 00:00:00" for d in (1, 2, 3))
SOUND = [
    ("a", "X", T1, T2, False),
    ("a", "Y", T2, T3, False),
    ("a", "Y", T3, None, True),
    ("b", "X", T2, None, False),
]
FAULTS = {
    "no open version": (2, ("a", "Y", T3, "2025-01-09 00:00:00", True)),
    "second open version": (1, ("a", "Y", T2, None, False)),
    "empty window": (1, ("a", "Y", T2, T2, False)),
    "overlap": (0, ("a", "X", T1, "2025-01-02 12:00:00", False)),
    "gap": (0, ("a", "X", T1, "2025-01-01 12:00:00", False)),
    "repeated version": (0, ("a", "Y", T1, T2, False)),
    "wrong department": (3, ("b", "Z", T2, None, False)),
}
HISTORY_CHECKS = {
    "not_one_open": lambda h, d: history_checks.not_one_open(h, ["k"]),
    "window_overlaps": lambda h, d: history_checks.window_overlaps(h, ["k"]),
    "not_tiling": lambda h, d: history_checks.not_tiling(h, ["k"]),
    "redundant": lambda h, d: history_checks.redundant_versions(h, ["k"], ["dep"]),
    "dump": lambda h, d: history_checks.open_not_matching_dump(h, d, ["k"], ["dep"]),
}
FIRES = {
    "no open version": {"not_one_open", "not_tiling"},
    "second open version": {"not_one_open", "window_overlaps", "not_tiling", "dump"},
    "empty window": {"window_overlaps", "not_tiling"},
    "overlap": {"window_overlaps", "not_tiling"},
    "gap": {"not_tiling"},
    "repeated version": {"redundant"},
    "wrong department": {"dump"},
}


@pytest.mark.parametrize("fault", [None, *FAULTS])
def test_history_checks_fire_on_their_faults_only(rows, fault):
    versions = list(SOUND)
    if fault:
        place, broken = FAULTS[fault]
        versions[place] = broken
    history, dump = rows(H, *versions), rows("k string, dep string", ("b", "X"))
    fired = {name for name, run in HISTORY_CHECKS.items() if not run(history, dump).isEmpty()}
    assert fired == FIRES.get(fault, set())


def test_repeated_open_versions_overlap(rows):
    twice = rows(H, ("a", "X", T1, None, False), ("a", "X", T1, None, False))
    assert history_checks.window_overlaps(twice, ["k"]).count() == 1


def test_attribution_checks(rows, bag):
    history = rows(H, *SOUND)
    facts = rows(
        "id int, k string, ts timestamp_ntz, then string",
        (1, "a", T1, "X"), (2, "a", T2, "X"), (3, "b", T1, "UNKNOWN"), (4, "b", T2, "UNKNOWN"),
    )
    wrong = history_checks.attribution_differs(
        facts.where("id < 3"), history.drop("valid_to"), ["k"], "ts", "then", "dep"
    )
    assert bag(wrong, "id", "derived") == [(2, "Y")]
    uncovered = history_checks.default_though_covered(
        facts, history, ["k"], "ts", "then", "UNKNOWN", "dep"
    )
    assert bag(uncovered, "id", "covering") == [(4, "X")]
    current = rows("k string, dep string", ("b", "X"))
    stale = history_checks.current_differs(facts, current, ["k"], "then", "dep", "UNKNOWN")
    assert bag(stale, "id", "expected") == [(1, "UNKNOWN"), (2, "UNKNOWN"), (3, "X"), (4, "X")]


# --- pivot checks ------------------------------------------------------------------------------

WIDE = (
    "m string, captured_amount_usd decimal(12,2), card_order_count int, "
    "card_amount_usd decimal(12,2), other_order_count int, other_amount_usd decimal(12,2)"
)


@pytest.mark.parametrize(
    "row, parts, populated",
    [
        (("ok", "5.00", 1, "3.00", 1, "2.00"), 0, 0),
        (("lost", "5.00", 1, "3.00", 1, "1.00"), 1, 0),
        (("missing", "5.00", 1, "5.00", 0, None), 1, 1),
        (("negative", "5.00", -1, "5.00", 0, "0.00"), 0, 1),
    ],
)
def test_pivot_checks_follow_the_list(rows, row, parts, populated):
    wide = rows(WIDE, row)
    assert pivot.parts_not_equal_total(wide, ["card"]).count() == parts
    assert pivot.generated_not_populated(wide, ["card"]).count() == populated
