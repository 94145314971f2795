"""Every registered query against its SQL oracle, and what no plan may contain."""

import os

import pytest

import __spark_entry__ as entry
from parity import compare, oracle_connection
from tidemark import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="star tables not present")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", catalogue.queries())
def test_query_equals_its_oracle(spark, oracle, name):
    assert compare(spark, oracle, SF, name)[0].startswith("ok")


def test_every_query_has_an_oracle():
    assert catalogue.queries().keys() == catalogue.oracle_sql().keys()
    assert catalogue.queries().keys() <= entry.queries().keys()


# Replays write tables while they are built; their parts are covered by the queries below.
REPLAYS = {n for n in catalogue.queries() if n.startswith(("daily_", "snapshot_", "nightly_"))}


@pytest.mark.parametrize("name", [n for n in catalogue.queries() if n not in REPLAYS])
def test_plans_have_no_crossing_joins_or_python(spark, name, capsys):
    entry.queries()[name](spark, SF).explain()
    plan = capsys.readouterr().out
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition, REPARTITION"):
        assert node not in plan


def test_latest_row_is_limited_before_the_shuffle(spark, capsys):
    entry.queries()["latest_per_key"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_only_needed_columns_are_read(spark, capsys):
    entry.queries()["payments_pivot"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert "l_partkey" not in plan and "o_totalprice" not in plan


def test_window_bounds_reach_the_scan(spark, capsys):
    """The bound on a feed's dates is pushed into the scan, with the rows that have none."""
    import datetime as dt

    from tidemark.operators.upsert import within

    orders = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("o_orderkey", "o_orderdate as at")
    orders.where(within("at", dt.date(1998, 1, 1))).explain()
    plan = capsys.readouterr().out
    assert "IsNull(o_orderdate)" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150
