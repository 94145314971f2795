"""Whole nightly runs: feeds in, gated by checks, tables out."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.checks import CheckCountMismatch, ChecksFailed
from tidemark.plans import feeds as specs
from tidemark.plans import marts, runs, suites


@pytest.fixture
def warehouse(spark, tmp_path):
    return runs.Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def raw(spark):
    """Raw feeds as delivered: all text, in the layout of their spec."""

    def make(spec, text):
        data = []
        for line in text.strip().splitlines():
            cells = [c.strip() or None for c in line.split("|")]
            data.append(tuple(cells))
        return spark.createDataFrame(data, spec.raw_schema)

    return make


def statuses(published):
    return {
        f"{r.table_name}.{r.check_name}": r.status for r in published.results.collect()
    }


# --- payments: known faults warn, new ones block ------------------------------------------------


@pytest.fixture
def payments(raw):
    return dict(
        sellers=raw(specs.SELLERS, "s1|One|US|true\ns2|Two|DE|false"),
        payouts=raw(
            specs.PAYOUTS,
            "p1|s1|2025-01-01|PAID|USD|30.00\np2|s2|2025-01-02|PENDING|EUR|5.00",
        ),
        lines=raw(
            specs.PAYOUT_LINES,
            """
            l1|p1|r1|USD|10.00|wise
            l2|p1|r2||20.00|
            l3||r3|USD|7.00|paypal
            l4|p404|r4|GBP|7.00|paypal
            """,
        ),
    )


def test_known_faults_are_reported_and_do_not_block(warehouse, payments, bag):
    done = runs.seller_payouts(warehouse, **payments)
    assert bag(done["seller_payouts"]) == [
        ("s1", "One", 1, 1, "30.00", 2),
        ("s2", "Two", 1, 0, "0.00", 0),
    ]
    outcome = statuses(done)
    assert len(outcome) == 33
    assert [n for n, s in outcome.items() if s == "warn"] == [
        "payout_lines.not_null(payout_id)",
        "payout_lines.not_null(currency)",
        "payout_lines.relationships(payout_id -> payout_id)",
    ]


@pytest.mark.parametrize(
    "table, change, check",
    [
        ("payouts", ("payout_amount", "31.00"), "payout_amount_equals_lines"),
        ("payouts", ("seller_id", "s9"), "relationships(seller_id"),
        ("payouts", ("status", "paid"), "accepted_values(status)"),
        ("payouts", ("payout_amount", "-1.00"), "not_negative(payout_amount)"),
        ("payouts", ("payout_id", "p7"), "paid_payout_has_lines|payout_amount"),
        ("lines", ("payment_method", "cash"), "accepted_values(payment_method)"),
        ("lines", ("line_id", None), "not_null(line_id)"),
        ("sellers", ("country", "FR"), "accepted_values(country)"),
        ("sellers", ("seller_id", "s1"), "unique(seller_id)"),
    ],
)
def test_new_faults_block_the_mart(warehouse, payments, table, change, check):
    column, value = change
    column = column.upper()
    payments[table] = payments[table].withColumn(column, F.lit(value).cast("string"))
    with pytest.raises(ChecksFailed, match=check.split("|")[0].replace("(", r"\(").split(")")[0]):
        runs.seller_payouts(warehouse, **payments)
    assert not warehouse.marts.exists("seller_payouts")


# --- daily payouts: batches, repeat, rebuild, red proofs ----------------------------------------


@pytest.fixture
def deliveries(raw):
    return dict(
        deliveries=raw(
            specs.DELIVERIES,
            """
            d1|c1|A|2025-01-01|COMPLETED|8.00|2025-01-02 03:00:00|1
            d2|c1|A|2025-01-01|CANCELLED|4.00|2025-01-02 03:00:00|1
            d3|c2|B|2025-01-02|RETURNED|5.00|2025-01-04 03:00:00|2
            d4|c2|B|2025-01-01|COMPLETED|6.00|2025-01-04 03:00:00|2
            """,
        ),
        adjustments=raw(
            specs.DELIVERY_ADJUSTMENTS,
            """
            a1|d1|TIP|1.50|1
            a2|d1|PENALTY|-0.50|1
            a3|d2|TIP|9.00|1
            a4|d4|SURGE|2.00|2
            """,
        ),
    )


def test_late_rows_reach_back_and_a_rebuild_agrees(warehouse, deliveries, bag):
    first = runs.daily_payouts(warehouse, **deliveries, batch=1)
    assert bag(first["daily_payouts"]) == [("2025-01-01", "A", 1, 1, "8.00", "1.00", "9.00")]
    second = bag(runs.daily_payouts(warehouse, **deliveries, batch=2)["daily_payouts"])
    assert second == [
        ("2025-01-01", "A", 1, 1, "8.00", "1.00", "9.00"),
        ("2025-01-01", "B", 1, 1, "6.00", "2.00", "8.00"),
        ("2025-01-02", "B", 1, 0, "5.00", "0.00", "5.00"),
    ]
    rebuilt = runs.daily_payouts(warehouse, **deliveries, batch=2, full_refresh=True)
    assert bag(rebuilt["daily_payouts"]) == second


PAYOUT_FAULTS = {
    "grain_unique(delivery_date, city_code)": lambda m: m.unionByName(m),
    "delivery_count_at_least_one": lambda m: m.withColumn("delivery_count", F.lit(0)),
    "completed_not_above_deliveries": lambda m: m.withColumn("completed_count", F.lit(99)),
    "total_is_base_plus_adjustments": lambda m: m.withColumn(
        "total_payout_usd", F.col("total_payout_usd") + F.lit("0.01").cast("decimal(10,2)")
    ),
    "reconciles_with_staging_both_ways": lambda m: m.where("city_code <> 'B'"),
    "not_null(adjustment_total_usd)": lambda m: m.withColumn(
        "adjustment_total_usd", F.nullif("adjustment_total_usd", F.lit(0))
    ),
}


@pytest.mark.parametrize("check", PAYOUT_FAULTS)
def test_payout_checks_fire_on_their_fault(deliveries, check):
    from tidemark.operators.checks import run_suites
    from tidemark.sources import feeds

    headers = feeds.staged_upto(deliveries["deliveries"], specs.DELIVERIES, 2)
    lines = feeds.staged_upto(deliveries["adjustments"], specs.DELIVERY_ADJUSTMENTS, 2)
    sound = marts.daily_payouts(headers, lines)

    def failing(mart):
        rows = run_suites(suites.daily_payouts(mart, headers)).collect()
        return {r.check_name for r in rows if r.status == "error"}

    assert failing(sound) == set()
    assert check in failing(PAYOUT_FAULTS[check](sound))


def run_checks(bound):
    from tidemark.operators.checks import run_suites

    return {r.check_name for r in run_suites(bound).collect() if r.status == "error"}


TENDER_FAULTS = {
    "totals_tie_out_to_staging": lambda m: m.where("merchant_id <> 'n'"),
    "methods_add_up_to_total": lambda m: m.withColumn(
        "other_amount_usd", F.lit(0).cast("decimal(12,2)")
    ),
    "generated_columns_populated": lambda m: m.withColumn(
        "card_order_count", F.nullif("card_order_count", F.lit(0))
    ),
    "grain_unique(merchant_id, order_month)": lambda m: m.unionByName(m),
}


@pytest.mark.parametrize("check", TENDER_FAULTS)
def test_payment_pivot_checks_fire_on_their_fault(rows, check):
    orders = rows(
        "order_id string, merchant_id string, ordered_at timestamp_ntz",
        ("o1", "m", "2025-01-01 00:00:00"), ("o2", "n", "2025-01-01 00:00:00"),
    )
    payments = rows(
        "payment_id string, order_id string, payment_method string, status string, "
        "amount_usd decimal(10,2)",
        ("p1", "o1", "card", "captured", "5.00"), ("p2", "o1", None, "captured", "1.00"),
        ("p3", "o2", "card", "failed", "9.00"),
    )
    mart = marts.merchant_month_payments(orders, payments, ["card"])
    bound = lambda m: suites.merchant_month_payments(m, orders, payments, ["card"])
    assert run_checks(bound(mart)) == set()
    assert check in run_checks(bound(TENDER_FAULTS[check](mart)))


REVENUE_FAULTS = {
    "reconciles_with_invoices": lambda r, m: (r.where("invoice_id <> 'i2'"), m),
    "plan_is_latest_version_then": lambda r, m: (r.withColumn("plan_code", F.lit("SCALE")), m),
    "not_null(billed_usd)": lambda r, m: (
        r.withColumn("billed_usd", F.nullif("billed_usd", F.lit(7))), m
    ),
    "totals_tie_out_to_staging": lambda r, m: (r, m.where("plan_code = 'GROWTH'")),
    "grain_unique(invoice_date, plan_code)": lambda r, m: (r, m.unionByName(m)),
    "accepted_values(plan_code)": lambda r, m: (r, m.withColumn("plan_code", F.lit("FREE"))),
}


@pytest.mark.parametrize("check", REVENUE_FAULTS)
def test_revenue_checks_fire_on_their_fault(rows, check):
    invoices = rows(
        "invoice_id string, customer_id string, invoiced_at timestamp_ntz",
        ("i1", "c", "2025-01-01 00:00:00"), ("i2", "c", "2025-01-05 00:00:00"),
    )
    lines = rows("invoice_id string, amount_usd decimal(10,2)", ("i1", "5.00"), ("i2", "7.00"))
    payments = rows("invoice_id string, amount_usd decimal(10,2)", ("i1", "2.00"))
    history = rows(
        "customer_id string, plan_code string, valid_from timestamp_ntz, valid_to timestamp_ntz",
        ("c", "STARTER", "2024-01-01 00:00:00", "2025-01-05 00:00:00"),
        ("c", "GROWTH", "2025-01-05 00:00:00", None),
    )
    revenue = marts.invoice_revenue(invoices, lines, payments, history)
    mart = marts.daily_revenue(revenue)
    bound = lambda r, m: suites.daily_revenue(r, m, invoices, lines, payments, history)
    assert run_checks(bound(revenue, mart)) == set()
    assert check in run_checks(bound(*REVENUE_FAULTS[check](revenue, mart)))


def test_a_check_that_never_ran_is_noticed(spark, warehouse):
    gate = runs.Gate("daily_payouts", spark)
    with pytest.raises(CheckCountMismatch):
        gate.publish()


# --- employees and revenue -----------------------------------------------------------------------


@pytest.fixture
def roster(raw):
    return dict(
        dumps=raw(
            specs.EMPLOYEE_DUMP,
            """
            e1|Ida|R|t|B1|2025-01-01 00:00:00|2025-01-01 08:00:00|1
            e2|Jo|R|t|B1|2025-01-01 00:00:00|2025-01-01 08:00:00|1
            e1|Ida|S|t|B1|2025-01-01 00:00:00|2025-01-02 08:00:00|2
            """,
        ),
        departments=raw(specs.DEPARTMENTS, "R|Research\nS|Sales"),
    )


def test_employees_over_two_nights(warehouse, roster, bag):
    runs.employees(warehouse, **roster, batch=1, run_ts="2025-01-01 20:00:00")
    done = runs.employees(warehouse, **roster, batch=2, run_ts="2025-01-02 20:00:00")
    assert bag(done["department_headcount"]) == [("R", "Research", 0, 1), ("S", "Sales", 1, 0)]
    assert done["history"].count() == 4 and len(statuses(done)) == 42


def test_unknown_department_stops_before_the_history_is_touched(warehouse, roster):
    roster["departments"] = roster["departments"].where("DEPARTMENT_CODE <> 'S'")
    runs.employees(
        warehouse, roster["dumps"], roster["departments"], batch=1, run_ts="2025-01-01 20:00:00"
    )
    with pytest.raises(ChecksFailed, match="relationships"):
        runs.employees(warehouse, **roster, batch=2, run_ts="2025-01-02 20:00:00")
    assert warehouse.histories.runs("employees") == [1]


@pytest.fixture
def billing(raw):
    return dict(
        customers=raw(
            specs.CUSTOMER_DUMP,
            """
            c1|Ann|STARTER|2025-01-01 00:00:00|1
            c1|Ann|GROWTH|2025-01-03 12:00:00|2
            """,
        ),
        invoices=raw(
            specs.INVOICES,
            "i1|c1|2025-01-02 09:00:00|1\ni2|c1|2025-01-03 12:00:00|2\ni3|c1|2025-01-03 11:59:59|2",
        ),
        lines=raw(
            specs.INVOICE_LINES,
            "l1|i1|USAGE|10.00|1\nl2|i1|SEATS|5.00|1\nl3|i2|USAGE|7.00|2\nl4|i3|USAGE|1.00|2",
        ),
        payments=raw(
            specs.INVOICE_PAYMENTS,
            "p1|i1|2025-01-02 10:00:00|3.00|1\np2|i1|2025-01-04 10:00:00|12.00|2",
        ),
    )


def test_late_payments_and_plans_at_the_time(warehouse, billing, bag):
    night = lambda n, **k: runs.daily_revenue(
        warehouse, **billing, batch=n, run_ts=f"2025-01-0{n} 22:00:00", **k
    )
    assert bag(night(1)["daily_revenue"]) == [("2025-01-02", "STARTER", 1, "15.00", "3.00", "12.00")]
    done = night(2)
    want = [
        ("2025-01-02", "STARTER", 1, "15.00", "15.00", "0.00"),
        ("2025-01-03", "GROWTH", 1, "7.00", "0.00", "7.00"),
        ("2025-01-03", "STARTER", 1, "1.00", "0.00", "1.00"),
    ]
    assert bag(done["daily_revenue"]) == want and len(statuses(done)) == 45


def test_invoice_without_lines_is_reported(warehouse, billing):
    billing["lines"] = billing["lines"].where("INVOICE_ID <> 'i3'")
    night = dict(warehouse=warehouse, **billing)
    runs.daily_revenue(**night, batch=1, run_ts="2025-01-01")
    with pytest.raises(ChecksFailed, match=r"billed_usd"):
        runs.daily_revenue(**night, batch=2, run_ts="2025-01-02")


def test_accounts_over_two_nights(warehouse, raw, bag):
    versions = raw(
        specs.ACCOUNT_VERSIONS,
        """
        a|A|STANDARD|EU|ACTIVE|2025-01-01 00:00:00|1
        a|A|PREMIUM|EU|ACTIVE|2025-01-02 06:00:00|2
        a|A|ENTERPRISE|EU|ACTIVE|2025-01-02 18:00:00|2
        """,
    )
    orders = raw(
        specs.ACCOUNT_ORDERS,
        "o1|a|2025-01-02 07:00:00|1.00\no2|a|2025-01-02 18:00:00|2.00\no3|b|2025-01-02 18:00:00|2.00",
    )
    runs.accounts(warehouse, versions, orders, 1, "2025-01-01 22:00:00")
    done = runs.accounts(warehouse, versions, orders, 2, "2025-01-02 22:00:00")
    # The middle version was overwritten within one night: no run ever saw it.
    assert bag(done["orders_attributed"], "order_id", "tier_at_order", "current_tier") == [
        ("o1", "STANDARD", "ENTERPRISE"),
        ("o2", "ENTERPRISE", "ENTERPRISE"),
        ("o3", "UNKNOWN", "UNKNOWN"),
    ]
    assert len(statuses(done)) == 39


# --- the remaining projects ----------------------------------------------------------------------


def test_projects_rebuilt_on_every_run(warehouse, raw, bag):
    done = runs.customer_orders(
        warehouse,
        raw(specs.CUSTOMERS, "1|Ada|ADA@X.ORG|2025-01-01|FR\n2|Ben|b@x.org|2025-01-01|NL"),
        raw(specs.CUSTOMER_ORDERS, "7|1|2025-01-02 00:00:00|5.00|completed\n8||2025-01-02 00:00:00|1.00|x"),
    )
    assert bag(done["customer_orders"]) == [(1, "Ada", 1, "5.00"), (2, "Ben", 0, "0.00")]
    done = runs.region_revenue(
        warehouse,
        raw(
            specs.ORDER_EXPORT,
            """
            1|c|FR| Pending|2025-01-01 00:00:00|9.00|2025-01-02 00:00:00
            1|c|FR|COMPLETED|2025-01-01 00:00:00|8.00|2025-01-03 00:00:00
            2|c|JP|cancelled|2025-01-01 00:00:00||2025-01-03 00:00:00
            """,
        ),
        raw(specs.COUNTRY_REGION, "FR|EMEA"),
    )
    assert bag(done["region_revenue"]) == [("EMEA", 1, 1, "8.00"), ("Unmapped", 1, 0, "0.00")]
    done = runs.plan_usage(
        warehouse,
        raw(specs.PLANS, "p|P|mid|9.00\nq|Q|top|"),
        raw(specs.SUBSCRIPTIONS, "s1|a|p|active|2025-01-01\ns2|b|p|churned|2025-01-01"),
        raw(specs.USAGE_EVENTS, "e1|s1|2025-01-01|calls||true\ne2|s2|2025-01-01|calls|5|true"),
    )
    assert bag(done["plan_usage"]) == [("p", 2, 1, 1, 0)]
    assert bag(done["plan_catalogue"], "plan_code", "is_custom_priced") == [("p", False), ("q", True)]
    done = runs.merchant_month_payments(
        warehouse,
        raw(specs.MERCHANT_ORDERS, "o1|m|2025-01-31 23:00:00\no2|m|2025-02-01 00:00:00"),
        raw(
            specs.MERCHANT_PAYMENTS,
            "p1|o1|CARD|captured|5.00|2025-02-02 00:00:00\np2|o1||captured|1.00|2025-02-02 00:00:00",
        ),
        ["card"],
    )
    assert bag(done["merchant_month_payments"]) == [
        ("m", "2025-01-01", 1, "6.00", 1, "5.00", 1, "1.00"),
        ("m", "2025-02-01", 1, "0.00", 0, "0.00", 0, "0.00"),
    ]


def test_shipments_reopen_the_newest_day_only(warehouse, raw, bag):
    shipments = raw(
        specs.SHIPMENTS,
        """
        s1|W|2025-01-01|IN_TRANSIT|5.00|2025-01-01 09:00:00|1
        s2|W|2025-01-02|IN_TRANSIT|6.00|2025-01-02 09:00:00|1
        s2|W|2025-01-02|CANCELLED|6.00|2025-01-03 09:00:00|2
        s3|V|2025-01-02|DELIVERED|7.00|2025-01-03 09:00:00|2
        """,
    )
    items = raw(specs.SHIPMENT_ITEMS, "i1|s1|k|2|1.000|1\ni2|s2|k|3|1.000|1\ni3|s3|k|4|0.500|2")
    first = runs.daily_shipments(warehouse, shipments, items, batch=1)
    assert bag(first["daily_shipments"], "ship_date", "warehouse_code") == [
        ("2025-01-01", "W"),
        ("2025-01-02", "W"),
    ]
    second = runs.daily_shipments(warehouse, shipments, items, batch=2)
    assert bag(second["daily_shipments"]) == [
        ("2025-01-01", "W", 1, 0, "5.00", 2, "1.000"),
        ("2025-01-02", "V", 1, 1, "7.00", 4, "0.500"),
    ]
