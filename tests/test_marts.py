"""Marts on small literal feeds; every row is there for a boundary case."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import pivot, temporal
from tidemark.plans import marts


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema}


def test_customer_orders(rows, bag):
    customers = rows("customer_id int, customer_name string", (1, "Ada"), (2, "Ben"), (3, "Cleo"))
    orders = rows(
        "order_id int, customer_id int, amount decimal(10,2)",
        (1, 1, "20.50"), (2, 1, None), (3, 2, None), (4, None, "99.00"), (5, None, "1.00"),
    )
    mart = marts.customer_orders(customers, orders)
    assert bag(mart) == [(1, "Ada", 2, "20.50"), (2, "Ben", 1, "0.00"), (3, "Cleo", 0, "0.00")]
    assert types(mart)["total_amount"] == "decimal(10,2)"
    assert types(marts.customer_orders(customers, orders, wide=True))["total_amount"] == "decimal(28,2)"


def test_region_revenue_takes_the_newest_export_only(rows, bag):
    export = rows(
        "order_id int, country_code string, order_status string, amount_usd decimal(12,2), "
        "exported_at timestamp_ntz",
        (1, "FR", "pending", "10.00", "2025-01-01 00:00:00"),
        (1, "FR", "completed", "12.00", "2025-01-02 00:00:00"),
        (2, "FR", "completed", None, "2025-01-01 00:00:00"),
        (3, "BR", "cancelled", "7.00", "2025-01-01 00:00:00"),
        (4, "??", "completed", "5.00", "2025-01-01 00:00:00"),
        (5, None, "pending", "1.00", "2025-01-01 00:00:00"),
    )
    lookup = rows("country_code string, region string", ("FR", "EMEA"), ("BR", "LATAM"), ("JP", "APAC"))
    mart = marts.region_revenue(marts.latest_export(export), lookup)
    assert bag(mart) == [
        ("EMEA", 2, 2, "12.00"),
        ("LATAM", 1, 0, "0.00"),
        ("Unmapped", 2, 1, "5.00"),
    ]


@pytest.fixture
def usage(rows):
    subscriptions = rows(
        "subscription_id string, plan_code string, status string",
        ("s1", "basic", "active"), ("s2", "basic", "churned"), ("s3", "pro", "active"),
        ("s4", "idle", "active"), ("s5", "trial", "trialing"),
    )
    events = rows(
        "event_id string, subscription_id string, event_date date, units int, is_billable boolean",
        ("e1", "s1", "2025-01-01", 10, True), ("e2", "s1", "2025-01-02", None, True),
        ("e3", "s1", "2025-01-02", 99, False), ("e4", "s2", "2025-01-02", 50, True),
        ("e5", "s3", "2025-01-02", None, True), ("e6", "s4", "2025-01-02", 7, False),
        ("e7", "s5", "2025-01-02", 7, True), ("e8", "s1", "2025-01-02", 7, None),
    )
    return subscriptions, events


def test_plan_usage_counts_events_without_units(usage, bag):
    subscriptions, events = usage
    mart = marts.plan_usage(subscriptions, events)
    assert bag(mart) == [
        ("basic", 2, 1, 2, 10),
        ("idle", 1, 1, 0, 0),
        ("pro", 1, 1, 1, 0),
        ("trial", 1, 0, 0, 0),
    ]
    assert types(mart)["billable_units"] == "int"


def test_billable_usage_leaves_units_alone(usage, bag):
    subscriptions, events = usage
    detail = marts.billable_usage(events, subscriptions)
    assert bag(detail, "event_id", "plan_code", "units") == [
        ("e1", "basic", 10),
        ("e2", "basic", None),
        ("e5", "pro", None),
    ]


def test_plan_catalogue_flags_custom_prices(rows, bag):
    plans = rows(
        "plan_code string, plan_name string, tier string, monthly_price_usd decimal(10,2)",
        ("a", "A", "low", "9.99"), ("b", "B", "top", None), ("c", "C", "low", "0.00"),
    )
    assert bag(marts.plan_catalogue(plans), "plan_code", "is_custom_priced") == [
        ("a", False),
        ("b", True),
        ("c", False),
    ]


def test_seller_payouts_keep_two_grains_apart(rows, bag):
    sellers = rows("seller_id string, seller_name string", ("s1", "One"), ("s2", "Two"), ("s9", "Idle"))
    payouts = rows(
        "payout_id string, seller_id string, status string, payout_amount decimal(12,2)",
        ("p1", "s1", "PAID", "100.00"), ("p2", "s1", "FAILED", "40.00"), ("p3", "s2", "PENDING", "5.00"),
        ("p4", "s3", "PAID", "1.00"),
    )
    lines = rows("payout_id string", ("p1",), ("p1",), ("p1",), ("p2",), (None,), ("p77",))
    assert bag(marts.seller_payouts(sellers, payouts, lines)) == [
        ("s1", "One", 2, 1, "100.00", 4),
        ("s2", "Two", 1, 0, "0.00", 0),
        ("s3", None, 1, 1, "1.00", 0),
    ]


SHIPMENTS = (
    "shipment_id string, warehouse_code string, ship_date date, status string, "
    "shipping_cost_usd decimal(10,2), updated_at timestamp_ntz"
)
ITEMS = "shipment_id string, quantity int, line_weight_kg decimal(9,3)"


@pytest.mark.parametrize("since", [None, "2025-01-02"])
def test_cancelled_shipments_do_not_fall_back_to_an_older_state(rows, bag, since):
    log = rows(
        SHIPMENTS,
        ("a", "W1", "2025-01-02", "IN_TRANSIT", "5.00", "2025-01-02 08:00:00"),
        ("a", "W1", "2025-01-02", "DELIVERED", "6.00", "2025-01-03 08:00:00"),
        ("b", "W1", "2025-01-02", "IN_TRANSIT", "7.00", "2025-01-02 08:00:00"),
        ("b", "W1", "2025-01-02", "CANCELLED", "7.00", "2025-01-03 08:00:00"),
        ("c", "W2", "2025-01-02", "CANCELLED", "7.00", "2025-01-03 08:00:00"),
        ("d", "W3", "2025-01-03", "IN_TRANSIT", "1.00", "2025-01-03 08:00:00"),
        ("e", "W3", "2025-01-01", "DELIVERED", "1.00", "2025-01-01 08:00:00"),
    )
    items = rows(ITEMS, ("a", 2, "1.500"), ("a", 3, "0.250"), ("b", 9, "9.000"), ("e", 1, "1.000"))
    mart = marts.daily_shipments(log, items, since and __import__("datetime").date.fromisoformat(since))
    want = [
        ("2025-01-01", "W3", 1, 1, "1.00", 1, "1.000"),
        ("2025-01-02", "W1", 1, 1, "6.00", 5, "1.750"),
        ("2025-01-03", "W3", 1, 0, "1.00", 0, "0.000"),
    ]
    assert bag(mart) == (want if since is None else want[1:])


def test_daily_payouts_with_and_without_lines(rows, bag):
    deliveries = rows(
        "delivery_id string, city_code string, delivery_date date, status string, "
        "payout_base_usd decimal(10,2)",
        ("d1", "A", "2025-01-01", "COMPLETED", "8.00"), ("d2", "A", "2025-01-01", "RETURNED", "2.00"),
        ("d3", "A", "2025-01-01", "CANCELLED", "9.00"), ("d4", "B", "2025-01-01", "CANCELLED", "9.00"),
    )
    lines = rows(
        "delivery_id string, adj_amount_usd decimal(10,2)",
        ("d1", "1.50"), ("d1", "-4.00"), ("d3", "7.00"),
    )
    assert bag(marts.daily_payouts(deliveries, lines)) == [
        ("2025-01-01", "A", 2, 1, "10.00", "-2.50", "7.50")
    ]


def test_orders_are_attributed_then_and_now(rows, bag):
    history = rows(
        "account_id string, account_name string, contract_tier string, billing_region string, "
        "account_status string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_deleted boolean",
        ("a", "A", "BASIC", "EU", "ACTIVE", "2025-01-02 00:00:00", "2025-01-05 12:00:00", False),
        ("a", "A", "GOLD", "UK", "ACTIVE", "2025-01-05 12:00:00", None, False),
        ("b", "B", "GOLD", "EU", "ACTIVE", "2025-01-01 00:00:00", "2025-01-03 00:00:00", False),
        ("b", "B", "GOLD", "EU", "CHURNED", "2025-01-03 00:00:00", None, False),
        ("c", "C", "GOLD", "EU", None, "2025-01-03 00:00:00", None, False),
    )
    current = marts.accounts_current(history)
    assert bag(current) == [("a", "A", "GOLD", "UK", "2025-01-05 12:00:00")]
    orders = rows(
        "order_id string, account_id string, order_ts timestamp_ntz, order_amount_usd decimal(10,2)",
        ("o1", "a", "2025-01-01 23:59:59", "1.00"), ("o2", "a", "2025-01-05 11:59:59", "1.00"),
        ("o3", "a", "2025-01-05 12:00:00", "1.00"), ("o4", "b", "2025-01-09 00:00:00", "1.00"),
        ("o5", "zz", "2025-01-09 00:00:00", "1.00"),
    )
    mart = marts.orders_attributed(orders, history, current)
    assert bag(mart, "order_id", "tier_at_order", "region_at_order", "current_tier") == [
        ("o1", "UNKNOWN", "UNKNOWN", "GOLD"),
        ("o2", "BASIC", "EU", "GOLD"),
        ("o3", "GOLD", "UK", "GOLD"),
        ("o4", "GOLD", "EU", "UNKNOWN"),
        ("o5", "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ]


def test_employees_today_and_headcount(rows, bag):
    dumps = rows(
        "employee_id string, full_name string, department_code string, job_title string, "
        "salary_band string, last_login_at timestamp_ntz, b int",
        ("e1", "Ida", "R", "t", "1", "2025-01-01 08:00:00", 1),
        ("e2", "Jo", "R", "t", "1", "2025-01-01 08:00:00", 1),
        ("e1", "Ida K", "R", "t", "1", "2025-01-02 08:00:00", 2),
        ("e1", "Ida K", "S", "t", "1", "2025-01-03 08:00:00", 3),
        ("e2", "Jo", "R", "t", "1", "2025-01-03 09:00:00", 3),
    )
    runs = [(n, f"2025-01-0{n} 20:00:00") for n in (1, 2, 3)]
    history = marts.employee_history(
        temporal.scd2_from_dumps(dumps, ["employee_id"], marts.TRACKED, "b", runs)
    )
    dump = dumps.where("b = 3").drop("b")
    current = marts.employees_current(history, dump)
    shown = ("employee_id", "full_name", "department_code", "last_login_at", "current_since")
    assert bag(current, *shown) == [
        ("e1", "Ida K", "S", "2025-01-03 08:00:00", "2025-01-03 20:00:00"),
        ("e2", "Jo", "R", "2025-01-03 09:00:00", "2025-01-03 20:00:00"),
    ]
    departments = rows("department_code string, department_name string", ("R", "Res"), ("S", "Sal"), ("T", "Tax"))
    assert bag(marts.department_headcount(departments, current, history)) == [
        ("R", "Res", 1, 1),
        ("S", "Sal", 1, 0),
        ("T", "Tax", 0, 0),
    ]


def test_invoice_revenue_keeps_unbilled_invoices_visible(rows, bag):
    invoices = rows(
        "invoice_id string, customer_id string, invoiced_at timestamp_ntz",
        ("i1", "c", "2025-01-01 10:00:00"), ("i2", "c", "2025-01-02 00:00:00"),
        ("i3", "c", "2025-01-02 09:00:00"),
    )
    lines = rows("invoice_id string, amount_usd decimal(10,2)", ("i1", "5.00"), ("i1", "6.00"), ("i2", "1.00"))
    payments = rows("invoice_id string, amount_usd decimal(10,2)", ("i1", "2.00"), ("i1", "2.00"))
    history = rows(
        "customer_id string, plan_code string, valid_from timestamp_ntz, valid_to timestamp_ntz",
        ("c", "S", "2024-01-01 00:00:00", "2025-01-02 00:00:00"), ("c", "G", "2025-01-02 00:00:00", None),
    )
    detail = marts.invoice_revenue(invoices, lines, payments, history)
    assert bag(detail, "invoice_id", "plan_code", "billed_usd", "collected_usd") == [
        ("i1", "S", "11.00", "4.00"),
        ("i2", "G", "1.00", "0.00"),
        ("i3", "G", None, "0.00"),
    ]
    mart = marts.daily_revenue(detail.where("billed_usd is not null"))
    assert bag(mart) == [
        ("2025-01-01", "S", 1, "11.00", "4.00", "7.00"),
        ("2025-01-02", "G", 1, "1.00", "0.00", "1.00"),
    ]


@pytest.fixture
def tenders(rows):
    orders = rows(
        "order_id string, merchant_id string, ordered_at timestamp_ntz",
        ("o1", "m", "2025-01-31 23:59:59"), ("o2", "m", "2025-01-02 00:00:00"),
        ("o3", "m", "2025-02-01 00:00:00"), ("o4", "n", "2025-01-15 00:00:00"),
    )
    payments = rows(
        "payment_id string, order_id string, payment_method string, status string, "
        "amount_usd decimal(10,2)",
        ("p1", "o1", "card", "captured", "10.00"), ("p2", "o1", "card", "captured", "5.00"),
        ("p3", "o1", None, "captured", "1.00"), ("p4", "o2", "card", "captured", "2.00"),
        ("p5", "o2", "voucher", "captured", "3.00"), ("p6", "o3", "card", "failed", "9.00"),
    )
    return orders, payments


def test_pivot_counts_orders_not_payments(tenders, bag):
    mart = marts.merchant_month_payments(*tenders, ["card"])
    assert mart.columns[2:] == [
        "order_count", "captured_amount_usd", "card_order_count", "card_amount_usd",
        "other_order_count", "other_amount_usd",
    ]
    assert bag(mart) == [
        ("m", "2025-01-01", 2, "21.00", 2, "17.00", 2, "4.00"),
        ("m", "2025-02-01", 1, "0.00", 0, "0.00", 0, "0.00"),
        ("n", "2025-01-01", 1, "0.00", 0, "0.00", 0, "0.00"),
    ]
    assert types(mart)["card_order_count"] == "int"


def test_pivot_columns_follow_the_list(tenders, bag):
    longer = marts.merchant_month_payments(*tenders, ["card", "VOUCHER"])
    assert bag(longer.where("order_count = 2"), "voucher_order_count", "other_amount_usd") == [(1, "1.00")]
    empty = marts.merchant_month_payments(*tenders, [])
    assert bag(empty.where("order_count = 2"), "other_order_count", "other_amount_usd") == [(2, "21.00")]


@pytest.mark.parametrize("bad", [None, "card", ["card", "Card"], ["other"], ["gift card"], ["1st"]])
def test_pivot_refuses_unusable_lists(bad):
    with pytest.raises(ValueError):
        pivot.listed(bad)


def test_long_form_and_melt_agree_with_the_pivot(tenders, bag):
    orders, payments = tenders
    captured = marts.captured_payments(payments, orders)
    assert bag(captured.where("payment_id = 'p3'"), "merchant_id", "order_month", "payment_method") == [
        ("m", "2025-01-01", None)
    ]
    long = pivot.long_metrics(
        captured, "order_id", ["merchant_id", "order_month"], "payment_method", "amount_usd"
    )
    assert bag(long, "payment_method", "order_count", "amount_usd") == [
        (None, 1, "1.00"),
        ("card", 2, "17.00"),
        ("voucher", 1, "3.00"),
    ]
    melted = pivot.melt_metrics(
        marts.merchant_month_payments(orders, payments, ["card"]), ["merchant_id", "order_month"], ["card"]
    )
    assert bag(melted.where("order_count > 0"), "bucket", "order_count", "amount_usd") == [
        ("card", 2, "17.00"),
        ("other", 2, "4.00"),
    ]


def test_engagement_counts_distinct_transactions(rows, bag):
    sale = lambda c, t, k: (c, t, k)
    sales = rows(
        "customer_id bigint, transaction_id bigint, class string",
        *[sale(1, t, "BASE") for t in range(10)], sale(1, 3, " GWP "), sale(1, 3, "GWP"),
        *[sale(2, t, "GWP") for t in range(9)], sale(2, None, "GWP"),
        *[sale(3, t, "BASE") for t in range(11)], sale(3, 0, "GWP"),
        *[sale(4, t, None) for t in range(16)], sale(4, 0, "GWP"), sale(4, 1, "GWP"),
    )
    assert bag(marts.engagement(sales, "GWP")) == [(1, "10.00"), (4, "12.50")]
    assert bag(marts.engaged_customers(sales, "GWP")) == [(1,), (4,)]
    assert bag(marts.engagement(sales, "GWP", min_rate=9).where(F.col("customer_id") == 3)) == [
        (3, "9.09")
    ]
