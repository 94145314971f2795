"""The checks that come with each mart: on its feeds, its intermediate frames and itself.

Fixed values: the columns checked, the accepted values, the severities and the number of checks
per project are part of the published contracts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks, history_checks, pivot, reconcile
from ..operators.checks import WARN, Check, CheckSuite
from . import marts

_KINDS = {"unique": checks.unique, "not_null": checks.not_null}

CURRENCIES = ("USD", "EUR", "GBP")
MARKETS = ("US", "DE", "GB", "PE")
METHODS = ("bank_transfer", "paypal", "wise")
TIERS = ("STANDARD", "PREMIUM", "ENTERPRISE")
PLAN_CODES = ("STARTER", "GROWTH", "SCALE")
BANDS = ("B1", "B2", "B3", "B4", "B5")


def bind(text: str) -> list[Check]:
    """``column kind kind ...`` per entry, entries separated by commas."""
    bound = []
    for entry in text.split(","):
        column, *kinds = entry.split()
        bound += [_KINDS[kind](column) for kind in kinds]
    return bound


def suite(name: str, table: DataFrame, text: str, *others: Check) -> CheckSuite:
    return CheckSuite(name, table, [*bind(text), *others])


def _failing_ties(published: DataFrame, totals: dict) -> DataFrame:
    return reconcile.tie_out(published, totals).where(F.col("difference") != 0)


def customer_feeds(customers: DataFrame, orders: DataFrame) -> list[CheckSuite]:
    known = checks.relationships("customer_id", customers, "customer_id")
    return [
        suite("customers", customers, "customer_id unique not_null, email not_null"),
        suite("customer_orders", orders, "order_id unique not_null", known),
    ]


def customer_orders(mart: DataFrame, customers: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "customer_order_summary",
            mart,
            "customer_id unique not_null, order_count not_null, total_amount not_null",
            checks.relationships("customer_id", customers, "customer_id"),
        ),
    ]


def export_feeds(
    export: DataFrame, orders: DataFrame, country_region: DataFrame
) -> list[CheckSuite]:
    """``export`` is the source as delivered: there an order may occur more than once."""
    return [
        suite("erp.orders", export, "ORDER_ID not_null, EXPORTED_AT not_null"),
        suite(
            "latest_export",
            orders,
            "order_id unique not_null, order_status not_null, country_code not_null, "
            "exported_at not_null",
            checks.accepted_values("order_status", ["completed", "pending", "cancelled"]),
        ),
        suite(
            "country_region", country_region, "country_code unique not_null, region not_null"
        ),
    ]


def region_revenue(mart: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "region_revenue",
            mart,
            "region unique not_null, total_order_count not_null, "
            "completed_order_count not_null, gross_revenue_usd not_null",
        ),
    ]


def usage_feeds(
    plans: DataFrame, subscriptions: DataFrame, events: DataFrame, billable: DataFrame
) -> list[CheckSuite]:
    return [
        suite(
            "plans",
            plans,
            "plan_code unique not_null, plan_name not_null, tier not_null",
            checks.accepted_values("tier", ["entry", "mid", "top"]),
        ),
        suite(
            "subscriptions",
            subscriptions,
            "subscription_id unique not_null, plan_code not_null, status not_null",
            checks.relationships("plan_code", plans, "plan_code"),
            checks.accepted_values("status", ["active", "churned", "trialing"]),
        ),
        suite(
            "usage_events",
            events,
            "event_id unique not_null, subscription_id not_null, is_billable not_null",
            checks.relationships("subscription_id", subscriptions, "subscription_id"),
        ),
        suite("billable_usage", billable, "event_id unique not_null, plan_code not_null"),
    ]


def plan_usage(mart: DataFrame, catalogue: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "plan_usage",
            mart,
            "plan_code unique not_null, subscription_count not_null, "
            "active_subscription_count not_null, billable_event_count not_null, "
            "billable_units not_null",
        ),
        suite(
            "plan_catalogue",
            catalogue,
            "plan_code unique not_null, plan_name not_null, tier not_null, "
            "is_custom_priced not_null",
        ),
    ]


def payout_feeds(sellers: DataFrame, payouts: DataFrame, lines: DataFrame) -> list[CheckSuite]:
    """Three faults of the line feed are known: they are reported on every run and never block."""
    paid = payouts.where(F.col("status") == "PAID")
    return [
        suite(
            "sellers",
            sellers,
            "seller_id unique not_null, seller_name not_null, country not_null",
            checks.accepted_values("country", MARKETS),
        ),
        suite(
            "payouts",
            payouts,
            "payout_id unique not_null, seller_id not_null, status not_null, currency not_null, "
            "payout_amount not_null",
            checks.relationships("seller_id", sellers, "seller_id"),
            checks.accepted_values("status", ["PAID", "PENDING", "FAILED"]),
            checks.accepted_values("currency", CURRENCIES),
            checks.not_negative("payout_amount"),
            checks.singular(
                "paid_payout_has_lines", checks.without_children(paid, lines, "payout_id")
            ),
            checks.singular(
                "payout_amount_equals_lines",
                checks.header_not_equal_lines(
                    payouts, lines, "payout_id", "payout_amount", "line_amount"
                ),
            ),
        ),
        suite(
            "payout_lines",
            lines,
            "line_id unique not_null, line_amount not_null",
            checks.not_null("payout_id", WARN),
            checks.relationships("payout_id", payouts, "payout_id", WARN),
            checks.not_null("currency", WARN),
            checks.accepted_values("currency", CURRENCIES),
            checks.accepted_values("payment_method", METHODS),
            checks.not_negative("line_amount"),
        ),
    ]


def seller_payouts(mart: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "seller_payouts",
            mart,
            "seller_id unique not_null, payout_count not_null, paid_payout_count not_null, "
            "paid_amount not_null, line_count not_null",
            checks.not_negative("paid_amount"),
        ),
    ]


def shipment_feeds(log: DataFrame, items: DataFrame, totals: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "shipments",
            log,
            "shipment_id not_null, warehouse_code not_null, ship_date not_null, status not_null, "
            "shipping_cost_usd not_null, updated_at not_null",
            checks.accepted_values("status", ["DELIVERED", "IN_TRANSIT", "CANCELLED"]),
        ),
        suite(
            "shipment_items",
            items,
            "item_id unique not_null, shipment_id not_null, quantity not_null, "
            "line_weight_kg not_null",
            checks.relationships("shipment_id", log, "shipment_id"),
        ),
        suite(
            "shipment_totals",
            totals,
            "shipment_id unique not_null, ship_date not_null, warehouse_code not_null",
        ),
    ]


def daily_shipments(mart: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "daily_shipments",
            mart,
            "ship_date not_null, warehouse_code not_null, shipment_count not_null, "
            "delivered_count not_null, shipping_cost_usd not_null, item_quantity not_null, "
            "total_weight_kg not_null",
            checks.grain_unique(["ship_date", "warehouse_code"]),
            checks.row_rule("shipment_count_at_least_one", F.col("shipment_count") >= 1),
            checks.row_rule(
                "delivered_not_above_shipments", F.col("delivered_count") <= F.col("shipment_count")
            ),
        ),
    ]


def delivery_feeds(
    deliveries: DataFrame, adjustments: DataFrame, totals: DataFrame
) -> list[CheckSuite]:
    return [
        suite(
            "deliveries",
            deliveries,
            "delivery_id unique not_null, city_code not_null, delivery_date not_null, "
            "status not_null, payout_base_usd not_null, loaded_at not_null",
            checks.accepted_values("status", ["COMPLETED", "RETURNED", "CANCELLED"]),
        ),
        suite(
            "delivery_adjustments",
            adjustments,
            "adjustment_id unique not_null, delivery_id not_null, adj_type not_null, "
            "adj_amount_usd not_null",
            checks.relationships("delivery_id", deliveries, "delivery_id"),
            checks.accepted_values("adj_type", ["TIP", "SURGE", "PENALTY"]),
        ),
        suite(
            "delivery_totals",
            totals,
            "delivery_id unique not_null, city_code not_null, delivery_date not_null, "
            "status not_null, payout_base_usd not_null, adjustment_total_usd not_null",
            checks.accepted_values("status", ["COMPLETED", "RETURNED"]),
        ),
    ]


def daily_payouts(mart: DataFrame, deliveries: DataFrame) -> list[CheckSuite]:
    staged = (
        deliveries.where(F.col("status") != "CANCELLED")
        .groupBy("delivery_date", "city_code")
        .agg(F.count("*").alias("delivery_count"))
    )
    both_ways = reconcile.reconcile(
        staged, mart, ["delivery_date", "city_code"], ["delivery_count"], ("staged", "published")
    )
    parts = F.col("payout_base_usd") + F.col("adjustment_total_usd")
    return [
        suite(
            "daily_payouts",
            mart,
            "delivery_date not_null, city_code not_null, delivery_count not_null, "
            "completed_count not_null, payout_base_usd not_null, adjustment_total_usd not_null, "
            "total_payout_usd not_null",
            checks.grain_unique(["delivery_date", "city_code"]),
            checks.row_rule("delivery_count_at_least_one", F.col("delivery_count") >= 1),
            checks.row_rule(
                "completed_not_above_deliveries",
                F.col("completed_count") <= F.col("delivery_count"),
            ),
            checks.singular("reconciles_with_staging_both_ways", both_ways),
            checks.row_rule("total_is_base_plus_adjustments", F.col("total_payout_usd") == parts),
        ),
    ]


def account_feeds(versions: DataFrame, orders: DataFrame, latest: DataFrame) -> list[CheckSuite]:
    return [
        suite(
            "account_versions",
            versions,
            "account_id not_null, account_name not_null, contract_tier not_null, "
            "billing_region not_null, account_status not_null, updated_at not_null",
            checks.accepted_values("contract_tier", TIERS),
            checks.accepted_values("account_status", ["ACTIVE", "CHURNED"]),
        ),
        suite(
            "account_orders",
            orders,
            "order_id unique not_null, account_id not_null, order_ts not_null, "
            "order_amount_usd not_null",
        ),
        suite("account_feed_latest", latest, "account_id unique not_null"),
    ]


def accounts_history(history: DataFrame) -> list[CheckSuite]:
    key = ["account_id"]
    return [
        suite(
            "accounts_history",
            history,
            "account_id not_null, contract_tier not_null, valid_from not_null",
            checks.accepted_values("contract_tier", TIERS),
            checks.singular("exactly_one_open", history_checks.not_one_open(history, key)),
            checks.singular("no_overlap_no_empty", history_checks.window_overlaps(history, key)),
        ),
    ]


def accounts(
    current: DataFrame, attributed: DataFrame, orders: DataFrame, history: DataFrame
) -> list[CheckSuite]:
    key = ["account_id"]
    return [
        suite(
            "accounts_current",
            current,
            "account_id unique not_null, account_name not_null, contract_tier not_null, "
            "billing_region not_null, current_since not_null",
        ),
        suite(
            "orders_attributed",
            attributed,
            "order_id unique not_null, account_id not_null, order_ts not_null, "
            "order_amount_usd not_null, tier_at_order not_null, region_at_order not_null, "
            "current_tier not_null",
            checks.accepted_values("tier_at_order", [*TIERS, marts.UNKNOWN]),
            checks.singular(
                "reconciles_with_orders",
                reconcile.reconcile(orders, attributed, ["order_id"], ["order_amount_usd"]),
            ),
            checks.singular(
                "unknown_only_without_covering_version",
                history_checks.default_though_covered(
                    attributed, history, key, "order_ts", "tier_at_order", marts.UNKNOWN,
                    "contract_tier",
                ),
            ),
            checks.singular(
                "current_tier_matches_dimension",
                history_checks.current_differs(
                    attributed, current, key, "current_tier", "contract_tier", marts.UNKNOWN
                ),
            ),
        ),
    ]


def employee_feeds(dump: DataFrame, departments: DataFrame) -> list[CheckSuite]:
    department = checks.relationships("department_code", departments, "department_code")
    return [
        suite(
            "employee_dump",
            dump,
            "employee_id unique not_null, full_name not_null, department_code not_null, "
            "job_title not_null, salary_band not_null, record_updated_at not_null",
            department,
            checks.accepted_values("salary_band", BANDS),
        ),
        suite(
            "departments", departments, "department_code unique not_null, department_name not_null"
        ),
    ]


def employees_history(history: DataFrame, view: DataFrame, dump: DataFrame) -> list[CheckSuite]:
    """``history`` is the stored one, ``view`` its typed interface."""
    key, tracked = ["employee_id"], list(marts.TRACKED)
    return [
        suite(
            "employees_history",
            history,
            "employee_id not_null, department_code not_null, job_title not_null, "
            "salary_band not_null, valid_from not_null, is_deleted not_null",
            checks.accepted_values("is_deleted", [True, False]),
            checks.singular("exactly_one_open", history_checks.not_one_open(history, key)),
            checks.singular("no_overlap_no_empty", history_checks.window_overlaps(history, key)),
            checks.singular(
                "open_versions_match_dump",
                history_checks.open_not_matching_dump(history, dump, key, tracked),
            ),
            checks.singular(
                "no_redundant_versions", history_checks.redundant_versions(history, key, tracked)
            ),
        ),
        suite(
            "employee_history",
            view,
            "employee_id not_null, valid_from not_null, is_deleted not_null, is_current not_null",
        ),
    ]


def employees(
    current: DataFrame,
    headcount: DataFrame,
    dump: DataFrame,
    departments: DataFrame,
    history: DataFrame,
) -> list[CheckSuite]:
    key = ["employee_id"]
    department = checks.relationships("department_code", departments, "department_code")
    ties = _failing_ties(
        headcount,
        {
            "headcount": (F.sum("current_headcount"), current, F.count("*")),
            "terminations": (
                F.sum("terminations_to_date"),
                history.where("is_deleted"),
                F.count("*"),
            ),
        },
    )
    return [
        suite(
            "employees_current",
            current,
            "employee_id unique not_null, full_name not_null, department_code not_null, "
            "job_title not_null, salary_band not_null, current_since not_null",
            department,
            checks.singular("reconciles_with_dump", reconcile.reconcile(dump, current, key)),
        ),
        suite(
            "department_headcount",
            headcount,
            "department_code unique not_null, department_name not_null, "
            "current_headcount not_null, terminations_to_date not_null",
            checks.singular("totals_tie_out", ties),
        ),
    ]


def billing_feeds(
    customers: DataFrame, invoices: DataFrame, lines: DataFrame, payments: DataFrame
) -> list[CheckSuite]:
    invoice = checks.relationships("invoice_id", invoices, "invoice_id")
    return [
        suite(
            "customer_dump",
            customers,
            "customer_id unique not_null, customer_name not_null, plan_code not_null, "
            "updated_at not_null",
            checks.accepted_values("plan_code", PLAN_CODES),
        ),
        suite(
            "invoices",
            invoices,
            "invoice_id unique not_null, customer_id not_null, invoiced_at not_null",
            checks.relationships("customer_id", customers, "customer_id"),
        ),
        suite(
            "invoice_lines",
            lines,
            "line_id unique not_null, invoice_id not_null, amount_usd not_null",
            invoice,
            checks.accepted_values("line_type", ["SUBSCRIPTION", "USAGE", "SEATS"]),
        ),
        suite(
            "invoice_payments",
            payments,
            "payment_id unique not_null, invoice_id not_null, paid_at not_null, "
            "amount_usd not_null",
            invoice,
        ),
    ]


def customers_history(history: DataFrame) -> list[CheckSuite]:
    key = ["customer_id"]
    return [
        suite(
            "customers_history",
            history,
            "customer_id not_null, plan_code not_null, valid_from not_null",
            checks.singular("versions_tile_timelines", history_checks.not_tiling(history, key)),
        ),
    ]


def daily_revenue(
    revenue: DataFrame,
    mart: DataFrame,
    invoices: DataFrame,
    lines: DataFrame,
    payments: DataFrame,
    history: DataFrame,
    recent: DataFrame | None = None,
) -> list[CheckSuite]:
    """Totals are tied to the staged feeds, not to the frame the mart was built from.

    ``recent`` are the invoices that ``revenue`` should hold, where that is not all of them.
    """
    key = ["customer_id"]
    plan = checks.accepted_values("plan_code", PLAN_CODES)
    ties = _failing_ties(
        mart,
        {
            "invoices": (F.sum("invoice_count"), invoices, F.count("*")),
            "billed": (F.sum("billed_usd"), lines, F.sum("amount_usd")),
            "collected": (F.sum("collected_usd"), payments, F.sum("amount_usd")),
        },
    )
    return [
        suite(
            "invoice_revenue",
            revenue,
            "invoice_id unique not_null, invoice_date not_null, plan_code not_null, "
            "billed_usd not_null, collected_usd not_null",
            plan,
            checks.singular(
                "reconciles_with_invoices",
                reconcile.reconcile(invoices if recent is None else recent, revenue, ["invoice_id"]),
            ),
            checks.singular(
                "plan_is_latest_version_then",
                history_checks.attribution_differs(
                    revenue.select("invoice_id", "customer_id", "invoiced_at", "plan_code"),
                    history.select("customer_id", "valid_from", F.col("plan_code").alias("then")),
                    key,
                    "invoiced_at",
                    "plan_code",
                    "then",
                ),
            ),
        ),
        suite(
            "daily_revenue",
            mart,
            "invoice_date not_null, plan_code not_null, invoice_count not_null, "
            "billed_usd not_null, collected_usd not_null, outstanding_usd not_null",
            plan,
            checks.grain_unique(["invoice_date", "plan_code"]),
            checks.singular("totals_tie_out_to_staging", ties),
        ),
    ]


def merchant_feeds(
    orders: DataFrame, payments: DataFrame, captured: DataFrame
) -> list[CheckSuite]:
    return [
        suite(
            "merchant_orders",
            orders,
            "order_id unique not_null, merchant_id not_null, ordered_at not_null",
        ),
        suite(
            "merchant_payments",
            payments,
            "payment_id unique not_null, order_id not_null, status not_null, amount_usd not_null",
            checks.relationships("order_id", orders, "order_id"),
            checks.accepted_values("status", ["captured", "failed"]),
        ),
        suite(
            "captured_payments",
            captured,
            "payment_id unique not_null, order_id not_null, merchant_id not_null, "
            "order_month not_null, amount_usd not_null",
        ),
    ]


def merchant_month_payments(
    mart: DataFrame, orders: DataFrame, payments: DataFrame, methods: Sequence[str] | None
) -> list[CheckSuite]:
    """The generated columns are covered by checks generated from the same list."""
    staged = payments.where(F.col("status") == "captured")
    ties = _failing_ties(
        mart,
        {
            "orders": (F.sum("order_count"), orders, F.count("*")),
            "captured": (F.sum("captured_amount_usd"), staged, F.sum("amount_usd")),
        },
    )
    return [
        suite(
            "merchant_month_payments",
            mart,
            "merchant_id not_null, order_month not_null, order_count not_null, "
            "captured_amount_usd not_null",
            checks.singular(
                "generated_columns_populated", pivot.generated_not_populated(mart, methods)
            ),
            checks.singular(
                "methods_add_up_to_total", pivot.parts_not_equal_total(mart, methods)
            ),
            checks.grain_unique(["merchant_id", "order_month"]),
            checks.singular("totals_tie_out_to_staging", ties),
        ),
    ]


# Checks per project; a run whose suites hold another number stops (see ``runs``).
EXPECTED = {
    "customer_orders": 11,
    "region_revenue": 16,
    "plan_usage": 30,
    "seller_payouts": 33,
    "daily_shipments": 27,
    "daily_payouts": 35,
    "accounts": 39,
    "employees": 42,
    "daily_revenue": 45,
    "merchant_month_payments": 25,
}
