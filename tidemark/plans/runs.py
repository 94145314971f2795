"""One nightly run of each project: stage the raw feeds, build, store, check.

A run takes the raw feeds as delivered (see ``feeds``), the batch to process and the warehouse,
and returns what it published. Checks on the feeds run before anything is built from them, those
on a history before a mart reads it, the others on the stored marts. A failing error check raises
at its step, so nothing downstream is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import snapshot, upsert
from ..operators.checks import CheckCountMismatch, ChecksFailed, CheckSuite, run_suites
from ..sources import feeds
from ..sources.store import HistoryStore, MartStore
from . import feeds as specs
from . import marts, suites


@dataclass
class Warehouse:
    """Where a project's marts and histories live (a folder all executors reach)."""

    spark: SparkSession
    root: str

    @property
    def marts(self) -> MartStore:
        return MartStore(self.spark, f"{self.root}/marts")

    @property
    def histories(self) -> HistoryStore:
        return HistoryStore(self.spark, f"{self.root}/histories")


@dataclass
class Published:
    """A run's tables by name and the outcome of its checks (one row per check)."""

    tables: dict[str, DataFrame]
    results: DataFrame

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def _whole(warehouse: Warehouse, name: str, run: int, df: DataFrame) -> DataFrame:
    """A mart that is rebuilt on every run."""
    warehouse.marts.write(name, run, df)
    return warehouse.marts.read(name, before_run=run + 1)


def _incremental(
    warehouse: Warehouse,
    name: str,
    build: Callable[[date | upsert.Window | None], DataFrame],
    grain: str,
    run: int,
    lookback_days: int,
    full_refresh: bool,
    reopened: Callable[[date], DataFrame],
) -> DataFrame:
    return upsert.run_incremental(
        warehouse.marts, name, build, grain, run, lookback_days, full_refresh, reopened=reopened
    )


class Gate:
    """Runs a project's checks step by step; a failing error check raises there and then."""

    def __init__(self, project: str, spark: SparkSession):
        self.project, self.spark = project, spark
        self._rows, self._schema = [], None

    def check(self, bound: Sequence[CheckSuite]) -> None:
        results = run_suites(bound)
        rows = results.collect()  # one row per check
        self._rows, self._schema = self._rows + rows, results.schema
        failed = [r for r in rows if r.status == "error"]
        if failed:
            text = "; ".join(f"{r.table_name}.{r.check_name}: {r.failing_rows}" for r in failed)
            raise ChecksFailed(text)

    def publish(self, **tables: DataFrame) -> Published:
        """The run's result, provided that every check of the project has been run."""
        expected = suites.EXPECTED[self.project]
        if len(self._rows) != expected:
            raise CheckCountMismatch(f"{len(self._rows)} checks ran, {expected} expected")
        return Published(tables, self.spark.createDataFrame(self._rows, self._schema))


def customer_orders(
    warehouse: Warehouse, customers: DataFrame, orders: DataFrame, run: int = 1
) -> Published:
    people = feeds.stage(customers, specs.CUSTOMERS)
    placed = feeds.stage(orders, specs.CUSTOMER_ORDERS)
    gate = Gate("customer_orders", warehouse.spark)
    gate.check(suites.customer_feeds(people, placed))
    mart = _whole(warehouse, "customer_orders", run, marts.customer_orders(people, placed))
    gate.check(suites.customer_orders(mart, people))
    return gate.publish(customer_orders=mart)


def region_revenue(
    warehouse: Warehouse, export: DataFrame, country_region: DataFrame, run: int = 1
) -> Published:
    latest = marts.latest_export(feeds.stage(export, specs.ORDER_EXPORT))
    lookup = feeds.stage(country_region, specs.COUNTRY_REGION)
    gate = Gate("region_revenue", warehouse.spark)
    gate.check(suites.export_feeds(export, latest, lookup))
    mart = _whole(warehouse, "region_revenue", run, marts.region_revenue(latest, lookup))
    gate.check(suites.region_revenue(mart))
    return gate.publish(region_revenue=mart, latest_export=latest)


def plan_usage(
    warehouse: Warehouse,
    plans: DataFrame,
    subscriptions: DataFrame,
    events: DataFrame,
    run: int = 1,
) -> Published:
    """Usage is stored; the catalogue stays a view; billable usage exists only inside the mart."""
    plans = feeds.stage(plans, specs.PLANS)
    subscriptions = feeds.stage(subscriptions, specs.SUBSCRIPTIONS)
    events = feeds.stage(events, specs.USAGE_EVENTS)
    billable = marts.billable_usage(events, subscriptions)
    gate = Gate("plan_usage", warehouse.spark)
    gate.check(suites.usage_feeds(plans, subscriptions, events, billable))
    mart = _whole(warehouse, "plan_usage", run, marts.plan_usage(subscriptions, events))
    marts.plan_catalogue(plans).createOrReplaceTempView("plan_catalogue")
    catalogue = warehouse.spark.table("plan_catalogue")
    gate.check(suites.plan_usage(mart, catalogue))
    return gate.publish(plan_usage=mart, plan_catalogue=catalogue)


def seller_payouts(
    warehouse: Warehouse, sellers: DataFrame, payouts: DataFrame, lines: DataFrame, run: int = 1
) -> Published:
    sellers = feeds.stage(sellers, specs.SELLERS)
    payouts = feeds.stage(payouts, specs.PAYOUTS)
    lines = feeds.stage(lines, specs.PAYOUT_LINES)
    gate = Gate("seller_payouts", warehouse.spark)
    gate.check(suites.payout_feeds(sellers, payouts, lines))
    mart = _whole(warehouse, "seller_payouts", run, marts.seller_payouts(sellers, payouts, lines))
    gate.check(suites.seller_payouts(mart))
    return gate.publish(seller_payouts=mart)


def daily_shipments(
    warehouse: Warehouse,
    shipments: DataFrame,
    items: DataFrame,
    batch: int,
    full_refresh: bool = False,
) -> Published:
    """The newest stored day is still open and is rebuilt; earlier days are closed."""
    log = feeds.staged_upto(shipments, specs.SHIPMENTS, batch)
    lines = feeds.staged_upto(items, specs.SHIPMENT_ITEMS, batch)
    arrived = feeds.staged_exact(items, specs.SHIPMENT_ITEMS, batch)

    def reopened(since: date) -> DataFrame:
        return upsert.touched_dates(log, arrived, ["shipment_id"], "ship_date")

    gate = Gate("daily_shipments", warehouse.spark)
    window = upsert.run_window(
        warehouse.marts, "daily_shipments", "ship_date", batch, 0, full_refresh, reopened
    )
    gate.check(suites.shipment_feeds(log, lines, marts.shipment_totals(log, lines, window)))
    mart = _incremental(
        warehouse,
        "daily_shipments",
        lambda _: marts.daily_shipments(log, lines, window),
        "ship_date",
        batch,
        0,
        full_refresh,
        reopened,
    )
    gate.check(suites.daily_shipments(mart))
    return gate.publish(daily_shipments=mart)


def daily_payouts(
    warehouse: Warehouse,
    deliveries: DataFrame,
    adjustments: DataFrame,
    batch: int,
    full_refresh: bool = False,
) -> Published:
    headers = feeds.staged_upto(deliveries, specs.DELIVERIES, batch)
    lines = feeds.staged_upto(adjustments, specs.DELIVERY_ADJUSTMENTS, batch)
    arrived = feeds.staged_exact(adjustments, specs.DELIVERY_ADJUSTMENTS, batch)

    def reopened(since: date) -> DataFrame:
        return upsert.touched_dates(headers, arrived, ["delivery_id"], "delivery_date")

    gate = Gate("daily_payouts", warehouse.spark)
    window = upsert.run_window(
        warehouse.marts, "daily_payouts", "delivery_date", batch, marts.DELIVERY_SLA_DAYS, full_refresh,
        reopened,
    )
    gate.check(suites.delivery_feeds(headers, lines, marts.delivery_totals(headers, lines, window)))
    mart = _incremental(
        warehouse,
        "daily_payouts",
        lambda _: marts.daily_payouts(headers, lines, window),
        "delivery_date",
        batch,
        marts.DELIVERY_SLA_DAYS,
        full_refresh,
        reopened,
    )
    gate.check(suites.daily_payouts(mart, headers))
    return gate.publish(daily_payouts=mart)


def accounts(
    warehouse: Warehouse, versions: DataFrame, orders: DataFrame, batch: int, run_ts: str
) -> Published:
    seen = feeds.staged_upto(versions, specs.ACCOUNT_VERSIONS, batch)
    # Stored, as the checks and the snapshot each read it.
    latest = _whole(warehouse, "account_feed_latest", batch, marts.account_feed_latest(seen))
    placed = feeds.stage(orders, specs.ACCOUNT_ORDERS)
    gate = Gate("accounts", warehouse.spark)
    gate.check(suites.account_feeds(seen, placed, latest))
    history = snapshot.run_snapshot(
        warehouse.histories, marts.ACCOUNTS_SNAPSHOT, latest, batch, run_ts
    )
    gate.check(suites.accounts_history(history))
    current = _whole(warehouse, "accounts_current", batch, marts.accounts_current(history))
    attributed = _whole(
        warehouse, "orders_attributed", batch, marts.orders_attributed(placed, history, current)
    )
    gate.check(suites.accounts(current, attributed, placed, history))
    return gate.publish(history=history, accounts_current=current, orders_attributed=attributed)


def employees(
    warehouse: Warehouse, dumps: DataFrame, departments: DataFrame, batch: int, run_ts: str
) -> Published:
    dump = feeds.staged_exact(dumps, specs.EMPLOYEE_DUMP, batch)
    names = feeds.stage(departments, specs.DEPARTMENTS)
    gate = Gate("employees", warehouse.spark)
    gate.check(suites.employee_feeds(dump, names))
    history = snapshot.run_snapshot(
        warehouse.histories, marts.EMPLOYEES_SNAPSHOT, dump, batch, run_ts
    )
    view = marts.employee_history(history)
    gate.check(suites.employees_history(history, view, dump))
    current = _whole(warehouse, "employees_current", batch, marts.employees_current(view, dump))
    headcount = _whole(
        warehouse, "department_headcount", batch, marts.department_headcount(names, current, view)
    )
    gate.check(suites.employees(current, headcount, dump, names, history))
    return gate.publish(
        history=history,
        employee_history=view,
        employees_current=current,
        department_headcount=headcount,
    )


def daily_revenue(
    warehouse: Warehouse,
    customers: DataFrame,
    invoices: DataFrame,
    lines: DataFrame,
    payments: DataFrame,
    batch: int,
    run_ts: str,
    full_refresh: bool = False,
) -> Published:
    """``full_refresh`` rebuilds the mart only: the history cannot be rebuilt.

    Invoices are joined and checked one by one in the window that this run recomputes, earlier ones
    having passed before; totals are tied over everything, one column of each feed."""
    people = feeds.staged_exact(customers, specs.CUSTOMER_DUMP, batch)
    billed = feeds.staged_upto(invoices, specs.INVOICES, batch)
    detail = feeds.staged_upto(lines, specs.INVOICE_LINES, batch)
    paid = feeds.staged_upto(payments, specs.INVOICE_PAYMENTS, batch)
    gate = Gate("daily_revenue", warehouse.spark)
    gate.check(suites.billing_feeds(people, billed, detail, paid))
    history = snapshot.run_snapshot(
        warehouse.histories, marts.PLANS_SNAPSHOT, people, batch, run_ts
    )
    gate.check(suites.customers_history(history))
    arrived = feeds.staged_exact(lines, specs.INVOICE_LINES, batch).select("invoice_id").unionByName(
        feeds.staged_exact(payments, specs.INVOICE_PAYMENTS, batch).select("invoice_id")
    )
    dated = billed.select("invoice_id", F.to_date("invoiced_at").alias("invoice_date"))

    def reopened(since: date) -> DataFrame:
        return upsert.touched_dates(dated, arrived, ["invoice_id"], "invoice_date")

    since = upsert.run_window(
        warehouse.marts, "daily_revenue", "invoice_date", batch, marts.PAYMENT_SLA_DAYS, full_refresh,
        reopened,
    )
    # Stored, as the mart and its checks each read it.
    window = warehouse.marts.stage(
        "invoice_revenue", batch, marts.invoice_revenue(billed, detail, paid, history, since)
    )
    mart = _incremental(
        warehouse,
        "daily_revenue",
        lambda _: marts.daily_revenue(window),
        "invoice_date",
        batch,
        marts.PAYMENT_SLA_DAYS,
        full_refresh,
        reopened,
    )
    recent = billed if since is None else marts.invoices_since(billed, since)
    gate.check(suites.daily_revenue(window, mart, billed, detail, paid, history, recent))
    revenue = marts.invoice_revenue(billed, detail, paid, history)
    return gate.publish(history=history, invoice_revenue=revenue, daily_revenue=mart)


def merchant_month_payments(
    warehouse: Warehouse,
    orders: DataFrame,
    payments: DataFrame,
    methods: Sequence[str] | None,
    run: int = 1,
) -> Published:
    placed = feeds.stage(orders, specs.MERCHANT_ORDERS)
    tendered = feeds.stage(payments, specs.MERCHANT_PAYMENTS)
    captured = marts.captured_payments(tendered, placed)
    gate = Gate("merchant_month_payments", warehouse.spark)
    gate.check(suites.merchant_feeds(placed, tendered, captured))
    built = marts.merchant_month_payments(placed, tendered, methods)
    mart = _whole(warehouse, "merchant_month_payments", run, built)
    gate.check(suites.merchant_month_payments(mart, placed, tendered, methods))
    return gate.publish(captured_payments=captured, merchant_month_payments=mart)
